"""The operators as queries over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import ann, audit, codes, langid, licenses, linededup, mixing, neardup, packing, phrases, pieces, private, scoring
from pressloom.llm.common import table
from pressloom.session import tune

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    run.__doc__ = function.__doc__
    _QUERIES[function.__name__] = run
    return run


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


@query
def op1_mix_sources(spark, sf_dir):
    """How many words the mix takes of each document."""
    return mixing.mix_sizes(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op2_pack_sequences(spark, sf_dir):
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


@query
def op3_find_private(spark, sf_dir):
    """Spans of personal data in each document."""
    return private.find(table(spark, sf_dir, "documents"))


@query
def op4_nearest_vectors(spark, sf_dir):
    """The 20 nearest vectors found for every twentieth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query
def op5_scan_licenses(spark, sf_dir):
    """Licenses that each document names or quotes."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op6_phrase_fingerprints(spark, sf_dir):
    """Fingerprint of each document and of an edited copy, and how alike they are."""
    return phrases.fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_dedup_lines(spark, sf_dir):
    """Lines of each document, lines removed as repeats, and what is left."""
    left = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("left_sha256")
    return left.select("doc_id", "n_lines", "removed_lines", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("left_chars"), digest)


@query
def op8_identify_language(spark, sf_dir):
    """Language of every document, by a network that learned from two thirds of them."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op9_score_documents(spark, sf_dir):
    """Log probability of each document under a count model and under the Pitman-Yor model."""
    return scoring.score(table(spark, sf_dir, "documents"))


@query
def op10_near_duplicates(spark, sf_dir):
    """Group of near-duplicates of each document, over shingles of four words."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4).drop("tie")


@query
def op11_filter_audit(spark, sf_dir):
    """What five filters remove of each source in each of their 120 orders."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_sentence_pieces(spark, sf_dir):
    """Digests of each document's piece ids and of the text they decode to."""
    coded = pieces.encode(table(spark, sf_dir, "documents"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op13_vector_codes(spark, sf_dir):
    """Code of each vector's four parts and how far it is from what the code stands for."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = {
    "op1_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
), summed AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weights,
    coalesce(sum(source_size) OVER fuller, 0) AS size_before, coalesce(sum(weight) OVER fuller, 0) AS weight_before
  FROM weighed
  WINDOW fuller AS (ORDER BY source_size::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, (total - 3 * size_before)::DOUBLE / (all_weights - weight_before)::DOUBLE * weight > 3 * source_size AS capped FROM summed
), level AS (
  SELECT (max(total) - 3 * coalesce(sum(source_size) FILTER (WHERE capped), 0))::DOUBLE
    / nullif(coalesce(sum(weight) FILTER (WHERE NOT capped), 0), 0)::DOUBLE AS share FROM marked
), targets AS (
  SELECT source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE share * weight END AS target,
    ('0x' || substr(md5('mix' || CASE WHEN source IS NULL THEN '-' ELSE '+' END || coalesce(source, '')), 1, 5))::BIGINT::DOUBLE / 1048576 AS start
  FROM marked, level
), numbered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.start,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    (row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) - 1)::DOUBLE AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), counted AS (
  SELECT *, (floor(start + (place + 1) * rate) - floor(start + place * rate))::BIGINT AS copies FROM numbered
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM counted
""",
    "op5_scan_licenses": licenses.oracle(),
    "op11_filter_audit": audit.ORACLE,
    "op13_vector_codes": codes.oracle(),
    "op10_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
}


def oracle_registry() -> dict[str, str]:
    return dict(ORACLE_SQL)
