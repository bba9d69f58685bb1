"""Search documents, their term counts and the upsert into a stored index."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom import schemas
from pressloom.functions.text import tokenize
from pressloom.operators.select import latest_of_repeated, removed_fields
from pressloom.sources.tables import KEY_BUCKETS, merge_buckets


def to_search_doc(silver: DataFrame) -> DataFrame:
    """The 12 index fields of a silver row; rows without an id are not documents."""
    published = [F.col(c).cast("timestamp") for c in ("publishedAt", "published_at") if c in silver.columns]
    element = silver.schema["entities"].dataType.elementType
    texts = (
        F.transform("entities", lambda e: e.text) if isinstance(element, T.StructType) else F.col("entities")
    )
    none = F.array().cast("array<string>")
    columns = {
        "published_at": F.coalesce(*published),
        "sentiment_label": F.col("sentiment.label"),
        "sentiment_score_positive": F.col("sentiment.scores.positive"),
        "entities": F.coalesce(texts, none),
        "key_phrases": F.coalesce("keyPhrases", none),
    }
    return silver.filter(F.length("id") > 0).select(
        *[columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.SEARCH_DOC.fields]
    )


def upsert_index(docs: DataFrame, index_path: str, buckets: int = KEY_BUCKETS) -> dict[str, int]:
    """Merge or upload documents by id into the stored documents, in the folders of their ids alone.

    Documents whose id is blank are reported as failed and left out; of several documents with one
    id the most recently published wins.
    """
    keyed = F.coalesce(F.length("id") > 0, F.lit(False))
    counted = docs.agg(F.count(F.lit(1)).alias("total"), F.count_if(~keyed).alias("failed")).first()
    order = [F.desc_nulls_last("published_at"), F.asc_nulls_last("url"), F.asc_nulls_last("title")]
    merged = merge_buckets(latest_of_repeated(docs.filter(keyed), ["id"], order), index_path, ["id"], buckets=buckets)
    return {
        "total": counted["total"],
        "succeeded": counted["total"] - counted["failed"],
        "failed": counted["failed"],
        "inserted": merged["inserted"],
        "updated": merged["updated"],
    }


def schema_warnings(live: T.StructType, updated: T.StructType = schemas.SEARCH_DOC) -> list[str]:
    """What a schema update would silently lose."""
    return [f"field {name} exists in the live index but not in the new schema" for name in removed_fields(live, updated)]


#: Searchable fields and their weights (fixed values).
FIELD_WEIGHTS = {"title": 3.0, "body_snippet": 1.0, "key_phrases": 2.0, "entities": 2.0}


def field_texts(docs: DataFrame) -> dict[str, Column]:
    """The searchable fields of search documents as text."""
    return {
        name: F.array_join(name, " ") if isinstance(docs.schema[name].dataType, T.ArrayType) else F.col(name)
        for name in FIELD_WEIGHTS
    }


def field_tokens(docs: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """``id, field, tokens`` with sorted tokens; a row for every document and field, empty ones too."""
    none = F.array().cast("array<string>")
    per_field = [
        F.struct(F.lit(name).alias("field"), F.sort_array(F.coalesce(tokenize(text), none)).alias("tokens"))
        for name, text in fields.items()
    ]
    return docs.select("id", F.inline(F.array(*per_field)))


def build_postings(tokens: DataFrame) -> DataFrame:
    """``id, field, term, tf, len``: how often a term occurs in a field, and the field's length.

    Tokens are sorted within the row, so equal terms are neighbours and a count is the distance
    between two starts. All of it stays inside the row: counting needs no shuffle.
    """
    places = F.when(F.size("tokens") > 0, F.sequence(F.lit(0), F.size("tokens") - 1))
    starts = F.filter(places, lambda i: (i == 0) | (F.get("tokens", i) != F.get("tokens", i - 1)))
    runs = tokens.select("id", "field", "tokens", starts.alias("starts"))
    counted = F.transform(
        "starts",
        lambda start, nth: F.struct(
            F.get("tokens", start).alias("term"),
            (F.coalesce(F.get("starts", nth + 1), F.size("tokens")) - start).alias("tf"),
        ),
    )
    return runs.select("id", "field", F.size("tokens").alias("len"), F.inline(counted))


def term_frequencies(postings: DataFrame) -> DataFrame:
    """``field, term, df, occurrences``. Partial counts leave each task before a frequent term meets."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("occurrences"))


def field_stats(frequencies: DataFrame, n_docs: Column) -> DataFrame:
    """``field, n_docs, avg_len``: one row per field with any term; a document without terms has length 0."""
    totals = frequencies.groupBy("field").agg(F.sum("occurrences").alias("length"))
    return totals.select("field", n_docs.alias("n_docs"), (F.col("length") / n_docs).alias("avg_len"))


@dataclass(frozen=True)
class TextIndex:
    """What keyword scoring reads; ``buckets`` is the number of term buckets of stored postings."""

    postings: DataFrame
    frequencies: DataFrame
    stats: DataFrame
    buckets: int = 0


def text_index(docs: DataFrame, fields: Mapping[str, Column] | None = None) -> TextIndex:
    """Index of a document table as part of the plan: for one batch of requests over changing documents."""
    counted = build_postings(field_tokens(docs, fields or field_texts(docs)))
    frequencies = term_frequencies(counted)
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    return TextIndex(counted, frequencies, field_stats(frequencies, n_docs))


TERM_BUCKETS = 64


def term_bucket(term: Column, buckets: int = TERM_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_text_index(
    docs: DataFrame, path: str, fields: Mapping[str, Column] | None = None, buckets: int = TERM_BUCKETS
) -> TextIndex:
    """Store the index below ``path``, a new version folder; texts are analysed once.

    Postings lie in folders by term bucket, sorted by term, so a search opens only what its terms
    need. The folder of a frequent term is written by several tasks. Choose more buckets for more text.
    """
    spark = docs.sparkSession
    observation = Observation()
    watched = docs.observe(observation, F.count(F.lit(1)).alias("n_docs"))
    counted = build_postings(field_tokens(watched, fields or field_texts(docs)))
    bucketed = counted.withColumn("bucket", term_bucket(F.col("term"), buckets)).hint("rebalance", "bucket")
    bucketed.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(
        f"{path}/postings"
    )
    n_docs = F.lit(int(observation.get.get("n_docs") or 0))
    frequencies = term_frequencies(spark.read.parquet(f"{path}/postings"))
    frequencies.write.mode("overwrite").parquet(f"{path}/frequencies")
    stats = field_stats(spark.read.parquet(f"{path}/frequencies"), n_docs).withColumn("buckets", F.lit(buckets))
    stats.write.mode("overwrite").parquet(f"{path}/stats")
    return read_text_index(spark, path)


def read_text_index(spark: SparkSession, path: str) -> TextIndex:
    """A stored index, read with the number of buckets it was written with."""
    postings, frequencies, stats = [spark.read.parquet(f"{path}/{part}") for part in ("postings", "frequencies", "stats")]
    row = stats.select("buckets").first()
    return TextIndex(postings, frequencies, stats.drop("buckets"), row["buckets"] if row else TERM_BUCKETS)
