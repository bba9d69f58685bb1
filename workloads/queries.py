"""Every operator as a query over the test tables. Names are the keys of ``queries()``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions import paths, pii, text
from pressloom.operators import cells, enrich, gold, governance, index, matching, monitor, pages, requests, search, segments, select
from pressloom.plans.enrich_job import run_enrich
from pressloom.plans.gold_job import gold_tables, run_gold
from pressloom.plans.refresh_job import refresh_index
from pressloom.session import scratch_path
from pressloom.sources import articles as sources
from pressloom.sources import publish, tables
from pressloom.sources.files import Folder
from pressloom.streaming import ingest, live
from workloads import tables as t

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}

#: The whole span of the test articles: look-back and keyword windows that together cover every day.
LOOKBACK, KEYWORD_WINDOW = t.DAYS, t.DAYS // 2
#: Words of the invented prose that stand for polar words.
LEXICON = enrich.Lexicon(positive=("with", "for", "that", "avec", "mit", "con"), negative=("not", "was", "this", "pas", "nicht", "por"))
EMBED_DIMS = 64
#: Term buckets that suit some million postings.
BUCKETS = 8
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def registry() -> dict[str, Query]:
    return dict(_registry)


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Days and instants as text, ranks as bigint: the same in every engine."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, TS_FORMAT)
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _as_of() -> F.Column:
    return F.lit(t.AS_OF).cast("timestamp")


def _write_silver(silver, root):
    rows = silver.drop("doc_id").withColumn("publishedAt", F.date_format("publishedAt", TS_FORMAT))
    tables.write_partitioned(rows, root, "category", "article_date")


# --- gold ---------------------------------------------------------------------------------------


@query
def sentiment_trends(spark, sf_dir):
    recent = select.rolling_window(gold.project_silver(t.silver(spark, sf_dir)), "article_date", t.LAST_DAY, LOOKBACK)
    return _dates_as_text(select.present(gold.sentiment_trends(recent, t.LAST_DAY), "category", "article_date"))


@query
def sentiment_rolling(spark, sf_dir):
    return _dates_as_text(gold.sentiment_rolling(gold.project_silver(t.silver(spark, sf_dir))))


@query
def top_entities(spark, sf_dir):
    return _dates_as_text(gold.top_entities(gold.project_silver(t.silver(spark, sf_dir)), t.LAST_DAY))


@query
def top_entities_articles(spark, sf_dir):
    projected = gold.project_silver(t.silver(spark, sf_dir))
    return _dates_as_text(gold.top_entities(projected, t.LAST_DAY, count_mode="articles"))


@query
def trending_keywords(spark, sf_dir):
    projected = gold.project_silver(t.silver(spark, sf_dir))
    return _dates_as_text(gold.trending_keywords(projected, t.LAST_DAY, KEYWORD_WINDOW))


@query
def data_quality(spark, sf_dir):
    return gold.data_quality(t.silver(spark, sf_dir), "silver")


@query
def date_spine(spark, sf_dir):
    """Articles per category and day, days without any included."""
    spine = select.date_spine(spark, t.FIRST_DAY, t.LAST_DAY, t.CATEGORIES)
    counts = t.articles(spark, sf_dir).groupBy("category", "article_date").agg(F.count(F.lit(1)).alias("n"))
    joined = spine.join(counts, ["category", "article_date"], "left")
    return _dates_as_text(joined.withColumn("n", F.coalesce("n", F.lit(0))))


@query
def gold_job(spark, sf_dir):
    """The nightly job end to end: silver written by day, three tables replaced twice, read back."""
    root = scratch_path(spark, "gold")
    _write_silver(t.silver(spark, sf_dir), f"{root}/silver")
    for _ in range(2):
        run_gold(spark, f"{root}/silver", f"{root}/gold", t.LAST_DAY, LOOKBACK, KEYWORD_WINDOW, t.CATEGORIES)
    return _dates_as_text(
        spark.read.parquet(f"{root}/gold/trending_keywords").select(
            "category", "key_phrase", "count_current", "count_prior", "trend_score", "rank"
        )
    )


# --- text and paths -----------------------------------------------------------------------------


@query
def url_hash(spark, sf_dir):
    padded = F.concat(F.lit(" \t"), F.col("url"), F.lit("\n "))
    return t.table(spark, sf_dir, "pages").select(
        "page_id", text.url_hash("url").alias("url_hash"), text.url_hash(padded).alias("padded_hash")
    )


@query
def extract_text(spark, sf_dir):
    """HTML pages as article content, with the truncation marker a news provider appends."""
    content = F.concat(F.col("html"), F.lit(" [+"), F.length("html").cast("string"), F.lit(" chars] \n"))
    pages = t.pages(spark, sf_dir).select("page_id", content.alias("content"), F.col("url").alias("title"))
    return pages.select(
        "page_id",
        text.extract_text("content", F.lit(None).cast("string"), "title").alias("text"),
        text.content_truncated("content").alias("truncated"),
    )


@query
def source_names(spark, sf_dir):
    """Articles per publisher, whose name comes as a field of a struct or as plain text; those without URL are told apart."""
    found = t.articles(spark, sf_dir).withColumn("url", F.when(F.pmod("doc_id", F.lit(11)) > 0, F.col("url")))
    known, unknown = sources.split_missing_url(found)
    owner = F.struct(F.lit(None).cast("string").alias("id"), F.col("source").alias("name")).alias("source")
    named = known.select(owner)
    named = named.select(text.source_name("source", named.schema["source"].dataType).alias("name"), F.lit(True).alias("usable"))
    plain = unknown.select(text.source_name("category", T.StringType()).alias("name"), F.lit(False).alias("usable"))
    return named.union(plain).groupBy("name", "usable").agg(F.count(F.lit(1)).alias("n"))


@query
def text_source(spark, sf_dir):
    """Conversation turns: assistants supply the content, users the description, the rest a title only."""
    turns = t.table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", F.col("text")).otherwise(F.lit("  ")).alias("content"),
        F.when(F.col("role") == "user", F.col("text")).alias("description"),
        F.concat(F.lit(" "), F.col("role"), F.lit("\t")).alias("title"),
    )
    best = text.extract_text("content", "description", "title")
    return turns.select(
        "conv_id",
        "turn",
        text.text_source("content", "description").alias("text_source"),
        text.body_snippet(best).alias("body_snippet"),
    )


@query
def truncate_words(spark, sf_dir):
    cut = text.truncate_words("text")
    return t.documents(spark, sf_dir).select("doc_id", F.length(cut).alias("chars").cast("bigint"), F.md5(cut).alias("digest"))


@query
def embedding_input(spark, sf_dir):
    joined = text.embedding_input("title", text.body_snippet("text"))
    return t.articles(spark, sf_dir).select("id", F.length(joined).cast("bigint").alias("chars"), F.md5(joined).alias("digest"))


@query
def strip_publisher(spark, sf_dir):
    headline = F.concat(F.col("title"), F.lit(" - "), F.when(F.pmod("doc_id", F.lit(2)) == 0, F.col("source")).otherwise("else"))
    return t.articles(spark, sf_dir).select("id", text.strip_publisher(headline, "source").alias("headline"))


@query
def parse_paths(spark, sf_dir):
    events = t.file_events(t.table(spark, sf_dir, "events"))
    path = paths.path_from_subject("subject")
    parsed = events.select(
        "event_id", paths.container_from_subject("subject").alias("container"), path.alias("path"),
        paths.parse_bronze_path(path).alias("p"),
    )
    day = F.col("p.date_str")
    return parsed.select(
        "event_id", "container", "path", F.col("p.category").alias("category"), day.alias("date_str"),
        F.col("p.url_hash").alias("url_hash"), paths.valid_date(day).alias("date_ok"),
    )


@query
def tokens(spark, sf_dir):
    """Terms of the corpus after analysis, with document frequency."""
    words = t.articles(spark, sf_dir).select("id", F.explode(F.array_distinct(text.tokenize("text"))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


# --- ingest, dedup, tables ----------------------------------------------------------------------


@query
def latest_per_key(spark, sf_dir):
    events = t.table(spark, sf_dir, "events")
    newest = select.latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return newest.select("user_id", "event_id", "event_type", "value")


@query
def envelope_explode(spark, sf_dir):
    """Each turn as a response envelope: its lines are articles; system turns are failed responses."""
    line = F.split("text", "\n")
    envelopes = t.table(spark, sf_dir, "conversations").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("category"),
        F.when(F.col("role") == "system", "error").otherwise("ok").alias("status"),
        F.lit("rateLimited").alias("code"),
        F.col("role").alias("message"),
        F.transform(
            line, lambda x, i: F.struct(x.alias("title"), F.when(F.length(x) > 40, F.concat(F.lit("u"), i)).alias("url"))
        ).alias("articles"),
    )
    found, failed = sources.explode_envelopes(envelopes)
    usable, unusable = sources.split_missing_url(found)
    return select.union_sources(
        [
            usable.select(F.lit("article").alias("kind"), "category", "title", "url"),
            unusable.select(F.lit("no_url").alias("kind"), "category", "title"),
            failed.select(F.lit("failed").alias("kind"), "category", F.col("message").alias("title"), F.col("code").alias("url")),
        ]
    )


@query
def bronze_latest(spark, sf_dir):
    """Two polls of one day into bronze; the second overwrites what it repeats."""
    root = scratch_path(spark, "bronze")
    first = t.articles(spark, sf_dir).select(
        "id", "category", "title", F.col("text").alias("content"), F.lit("2024-01-31T06:00:00Z").alias("ingested_at")
    )
    second = first.filter(F.length("content") > 1000).select(
        "id", "category", F.concat(F.lit("Update: "), "title").alias("title"), "content", F.lit("2024-01-31T12:00:00Z").alias("ingested_at")
    )
    for poll in (first, second):
        tables.write_bronze(poll, root, t.AS_OF.date())
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("title", "content", "ingested_at")])
    stored = sources.read_bronze(spark, root, ingest_date=t.AS_OF.date(), schema=schema)
    return tables.current_bronze(stored).select("id", "category", "title", "ingested_at")


@query
def dedup_new(spark, sf_dir):
    """First announcement per file, without the users whose files the ingest table knows from errors."""
    events = t.table(spark, sf_dir, "events")
    key = F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 16)
    known = tables.dedup_rows(
        events.filter((F.col("event_type") == "error") & (F.col("value") > 90)).select(
            key.alias("url_hash"), F.lit("").alias("url"), F.lit("user").alias("category"), F.col("ts").alias("ingested_at")
        )
    )
    announced = events.select(key.alias("url_hash"), F.col("ts").cast("timestamp").alias("ingested_at"))
    return _dates_as_text(matching.drop_seen(announced, known))


@query
def new_only(spark, sf_dir):
    """Pending articles without silver; every article is announced twice."""
    pending = t.articles(spark, sf_dir).select(
        "category", "article_date", "id",
        F.explode(F.array(F.lit("a"), F.lit("b"))).alias("ingested_at"),
    )
    enriched = t.silver(spark, sf_dir).filter(F.col("nlpStatus") == "ok")
    return _dates_as_text(matching.new_only(pending, enriched))


def _candidates(spark, sf_dir):
    enriched = t.silver(spark, sf_dir).filter(F.col("nlpStatus") == "ok")
    bronze = t.articles(spark, sf_dir)
    return matching.backfill_candidates(bronze, enriched, t.FIRST_DAY, t.LAST_DAY, t.CATEGORIES)


@query
def backfill_candidates(spark, sf_dir):
    return _dates_as_text(_candidates(spark, sf_dir))


@query
def backfill_stats(spark, sf_dir):
    return matching.backfill_stats(_candidates(spark, sf_dir))


@query
def backfill_sample(spark, sf_dir):
    return matching.backfill_sample(_candidates(spark, sf_dir))


@query
def merge_upsert(spark, sf_dir):
    """Customers, upserted with suppliers on a key that half of them share."""
    path = scratch_path(spark, "merge")
    target = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    source = t.table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 30).alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    tables.merge_buckets(target, path, ["key"], buckets=BUCKETS)
    for _ in range(2):
        tables.merge_buckets(source, path, ["key"], ["balance"])
    return tables.bucketed_table(spark, path)


@query
def merge_counts(spark, sf_dir):
    """What an upsert of suppliers into customers reports."""
    customers = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    suppliers = t.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 30).alias("key"), F.col("s_name").alias("name"))
    merged = tables.merge_rows(customers, suppliers, ["key"])
    return merged.groupBy(F.col("_change").alias("change")).agg(F.count(F.lit(1)).alias("n"))


@query
def overwrite_partition(spark, sf_dir):
    """One partition per category, each replaced by its articles' hashes after a first, other version."""
    path = scratch_path(spark, "overwrite")
    found = t.articles(spark, sf_dir).select("id", "category", text.url_hash("url").alias("url_hash"))
    for category in t.CATEGORIES:
        part = found.filter(F.col("category") == category)
        tables.overwrite_partition(part.withColumn("url_hash", F.lit("old")), path, "category", category)
        tables.overwrite_partition(part, path, "category", category)
    return spark.read.parquet(path)


@query
def audit_rows(spark, sf_dir):
    path = scratch_path(spark, "audit")
    events = t.logs(spark, sf_dir).withColumn("url_hash", text.url_hash(F.col("user_id").cast("string")))
    tables.append_audit(tables.audit_rows(events, "enrich_queued", ["message", "event_id"]), path)
    days = [tables.audits_by_date(spark, path, t.FIRST_DAY + timedelta(days=n)) for n in range(t.DAYS)]
    return _dates_as_text(select.union_sources(days).select("rowKey", "urlHash", "event", "details", "audit_date"))


@query
def error_rows(spark, sf_dir):
    failed = t.silver(spark, sf_dir).filter(F.col("nlpStatus") == "failed").select(
        "id", paths.bronze_path("category", "article_date", "id").alias("blobPath"), "category", "article_date",
        F.lit("no label").alias("error"), F.lit("enrichment").alias("stage"), F.lit("2024-01-31").alias("failed_at"),
    )
    rows = tables.error_rows(failed)
    return _dates_as_text(rows.select("urlHash", "blobPath", "errorMeta.error", "errorMeta.stage", "category", "article_date"))


def _pending(spark, sf_dir):
    path = scratch_path(spark, "pending")
    announced = ingest.bronze_events(t.file_events(t.table(spark, sf_dir, "events")))
    tables.write_pending(announced, path)
    return path


@query
def peek_pending(spark, sf_dir):
    seen = tables.peek_pending(spark, _pending(spark, sf_dir), 10)
    return seen.select("blobPath", "urlHash", "category", F.date_format("enqueued_at", TS_FORMAT).alias("enqueued_at"))


@query
def pending_depth(spark, sf_dir):
    depth = tables.pending_depth(spark, _pending(spark, sf_dir))
    return spark.range(1).select(F.lit(depth).cast("bigint").alias("depth"))


@query
def merge_annotations(spark, sf_dir):
    """Three annotators that each answer for other articles."""
    found = t.silver(spark, sf_dir)
    merged = matching.merge_annotations(
        found.select("id", "category"),
        found.filter(F.col("sentiment").isNotNull()).select("id", F.col("sentiment.label").alias("sentiment")),
        found.filter(F.col("hasPii")).select("id", F.col("entities.text").alias("entities")),
        found.filter(F.length("body_snippet") > 2000).select("id", "keyPhrases"),
    )
    return merged.select(
        "id", "nlpStatus", "nlpError", "sentiment",
        F.size("entities").cast("bigint").alias("n_entities"), F.size("keyPhrases").cast("bigint").alias("n_phrases"),
    )


# --- enrichment ---------------------------------------------------------------------------------


@query
def sentiment_lexicon(spark, sf_dir):
    scored = t.articles(spark, sf_dir).select("id", enrich.score_sentiment("text", LEXICON).alias("s"))
    rounded = [F.round(F.col(f"s.scores.{n}"), 6).alias(n) for n in ("positive", "negative", "neutral")]
    return scored.select("id", F.col("s.label").alias("label"), *rounded)


def _gazetteer(spark, sf_dir):
    """Names in the benchmark texts: capitalised words, and the two words each text opens with."""
    words = F.array_append(
        F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{L}+"), F.lit(0)), F.regexp_extract("text", r"^\p{L}+ \p{L}+", 0)
    )
    names = t.table(spark, sf_dir, "benchmark").select(F.explode(words).alias("name")).filter(F.col("name") != "").distinct()
    return names.select(
        "name",
        F.when(F.pmod(F.length("name"), F.lit(2)) == 0, "Organization").otherwise("Person").alias("category"),
        F.lit(None).cast("string").alias("subcategory"),
    )


@query
def entities_extract(spark, sf_dir):
    texts = t.articles(spark, sf_dir).select("id", "text")
    found = enrich.extract_entities(enrich.cluster_by_id(texts), _gazetteer(spark, sf_dir))
    listed = F.array_join(F.transform("entities", lambda e: F.concat_ws(":", e.category, e.text)), "|")
    return found.select("id", listed.alias("entities"), pii.has_pii("entities").alias("has_pii"))


@query
def rake_phrases(spark, sf_dir):
    texts = enrich.cluster_by_id(t.articles(spark, sf_dir).select("id", "text"))
    return _dates_as_text(enrich.top_phrases(texts))


@query
def hashed_embedding(spark, sf_dir):
    embedded = enrich.embed(t.articles(spark, sf_dir).select("id", F.col("text").alias("embedding_text")), EMBED_DIMS)
    norm = F.sqrt(F.aggregate(F.transform("content_vector", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, x: a + x))
    return embedded.select(
        "id", "vectorStatus", F.size("content_vector").cast("bigint").alias("dims"), F.round(norm, 4).alias("norm")
    )


@query
def enrich_end_to_end(spark, sf_dir):
    """Bronze articles and pending references to silver, by the whole job."""
    root = scratch_path(spark, "enrich")
    found = t.articles(spark, sf_dir)
    bronze = found.select(
        "id", "category", "article_date", "url", "title", F.col("text").alias("content"),
        F.lit(None).cast("string").alias("description"), "source", F.lit(None).cast("string").alias("author"),
        F.col("published_at").cast("string").alias("publishedAt"),
    )
    announced = found.select(
        paths.bronze_path("category", "article_date", "id").alias("blobPath"), F.col("id").alias("urlHash"), "category",
        F.lit("2024-01-31T00:00:00Z").alias("ingestedAt"),
    )

    def annotator(prepared):
        return enrich.annotate(prepared, LEXICON, dims=EMBED_DIMS)

    run_enrich(spark, announced, bronze, f"{root}/silver", f"{root}/work", "1", annotator, _as_of())
    return sources.read_silver(spark, f"{root}/silver").select(
        "id",
        "category",
        "nlpStatus",
        F.col("sentiment.label").alias("sentiment_label"),
        F.size("entities").cast("bigint").alias("n_entities"),
        "hasPii",
        F.get("keyPhrases", F.lit(0)).alias("top_phrase"),
        F.size("keyPhrases").cast("bigint").alias("n_phrases"),
        "vectorStatus",
    )


# --- index and search ---------------------------------------------------------------------------


def _silver_with_vectors(spark, sf_dir):
    return t.attached(t.silver(spark, sf_dir), t.vectors(spark, sf_dir).drop("label"))


@query
def search_docs(spark, sf_dir):
    docs = index.to_search_doc(_silver_with_vectors(spark, sf_dir))
    first_entity = F.get("entities", F.lit(0))
    return _dates_as_text(
        docs.select(
            "id", "url", "title", "source", "category", "published_at", "sentiment_label",
            F.round("sentiment_score_positive", 6).alias("sentiment_score_positive"),
            F.size("entities").alias("n_entities"), first_entity.alias("first_entity"),
            F.size("key_phrases").alias("n_key_phrases"), F.size("content_vector").alias("dims"),
        )
    )


@query
def index_upsert(spark, sf_dir):
    """All documents into the index, then a second version of the negative ones, read through the published view."""
    path = scratch_path(spark, "index")
    docs = index.to_search_doc(_silver_with_vectors(spark, sf_dir))
    index.upsert_index(docs, path, BUCKETS)
    changed = docs.filter(F.col("sentiment_label") == "negative").withColumn("title", F.concat(F.lit("Update: "), "title"))
    index.upsert_index(changed, path)
    publish.publish(spark, "pressloom_index", path)
    published = spark.table("pressloom_index")
    return _dates_as_text(published.select("id", "title", "category", "published_at", "sentiment_label"))


@query
def index_refresh(spark, sf_dir):
    """The refresh job from silver stored by day, for two spans of days that overlap; documents and terms of the index."""
    root = scratch_path(spark, "refresh")
    _write_silver(t.silver(spark, sf_dir), f"{root}/silver")
    for first, last in ((t.FIRST_DAY, t.FIRST_DAY + timedelta(days=19)), (t.FIRST_DAY + timedelta(days=14), t.LAST_DAY)):
        refresh_index(spark, f"{root}/silver", f"{root}/index", last, t.CATEGORIES, first, f"{root}/terms", BUCKETS)
    docs = spark.read.parquet(f"{root}/index")
    found = segments.open_index(spark, f"{root}/terms").forward().select("id", F.element_at("lens", 1).alias("title_terms"))
    return _dates_as_text(docs.join(found, "id", "left").select("id", "category", "published_at", "sentiment_label", "title_terms"))


@query
def index_stats(spark, sf_dir):
    path = scratch_path(spark, "index")
    index.upsert_index(index.to_search_doc(_silver_with_vectors(spark, sf_dir)), path, BUCKETS)
    stats = publish.index_stats(spark, path)
    return stats.select("document_count", (F.col("storage_bytes") > 0).alias("has_bytes"))


def _texts(spark, sf_dir):
    """The searchable fields of all articles."""
    return index.to_search_doc(_silver_with_vectors(spark, sf_dir))


_built: dict[tuple[str, str], str] = {}


def _index_path(spark, sf_dir):
    """Build the search index, documents and segments, once per session and folder of tables.

    The index is a stored table that many searches share; ``index_build`` is the query that times it.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built or not Folder(spark, _built[key]).exists():
        _built[key] = _build_index(spark, sf_dir)
    return _built[key]


def _build_index(spark, sf_dir):
    path = scratch_path(spark, "corpus")
    t.search_corpus(spark, sf_dir).write.option("compression", "zstd").parquet(f"{path}/docs")
    segments.refresh(spark.read.parquet(f"{path}/docs"), f"{path}/terms", buckets=BUCKETS)
    return path


def _stored_index(spark, sf_dir):
    path = _index_path(spark, sf_dir)
    return spark.read.parquet(f"{path}/docs"), segments.open_index(spark, f"{path}/terms")


@query
def index_build(spark, sf_dir):
    """The whole index build: documents stored, texts analysed, postings and statistics stored."""
    path = _built[(spark.sparkContext.applicationId, sf_dir)] = _build_index(spark, sf_dir)
    found = segments.open_index(spark, f"{path}/terms")
    per_field = found.frequencies().groupBy("field").agg(F.sum("df").alias("postings"), F.sum("occurrences").alias("tokens"))
    return per_field.join(found.stats(), "field").select(
        "field", "postings", "tokens", "n_docs", F.round("avg_len", 6).alias("avg_len")
    )


@query
def corpus_stats(spark, sf_dir):
    stats = index.text_index(_texts(spark, sf_dir)).stats
    return stats.select("field", "n_docs", F.round("avg_len", 6).alias("avg_len"))


@query
def postings(spark, sf_dir):
    """Term statistics of the index: per field and term, documents and occurrences."""
    return index.text_index(_texts(spark, sf_dir)).frequencies


def _plain_requests(spark, sf_dir):
    """Benchmark texts as requests without filters and freshness: plain relevance."""
    none = F.lit(None).cast("string")
    return t.requests(spark, sf_dir).select(
        "query_id", "q", F.lit(10).alias("top"), none.alias("category"), none.alias("source"), none.alias("sentiment"),
        F.lit(True).alias("semantic"), F.lit(False).alias("vector"), none.alias("date_from"), none.alias("date_to"), "qvec",
    )


@query
def bm25_top(spark, sf_dir):
    _, stored = _stored_index(spark, sf_dir)
    return _dates_as_text(pages.BlockMatches(_plain_requests(spark, sf_dir), stored, _as_of()).best(F.lit(10)))


@query
def segment_refresh(spark, sf_dir):
    """Three daily refreshes of a stored index, each with new articles, updates and deletes, and what is then found."""
    path = scratch_path(spark, "segments")
    docs = _texts(spark, sf_dir)
    number, day = F.col("id").cast("bigint"), F.dayofmonth("published_at")
    segments.refresh(docs.where(day <= 27), path, buckets=BUCKETS)
    for nth in range(3):
        updated = docs.where((day <= 27) & (number % 20 == nth)).withColumn("title", F.concat(F.lit("Update: "), "title"))
        deleted = docs.where((day <= 27) & (number % 23 == nth)).select("id")
        segments.refresh(docs.where(day == 28 + nth).unionByName(updated), path, deleted, buckets=BUCKETS)
    found = pages.BlockMatches(_plain_requests(spark, sf_dir), segments.open_index(spark, path), _as_of())
    return _dates_as_text(found.best(F.lit(10)))


def _open_requests(spark, sf_dir):
    """Benchmark texts as valid requests in all four modes; odd ones filter by category and dates."""
    odd = F.pmod("query_id", F.lit(2)) == 1
    none = F.lit(None).cast("string")
    return t.requests(spark, sf_dir).select(
        "query_id", "q", F.lit(10).alias("top"), F.when(odd, F.lit("en")).alias("category"), none.alias("source"),
        none.alias("sentiment"), (F.pmod("query_id", F.lit(4)) >= 2).alias("semantic"), (F.pmod("query_id", F.lit(3)) != 0).alias("vector"),
        F.when(odd, F.lit("2024-01-05")).alias("date_from"), none.alias("date_to"), "qvec",
    )


def _mean_requests(found):
    """The mean vector of each label as a request."""
    return (
        found.select("label", F.posexplode("content_vector").alias("place", "x"))
        .groupBy("label", "place")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("m"))
        .select(F.col("label").cast("bigint").alias("query_id"), F.transform("m", lambda p: p.x).alias("qvec"))
    )


@query
def knn_top(spark, sf_dir):
    """Nearest vectors to the mean vector of each label."""
    found = t.vectors(spark, sf_dir)
    ranked = search.knn(_mean_requests(found), found.select("id", "content_vector"), 20)
    return _dates_as_text(ranked.withColumn("score", F.round("score", 6)))


@query
def knn_cells(spark, sf_dir):
    """The same from vectors stored by cell, with exact answers."""
    found = t.vectors(spark, sf_dir)
    store = cells.write_cells(found.select("id", "content_vector"), scratch_path(spark, "cells"))
    ranked = cells.knn_cells(_mean_requests(found), store, 20, exact=True)
    return _dates_as_text(ranked.withColumn("score", F.round("score", 6)))


@query
def knn_recall(spark, sf_dir):
    """Whether stored cells find nine tenths of the 20 nearest vectors of every twentieth vector."""
    found = t.vectors(spark, sf_dir)
    store = cells.write_cells(found.select("id", "content_vector"), scratch_path(spark, "cells"))
    asked = found.select(F.col("id").cast("bigint").alias("query_id"), F.col("content_vector").alias("qvec")).where(F.col("query_id") % 20 == 0)
    best = search.knn(asked, found.select("id", "content_vector"), 20).select("query_id", "id")
    hits = cells.knn_cells(asked, store, 20).select("query_id", "id", F.lit(1).alias("hit"))
    counted = best.join(hits, ["query_id", "id"], "left")
    return counted.agg(F.countDistinct("query_id").alias("n_queries"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("reached"))


def _matches(spark, sf_dir):
    """Requests, documents and the requests' keyword matches by blocks of the stored index."""
    asked = _open_requests(spark, sf_dir)
    docs, stored = _stored_index(spark, sf_dir)
    return asked, docs, pages.BlockMatches(asked, stored, _as_of())


@query
def rrf_hybrid(spark, sf_dir):
    """Pages in all modes: boosted BM25 or BM25 and vectors, fused; semantic requests reranked over all fields."""
    asked, docs, matches = _matches(spark, sf_dir)
    results = search.search(asked, docs, _as_of(), matches=matches)
    return _dates_as_text(results.select("query_id", "rank", "id", "score", "warning"))


@query
def rerank(spark, sf_dir):
    """The best 50 by BM25, reordered by weighted term overlap over all fields."""
    asked = _plain_requests(spark, sf_dir)
    docs, stored = _stored_index(spark, sf_dir)
    best = pages.BlockMatches(asked, stored, _as_of()).best(F.lit(search.RERANK_CANDIDATES))
    candidates = best.join(asked.select("query_id", "q"), "query_id")
    found = docs.drop("content_vector").join(search.request_side(asked, candidates), "id")
    reordered = search.rerank(found, search.token_overlap(F.col("q"), index.field_texts(docs)))
    return _dates_as_text(reordered.select("query_id", "rank", "id", "score"))


@query
def facets(spark, sf_dir):
    """Facets and totals of every request over its whole filtered match set."""
    _, _, matches = _matches(spark, sf_dir)
    counts = matches.counts()
    total = search.total_counts(counts).select(
        "query_id", F.lit("total").alias("facet"), F.lit("").alias("value"), F.col("count").alias("n"), F.lit(1).alias("rank")
    )
    return _dates_as_text(search.facets(counts).unionByName(total))


@query
def search_report(spark, sf_dir):
    asked, docs, matches = _matches(spark, sf_dir)
    results = search.search(asked, docs, _as_of(), matches=matches)
    report = search.search_report(asked, results, matches.counts())
    ids = F.array_join(F.transform("results", lambda r: r.id), "|")
    facet = F.array_join(F.transform("facets", lambda f: F.concat_ws(":", f.facet, f.value, f.n.cast("string"))), "|")
    return report.select("query_id", F.col("query.vector").alias("vector"), "count", ids.alias("ids"), facet.alias("facets"), "warning")


@query
def filter_docs(spark, sf_dir):
    """One request's literal filters, entity membership included, sorted by date."""
    docs = t.search_corpus(spark, sf_dir)
    kept = requests.apply_filters(
        docs, category="en", sentiment="positive", date_from="2024-01-03", date_to="2024-01-28", entity="The"
    )
    page = requests.format_results(select.sort_by(kept, "published_at").withColumn("score", F.lit(1.0)))
    return _dates_as_text(
        page.select(
            "score", "id", "url", "source", "category", "publishedAt", "sentimentLabel",
            F.round("sentimentScore", 6).alias("sentimentScore"), F.size("entities").alias("n_entities"),
            F.size("keyPhrases").alias("n_phrases"),
        )
    )


@query
def validate_queries(spark, sf_dir):
    """Benchmark texts as raw requests whose parameters break each rule in turn."""
    kind = F.pmod("item_id", F.lit(12))

    def pick(**cases):
        chosen = F.lit(None).cast("string")
        for number, value in cases.items():
            chosen = F.when(kind == int(number[1:]), value if isinstance(value, F.Column) else F.lit(value)).otherwise(chosen)
        return chosen

    raw = t.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.coalesce(pick(_0=" \t ", _1=F.repeat("text", 10)), F.concat(F.lit(" "), "text", F.lit("\n"))).alias("q"),
        pick(_2="51", _3="abc", _4="0", _5="25", _6=" 7 ").alias("top"),
        pick(_5=" EN ", _7="sports").alias("category"),
        pick(_5=" src1 ", _6=" ").alias("source"),
        pick(_5="Positive", _8="happy").alias("sentiment"),
        pick(_5="true", _6="1", _7="yes").alias("semantic"),
        pick(_5="false", _6="0", _7="no").alias("vector"),
        pick(_5="2024-01-01", _9="15-01-2024", _11="2024-02-01").alias("date_from"),
        pick(_5="2024-01-31", _10="2024/01/01", _11="2024-01-01").alias("date_to"),
    )
    return _dates_as_text(requests.validate_queries(raw, t.CATEGORIES))


# --- governance ---------------------------------------------------------------------------------


def _scanned(spark, sf_dir):
    raw = t.articles(spark, sf_dir).select("id", "title", "text")
    # Words in "er" stand for the names of persons.
    person = F.transform("entities", lambda e: e.withField("category", F.when(e.text.endswith("er"), "Person").otherwise(e.category)))
    enriched = t.silver(spark, sf_dir).select("id", "hasPii", F.col("body_snippet").alias("text"), person.alias("entities"))
    return governance.scan({"bronze": raw, "silver": enriched, "gold": raw})


@query
def pii_classify(spark, sf_dir):
    return _scanned(spark, sf_dir).select("layer", "id", F.array_join("labels", "|").alias("labels"), "sensitivity")


@query
def classification_report(spark, sf_dir):
    return governance.classification_report(_scanned(spark, sf_dir))


@query
def lineage_edges(spark, sf_dir):
    """Edges of the three registered processes with the rows each one moved."""
    found = t.silver(spark, sf_dir).agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("nlpStatus") == "ok").alias("ok")).first()
    moved = {"ingest": found["all"], "enrich": found["all"], "index-refresh": found["ok"]}
    path = scratch_path(spark, "lineage")
    for process, inputs, outputs in governance.PROCESSES:
        governance.record_lineage(governance.lineage_edges(spark, "run-1", process, inputs, outputs, moved[process]), path)
    return spark.read.schema(governance.LINEAGE).parquet(path)


@query
def lineage_reach(spark, sf_dir):
    """Assets downstream of one source: source to category, category to day."""
    found = t.articles(spark, sf_dir)
    day = F.col("article_date").cast("string")
    edges = found.select(F.col("source").alias("input"), F.col("category").alias("output")).unionAll(
        found.select(F.col("category").alias("input"), day.alias("output"))
    )
    return _dates_as_text(governance.reachable(edges, "src1"))


# --- monitoring ---------------------------------------------------------------------------------


@query
def errors_by_message(spark, sf_dir):
    return monitor.errors_by_message(t.logs(spark, sf_dir), datetime(2024, 1, 31), hours=24 * t.DAYS)


@query
def hourly_count(spark, sf_dir):
    return _dates_as_text(monitor.hourly_count(t.logs(spark, sf_dir), "err"))


@query
def hourly_latency(spark, sf_dir):
    return _dates_as_text(monitor.hourly_latency(t.logs(spark, sf_dir), "$.k"))


def _sketch_report(spark, sf_dir, hours):
    """Stored hourly sketches merged to days and these to weeks; whether each 95th percentile is within one percent of ranks."""
    days = monitor.rollup_latency(hours)
    both = monitor.sketched_latency(days).withColumn("span", F.lit("day")).union(
        monitor.sketched_latency(monitor.rollup_latency(days, "7 days")).withColumn("span", F.lit("week"))
    )
    values = t.logs(spark, sf_dir).select("ts", F.get_json_object("props", "$.k").try_cast("bigint").alias("ms"))
    values = values.join(hours.select("window_start", "window_end"), (F.date_trunc("hour", "ts") == F.col("window_start")), "left_semi")
    spans = [
        F.struct(F.lit(name).alias("span"), F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / seconds) * seconds).alias("window_start"))
        for name, seconds in (("day", 86_400), ("week", 7 * 86_400))
    ]
    placed = values.select("ms", F.inline(F.array(*spans))).join(F.broadcast(both), ["span", "window_start"])
    ranks = placed.groupBy("span", "window_start", "n", "avg_ms").agg(
        F.avg((F.col("ms") < F.col("quantile_ms")).cast("double")).alias("below"), F.avg((F.col("ms") <= F.col("quantile_ms")).cast("double")).alias("upto")
    )
    within = (F.col("below") <= 0.96) & (F.col("upto") >= 0.94)
    return _dates_as_text(ranks.select("span", "window_start", "n", "avg_ms", within.alias("within")))


@query
def latency_rollup(spark, sf_dir):
    path = scratch_path(spark, "sketches")
    monitor.latency_sketches(t.logs(spark, sf_dir), "$.k").write.parquet(path)
    return _sketch_report(spark, sf_dir, spark.read.parquet(path))


@query
def stream_latency_rollup(spark, sf_dir):
    """The same from sketches that a stream wrote for the hours it has closed."""
    root = scratch_path(spark, "live-sketches")
    stream = live.live_latency_sketches(_log_stream(spark, sf_dir), "$.k")
    live.run_available(stream, f"{root}/out", f"{root}/checkpoint")
    return _sketch_report(spark, sf_dir, spark.read.schema(stream.schema).parquet(f"{root}/out"))


@query
def alerts_5m_1m(spark, sf_dir):
    return _dates_as_text(monitor.exception_alert(t.logs(spark, sf_dir), threshold=2))


@query
def depth_15m_5m(spark, sf_dir):
    samples = t.logs(spark, sf_dir).withColumn("depth", F.col("value") * 100)
    alerts = monitor.queue_depth_alert(samples)
    return _dates_as_text(alerts.withColumn("metric", F.round("metric", 4)))


@query
def daily_alerts(spark, sf_dir):
    """Alert flags per day: events as queue depth, unlabelled articles as failures, labelled as indexed."""
    daily = t.silver(spark, sf_dir).groupBy("article_date").agg(
        F.count(F.lit(1)).alias("enrich_total"),
        F.count_if(F.col("nlpStatus") == "failed").alias("enrich_failed"),
        F.count_if(F.col("nlpStatus") == "ok").alias("doc_count"),
    )
    depth = t.logs(spark, sf_dir).groupBy(F.to_date("ts").alias("article_date")).agg(F.count(F.lit(1)).alias("queue_depth"))
    before = daily.select(F.date_add("article_date", 1).alias("article_date"), F.col("doc_count").alias("previous_doc_count"))
    metrics = daily.join(depth, "article_date", "left").join(before, "article_date", "left")
    return _dates_as_text(monitor.evaluate_alerts(metrics))


@query
def run_summary(spark, sf_dir):
    outcomes = t.silver(spark, sf_dir).select("id", F.when(F.col("nlpStatus") == "failed", "no label").alias("error"))
    return _dates_as_text(monitor.run_summary(outcomes))


@query
def reported_errors(spark, sf_dir):
    outcomes = t.silver(spark, sf_dir).select("id", F.when(F.col("nlpStatus") == "failed", "no label").alias("error"))
    return monitor.reported_errors(outcomes)


# --- streams ------------------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = t.table(spark, sf_dir, "events").schema
    # The pattern matches one path only; as a pattern it may name a single file as well as a folder.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _log_stream(spark, sf_dir):
    return _event_stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("message"), "value", "props")


def _run_live(spark, stream, label):
    root = scratch_path(spark, label)
    schema = stream.schema
    live.run_available(stream, f"{root}/out", f"{root}/checkpoint")
    return _dates_as_text(spark.read.schema(schema).parquet(f"{root}/out"))


@query
def stream_dedup(spark, sf_dir):
    """File events to work references through the ingest job, delivered to it twice."""
    root = scratch_path(spark, "ingest")
    for subscriber in ("first", "again"):
        events = t.file_events(_event_stream(spark, sf_dir))
        for stream in ingest.start_ingest(events, f"{root}/work", f"{root}/checkpoint-{subscriber}", subscriber):
            stream.awaitTermination()
    pending = tables.decode_pending(spark.read.schema(ingest.PENDING).parquet(f"{root}/work/pending"))
    return pending.select("urlHash", "category")


@query
def stream_first(spark, sf_dir):
    """First events by key as a purely streaming operator, over file events that arrive twice."""
    root = scratch_path(spark, "first")
    events = ingest.bronze_events(t.file_events(_event_stream(spark, sf_dir)))
    twice = events.unionByName(events).select("url_hash", "category", "ingested_at")
    found = ingest.dedup_stream(twice, ttl=None).select("url_hash", "category")
    return _run_live(spark, found, root.rpartition("/")[2])


@query
def consume_pending(spark, sf_dir):
    """Articles as pending work that a consumer takes in three runs; those in French fail until they are poison."""
    root = scratch_path(spark, "consume")
    work = t.articles(spark, sf_dir).select(
        F.concat_ws("/", "category", F.col("article_date").cast("string"), F.col("id")).alias("blob_path"),
        text.url_hash("url").alias("url_hash"), "category", F.col("published_at").alias("ingested_at"),
    )
    tables.write_pending(work, f"{root}/pending")
    for _ in range(3):
        stream = ingest.read_pending_stream(spark, f"{root}/pending")
        ingest.consume(stream, lambda rows: rows.where(F.col("category") == "fr"), root, f"{root}/checkpoint", max_attempts=2).awaitTermination()
    poison = tables.decode_pending(spark.read.schema(ingest.PENDING).parquet(f"{root}/poison"))
    return _dates_as_text(poison.select("urlHash", "category", "attempts"))


@query
def stream_hourly(spark, sf_dir):
    return _run_live(spark, live.live_hourly_count(_log_stream(spark, sf_dir), "e"), "hourly")


@query
def stream_latency(spark, sf_dir):
    return _run_live(spark, live.live_hourly_latency(_log_stream(spark, sf_dir), "$.k"), "latency")


@query
def stream_alert(spark, sf_dir):
    return _run_live(spark, live.live_exception_alert(_log_stream(spark, sf_dir), 2), "alert")


@query
def stream_depth(spark, sf_dir):
    samples = _log_stream(spark, sf_dir).withColumn("depth", F.col("value") * 100)
    found = _run_live(spark, live.live_queue_depth_alert(samples, monitor.MAX_QUEUE_DEPTH), "depth")
    return found.withColumn("metric", F.round("metric", 4))
