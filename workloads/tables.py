"""Test tables seen as article tables.

documents are articles (id = doc_id, category = lang, content = text), labels decide their sentiment
and status, embeddings are their vectors, benchmark holds search texts, events are file events and
job logs, pages and conversations are raw input. Nothing is filtered or sampled here.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions import pii
from pressloom.session import small, spread, tune

#: Articles and events span these days.
FIRST_DAY, LAST_DAY = date(2024, 1, 1), date(2024, 1, 30)
DAYS = 30
AS_OF = datetime(2024, 1, 31)
CATEGORIES = ("en", "fr", "de", "es")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"))


def article_day(doc_id) -> F.Column:
    return F.date_add(F.lit(FIRST_DAY), F.pmod(doc_id, F.lit(DAYS)).cast("int"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles: one per document, headline = text up to the first full stop or line break."""
    day = article_day(F.col("doc_id"))
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        "doc_id",
        F.concat(F.lit("https://news.example.com/"), F.col("source"), F.lit("/"), F.col("doc_id")).alias("url"),
        F.regexp_extract("text", r"^[^.\n]*", 0).alias("title"),
        "text",
        F.col("lang").alias("category"),
        "source",
        "n_chars",
        day.alias("article_date"),
        (day.cast("timestamp") + F.make_dt_interval(hours=F.pmod("doc_id", F.lit(24)).cast("int"))).alias("published_at"),
    )


#: Labels or vectors up to so many are sent to the tasks that read the texts, about 80 MB of vectors; more meet them in a shuffle.
BROADCAST_ROWS = 250_000


def attached(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts with the rows of their id, if any. Where the rows are few, no text travels."""
    return texts.join(F.broadcast(rows) if small(rows, BROADCAST_ROWS) else rows, "id", "left")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched articles. Labels give the sentiment; an article without a label failed annotation."""
    # By the same id as vectors are joined: texts travel once for both, and before anything is derived from them.
    labels = table(spark, sf_dir, "labels").withColumn("id", F.col("doc_id").cast("string")).drop("doc_id")
    spread = F.pmod("n_chars", F.lit(97)) / F.lit(97.0)
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    positive = F.when(toxic, F.lit(0.05)).when(good, 0.55 + spread * 0.25).otherwise(spread * 0.3)
    negative = F.when(toxic, 0.6 + spread * 0.3).otherwise(spread * 0.2)
    labelled = F.col("quality").isNotNull()
    label = F.when(toxic, "negative").when(good, "positive").otherwise("neutral")
    scores = F.struct(
        positive.alias("positive"), negative.alias("negative"), (1.0 - positive - negative).alias("neutral")
    )
    capitalised = F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{L}+"), F.lit(0))
    none = F.lit(None).cast("string")
    return (
        attached(articles(spark, sf_dir), labels)
        .select(
            "id",
            "doc_id",
            "url",
            "title",
            F.col("text").alias("body_snippet"),
            "source",
            "category",
            "article_date",
            F.col("published_at").alias("publishedAt"),
            F.when(labelled, "ok").otherwise("failed").alias("nlpStatus"),
            F.when(labelled, F.struct(label.alias("label"), scores.alias("scores"))).alias("sentiment"),
            F.transform(
                capitalised,
                lambda hit: F.struct(
                    hit.alias("text"), F.lit("Term").alias("category"), none.alias("subcategory"),
                    F.lit(1.0).alias("confidenceScore"),
                ),
            ).alias("entities"),
            F.split("text", r"[ \t\n\r]+").alias("keyPhrases"),
            (F.col("text").rlike(pii.EMAIL_PATTERN) | F.col("text").rlike(pii.PHONE_PATTERN)).alias("hasPii"),
        )
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("content_vector"), "label"
    )


def search_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape search works on; the body is the whole text."""
    enriched = silver(spark, sf_dir)
    return attached(enriched, vectors(spark, sf_dir).drop("label")).select(
        "id",
        "url",
        "title",
        "body_snippet",
        "source",
        "category",
        F.col("publishedAt").alias("published_at"),
        F.col("sentiment.label").alias("sentiment_label"),
        F.col("sentiment.scores.positive").alias("sentiment_score_positive"),
        F.transform("entities", lambda e: e.text).alias("entities"),
        F.col("keyPhrases").alias("key_phrases"),
        "content_vector",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as search requests; the vector of equal number, where there is one, is theirs."""
    asked = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("q"), F.col("item_id").cast("string").alias("id")
    )
    return asked.join(vectors(spark, sf_dir).select("id", F.col("content_vector").alias("qvec")), "id", "left").drop("id")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("message"),
        "event_id",
        "user_id",
        "value",
        "props",
    )


def file_events(events: DataFrame) -> DataFrame:
    """Job events as file-created events: one file per user and day, ``error`` files elsewhere."""
    at = F.col("ts").cast("timestamp")
    container = F.when(F.col("event_type") == "error", "articles-error").otherwise("articles-bronze")
    path = F.concat_ws(
        "/",
        F.lit("user"),
        F.date_format(at, "yyyy-MM-dd"),
        F.concat(F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 16), F.lit(".json")),
    )
    return events.select(
        "event_id",
        F.when(F.col("event_type") == "view", "Microsoft.Storage.BlobDeleted")
        .otherwise("Microsoft.Storage.BlobCreated")
        .alias("eventType"),
        F.concat(F.lit("/blobServices/default/containers/"), container, F.lit("/blobs/"), path).alias("subject"),
        at.alias("eventTime"),
    )
