"""Gold aggregates over enriched articles.

Every aggregate is built so that the row-level shuffle carries partially aggregated rows: with a
handful of categories and a few hundred days, grouping keys are hot by nature, and only map-side
aggregation or a per-partition cut keeps those groups off a single task.

Arrays are exploded with ``explode_outer`` and tested afterwards: for a plain ``explode`` the optimizer
adds a test on the array below it, which computes an array that is not stored a second time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions.scores import dominant_sentiment, trend_score
from pressloom.operators.select import in_window, top_n

# Sizes of the ranked tables and the quality threshold.
TOP_ENTITIES = 20
TOP_KEYWORDS = 30
MIN_ENTITY_CHARS = 2
MIN_PHRASE_CHARS = 3
MAX_FAILURE_RATE = 0.20

_SCORES = ("positive", "negative", "neutral")


def project_silver(silver: DataFrame) -> DataFrame:
    """Columns the gold tables read, annotated articles only."""
    scores = [
        F.col(f"sentiment.scores.{name}").cast("double").alias(f"sentiment_{name}") for name in _SCORES
    ]
    return silver.filter(F.col("nlpStatus") == "ok").select(
        "id",
        "category",
        "article_date",
        F.col("publishedAt").alias("published_at"),
        F.col("sentiment.label").alias("sentiment_label"),
        *scores,
        "entities",
        "keyPhrases",
        "nlpStatus",
    )


def sentiment_trends(projected: DataFrame, run_date: date, dominant: str = "cascade") -> DataFrame:
    """Article count, mean scores and dominant label per category and day."""
    means = [F.round(F.avg(f"sentiment_{name}"), 4).alias(f"avg_{name}") for name in _SCORES]
    daily = projected.groupBy("category", "article_date").agg(F.count("id").alias("article_count"), *means)
    label = dominant_sentiment(*[F.col(f"avg_{name}") for name in _SCORES], mode=dominant)
    return daily.select("*", label.alias("dominant_sentiment"), F.lit(run_date).alias("run_date"))


def sentiment_rolling(projected: DataFrame, days: int = 7) -> DataFrame:
    """Mean scores per category over the ``days`` calendar days that end on each date.

    Weighted by articles: daily sums and counts are rolled up, not daily means. The frame runs over
    one row per category and day, whatever the number of articles.
    """
    sums = [F.sum(f"sentiment_{n}").alias(f"sum_{n}") for n in _SCORES]
    counts = [F.count(f"sentiment_{n}").alias(f"n_{n}") for n in _SCORES]
    daily = projected.groupBy("category", "article_date").agg(F.count("id").alias("day_articles"), *sums, *counts)
    frame = (
        Window.partitionBy("category").orderBy(F.unix_date("article_date")).rangeBetween(-(days - 1), Window.currentRow)
    )
    means = [
        F.round(F.sum(f"sum_{n}").over(frame) / F.sum(f"n_{n}").over(frame), 4).alias(f"avg_{n}") for n in _SCORES
    ]
    return daily.select("category", "article_date", F.sum("day_articles").over(frame).alias("article_count"), *means)


def explode_entities(df: DataFrame, keep_untexted: bool = False) -> DataFrame:
    """One row per entity: id, category, entity, entity_text.

    Works for arrays of structs and of plain strings. A struct without text is dropped, or with
    ``keep_untexted`` shown as the struct's string form.
    """
    element = df.schema["entities"].dataType.elementType
    if isinstance(element, T.StructType) and "text" in element.fieldNames():
        text = F.col("entity.text")
        if keep_untexted:
            text = F.coalesce(text, F.col("entity").cast("string"))
    else:
        text = F.col("entity").cast("string")
    exploded = df.select("id", "category", F.explode_outer("entities").alias("entity"))
    return exploded.withColumn("entity_text", text).filter(F.col("entity_text").isNotNull())


def entity_totals(df: DataFrame, count_mode: str = "mentions") -> DataFrame:
    """Mentions, or articles that mention, per category and entity."""
    entities = explode_entities(df).filter(F.length("entity_text") >= MIN_ENTITY_CHARS)
    if count_mode == "articles":
        # First one row per article and entity, then a plain count that combines map-side.
        entities = entities.select("id", "category", "entity_text").distinct()
    elif count_mode != "mentions":
        raise ValueError(f"unknown count_mode {count_mode!r}")
    return entities.groupBy("category", "entity_text").agg(F.count("id").alias("entity_count"))


def top_entities(
    projected: DataFrame, run_date: date, n: int = TOP_ENTITIES, count_mode: str = "mentions"
) -> DataFrame:
    totals = entity_totals(projected, count_mode)
    ranked = top_n(totals, ["category"], [F.desc("entity_count"), F.asc("entity_text")], n)
    return ranked.withColumn("run_date", F.lit(run_date))


def explode_phrases(df: DataFrame) -> DataFrame:
    """One row per key phrase. The length test sees the phrase before it is trimmed."""
    exploded = df.select("id", "category", "article_date", F.explode_outer("keyPhrases").alias("key_phrase"))
    return exploded.filter(F.length("key_phrase") >= MIN_PHRASE_CHARS).withColumn(
        "key_phrase", F.lower(F.trim("key_phrase"))
    )


def phrase_counts(df: DataFrame, run_date: date, window_days: int) -> DataFrame:
    """Counts of both windows in one pass: a conditional aggregate instead of a join of two."""
    current = in_window("article_date", run_date, window_days)
    prior = in_window("article_date", run_date, window_days, back=1)
    return (
        explode_phrases(df.filter(current | prior))
        .groupBy("category", "key_phrase")
        .agg(
            F.count_if(current).alias("count_current"),
            F.count_if(prior).alias("count_prior"),
        )
        .filter(F.col("count_current") > 0)
    )


def trending_keywords(
    projected: DataFrame, run_date: date, window_days: int = 3, n: int = TOP_KEYWORDS
) -> DataFrame:
    """Phrases of the current window, ranked by growth against the window before."""
    scored = phrase_counts(projected, run_date, window_days).withColumn(
        "trend_score", trend_score(F.col("count_current"), F.col("count_prior"))
    )
    order: list[Column] = [F.desc("trend_score"), F.desc("count_current"), F.asc("key_phrase")]
    return top_n(scored, ["category"], order, n).withColumn("run_date", F.lit(run_date))


def data_quality(df: DataFrame, label: str) -> DataFrame:
    """One row: totals, failures, personal-data rows and a warning, from a single pass."""
    pii = F.count_if(F.col("hasPii")) if "hasPii" in df.columns else F.lit(None).cast("bigint")
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("nlpStatus") == "ok").alias("nlp_ok"),
        pii.alias("pii_rows"),
    )
    failed = F.col("total_rows") - F.col("nlp_ok")
    warning = F.when(F.col("total_rows") == 0, F.lit("NO_ROWS")).when(
        failed / F.col("total_rows") > MAX_FAILURE_RATE, F.lit("HIGH_FAILURE_RATE")
    )
    return counted.select(
        F.lit(label).alias("label"), "total_rows", "nlp_ok", failed.alias("nlp_failed"), "pii_rows", warning.alias("warning")
    )
