"""Joins that decide what work is left: dedup, backfill, idempotent enrichment, annotation merge."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.functions.paths import bronze_path
from pressloom.operators.enrich import combine_status
from pressloom.operators.select import latest_per_key, sample_head

def drop_seen(events: DataFrame, ingested: DataFrame, key: str = "url_hash", order: str = "ingested_at") -> DataFrame:
    """First event per hash whose hash is not in the ingest table.

    Repeats are cut before any join, so a URL that fires a third of all events is one row by then.
    The ingest table, by far the larger side, is first reduced to the hashes of this batch: with a
    batch small enough to broadcast it is scanned and never shuffled.
    """
    fresh = latest_per_key(events, [key], [F.asc(order)])
    stored = ingested.select(F.col("rowKey").alias(key))
    hits = stored.join(fresh.select(key), key, "left_semi").distinct()
    return fresh.join(hits, key, "left_anti")


def new_only(pending: DataFrame, silver: DataFrame) -> DataFrame:
    """Pending articles that have no silver row yet, at most one per article."""
    keys = ["category", "article_date", "id"]
    unique = latest_per_key(pending, keys, [F.asc("ingested_at")])
    return unique.join(silver.select(*keys).distinct(), keys, "left_anti")


def backfill_candidates(
    bronze: DataFrame, silver: DataFrame, first: date, last: date, categories: Iterable[str], force: bool = False
) -> DataFrame:
    """Bronze articles of a date range with their path and an ``enriched`` flag.

    ``enriched`` rows already have silver and need no work; ``force`` clears the flag. The range and
    category filters prune both tables before the join.
    """
    keys = ["category", "article_date", "id"]
    wanted = F.col("article_date").between(F.lit(first), F.lit(last)) & F.col("category").isin(list(categories))
    found = bronze.filter(wanted).select(*keys)
    path = bronze_path("category", "article_date", "id").alias("blob_path")
    if force:
        return found.select(*keys, path, F.lit(False).alias("enriched"))
    done = silver.filter(wanted).select(*keys).distinct().withColumn("_done", F.lit(True))
    joined = found.join(done, keys, "left")
    return joined.select(*keys, path, F.col("_done").isNotNull().alias("enriched"))


def backfill_stats(candidates: DataFrame) -> DataFrame:
    """One row: total, already enriched, queued, failed (no usable key)."""
    usable = F.length(F.coalesce(F.col("id"), F.lit(""))) > 0
    return candidates.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(usable & F.col("enriched")).alias("already_enriched"),
        F.count_if(usable & ~F.col("enriched")).alias("queued"),
        F.count_if(~usable).alias("failed"),
    )


def backfill_sample(candidates: DataFrame, n: int = 5) -> DataFrame:
    """What a dry run shows: the first paths that would be queued."""
    return sample_head(candidates.filter(~F.col("enriched")).select("blob_path"), n, "blob_path")


def merge_annotations(articles: DataFrame, sentiment: DataFrame, entities: DataFrame, phrases: DataFrame) -> DataFrame:
    """One row per article with the three annotation results and the resulting status.

    Inputs carry ``id`` and ``sentiment`` / ``entities`` / ``keyPhrases``, and optionally ``error`` on
    sentiment. A sentiment error fails the article, missing entities or phrases are empty, and an
    article without any result is failed.
    """
    scored = sentiment if "error" in sentiment.columns else sentiment.withColumn("error", F.lit(None).cast("string"))
    scored = scored.select("id", "sentiment", F.col("error").alias("_error"), F.lit(True).alias("_s"))
    named = entities.select("id", "entities", F.lit(True).alias("_e"))
    phrased = phrases.select("id", "keyPhrases", F.lit(True).alias("_p"))
    joined = articles.join(scored, "id", "left").join(named, "id", "left").join(phrased, "id", "left")
    answered = F.coalesce("_s", "_e", "_p", F.lit(False))
    status, error = combine_status(F.col("_error"), answered)
    return joined.select(
        *[F.col(c) for c in articles.columns],
        status.alias("nlpStatus"),
        error.alias("nlpError"),
        "sentiment",
        F.coalesce("entities", F.array()).alias("entities"),
        F.coalesce("keyPhrases", F.array()).alias("keyPhrases"),
    )
