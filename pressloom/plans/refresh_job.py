"""Index refresh and backfill."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom import schemas
from pressloom.operators.index import to_search_doc, upsert_index
from pressloom.operators.matching import backfill_candidates, backfill_stats
from pressloom.operators.monitor import reported_errors
from pressloom.operators.segments import refresh
from pressloom.sources.articles import default_run_date, read_silver
from pressloom.sources.tables import KEY_BUCKETS, write_pending


def refresh_index(
    spark: SparkSession,
    silver_root: str,
    index_path: str,
    day: date | None = None,
    categories: Sequence[str] = schemas.CATEGORIES,
    first: date | None = None,
    terms_path: str | None = None,
    buckets: int = KEY_BUCKETS,
) -> dict:
    """Map silver of one day, or of all days from ``first`` to it, to search documents and upsert them.

    Their terms become a segment of the index at ``terms_path``, if there is one. A new index gets ``buckets`` folders of
    documents and of terms. Outcome 207 if any row was unusable.
    """
    refresh_day = day or default_run_date()
    days = F.col("article_date").between(F.lit(first or refresh_day), F.lit(refresh_day))
    silver = read_silver(spark, silver_root).filter(days & F.col("category").isin(list(categories)))
    keyed = F.coalesce(F.length("id") > 0, F.lit(False))
    outcomes = silver.select(
        F.coalesce("url", "title", F.lit("unknown")).alias("id"), F.when(~keyed, "document has no id").alias("error")
    )
    result = upsert_index(to_search_doc(silver), index_path, buckets)
    if terms_path:
        refresh(to_search_doc(silver), terms_path, buckets=buckets)
    unusable = outcomes.filter(F.col("error").isNotNull())
    failed = unusable.count()
    return {
        "date": refresh_day.isoformat(),
        "categories": list(categories),
        "processed": result["total"] + failed,
        "succeeded": result["succeeded"],
        "failed": failed,
        "errors": [row.asDict() for row in reported_errors(unusable).collect()] if failed else [],
        "outcome": 207 if failed else 200,
    }


def run_backfill(
    bronze: DataFrame,
    silver: DataFrame,
    pending_path: str,
    first: date,
    last: date,
    categories: Sequence[str] = schemas.CATEGORIES,
    force: bool = False,
    dry_run: bool = False,
) -> dict[str, int]:
    """Queue bronze articles that lack silver; a dry run only counts."""
    candidates = backfill_candidates(bronze, silver, first, last, categories, force)
    stats = backfill_stats(candidates).first().asDict()
    if dry_run or not stats["queued"]:
        return stats
    todo = candidates.filter(~F.col("enriched")).select(
        "blob_path", F.col("id").alias("url_hash"), "category", F.current_timestamp().alias("ingested_at")
    )
    sent = write_pending(todo, pending_path)
    return {**stats, "queued": sent["enqueued"], "failed": stats["failed"] + sent["failed"]}
