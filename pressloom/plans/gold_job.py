"""Nightly gold job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pressloom import schemas
from pressloom.operators import gold
from pressloom.operators.select import assert_columns, require_rows, rolling_window
from pressloom.sources.articles import default_run_date, lookback_for, read_silver_window
from pressloom.sources.tables import overwrite_partition

NO_DATA = "NO_DATA"


def gold_tables(
    silver: DataFrame, run_date: date, lookback_days: int, keyword_window: int
) -> dict[str, DataFrame]:
    """The three gold tables of one silver window.

    The window is not cached: each table reads other silver columns (scores, entities, phrases), so
    three pruned scans read every column once, while a cache would hold the whole window.
    """
    projected = gold.project_silver(silver)
    recent = rolling_window(projected, "article_date", run_date, lookback_days)
    return {
        "sentiment_trends": gold.sentiment_trends(recent, run_date),
        "top_entities": gold.top_entities(recent, run_date),
        "trending_keywords": gold.trending_keywords(projected, run_date, keyword_window),
    }


def run_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    run_date: date | None = None,
    lookback_days: int = 7,
    keyword_window: int = 3,
    categories: Sequence[str] = schemas.CATEGORIES,
) -> dict:
    """Compute and replace the run date's partition of the three gold tables.

    Returns a summary; an empty window returns the code ``NO_DATA`` and writes nothing.
    """
    day = run_date or default_run_date()
    scan_days = lookback_for(lookback_days, keyword_window)
    silver = read_silver_window(spark, silver_root, day, scan_days, categories)
    assert_columns(silver, schemas.SILVER_REQUIRED)
    try:
        require_rows(silver.select("id"), NO_DATA)
    except LookupError as reason:
        return {"run_date": day.isoformat(), "outcome": str(reason)}
    in_lookback = rolling_window(silver, "article_date", day, lookback_days)
    quality = gold.data_quality(in_lookback.select("nlpStatus", "hasPii"), "silver-window").first()
    rows = {
        name: overwrite_partition(table, f"{gold_root}/{name}", "run_date", day)
        for name, table in gold_tables(silver, day, lookback_days, keyword_window).items()
    }
    return {
        "run_date": day.isoformat(),
        "outcome": "OK",
        "silver_articles": quality["nlp_ok"],
        "quality": quality.asDict(),
        "rows": rows,
        "outputs": {name: f"{gold_root}/{name}" for name in rows},
    }
