"""Reading envelopes, bronze and silver."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom import schemas
from pressloom.functions.paths import parse_bronze_path
from pressloom.functions.text import has_text
from pressloom.operators.select import window_bounds
from pressloom.sources.files import Folder

SOURCE_OK = "ok"


def explode_envelopes(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles of the successful responses, and the other responses as rejects."""
    is_ok = F.coalesce(F.col("status") == SOURCE_OK, F.lit(False))
    articles = envelopes.filter(is_ok).select("category", F.explode("articles").alias("a")).select("category", "a.*")
    rejects = envelopes.filter(~is_ok).select("category", "status", "code", "message")
    return articles, rejects


def split_missing_url(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles with a URL, and title and category of those without."""
    usable = has_text("url")
    return articles.filter(usable), articles.filter(~usable).select("category", "title")


def read_articles(spark: SparkSession, root: str, schema: T.StructType = schemas.ARTICLE) -> DataFrame:
    """Foreign documents, one JSON file per article at ``category/date/hash.json`` below ``root``.

    Such files are often pretty-printed, hence ``multiLine``. Key columns come from the path; files
    at other places are not read as articles.
    """
    documents = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(root)
    )
    # Local files are reported with one or three slashes after the scheme.
    segments = F.split(F.regexp_replace("_metadata.file_path", "^file:/+", "/"), "/")
    above = re.sub("^file:/+", "/", Folder(spark, root).qualified()).count("/") + 1
    segments = F.slice(segments, F.lit(above + 1), F.greatest(F.size(segments) - above, F.lit(0)))
    located = documents.select("*", parse_bronze_path(F.array_join(segments, "/")).alias("_path"))
    return located.filter(F.col("_path").isNotNull()).select(
        F.col("_path.url_hash").alias("id"),
        F.col("_path.category").alias("category"),
        F.col("_path.date_str").try_cast("date").alias("ingest_date"),
        *[F.col(name) for name in schema.fieldNames()],
    )


def read_bronze(
    spark: SparkSession,
    root: str,
    category: str | None = None,
    ingest_date: date | None = None,
    schema: T.StructType = schemas.ARTICLE,
) -> DataFrame:
    """Articles written by ``write_bronze``; the two arguments prune partitions, as a path prefix would."""
    stored = T.StructType(
        [T.StructField("id", T.StringType())]
        + schema.fields
        + [T.StructField("category", T.StringType()), T.StructField("ingest_date", T.DateType())]
    )
    bronze = spark.read.schema(stored).json(root)
    if category is not None:
        bronze = bronze.filter(F.col("category") == category)
    if ingest_date is not None:
        bronze = bronze.filter(F.col("ingest_date") == F.lit(ingest_date))
    return bronze


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.SILVER).parquet(root)


def lookback_for(lookback_days: int, keyword_window: int) -> int:
    """Days to scan so that the prior keyword window is never cut off."""
    return max(lookback_days, 2 * keyword_window)


def read_silver_window(
    spark: SparkSession, root: str, run_date: date, lookback_days: int, categories: Sequence[str]
) -> DataFrame:
    """Silver of the look-back window: one read, pruned to the partitions that exist."""
    first, last = window_bounds(run_date, lookback_days)
    return read_silver(spark, root).filter(
        F.col("article_date").between(F.lit(first), F.lit(last)) & F.col("category").isin(list(categories))
    )


def parse_categories(text: str | None) -> list[str]:
    """Comma list, trimmed, empties dropped; the default categories for an empty text."""
    names = [part.strip() for part in (text or ",".join(schemas.CATEGORIES)).split(",")]
    return [name for name in names if name]


def default_run_date(today: date | None = None) -> date:
    """Yesterday: nightly jobs work on the last complete day."""
    return (today or date.today()) - timedelta(days=1)
