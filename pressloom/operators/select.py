"""Windows over dates, latest row per key, top-n per group, presentation order, unions, contracts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def window_bounds(run_date: date, days: int, back: int = 0) -> tuple[date, date]:
    """First and last day of the ``days``-long window that ends ``back`` windows before ``run_date``."""
    last = run_date - timedelta(days=days * back)
    return last - timedelta(days=days - 1), last


def in_window(day: Column | str, run_date: date, days: int, back: int = 0) -> Column:
    first, last = window_bounds(run_date, days, back)
    column = F.col(day) if isinstance(day, str) else day
    return column.between(F.lit(first), F.lit(last))


def rolling_window(df: DataFrame, date_col: str, run_date: date, days: int) -> DataFrame:
    """Rows of the ``days`` days that end on ``run_date``, both ends included."""
    return df.filter(in_window(date_col, run_date, days))


def prior_window(df: DataFrame, date_col: str, run_date: date, days: int) -> DataFrame:
    """Rows of the equally long window right before the rolling one."""
    return df.filter(in_window(date_col, run_date, days, back=1))


def date_spine(spark: SparkSession, first: date, last: date, categories: Iterable[str]) -> DataFrame:
    """Every (category, day) of a range, both ends included; empty if the range is reversed."""
    days = F.sequence(F.lit(first), F.lit(last)) if first <= last else F.array().cast("array<date>")
    return (
        spark.range(1)
        .select(F.explode(days).alias("article_date"))
        .select(F.explode(F.array(*[F.lit(c) for c in categories])).alias("category"), "article_date")
    )


def top_n(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """Best ``n`` rows per group with their rank.

    The rank filter lets Spark cut every partition to ``n`` rows per group before the shuffle, so a
    group holding a third of the rows sends no more than any other. ``order`` has to end in a unique
    key, or the cut is not deterministic.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``, for example newest first: last write wins.

    Ties are settled by the rows' contents, so the winner does not depend on the order of the input.
    """
    contents = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return top_n(df, keys, [*order, F.xxhash64(*contents)], 1, "_version").drop("_version")


#: Repeated keys up to this many are broadcast.
BROADCAST_KEYS = 500_000


def latest_of_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """:func:`latest_per_key` where few keys are repeated: whole rows travel for those alone, of the others only keys.

    Keys are not null.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
    n = repeated.count()
    if n > BROADCAST_KEYS:
        return latest_per_key(df, keys, order)
    if not n:
        return df
    side = F.broadcast(repeated)
    return df.join(side, list(keys), "left_anti").unionByName(latest_per_key(df.join(side, list(keys), "left_semi"), keys, order))


def present(df: DataFrame, *order: str | Column) -> DataFrame:
    """Order for a reader. Sinks do not use this: a global sort before a write is wasted."""
    return df.orderBy(*order)


def sort_by(df: DataFrame, field: str, descending: bool = True) -> DataFrame:
    """Sort search documents by a sortable field, ties by id."""
    if field not in ("published_at", "sentiment_score_positive"):
        raise ValueError(f"{field} is not sortable")
    key = F.col(field).desc_nulls_last() if descending else F.col(field).asc_nulls_last()
    return df.orderBy(key, "id")


def sample_head(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a stated order, for reports."""
    return df.orderBy(*order).limit(n)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a source lacks are NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def assert_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise if required columns are absent. Looks at metadata only."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}; available columns: {sorted(df.columns)}")


def removed_fields(live: T.StructType, updated: T.StructType) -> list[str]:
    """Fields of the live schema that an updated schema would lose."""
    kept = set(updated.fieldNames())
    return [name for name in live.fieldNames() if name not in kept]


def require_rows(df: DataFrame, code: str = "SILVER_EMPTY") -> DataFrame:
    """Stop a job before aggregation when there is nothing to aggregate."""
    if df.isEmpty():
        raise LookupError(code)
    return df
