"""Helpers shared by the operators: staged tables, global positions, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.session import scratch_path

#: Largest number of rows that is ever hinted as a broadcast side.
BROADCAST_ROWS = 1_000_000
#: ``monotonically_increasing_id`` is the partition number times this, plus the row's number within it.
_ROWS_PER_PART = 1 << 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """A copy in the shared folder: read often, computed once, and it outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__file`` and ``__row``, which tell every row from every other, however equal.

    Rows of files are told by file and place in it; any other frame is staged with a number first. Both stay the
    same when the frame is read again.
    """
    from pyspark.errors import AnalysisException

    try:
        found = docs.withColumns({"__file": F.xxhash64(F.col("_metadata.file_path")), "__row": F.col("_metadata.row_index")})
        found.schema  # noqa: B018
        return found
    except AnalysisException:
        return stage(docs.withColumns({"__file": F.lit(0).cast("long"), "__row": F.monotonically_increasing_id()}), "keyed")


def give_back() -> None:
    """Give memory that this process has freed back to the machine."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returning_memory(function):
    """A batch function whose worker, kept for other tasks, gives freed memory back when it is done."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def maybe_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only for a counted frame; above the bound the same join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def part_of(position: str | Column) -> Column:
    """Partition number in a ``monotonically_increasing_id``."""
    return F.shiftright(F.col(position) if isinstance(position, str) else position, 33)


def ordered(df: DataFrame, *order: Column, label: str, position: str = "position") -> DataFrame:
    """Stage the rows in global order; ``position`` grows along it, with gaps between partitions.

    Rows are dealt by range, so equal leading keys spread over tasks as soon as a later key differs.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(dealt.withColumn(position, F.monotonically_increasing_id()), label)


def index_within(df: DataFrame, key: str, position: str = "position", index: str = "index") -> DataFrame:
    """Number the rows of an :func:`ordered` table, sorted by ``key`` first, from 0 within each key.

    Only one row per partition and key is shuffled; a key that fills many partitions stays in them.
    """
    spans = df.groupBy(F.col(key).alias("_key"), part_of(position).alias("_part")).agg(
        F.min(position).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = stage(spans.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows"), "spans")
    joined = df.join(
        maybe_broadcast(spans, spans.count()), F.col(key).eqNullSafe(F.col("_key")) & (part_of(position) == F.col("_part"))
    )
    return joined.withColumn(index, F.col(position) - F.col("_first") + F.col("_before")).drop("_key", "_part", "_first", "_before")
