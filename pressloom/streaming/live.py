"""Windowed log queries on a live stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pressloom.operators.monitor import exception_alert, hourly_count, hourly_latency, latency_sketches, queue_depth_alert

LATENESS = "1 hour"


def read_log_stream(spark: SparkSession, path: str, schema: T.StructType, ts: str = "ts") -> DataFrame:
    """A log directory as a stream; the time column becomes an instant, which a watermark needs."""
    raw = spark.readStream.schema(schema).parquet(path)
    return raw.withColumn(ts, F.col(ts).cast("timestamp"))


def live_hourly_count(logs: DataFrame, marker: str, lateness: str = LATENESS) -> DataFrame:
    return hourly_count(logs.withWatermark("ts", lateness), marker)


def live_hourly_latency(logs: DataFrame, json_path: str, lateness: str = LATENESS) -> DataFrame:
    return hourly_latency(logs.withWatermark("ts", lateness), json_path)


def live_latency_sketches(logs: DataFrame, json_path: str, lateness: str = LATENESS) -> DataFrame:
    """Hourly latency sketches; unlike exact percentiles their state has a bounded size."""
    return latency_sketches(logs.withWatermark("ts", lateness), json_path)


def live_exception_alert(logs: DataFrame, threshold: float, lateness: str = LATENESS) -> DataFrame:
    return exception_alert(logs.withWatermark("ts", lateness), threshold)


def live_queue_depth_alert(
    samples: DataFrame, threshold: float, depth: str = "depth", lateness: str = LATENESS
) -> DataFrame:
    return queue_depth_alert(samples.withWatermark("ts", lateness), threshold, depth)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop. Append mode: only windows the watermark has closed are written."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
