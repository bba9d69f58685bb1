"""Log queries, run summaries and alerts. The windowed operators work on tables and on streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.operators.select import sample_head

# Thresholds and windows of the alerts.
MAX_QUEUE_DEPTH = 500
MAX_ENRICH_ERROR_RATE = 0.05
MAX_EXCEPTIONS = 50
EXCEPTION_WINDOW, EXCEPTION_SLIDE = "5 minutes", "1 minute"
DEPTH_WINDOW, DEPTH_SLIDE = "15 minutes", "5 minutes"
MAX_REPORTED_ERRORS = 50


def errors_by_message(logs: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Exceptions of the last ``hours`` by message, most frequent first."""
    until = F.lit(as_of).cast("timestamp")
    since = until - F.make_dt_interval(hours=F.lit(hours))
    recent = logs.filter((F.col("ts") > since) & (F.col("ts") <= until))
    return recent.groupBy("message").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "message")


def _binned(logs: DataFrame, size: str, slide: str | None = None) -> Column:
    return F.window("ts", size, slide) if slide else F.window("ts", size)


def _with_window(aggregated: DataFrame) -> DataFrame:
    values = [c for c in aggregated.columns if c != "window"]
    return aggregated.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *values
    )


def hourly_count(logs: DataFrame, marker: str) -> DataFrame:
    """Rows per hour whose message contains ``marker``."""
    marked = logs.filter(F.col("message").contains(marker))
    return _with_window(marked.groupBy(_binned(marked, "1 hour")).agg(F.count(F.lit(1)).alias("n")))


def hourly_latency(logs: DataFrame, json_path: str, approximate: bool = False) -> DataFrame:
    """Mean and 95th percentile per hour of a whole number inside the JSON column ``props``.

    The exact percentile keeps a count per distinct value of an hour, which for whole milliseconds
    stays small; ``approximate`` bounds it by a sketch instead.
    """
    timed = logs.withColumn("_ms", F.get_json_object("props", json_path).try_cast("int"))
    p95 = F.percentile_approx("_ms", 0.95, 10000) if approximate else F.percentile("_ms", 0.95)
    aggregated = timed.groupBy(_binned(timed, "1 hour")).agg(
        F.round(F.avg("_ms"), 4).alias("avg_ms"), F.round(p95.cast("double"), 4).alias("p95_ms")
    )
    return _with_window(aggregated)


#: Size of the quantile sketches; ranks are off by 0.4 % of the rows at most, 99 times of 100.
SKETCH_SIZE = 800


def latency_sketches(logs: DataFrame, json_path: str, size: int = SKETCH_SIZE) -> DataFrame:
    """``window_start, window_end, n, total_ms, sketch`` per hour: what latencies of longer spans are merged from.

    A sketch has a bounded size, whatever the number of rows and of distinct values, also as state of a stream.
    """
    timed = logs.withColumn("_ms", F.get_json_object("props", json_path).try_cast("bigint"))
    return _with_window(
        timed.groupBy(_binned(timed, "1 hour")).agg(
            F.count("_ms").alias("n"), F.sum("_ms").alias("total_ms"), F.kll_sketch_agg_bigint("_ms", F.lit(size)).alias("sketch")
        )
    )


def rollup_latency(sketches: DataFrame, span: str = "1 day") -> DataFrame:
    """Sketches of longer spans from those of shorter ones; of hours or of an earlier roll-up."""
    merged = sketches.where("n > 0").groupBy(F.window("window_start", span)).agg(
        F.sum("n").alias("n"), F.sum("total_ms").alias("total_ms"), F.kll_merge_agg_bigint("sketch").alias("sketch")
    )
    return _with_window(merged)


def sketched_latency(sketches: DataFrame, share: float = 0.95) -> DataFrame:
    """``window_start, window_end, n, avg_ms, quantile_ms`` of stored sketches."""
    quantile = F.kll_sketch_get_quantile_bigint("sketch", F.lit(share))
    return sketches.where("n > 0").select(
        "window_start", "window_end", "n", F.round(F.col("total_ms") / F.col("n"), 4).alias("avg_ms"), quantile.alias("quantile_ms")
    )


def sliding_alert(
    logs: DataFrame, size: str, slide: str, threshold: float, metric: Column | None = None
) -> DataFrame:
    """Windows in which ``metric`` (the row count by default) exceeds the threshold."""
    value = F.count(F.lit(1)).cast("double") if metric is None else metric
    aggregated = logs.groupBy(_binned(logs, size, slide)).agg(value.alias("metric"))
    return _with_window(aggregated.filter(F.col("metric") > threshold))


def exception_alert(logs: DataFrame, threshold: float = MAX_EXCEPTIONS) -> DataFrame:
    return sliding_alert(logs, EXCEPTION_WINDOW, EXCEPTION_SLIDE, threshold)


def queue_depth_alert(samples: DataFrame, threshold: float = MAX_QUEUE_DEPTH, depth: str = "depth") -> DataFrame:
    return sliding_alert(samples, DEPTH_WINDOW, DEPTH_SLIDE, threshold, F.avg(depth))


def evaluate_alerts(metrics: DataFrame) -> DataFrame:
    """Alert flags per run from ``queue_depth, enrich_total, enrich_failed, doc_count, previous_doc_count``."""
    rate = F.col("enrich_failed") / F.nullif(F.col("enrich_total"), F.lit(0))
    return metrics.select(
        "*",
        (F.col("queue_depth") > MAX_QUEUE_DEPTH).alias("alert_queue_depth"),
        F.coalesce(rate > MAX_ENRICH_ERROR_RATE, F.lit(False)).alias("alert_enrich_errors"),
        F.coalesce(F.col("doc_count") <= F.col("previous_doc_count"), F.lit(False)).alias("alert_no_growth"),
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row from per-document ``outcomes(id, error)``: counts and outcome code 200, or 207 if any failed."""
    counted = outcomes.agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(F.col("error").isNull()).alias("succeeded")
    )
    failed = F.col("processed") - F.col("succeeded")
    return counted.select(
        "processed", "succeeded", failed.alias("failed"), F.when(failed > 0, 207).otherwise(200).alias("outcome")
    )


def reported_errors(outcomes: DataFrame, n: int = MAX_REPORTED_ERRORS) -> DataFrame:
    """The first errors of a run, for its report."""
    return sample_head(outcomes.filter(F.col("error").isNotNull()).select("id", "error"), n, "id")
