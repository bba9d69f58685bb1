"""Streams: ingest with dedup and replays, retries and poison, live windows equal to batch ones."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pressloom import schemas
from pressloom.operators import monitor
from pressloom.session import scratch_path
from pressloom.sources import tables
from pressloom.streaming import ingest, live

START = datetime(2024, 1, 1)


def event(n, minutes, kind=schemas.FILE_CREATED, container="articles-bronze", path=None):
    path = path or f"science/2024-01-01/h{n}.json"
    return (kind, f"/blobServices/default/containers/{container}/blobs/{path}", START + timedelta(minutes=minutes), (f"u{n}", 1))


def deliver(spark, root, *events):
    spark.createDataFrame(list(events), schemas.EVENT).coalesce(1).write.mode("append").parquet(f"{root}/events")


def run_ingest(spark, root):
    stream = spark.readStream.schema(schemas.EVENT).parquet(f"{root}/events")
    for query in ingest.start_ingest(stream, f"{root}/work", f"{root}/checkpoint"):
        query.awaitTermination()
    return tables.decode_pending(spark.read.schema(ingest.PENDING).parquet(f"{root}/work/pending"))


def test_event_filter(spark):
    frame = spark.createDataFrame(
        [
            event(1, 0),
            event(2, 0, kind="Microsoft.Storage.BlobDeleted"),
            event(3, 0, container="articles-silver"),
            event(4, 0, path="science/h4.json"),
            event(5, 0, path="science/2024-01-01/h5.txt"),
        ],
        schemas.EVENT,
    )
    assert [(r["category"], r["date_str"], r["url_hash"]) for r in ingest.bronze_events(frame).collect()] == [
        ("science", "2024-01-01", "h1")
    ]


def test_ingest_drops_repeats_within_and_across_runs(spark):
    root = scratch_path(spark, "t")
    deliver(spark, root, event(1, 0), event(1, 5), event(2, 6), event(3, 7, container="other"))
    assert sorted(r["urlHash"] for r in run_ingest(spark, root).collect()) == ["h1", "h2"]
    # A repeat of any age is caught by the ingest table.
    deliver(spark, root, event(1, 60 * 24 * 9), event(4, 60 * 24 * 9))
    assert sorted(r["urlHash"] for r in run_ingest(spark, root).collect()) == ["h1", "h2", "h4"]
    audits = spark.read.parquet(f"{root}/work/audit")
    assert audits.count() == 5  # every bronze announcement, repeats too


@pytest.mark.parametrize("ttl", [ingest.REDELIVERY, None])
def test_streaming_dedup(spark, ttl):
    """Repeats of a hot key in several files and runs; with a ttl the state forgets old keys."""
    root = scratch_path(spark, "t")

    def run():
        stream = ingest.bronze_events(spark.readStream.schema(schemas.EVENT).parquet(f"{root}/events"))
        live.run_available(ingest.dedup_stream(stream, ttl).select("url_hash"), f"{root}/out", f"{root}/checkpoint")
        return sorted(r["url_hash"] for r in spark.read.schema("url_hash string").parquet(f"{root}/out").collect())

    for n in range(3):
        deliver(spark, root, *[event(1, m + n) for m in range(20)], event(10 + n, n))
    assert run() == ["h1", "h10", "h11", "h12"]
    deliver(spark, root, event(1, 30), event(2, 60 * 24 * 9))
    assert run() == ["h1", "h10", "h11", "h12", "h2"]
    deliver(spark, root, event(1, 60 * 24 * 9 + 5))
    assert run() == (["h1", "h1", "h10", "h11", "h12", "h2"] if ttl else ["h1", "h10", "h11", "h12", "h2"])


def test_replayed_batch_changes_nothing(spark):
    root = scratch_path(spark, "t")
    handle = ingest.ingest_batch(f"{root}/ingested", f"{root}/pending", "feed")
    batch = ingest.bronze_events(spark.createDataFrame([event(1, 0), event(2, 1)], schemas.EVENT))
    for _ in range(2):
        handle(batch, 0)
        assert spark.read.schema(ingest.PENDING).parquet(f"{root}/pending").count() == 2
    handle(batch, 1)
    assert spark.read.schema(ingest.PENDING).parquet(f"{root}/pending").count() == 2


def test_consume_retries_then_poison(spark):
    root = scratch_path(spark, "t")
    work = spark.createDataFrame(
        [("p/d/ok.json", "ok", "c", START), ("p/d/bad.json", "bad", "c", START)],
        "blob_path string, url_hash string, category string, ingested_at timestamp",
    )
    tables.write_pending(work, f"{root}/pending")
    spark.createDataFrame([("!!", START, 0)], ingest.PENDING).write.mode("append").parquet(f"{root}/pending")
    tried = []

    def process(rows):
        tried.extend(r["urlHash"] for r in rows.collect())
        return rows.filter("urlHash = 'bad'")

    for _ in range(4):
        stream = ingest.read_pending_stream(spark, f"{root}/pending")
        ingest.consume(stream, process, root, f"{root}/checkpoint", max_attempts=2).awaitTermination()
    assert tried.count("ok") == 1 and tried.count("bad") == 2
    poison = tables.decode_pending(spark.read.schema(ingest.PENDING).parquet(f"{root}/poison"))
    assert [(r["urlHash"], r["attempts"]) for r in poison.collect()] == [("bad", 2)]
    assert spark.read.schema(ingest.PENDING).parquet(f"{root}/rejected").count() == 1


def closed(df, last, lateness):
    return df.filter(F.col("window_end") <= F.lit(last - lateness).cast("timestamp"))


@pytest.mark.parametrize("files", [1, 3])
def test_live_windows_equal_batch_windows(spark, files):
    root = scratch_path(spark, "t")
    rows = [
        (START + timedelta(seconds=97 * n), "Enrichment complete" if n % 3 else "error", float(n % 700), '{"ms": %d}' % (n % 50))
        for n in range(400)
    ]
    size = len(rows) // files + 1
    for n in range(files):
        part = rows[n * size : (n + 1) * size]
        spark.createDataFrame(part, "ts timestamp, message string, depth double, props string").coalesce(1).write.mode("append").parquet(f"{root}/logs")
    logs = spark.read.parquet(f"{root}/logs")
    last, lateness = rows[-1][0], timedelta(hours=1)
    pairs = {
        "latency": (live.live_hourly_latency, monitor.hourly_latency, ("$.ms",)),
        "alert": (live.live_exception_alert, monitor.exception_alert, (2,)),
        "depth": (live.live_queue_depth_alert, monitor.queue_depth_alert, (300,)),
    }
    for name, (streamed, batch, arguments) in pairs.items():
        stream = streamed(live.read_log_stream(spark, f"{root}/logs", logs.schema), *arguments)
        live.run_available(stream, f"{root}/{name}", f"{root}/{name}-checkpoint")
        got = sorted(map(tuple, spark.read.schema(stream.schema).parquet(f"{root}/{name}").collect()))
        expected = sorted(map(tuple, closed(batch(logs, *arguments), last, lateness).collect()))
        assert got == expected and got


def test_hourly_count_and_errors(spark):
    logs = spark.createDataFrame(
        [(START, "Search complete a"), (START + timedelta(minutes=59), "Search complete b"), (START + timedelta(hours=1), "x"), (START - timedelta(days=2), "x")],
        "ts timestamp, message string",
    )
    assert [r["n"] for r in monitor.hourly_count(logs, "Search complete").collect()] == [2]
    recent = monitor.errors_by_message(logs, START + timedelta(hours=2)).collect()
    assert {r["message"]: r["n"] for r in recent} == {"Search complete a": 1, "Search complete b": 1, "x": 1}


def test_alert_thresholds(spark):
    metrics = spark.createDataFrame(
        [(501, 100, 6, 10, 10), (500, 100, 5, 11, 10), (0, 0, 0, 1, None)],
        "queue_depth long, enrich_total long, enrich_failed long, doc_count long, previous_doc_count long",
    )
    got = [tuple(r)[5:] for r in monitor.evaluate_alerts(metrics).collect()]
    assert got == [(True, True, True), (False, False, False), (False, False, False)]


def test_run_summary(spark):
    outcomes = spark.createDataFrame([(f"d{n:03d}", "boom" if n < 60 else None) for n in range(100)], "id string, error string")
    assert tuple(monitor.run_summary(outcomes).first()) == (100, 40, 60, 207)
    assert monitor.reported_errors(outcomes).count() == 50
    assert monitor.run_summary(outcomes.filter("error IS NULL")).first()["outcome"] == 200


def test_a_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    read = []
    whole = ingest.drop_seen
    monkeypatch.setattr(ingest, "drop_seen", lambda events, *rest: (read.extend(events.inputFiles()), whole(events, *rest))[1])
    rows = [(f"en/2024-01-01/h{i % 3}.json", "en", "2024-01-01", f"h{i % 3}", datetime(2024, 1, 1, 0, i)) for i in range(9)]
    batch = spark.createDataFrame(rows, "blob_path string, category string, date_str string, url_hash string, ingested_at timestamp")
    ingest.ingest_batch(f"{tmp_path}/ingested", f"{tmp_path}/pending", "feed")(batch, 0)
    assert read and all("/_first.feed-0/" in name for name in read)
    assert spark.read.parquet(f"{tmp_path}/pending/batch=feed-0").count() == 3
    assert not [name for name in os.listdir(f"{tmp_path}/pending") if name.startswith("_first")]
