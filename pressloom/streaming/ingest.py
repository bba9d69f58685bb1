"""File events to work references: filter, dedup, fan-out, batched consumption with retries.

Each sink is a query with a checkpoint of its own. Batch writes go to a partition named after the
batch, so a batch that is repeated after a failure replaces its first attempt.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pressloom import schemas
from pressloom.functions.paths import container_from_subject, parse_bronze_path, path_from_subject
from pressloom.operators.matching import drop_seen
from pressloom.operators.select import latest_per_key
from pressloom.sources.files import Folder
from pressloom.sources.tables import (
    audit_rows,
    decode_pending,
    mark_ingested,
    overwrite_partition,
    pending_rows,
    read_ingested,
    write_partitioned,
)

#: Events are delivered again for at most a day (fixed value).
REDELIVERY = "24 hours"
MAX_ATTEMPTS = 5
FILES_PER_BATCH = 10


PENDING = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("enqueued_at", T.TimestampType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)


def bronze_events(events: DataFrame) -> DataFrame:
    """Events that announce a new bronze article: key columns, path, event time. Batch or stream."""
    path = path_from_subject("subject")
    parsed = events.filter(
        (F.col("eventType") == schemas.FILE_CREATED)
        & (container_from_subject("subject") == schemas.BRONZE_CONTAINER)
    ).select(path.alias("blob_path"), F.col("eventTime").alias("ingested_at"))
    return parsed.select("*", parse_bronze_path("blob_path").alias("_p")).filter(F.col("_p").isNotNull()).select(
        "blob_path",
        F.col("_p.category").alias("category"),
        F.col("_p.date_str").alias("date_str"),
        F.col("_p.url_hash").alias("url_hash"),
        "ingested_at",
    )


def dedup_stream(events: DataFrame, ttl: str | None = REDELIVERY, key: str = "url_hash", salts: int = 8) -> DataFrame:
    """First event per key, as a purely streaming operator.

    With a ``ttl`` the state forgets keys that old; without, it grows for ever. A stream has no
    map-side cut, so repeats are dropped in two steps: per key and input split, spread over ``salts``
    tasks, then per key. A key with a third of all events sends one event per salt to the second.
    """
    salted = events.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    if ttl is None:
        return salted.dropDuplicates([key, "_salt"]).dropDuplicates([key]).drop("_salt")
    marked = salted.withWatermark("ingested_at", ttl)
    return marked.dropDuplicatesWithinWatermark([key, "_salt"]).dropDuplicatesWithinWatermark([key]).drop("_salt")


def ingest_batch(dedup_path: str, pending_path: str, feed: str) -> Callable[[DataFrame, int], None]:
    """Batch handler: drop what the ingest table knows, write references, then mark them.

    ``feed`` names the event source, so that batches of several sources stay apart.

    References come first: if the batch dies in between, its repeat finds the hashes unmarked (its
    own marks are ignored) and writes the same references into the same partition.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{feed}-{batch_id}"
        # Events are parsed once; what is asked twice is the first event of each key.
        first = Folder(spark, f"{pending_path}/_first.{name}")
        latest_per_key(batch, ["url_hash"], [F.asc("ingested_at")]).write.mode("overwrite").parquet(first.path)
        unique = spark.read.schema(batch.schema).parquet(first.path)
        fresh = drop_seen(unique, read_ingested(spark, dedup_path, except_batch=name))
        overwrite_partition(pending_rows(fresh).withColumn("batch", F.lit(name)), pending_path, "batch", name)
        written = decode_pending(spark.read.schema(PENDING).parquet(f"{pending_path}/batch={name}"))
        marks = written.select(
            F.col("urlHash").alias("url_hash"),
            F.lit("").alias("url"),
            "category",
            F.col("ingestedAt").alias("ingested_at"),
        )
        mark_ingested(marks, dedup_path, name)
        first.remove()

    return handle


def audit_batch(audit_path: str, feed: str) -> Callable[[DataFrame, int], None]:
    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = audit_rows(batch, "blob_created", ["blob_path", "category", "date_str"], ts="ingested_at")
        write_partitioned(rows, f"{audit_path}/batch={feed}-{batch_id}", "audit_date", mode="overwrite")

    return handle


def start_ingest(
    events: DataFrame, work_root: str, checkpoint_root: str, feed: str = "events"
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both subscribers of the event stream: work references and the audit trail.

    They share nothing but the source, so a failing audit does not stop the work. Repeats are dropped
    per batch against the ingest table, which is exact for any age; no streaming state is kept.
    """
    announced = bronze_events(events)
    work = (
        announced.writeStream.queryName(f"work_{feed}")
        .option("checkpointLocation", f"{checkpoint_root}/work")
        .foreachBatch(ingest_batch(f"{work_root}/ingested", f"{work_root}/pending", feed))
        .trigger(availableNow=True)
        .start()
    )
    audit = (
        announced.writeStream.queryName(f"audit_{feed}")
        .option("checkpointLocation", f"{checkpoint_root}/audit")
        .foreachBatch(audit_batch(f"{work_root}/audit", feed))
        .trigger(availableNow=True)
        .start()
    )
    return work, audit


def read_pending_stream(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.schema(PENDING).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def route_attempts(decoded: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decoded pending rows as (work, poison, malformed).

    ``attempts`` counts earlier tries; a reference tried ``max_attempts`` times goes to poison.
    """
    sound = decoded.filter(~F.col("malformed"))
    spent = F.col("attempts") >= max_attempts
    return sound.filter(~spent), sound.filter(spent), decoded.filter("malformed")


def consume(
    pending: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    work_root: str,
    checkpoint: str,
    max_attempts: int = MAX_ATTEMPTS,
) -> StreamingQuery:
    """Feed references to ``process`` batch by batch.

    ``process`` gets the work rows and returns those that failed, with their columns unchanged. They
    come back as pending with one attempt more, or as poison after the last.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        work, poison, malformed = route_attempts(decode_pending(batch.select(*PENDING.fieldNames())), max_attempts)
        columns = [F.col(c) for c in PENDING.fieldNames()]
        for rows, name in ((poison, "poison"), (malformed, "rejected")):
            overwrite_partition(
                rows.select(*columns, F.lit(str(batch_id)).alias("batch")), f"{work_root}/{name}", "batch", str(batch_id)
            )
        again = process(work).select("body", "enqueued_at", (F.col("attempts") + 1).alias("attempts"))
        retry = f"retry-{batch_id}"
        overwrite_partition(again.withColumn("batch", F.lit(retry)), f"{work_root}/pending", "batch", retry)

    return (
        pending.writeStream.queryName(f"consume_{uuid.uuid4().hex[:12]}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
        .trigger(availableNow=True)
        .start()
    )
