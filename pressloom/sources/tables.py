"""Idempotent table writes over Parquet: partition replacement, keyed upsert, appends."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom import schemas
from pressloom.operators.select import latest_per_key
from pressloom.sources.files import Folder


def _metrics(observation: Observation, names: Sequence[str]) -> dict[str, int]:
    """Observed values; a frame the optimizer proved empty observes nothing, which counts as zero."""
    seen = observation.get
    return {name: int(seen.get(name) or 0) for name in names}


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, readable without ``multiLine``."""
    df.write.mode(mode).json(path)


def write_partitioned(df: DataFrame, path: str, *columns: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Write below ``column=value`` folders with rows gathered by folder.

    Without gathering, every task writes a file into every folder. The rebalance hint also splits a
    folder that holds much of the data over several tasks, which a plain repartition would not.
    """
    df.hint("rebalance", *columns).write.mode(mode).format(fmt).partitionBy(*columns).save(path)


def overwrite_partition(df: DataFrame, path: str, column: str, value: str | date) -> int:
    """Replace ``path/column=value`` with ``df`` and return the rows written.

    The check that every row carries ``value`` and the row count are taken while the rows are staged,
    so the frame is computed once. An empty frame empties the partition.
    """
    spark = df.sparkSession
    folder = Folder(spark, f"{path}/{column}={value}")
    observation = Observation()
    foreign = ~F.col(column).eqNullSafe(F.lit(value).cast(df.schema[column].dataType))
    watched = df.observe(
        observation, F.count(F.lit(1)).alias("rows"), F.count_if(foreign).alias("foreign")
    )
    watched.drop(column).write.mode("overwrite").parquet(folder.staging)
    seen = _metrics(observation, ("rows", "foreign"))
    if seen["foreign"]:
        folder.discard_staging()
        raise ValueError(f"{seen['foreign']} rows do not belong to {column}={value}")
    folder.swap_in()
    return seen["rows"]


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None
) -> DataFrame:
    """Target after the upsert, with ``_change`` in (kept, updated, inserted) and ``_copies``.

    ``_copies`` counts the source rows of the key; above 1 the upsert is ambiguous and must not be
    stored. Matching is SQL equality, so rows with a NULL key never match: they skip the joins, which
    would send all of them to one task. The matched side is a left join, which adaptive execution can
    split when many target rows share a key; a full outer join it cannot.
    """
    unknown = sorted(set(source.columns) - set(target.columns))
    if unknown:
        raise ValueError(f"source columns {unknown} are not in the target")
    values = [c for c in source.columns if c not in keys]
    updates = set(values if update_cols is None else update_cols)
    has_keys = F.lit(True)
    for key in keys:
        has_keys = has_keys & F.col(key).isNotNull()

    incoming = (
        source.filter(has_keys)
        .groupBy(*keys)
        .agg(F.first(F.struct(F.lit(1).alias("_"), *values)).alias("_new"), F.count(F.lit(1)).alias("_copies"))
    )
    matched = F.col("_new").isNotNull()
    merged_columns: list[Column] = [
        F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
        for c in target.columns
    ]
    rewritten = (
        target.filter(has_keys)
        .join(incoming, list(keys), "left")
        .select(
            *merged_columns,
            F.when(matched, F.lit("updated")).otherwise(F.lit("kept")).alias("_change"),
            F.coalesce("_copies", F.lit(0)).alias("_copies"),
        )
    )
    unkeyed = target.filter(~has_keys).select("*", F.lit("kept").alias("_change"), F.lit(0).alias("_copies"))

    known = target.filter(has_keys).select(*keys).distinct()
    inserted = (
        incoming.join(known, list(keys), "left_anti")
        .select(*keys, *[F.col(f"_new.{c}").alias(c) for c in values], "_copies")
        .unionByName(source.filter(~has_keys).withColumn("_copies", F.lit(1)))
        .withColumn("_change", F.lit("inserted"))
    )
    return rewritten.unionByName(unkeyed).unionByName(inserted, allowMissingColumns=True)


def merge_upsert(
    source: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str] | None = None
) -> dict[str, int]:
    """Create or upsert the table at ``path``; counts of inserted, updated and touched rows."""
    spark = source.sparkSession
    folder = Folder(spark, path)
    folder.recover()
    if folder.exists():
        merged = merge_rows(spark.read.parquet(path), source, keys, update_cols)
    else:
        merged = source.select("*", F.lit("inserted").alias("_change"), F.lit(1).alias("_copies"))
    observation = Observation()
    watched = merged.observe(
        observation,
        F.count_if(F.col("_change") == "inserted").alias("inserted"),
        F.count_if(F.col("_change") == "updated").alias("updated"),
        F.count_if(F.col("_copies") > 1).alias("ambiguous"),
    )
    watched.drop("_change", "_copies").write.mode("overwrite").parquet(folder.staging)
    seen = _metrics(observation, ("inserted", "updated", "ambiguous"))
    if seen["ambiguous"]:
        folder.discard_staging()
        raise ValueError(f"several source rows share a key in {list(keys)}")
    folder.swap_in()
    return {"inserted": seen["inserted"], "updated": seen["updated"], "total": seen["inserted"] + seen["updated"]}


#: Keys of a source up to this many are broadcast to the stored rows, about 60 bytes each.
REPLACED_KEYS = 2_000_000
#: Rows are gathered by folder where files would get smaller than this, or have come down to a quarter of it.
SMALL_FILE = 1 << 20
#: Folders of a table merged by key; a table keeps the number it was created with.
KEY_BUCKETS = 64


def key_bucket(keys: Sequence[str], columns: Sequence[str], buckets: int) -> Column:
    """Folder of a row by its key; rows with a NULL in the key match nothing, so they are dealt by their contents."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    contents = F.xxhash64(*[F.col(c).cast("string") for c in columns])
    return F.pmod(F.when(whole, F.xxhash64(*[F.col(k).cast("string") for k in keys])).otherwise(contents), F.lit(buckets)).cast("int")


def merge_buckets(
    source: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str] | None = None, buckets: int = KEY_BUCKETS
) -> dict[str, int]:
    """:func:`merge_upsert` for a table in folders by the hash of its key: only folders with source rows are touched.

    The source is dealt into folders once. Those that the table lacks are moved in as they are; of the touched folders
    it has, the rows that the source does not replace join the source's, or, where rows are not replaced as a whole,
    both are merged into a staging folder; the folders are checked and moved in one by one; the others are neither read nor written. A merge that dies between two moves is repeated whole: it gives the same rows.
    The table has the source's columns of the first merge and a column ``_bucket``, which readers drop.
    """
    spark = source.sparkSession
    folder = Folder(spark, path)
    staged = f"{path}/_merge.{folder.run}"
    schema_path = f"{path}/_schema"
    known = Folder(spark, schema_path).exists()
    if known:
        kept = spark.read.parquet(schema_path)
        buckets, columns = kept.first()["_buckets"], [c for c in kept.columns if c != "_buckets"]
    else:
        columns = list(source.columns)
        spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema.fields], F.lit(buckets).alias("_buckets")).coalesce(
            1
        ).write.parquet(schema_path)
    kept = spark.read.parquet(schema_path).schema
    unknown = sorted(set(source.columns) - set(kept.names))
    if unknown:
        raise ValueError(f"source columns {unknown} are not in the target")
    number = key_bucket(keys, source.columns, buckets)
    dealt = _gathered(source.withColumn("_bucket", number), buckets).write.partitionBy("_bucket")
    dealt.option("compression", "zstd").parquet(f"{staged}/source")
    source_schema = source.schema
    touched = sorted(int(n.partition("=")[2]) for n in Folder(spark, f"{staged}/source").children() if n.startswith("_bucket="))
    for b in touched:
        Folder(spark, f"{path}/_bucket={b}").recover()
    stored = set(folder.children())
    # A folder that the table does not have yet is the source's own, unless its columns have other types.
    same = all(kept[f.name].dataType == f.dataType for f in source_schema.fields)
    present = [b for b in touched if f"_bucket={b}" in stored or not same]
    new = [b for b in touched if b not in set(present)]

    def dealt_rows(numbers: Sequence[int]) -> DataFrame:
        if not numbers:
            return spark.createDataFrame([], source_schema)
        reader = spark.read.schema(source_schema).option("basePath", f"{staged}/source")
        return reader.parquet(*[f"{staged}/source/_bucket={b}" for b in numbers]).select(*source_schema.names)

    added = dealt_rows(new)
    whole = added.dropna("any", subset=list(keys))
    if not whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1").isEmpty():
        Folder(spark, staged).remove()
        raise ValueError(f"several source rows share a key in {list(keys)}")
    n_added = added.count()
    seen = {"inserted": 0, "updated": 0}
    replaced = None
    if present and same and update_cols is None and set(source.columns) == set(columns):
        replaced = _keep_others(spark, path, f"{staged}/source", present, dealt_rows(present), keys)
    if replaced is not None:
        seen = replaced
    elif present:
        source = dealt_rows(present)
        target = _bucket_rows(spark, path, [b for b in present if f"_bucket={b}" in stored])
        merged = merge_rows(target, source, keys, update_cols)
        observation = Observation()
        watched = merged.observe(
            observation,
            F.count_if(F.col("_change") == "inserted").alias("inserted"),
            F.count_if(F.col("_change") == "updated").alias("updated"),
            F.count_if(F.col("_copies") > 1).alias("ambiguous"),
        )
        # Stored rows stay in their folder, also those without a whole key, whose contents may have changed.
        rows = watched.select(*columns, F.coalesce("_bucket", key_bucket(keys, source.columns, buckets)).alias("_bucket"))
        rows.hint("rebalance", "_bucket").write.partitionBy("_bucket").option("compression", "zstd").parquet(f"{staged}/target")
        seen = _metrics(observation, ("inserted", "updated", "ambiguous"))
        if seen["ambiguous"]:
            Folder(spark, staged).remove()
            raise ValueError(f"several source rows share a key in {list(keys)}")
        for name in Folder(spark, f"{staged}/target").children():
            if name.startswith("_bucket="):
                Folder(spark, f"{path}/{name}").replace_with(f"{staged}/target/{name}")
    for b in new if replaced is None else touched:
        Folder(spark, f"{path}/_bucket={b}").replace_with(f"{staged}/source/_bucket={b}")
    Folder(spark, staged).remove()
    inserted, updated = seen["inserted"] + n_added, seen["updated"]
    return {"inserted": inserted, "updated": updated, "total": inserted + updated}


def _gathered(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows for a write into folders by ``_bucket``: gathered by folder, unless the files that the rows come from are so
    large that tasks for all cores can each write a sound file into every folder; then no row travels."""
    spark = rows.sparkSession
    tasks = sum(Folder(spark, name).size()[0] for name in rows.inputFiles()) // (2 * SMALL_FILE * buckets)
    return rows.coalesce(tasks) if tasks >= spark.sparkContext.defaultParallelism else rows.hint("rebalance", "_bucket")


def _keep_others(
    spark: SparkSession, path: str, staged: str, buckets: Sequence[int], source: DataFrame, keys: Sequence[str]
) -> dict[str, int] | None:
    """Add the stored rows of some folders that no source row replaces to the staged source, and count the others.

    Rows stay in their folder, so only keys travel: up to ``REPLACED_KEYS`` of the source are broadcast. None, and
    nothing is written, if the table holds several rows of a replaced key (each of them has to become the new one) or
    the source does, which the general merge reports.
    """
    target = _bucket_rows(spark, path, buckets)
    incoming = source.select(*keys).dropna("any").groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    counted = incoming.agg(F.count(F.lit(1)).alias("n"), F.max("_copies").alias("most")).first()
    few = counted["n"] <= REPLACED_KEYS
    side = F.broadcast(incoming.select(*keys)) if few else incoming.select(*keys)
    met = target.select(*keys).join(side, list(keys), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    updated = met.agg(F.count(F.lit(1)).alias("n"), F.max("_copies").alias("most")).first()
    if max(counted["most"] or 1, updated["most"] or 1) > 1:
        return None
    sizes = [Folder(spark, f"{path}/_bucket={b}").size() for b in buckets]
    n = source.count()
    kept = target.join(side, list(keys), "left_anti")
    # Every task writes a file into each folder it has rows of: gathered first if files are small by now.
    if not few or sum(length for length, _ in sizes) < SMALL_FILE // 4 * sum(n for _, n in sizes):
        kept = kept.hint("rebalance", "_bucket")
    kept.write.mode("append").partitionBy("_bucket").option("compression", "zstd").parquet(staged)
    return {"inserted": n - updated["n"], "updated": updated["n"]}


def _bucket_rows(spark: SparkSession, path: str, buckets: Sequence[int]) -> DataFrame:
    """Rows of some folders with their ``_bucket``; other folders are not listed."""
    kept = spark.read.parquet(f"{path}/_schema")
    schema = T.StructType([f for f in kept.schema.fields if f.name != "_buckets"]).add("_bucket", T.IntegerType())
    if not buckets:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/_bucket={b}" for b in buckets])


def bucketed_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that :func:`merge_buckets` keeps at ``path``."""
    names = [n.partition("=")[2] for n in Folder(spark, path).children() if n.startswith("_bucket=")]
    return _bucket_rows(spark, path, sorted(map(int, names))).drop("_bucket")


def write_bronze(articles: DataFrame, root: str, ingest_date: date) -> None:
    """Store a poll under ``category=/ingest_date=``: the day of ingest, not of publication.

    Polls of a day append; ``current_bronze`` applies last-write-wins when reading, so no poll has to
    rewrite what earlier ones stored. Expects ``id`` and ``ingested_at``.
    """
    newest = latest_per_key(articles, ["category", "id"], [F.desc("ingested_at")])
    dated = newest.withColumn("ingest_date", F.lit(ingest_date))
    write_partitioned(dated, root, "category", "ingest_date", fmt="json")


def current_bronze(bronze: DataFrame) -> DataFrame:
    """The last version of every (category, ingest_date, id)."""
    return latest_per_key(bronze, ["category", "ingest_date", "id"], [F.desc("ingested_at")])


def error_rows(failed: DataFrame) -> DataFrame:
    """Error records of articles that could not be enriched: expects ``error`` and ``stage`` columns."""
    return failed.select(
        F.col("id").alias("urlHash"),
        "blobPath",
        F.struct("error", "stage").alias("errorMeta"),
        F.col("failed_at").cast("string").alias("failedAt"),
        "category",
        "article_date",
    )


def write_errors(failed: DataFrame, root: str) -> None:
    """Store the error rows of one batch at a path of its own; a repeat replaces them."""
    write_partitioned(error_rows(failed), root, "category", "article_date", mode="overwrite")


def dedup_rows(seen: DataFrame) -> DataFrame:
    """Ingest-table rows: the first two hash digits are the bucket."""
    return seen.select(
        F.substring("url_hash", 1, 2).alias("partitionKey"),
        F.col("url_hash").alias("rowKey"),
        F.coalesce("url", F.lit("")).alias("url"),
        "category",
        F.col("ingested_at").cast("string").alias("ingestedAt"),
    )


def mark_ingested(seen: DataFrame, path: str, batch: str | int) -> int:
    """Record hashes in the ingest table as one batch; repeating a batch replaces it.

    Batches are only added, so marking costs as much as the batch, not as the table.
    """
    newest = latest_per_key(dedup_rows(seen), ["rowKey"], [F.desc("ingestedAt"), F.asc("url"), F.asc("category")])
    return overwrite_partition(newest.withColumn("batch", F.lit(str(batch))), path, "batch", str(batch))


def read_ingested(spark: SparkSession, path: str, except_batch: str | int | None = None) -> DataFrame:
    """The ingest table as stored, without the rows of a batch that is being repeated."""
    stored = T.StructType(schemas.DEDUP.fields + [T.StructField("batch", T.StringType())])
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], stored)
    table = spark.read.schema(stored).parquet(path)
    return table if except_batch is None else table.filter(F.col("batch") != str(except_batch))


def current_ingested(ingested: DataFrame) -> DataFrame:
    """Last entry per hash: later entries replace earlier ones."""
    order = [F.desc("ingestedAt"), F.asc("url"), F.asc("category")]
    return latest_per_key(ingested, ["rowKey"], order).drop("batch")


def audit_rows(df: DataFrame, event: str, details: Sequence[str], ts: str = "ts", key: str = "url_hash") -> DataFrame:
    """Audit records: key ``hash_event_millis``, details as a JSON text."""
    at = F.col(ts)
    row_key = F.concat_ws("_", F.col(key), F.lit(event), F.unix_millis(at).cast("string"))
    return df.select(
        row_key.alias("rowKey"),
        F.col(key).alias("urlHash"),
        F.lit(event).alias("event"),
        F.to_json(F.struct(*details)).alias("details"),
        at.alias("ts"),
        F.to_date(at).alias("audit_date"),
    )


def append_audit(rows: DataFrame, root: str) -> None:
    write_partitioned(rows, root, "audit_date")


def audits_by_date(spark: SparkSession, root: str, day: date) -> DataFrame:
    return spark.read.schema(schemas.AUDIT).parquet(root).filter(F.col("audit_date") == F.lit(day))


def pending_rows(df: DataFrame) -> DataFrame:
    """Work references with the base64 message body a queue would carry."""
    message = F.struct(
        F.col("blob_path").alias("blobPath"),
        F.col("url_hash").alias("urlHash"),
        "category",
        F.col("ingested_at").cast("string").alias("ingestedAt"),
    )
    return df.select(
        F.base64(F.encode(F.to_json(message), "UTF-8")).alias("body"),
        F.col("ingested_at").alias("enqueued_at"),
        F.lit(0).alias("attempts"),
    )


def write_pending(df: DataFrame, path: str) -> dict[str, int]:
    """Append work references; incomplete ones are counted as failed and not written."""
    complete = F.col("blob_path").isNotNull() & F.col("url_hash").isNotNull() & F.col("category").isNotNull()
    observation = Observation()
    watched = df.observe(
        observation, F.count(F.lit(1)).alias("total"), F.count_if(complete).alias("enqueued")
    )
    pending_rows(watched.filter(complete)).write.mode("append").parquet(path)
    seen = _metrics(observation, ("total", "enqueued"))
    return {**seen, "failed": seen["total"] - seen["enqueued"]}


def decode_pending(pending: DataFrame) -> DataFrame:
    """Message fields of pending rows; ``malformed`` marks bodies that are no complete message."""
    body = F.decode(F.try_to_binary("body", F.lit("base64")), "UTF-8")
    decoded = pending.withColumn("m", F.from_json(body, schemas.QUEUE_MSG)).select("*", "m.*").drop("m")
    required = [F.length(F.coalesce(F.col(c), F.lit(""))) > 0 for c in ("blobPath", "urlHash", "category")]
    return decoded.withColumn("malformed", ~(required[0] & required[1] & required[2]))


MAX_PEEK = 32


def peek_pending(spark: SparkSession, path: str, count: int = 10) -> DataFrame:
    """The oldest messages, at most 32, left where they are."""
    pending = spark.read.parquet(path).orderBy("enqueued_at", "body").limit(max(1, min(count, MAX_PEEK)))
    return decode_pending(pending)


def pending_depth(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count()
