"""Session settings and the shared folder every multi-step job writes to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the library relies on. All can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Ten thousand long texts would be a batch of 100 MB, several times over in a task.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

_local_dirs: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session someone else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pressloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # A few MB per task keep all cores of one machine busy; a cluster keeps Spark's 64 MB.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may run without the setting: it gets a folder of its own. On a cluster a
    machine-local folder would lose its files with the executor, so the missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="pressloom-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the plan at a copy in the shared folder, which outlives any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_dir(df.sparkSession)}/checkpoints")
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input with fewer splits than cores, such as one big row group.

    Meant for tables whose rows are costly to process. An input of many splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def small(df: DataFrame, max_rows: int) -> bool:
    """Whether a frame has at most ``max_rows`` rows; the count combines in the tasks, one number each leaves them."""
    return df.count() <= max_rows
