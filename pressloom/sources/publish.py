"""Index statistics and versioned publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.sources.files import Folder


def index_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row: documents and bytes. Sizes come from file metadata, once per file."""
    per_file = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("documents"), F.max("_metadata.file_size").alias("bytes"))
    )
    return per_file.agg(
        F.coalesce(F.sum("documents"), F.lit(0)).alias("document_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("storage_bytes"),
    )


def publish(spark: SparkSession, alias: str, version_path: str) -> None:
    """Point a catalog view at a table version; readers of the view switch in one step."""
    if not Folder(spark, version_path).exists():
        raise FileNotFoundError(version_path)
    location = version_path.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW `{alias.replace('`', '``')}` AS SELECT * FROM parquet.`{location}`")
