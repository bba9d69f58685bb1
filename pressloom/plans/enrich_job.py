"""Bronze to silver: pick up references, annotate, write silver, audit and error rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom import schemas
from pressloom.functions.paths import parse_bronze_path
from pressloom.operators import enrich
from pressloom.operators.matching import new_only
from pressloom.session import small
from pressloom.sources.files import Folder
from pressloom.sources.tables import audit_rows, overwrite_partition, write_errors, write_partitioned

Annotator = Callable[[DataFrame], DataFrame]

#: References up to this many are broadcast to the bronze scan; more are joined by shuffling both.
BROADCAST_WORK = 500_000


def references(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded pending messages as article keys, and the messages whose path names no valid day."""
    parsed = decoded.select("*", parse_bronze_path("blobPath").alias("_p")).withColumn(
        "article_date", F.col("_p.date_str").try_cast("date")
    )
    keyed = parsed.filter(F.col("article_date").isNotNull()).select(
        F.col("urlHash").alias("id"),
        "category",
        "article_date",
        F.col("blobPath").alias("blob_path"),
        F.col("ingestedAt").alias("ingested_at"),
    )
    return keyed, parsed.filter(F.col("article_date").isNull()).select("blobPath", "urlHash", "category", "ingestedAt")


def enrich_articles(
    work: DataFrame, bronze: DataFrame, enriched_at: Column, annotator: Annotator = enrich.annotate
) -> DataFrame:
    """Silver rows of the referenced articles; references without a bronze article yield none.

    ``bronze`` holds one row per (category, article_date, id). ``annotator`` maps prepared articles to
    the annotation columns; replace it to run models through ``enrich.apply_model``.
    """
    side = F.broadcast(work) if small(work, BROADCAST_WORK) else work
    articles = bronze.drop("blob_path", "ingested_at").join(side, ["category", "article_date", "id"])
    return enrich.build_silver(annotator(enrich.prepare(articles)), enriched_at)


def run_enrich(
    spark: SparkSession,
    decoded: DataFrame,
    bronze: DataFrame,
    silver_root: str,
    work_root: str,
    batch: str,
    annotator: Annotator = enrich.annotate,
    enriched_at: Column | None = None,
) -> dict[str, int]:
    """Enrich pending articles that have no silver row and append them to silver.

    The batch is staged once; silver, audit and error rows are read back from the staged table, so the
    annotators run a single time. Repeating a batch finds its silver rows and adds nothing.
    """
    at = F.current_timestamp() if enriched_at is None else enriched_at
    keyed, rejected = references(decoded)
    overwrite_partition(rejected.withColumn("batch", F.lit(batch)), f"{work_root}/rejected", "batch", batch)
    span = keyed.agg(F.min("article_date").alias("first"), F.max("article_date").alias("last")).first()
    if span["first"] is None:
        return {"enriched": 0}
    # Bronze and silver are stored by day: read the days of this batch only.
    in_span = F.col("article_date").between(F.lit(span["first"]), F.lit(span["last"]))
    known = (
        spark.read.schema(schemas.SILVER).parquet(silver_root)
        if Folder(spark, silver_root).exists()
        else spark.createDataFrame([], schemas.SILVER)
    )
    work = new_only(keyed, known.filter(in_span))
    silver = enrich_articles(work, bronze.filter(in_span), at, annotator).withColumn("batch", F.lit(batch))
    staged_root = f"{work_root}/enriched"
    written = overwrite_partition(silver, staged_root, "batch", batch)
    if not written:
        return {"enriched": 0}
    staged = spark.read.schema(schemas.SILVER).parquet(f"{staged_root}/batch={batch}")

    failed = staged.filter(F.col("nlpStatus") == "failed").select(
        "id",
        F.concat_ws("/", "category", F.col("article_date").cast("string"), F.concat("id", F.lit(".json"))).alias("blobPath"),
        F.col("nlpError").alias("error"),
        F.lit("enrichment").alias("stage"),
        F.col("enrichedAt").alias("failed_at"),
        "category",
        "article_date",
    )
    write_errors(failed, f"{work_root}/errors/batch={batch}")
    done = staged.select(F.col("id").alias("url_hash"), "nlpStatus", "vectorStatus", "hasPii", at.alias("ts"))
    audits = audit_rows(done, "enrich_complete", ["nlpStatus", "vectorStatus", "hasPii"])
    write_partitioned(audits, f"{work_root}/audit/batch=enrich-{batch}", "audit_date", mode="overwrite")
    write_partitioned(staged, silver_root, "category", "article_date")
    return {"enriched": written}
