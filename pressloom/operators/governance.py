"""Classification of documents, its report, and lineage edges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions.pii import RULES, Rule, classify, sensitivity
from pressloom.session import reliable_checkpoint

#: Rules that apply per layer (fixed values): raw and enriched documents get all, aggregates none.
SCAN_SCOPE: Mapping[str, tuple[Rule, ...]] = {"bronze": RULES, "silver": RULES, "gold": ()}


def label_documents(df: DataFrame, id_col: str = "id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``id, labels, sensitivity``: rules matched by each row's JSON form, and the strictest label."""
    document = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    labelled = df.select(F.col(id_col).cast("string").alias("id"), classify(document, rules).alias("labels"))
    return labelled.select("id", "labels", sensitivity("labels", rules).alias("sensitivity"))


def scan(tables: Mapping[str, DataFrame], scope: Mapping[str, tuple[Rule, ...]] = SCAN_SCOPE) -> DataFrame:
    """Labelled documents of several layers, each with the rules its layer calls for."""
    labelled = [
        label_documents(df, rules=scope[layer]).select(F.lit(layer).alias("layer"), "*")
        for layer, df in tables.items()
        if scope.get(layer)
    ]
    if not labelled:
        raise ValueError("no table is in the scan scope")
    return reduce(DataFrame.unionByName, labelled)


def classification_report(labelled: DataFrame, rules: Sequence = RULES) -> DataFrame:
    """Documents per layer and matched rule, with the sensitivity the rule carries; ``rules`` as given to the scan."""
    label_of = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.label)])
    return (
        labelled.select("layer", F.explode_outer("labels").alias("rule"))
        .filter(F.col("rule").isNotNull())
        .groupBy("layer", "rule")
        .agg(F.count(F.lit(1)).alias("documents"))
        .withColumn("sensitivity", label_of[F.col("rule")])
    )


LINEAGE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("process", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)

#: Registered processes with their inputs and outputs (fixed values).
PROCESSES = (
    ("ingest", ("news-api",), ("articles-bronze",)),
    ("enrich", ("articles-bronze",), ("articles-silver",)),
    ("index-refresh", ("articles-silver",), ("search-index",)),
)


def lineage_edges(
    spark: SparkSession, run_id: str, process: str, inputs: Sequence[str], outputs: Sequence[str], rows: int
) -> DataFrame:
    """One edge per input and output of a job run."""
    edges = [(run_id, process, source, target, rows) for source in inputs for target in outputs]
    return spark.createDataFrame(edges, LINEAGE)


def record_lineage(edges: DataFrame, path: str) -> None:
    edges.write.mode("append").parquet(path)


def reachable(edges: DataFrame, start: str, max_hops: int | None = None) -> DataFrame:
    """Assets downstream of ``start`` with the least number of hops: ``asset, hops``.

    One join per hop, against what is not yet found, until nothing new is found or ``max_hops`` is reached.
    Links and frontiers are checkpointed, so the plan does not grow with the hops and a lost executor
    costs one of them.
    """
    spark = edges.sparkSession
    links = reliable_checkpoint(edges.select(F.col("input").alias("asset"), F.col("output").alias("next")).distinct())
    frontier = spark.range(1).select(F.lit(start).alias("asset"), F.lit(0).alias("hops"))
    found = frontier
    hop = 0
    while max_hops is None or hop < max_hops:
        hop += 1
        step = links.join(frontier.select("asset"), "asset").select(F.col("next").alias("asset")).distinct()
        fresh = step.join(found.select("asset"), "asset", "left_anti")
        frontier = reliable_checkpoint(fresh.select("asset", F.lit(hop).alias("hops")))
        if frontier.isEmpty():
            break
        found = reliable_checkpoint(found.unionAll(frontier)) if hop % 10 == 0 else found.unionAll(frontier)
    return found.filter(F.col("hops") > 0)
