"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import maybe_broadcast, stage

#: Links that one task writes at least.
LINKS_A_TASK = 100_000


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for the nodes of ``a``-``b`` links.

    Alternating star contraction: every node hands its larger neighbours, then all of them, to the
    smallest one. Links stay a table throughout; a round costs one aggregate and one join per star, and
    the number of rounds grows with the logarithm of the longest path. Null ends are ignored.
    Counted links decide what a round shuffles: the smallest neighbours of few nodes are broadcast, and few links
    are written by few tasks.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "links")
    seen = _state(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = both.join(maybe_broadcast(low, 2 * seen[0]), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = larger.where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(maybe_broadcast(low, 2 * seen[0]), "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct().coalesce(1 + seen[0] // LINKS_A_TASK), "links")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("links did not settle")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of links and a sum over them, equal for equal links."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
