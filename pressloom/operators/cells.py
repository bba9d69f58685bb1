"""A stored table of vectors in folders by cell, for nearest neighbours that open few of them.

Cells are the Voronoi cells of centroids on the unit sphere. A request first meets the vectors of its nearest
cells; its k-th cosine there tells which other cells can still hold a better one, by the angle between request
and centroid and the cell's angular radius. With the largest angle of a cell as its radius the answer is
exact; with a quantile of the angles, what lies outside of it is missed only in cells not met at first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.operators.search import (
    FILTERS,
    QUERIES_PER_PASS,
    filter_column,
    filter_instants,
    meetings,
    nearest_start,
    top_k,
)
from pressloom.session import scratch_path, small

#: Vectors that centroids are fitted on, at most.
SAMPLE = 100_000
#: Centroids are held by every task that chooses or assigns cells.
MAX_CELLS = 4_096
#: Cells that a request meets before its other ones are judged.
FIRST_CELLS = 4
#: Share of a cell's vectors that its radius covers, unless answers have to be exact.
COVERED = 0.95
_SLACK = 1e-6


@dataclass(frozen=True)
class CellStore:
    spark: SparkSession
    path: str

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    @property
    def cells(self) -> DataFrame:
        """``cell, center, covered, radius, n``: unit centroid, angle that covers most vectors and all, and their number."""
        return self.spark.read.parquet(f"{self.path}/cells")


def _unit(column: Column) -> Column:
    norm = F.sqrt(F.aggregate(column, F.lit(0.0), lambda total, x: total + x * x))
    return F.transform(column, lambda x: x / norm)


def fit_centers(vectors: DataFrame, cells: int, sample: int = SAMPLE, seed: int = 7) -> np.ndarray:
    """Unit centroids fitted on a sample of bounded size; fewer if the sample has fewer distinct vectors."""
    n = vectors.count()
    some = vectors if n <= sample else vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(0.95 * sample / n * (1 << 20))).limit(sample)
    model = KMeans(k=max(2, cells), distanceMeasure="cosine", initMode="k-means||", maxIter=10, seed=seed).fit(some.select(array_to_vector("unit").alias("features")))
    centers = np.array(model.clusterCenters(), np.float64)
    norms = np.linalg.norm(centers, axis=1)
    return (centers / np.where(norms > 0, norms, 1)[:, None])[norms > 0]


def write_cells(vectors: DataFrame, path: str, cells: int | None = None, sample: int = SAMPLE) -> CellStore:
    """Store every vector (``id, content_vector`` and filter columns) in the folder of its nearest centroid.

    About as many cells as the root of the number of vectors, ``MAX_CELLS`` at most. Null vectors and those without
    length are nobody's neighbours and are left out. A cell of many vectors is written by several tasks.
    """
    spark = vectors.sparkSession
    usable = vectors.where(F.exists("content_vector", lambda x: x != 0) & ~F.exists("content_vector", lambda x: x.isNull() | F.isnan(x)))
    usable = usable.withColumn("unit", _unit(F.col("content_vector").cast("array<double>")))
    n = usable.count()
    if not n:
        usable.drop("unit").withColumns({"cell": F.lit(0), "angle": F.lit(0.0)}).limit(0).write.mode("overwrite").parquet(f"{path}/vectors")
        spark.createDataFrame([], "cell int, center array<double>, covered double, radius double, n long").write.mode("overwrite").parquet(f"{path}/cells")
        return CellStore(spark, path)
    wanted = min(MAX_CELLS, cells or max(2, int(n**0.5)))
    centers = fit_centers(usable.select("id", "unit"), wanted, sample)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = batch.column("unit").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            cosines = unit @ centers.T
            best = cosines.argmax(axis=1)
            angles = np.arccos(np.clip(cosines[np.arange(len(best)), best], -1, 1))
            columns = [batch.column(c) for c in batch.schema.names if c != "unit"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best, pa.int32()), pa.array(angles)], names=[*[c for c in batch.schema.names if c != "unit"], "cell", "angle"])

    schema = usable.drop("unit").schema.add("cell", T.IntegerType()).add("angle", T.DoubleType())
    placed = usable.select(*[c for c in usable.columns if c != "unit"], "unit").mapInArrow(assign, schema)
    placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    seen = spark.read.parquet(f"{path}/vectors").groupBy("cell").agg(
        F.expr(f"approx_percentile(angle, {COVERED})").alias("covered"), F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")
    )
    known = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cell int, center array<double>")
    known.join(seen, "cell").write.mode("overwrite").parquet(f"{path}/cells")
    return CellStore(spark, path)


def _choose(asked: DataFrame, store: CellStore, first: int, exact: bool) -> DataFrame:
    """``query_id, cell, round`` for requests with ``qvec`` and ``least``, their k-th cosine so far (null: not yet asked).

    Round 1 are the nearest cells; after it, all cells whose nearest possible vector is not farther than ``least``.
    """
    rows = store.cells.collect()
    numbers = np.array([row["cell"] for row in rows], np.int32)
    centers = np.array([row["center"] for row in rows], np.float64)
    radius = np.array([row["radius" if exact else "covered"] for row in rows], np.float64)

    def choose(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("qvec").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            norms = np.linalg.norm(vectors, axis=1)
            cosines = np.clip(vectors @ centers.T / np.where(norms > 0, norms, 1)[:, None], -1, 1)
            near = np.zeros(cosines.shape, bool)
            np.put_along_axis(near, np.argsort(-cosines, axis=1, kind="stable")[:, :first], True, axis=1)
            least = np.array(batch.column("least").to_numpy(zero_copy_only=False), np.float64)
            if not batch.column("begun")[0].as_py():
                taken = near
            else:
                possible = np.cos(np.maximum(np.arccos(cosines) - radius, 0))
                taken = ~near & (np.isnan(least)[:, None] | (possible + _SLACK >= least[:, None]))
            taken &= (norms > 0)[:, None]
            query, cell = np.nonzero(taken)
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(query)), pa.array(numbers[cell])], names=["query_id", "cell"])

    if not rows:
        return asked.select("query_id", F.lit(0).alias("cell")).limit(0)
    return asked.select("query_id", "qvec", "least", "begun").mapInArrow(choose, "query_id bigint, cell int")


def _meet(asked: DataFrame, chosen: DataFrame, store: CellStore, k: int, per_pass: int) -> DataFrame:
    """``query_id, id, score``: best ``k`` of each request among the vectors of its chosen cells.

    Folders of cells that nobody chose are not opened. Few requests travel with the tasks; more are dealt, with the
    vectors of the cells they chose, by cell, where requests of one cell form blocks of bounded size.
    """
    spark = store.spark
    path = scratch_path(spark, "chosen")
    chosen.write.parquet(path)
    chosen = spark.read.schema(chosen.schema).parquet(path)
    filters = [c for c in FILTERS if c in asked.columns]
    # What a request has found so far bounds what it still looks for.
    bounds = [c for c in ("least",) if c in asked.columns]
    columns = ["query_id", "qvec", *filters, *bounds]
    cells = [row["cell"] for row in chosen.select("cell").distinct().collect()]
    vectors = store.vectors.where(F.col("cell").isin(cells))
    attributes = [c for c in ("doc_category", "doc_source", "doc_sentiment") if c in vectors.columns]
    instants = [filter_instants("doc_published_at")] if "doc_published_at" in vectors.columns else []
    candidates = vectors.select("id", "content_vector", *attributes, *instants, "cell")
    schema = "query_id bigint, id string, score double"
    start = nearest_start(filters, k)
    if asked.count() <= per_pass:
        rows = {row["query_id"]: row.asDict() for row in asked.select(*columns).collect()}
        by_cell: dict[int, list] = {}
        for row in chosen.collect():
            by_cell.setdefault(row["cell"], []).append(rows[row["query_id"]])

        def run(batches):
            open_cells = {}
            for batch in batches:
                cell = batch.column("cell").to_numpy()
                for number in np.unique(cell):
                    if number not in open_cells:
                        open_cells[number] = start(by_cell[number])
                    open_cells[number][0](batch.filter(pa.array(cell == number)))
            for _, results in open_cells.values():
                yield from results()

        return top_k(candidates.mapInArrow(run, schema), k)
    load = chosen.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / per_pass).cast("int").alias("groups"))
    each = F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    group = F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int")
    questions = chosen.join(F.broadcast(load), "cell").join(asked.select(*columns), "query_id")
    questions = questions.select(F.col("cell").alias("block"), group.alias("deal"), F.lit(False).alias("candidate"), *columns)
    answers = candidates.join(F.broadcast(load), "cell").select(F.col("cell").alias("block"), each.alias("deal"), F.lit(True).alias("candidate"), *[c for c in candidates.columns if c != "cell"])
    met = questions.unionByName(answers, allowMissingColumns=True).repartition("block", "deal").sortWithinPartitions("block", "deal", "candidate")
    return top_k(met.mapInArrow(meetings(filters, k, *bounds), schema), k)


def knn_cells(requests: DataFrame, store: CellStore, k: int, exact: bool = False, first: int = FIRST_CELLS, per_pass: int = QUERIES_PER_PASS) -> DataFrame:
    """``query_id, id, score, rank`` of the ``k`` nearest vectors that pass each request's filters, by cosine.

    Two rounds: the nearest cells, then the cells that can still hold a nearer vector. A request that finds less than
    ``k`` in its first cells, for its filters, meets all cells. Vectors outside a cell's covered angle
    are the only ones ever missed, and none with ``exact``.
    """
    spark = requests.sparkSession
    filters = [filter_column(name).alias(name) for name in FILTERS if name in requests.columns]
    asked = requests.where(F.col("qvec").isNotNull()).select("query_id", F.col("qvec").cast("array<double>").alias("qvec"), *filters)
    path = scratch_path(spark, "asked")
    asked.write.parquet(path)
    asked = spark.read.schema(asked.schema).parquet(path)
    begin = asked.withColumns({"least": F.lit(None).cast("double"), "begun": F.lit(False)})
    near = _meet(asked, _choose(begin, store, first, exact), store, k, per_pass)
    path = scratch_path(spark, "near")
    near.write.parquet(path)
    near = spark.read.schema(near.schema).parquet(path)
    least = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    again = asked.join(F.broadcast(least) if small(least, QUERIES_PER_PASS) else least, "query_id", "left").withColumn("begun", F.lit(True))
    far = _meet(again, _choose(again, store, first, exact), store, k, per_pass)
    return top_k(near.drop("rank").union(far.drop("rank")), k)
