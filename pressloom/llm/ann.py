"""Approximate nearest neighbours: a navigable small-world graph per shard, shard results merged."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import stage

#: Vectors of a shard, queries of a block, links of a node above the ground layer (twice as many on it).
SHARD_ROWS, BLOCK_ROWS, LINKS = 4096, 512, 12
#: Nodes kept in sight while building and while searching.
BUILD_SIGHT, SEARCH_SIGHT = 64, 96
#: Nodes inserted together at most, nodes of one query looked around at once, and blocks of queries that meet a shard at once at most.
TOGETHER, STEPS, BLOCKS = 256, 4, 8
#: Vectors compared at once.
ROWS = 2048
_SEED = 11


class Graph:
    """Layers of neighbour arrays over unit-like vectors; nearness is the inner product.

    ``links[layer]`` is (nodes, width) with -1 where a node has fewer neighbours or is not on the layer. Nodes are inserted
    and searched for many at a time, so a step is one of arrays; those of one batch meet by the links of later ones.
    """

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.links, self.entry = vectors, links, entry

    @classmethod
    def build(cls, vectors: np.ndarray, width: int = LINKS, sight: int = BUILD_SIGHT) -> Graph:
        n = len(vectors)
        rng = np.random.default_rng(_SEED)
        heights = np.minimum((-np.log(1 - rng.random(n)) / math.log(width)).astype(int), 6)
        top = int(heights.max(initial=0))
        links = [np.full((n, width * (1 if layer else 2)), -1, np.int32) for layer in range(top + 1)]
        graph = cls(vectors, links, 0)
        reached, done = int(heights[0]) if n else 0, 1
        while done < n:
            end = min(n, done + max(1, min(TOGETHER, done // 4)))
            # A node above all others is the last of its batch, so that the next ones start from it.
            taller = np.flatnonzero(heights[done:end] > reached)
            end = done + int(taller[0]) + 1 if len(taller) else end
            graph._insert(np.arange(done, end), heights[done:end], reached, sight)
            if heights[end - 1] > reached:
                reached, graph.entry = int(heights[end - 1]), end - 1
            done = end
        return graph

    def _insert(self, nodes, heights, reached, sight):
        starts = np.full((len(nodes), 1), self.entry)
        for layer in range(reached, -1, -1):
            there = np.full((len(nodes), sight), -1)
            passing, staying = np.flatnonzero(heights < layer), np.flatnonzero(heights >= layer)
            if len(passing):
                there[passing, :1] = self._near(self.vectors[nodes[passing]], starts[passing], 1, layer)[0]
            if len(staying):
                found, scores = self._near(self.vectors[nodes[staying]], starts[staying], sight, layer)
                there[staying] = found
                chosen = self._diverse(found, scores, self.links[layer].shape[1] // (1 if layer else 2))
                self.links[layer][nodes[staying], : chosen.shape[1]] = chosen
                self._link(chosen, nodes[staying], layer)
            starts = there

    def _near(self, queries, starts, sight, layer):
        """Up to ``sight`` nodes for each query, nearest first, and their nearness; -1 and -inf where there are fewer."""
        n, links = len(self.vectors), self.links[layer]
        seen = np.zeros(len(queries) * n, bool)
        best = np.full((len(queries), sight), -np.inf, np.float32)
        nodes = np.full((len(queries), sight), -1)
        waiting = np.zeros((len(queries), sight), bool)
        # Work arrays that are used again: new ones of this size cost more than what is done with them.
        ours, theirs = np.empty((2, ROWS, queries.shape[1]), np.float32)

        def meet(keys):
            """Keep the nearest of new nodes and those kept before; a key tells a query and a node."""
            seen[keys] = True
            rows, ids = np.divmod(keys, n)
            scores = np.empty(len(keys), np.float32)
            for k in range(0, len(keys), ROWS):
                m = min(ROWS, len(keys) - k)
                np.take(self.vectors, ids[k : k + m], axis=0, out=ours[:m], mode="clip")
                np.take(queries, rows[k : k + m], axis=0, out=theirs[:m], mode="clip")
                np.einsum("ij,ij->i", ours[:m], theirs[:m], out=scores[k : k + m])
            good = scores > best.min(axis=1)[rows]
            rows, ids, scores = rows[good], ids[good], scores[good]
            if not len(rows):
                return
            # Keys come in order, and so do rows.
            new = np.append(True, rows[1:] != rows[:-1])
            first, place = np.flatnonzero(new), np.cumsum(new) - 1
            own, nth = rows[first], np.arange(len(rows)) - first[place]
            more = np.full((len(own), int(nth.max()) + 1), -np.inf, np.float32)
            names = np.full(more.shape, -1)
            more[place, nth], names[place, nth] = scores, ids
            every = np.concatenate([best[own], more], axis=1)
            kept = np.argpartition(-every, sight - 1, axis=1)[:, :sight]
            best[own] = np.take_along_axis(every, kept, axis=1)
            nodes[own] = np.take_along_axis(np.concatenate([nodes[own], names], axis=1), kept, axis=1)
            waiting[own] = np.take_along_axis(np.concatenate([waiting[own], names >= 0], axis=1), kept, axis=1)

        rows, at = np.nonzero(starts >= 0)
        meet(np.sort(rows * n + starts[rows, at]))
        while True:
            left = np.flatnonzero(waiting.any(axis=1))
            if not len(left):
                break
            scores = np.where(waiting[left], best[left], -np.inf)
            some = min(STEPS, sight)
            pick = np.argpartition(-scores, some - 1, axis=1)[:, :some]
            at, nth = np.nonzero(np.take_along_axis(scores, pick, axis=1) > -np.inf)
            rows, pick = left[at], pick[at, nth]
            waiting[rows, pick] = False
            around = links[nodes[rows, pick]]
            there = around >= 0
            keys = np.repeat(rows, around.shape[1])[there.ravel()] * n + around[there]
            keys = np.sort(keys[~seen[keys]])
            if len(keys):
                meet(keys[np.append(True, keys[1:] != keys[:-1])])
        order = np.argsort(-best, axis=1)
        return np.take_along_axis(nodes, order, axis=1), np.take_along_axis(best, order, axis=1)

    def _diverse(self, found, scores, limit):
        """Of nodes, nearest first, those nearer to the new one than to any chosen before; the nearest others fill up."""
        there = found >= 0
        width = max(1, int(there.sum(axis=1).max(initial=0)))
        found, scores, there = found[:, :width], scores[:, :width], there[:, :width]
        if width > limit:
            own = self.vectors[found]
            between = own @ own.transpose(0, 2, 1)
            chosen, closest, count = np.zeros(found.shape, bool), np.full(found.shape, -np.inf, np.float32), np.zeros(len(found), int)
            for at in range(width):
                take = np.flatnonzero(there[:, at] & (closest[:, at] < scores[:, at]) & (count < limit))
                chosen[take, at] = True
                count[take] += 1
                closest[take] = np.maximum(closest[take], between[take, at])
            order = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :limit]
            found = np.take_along_axis(found, order, axis=1)
        return found

    def _link(self, chosen, nodes, layer):
        """Add each of ``nodes`` to the neighbours of those it chose; where there are too many the diverse ones stay."""
        links = self.links[layer]
        width = links.shape[1]
        at, nth = np.nonzero(chosen >= 0)
        targets, sources = chosen[at, nth], nodes[at]
        order = np.argsort(targets, kind="stable")
        targets, sources = targets[order], sources[order]
        rank = np.arange(len(targets)) - np.searchsorted(targets, targets)
        for turn in range(int(rank.max(initial=-1)) // width + 1):
            some = rank // width == turn
            own, place = np.unique(targets[some], return_inverse=True)
            new = np.full((len(own), width), -1)
            new[place, rank[some] % width] = sources[some]
            around = np.concatenate([links[own], new], axis=1)
            scores = np.where(around >= 0, np.einsum("ijk,ik->ij", self.vectors[around], self.vectors[own]), -np.inf)
            order = np.argsort(-scores, axis=1)
            kept = self._diverse(np.take_along_axis(around, order, axis=1), np.take_along_axis(scores, order, axis=1), width)
            links[own] = -1
            links[own, : kept.shape[1]] = kept

    def search(self, queries: np.ndarray, n: int, sight: int = SEARCH_SIGHT) -> np.ndarray:
        """About the ``n`` nodes nearest to each vector, -1 where there are fewer; all nodes if there are no more than are kept in sight."""
        sight = max(sight, n)
        if len(self.vectors) <= sight:
            return np.tile(np.arange(len(self.vectors)), (len(queries), 1))
        starts = np.full((len(queries), 1), self.entry)
        for layer in range(len(self.links) - 1, 0, -1):
            starts = self._near(queries, starts, 1, layer)[0]
        return self._near(queries, starts, sight, 0)[0][:, :n]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``embedding`` (array<double>) of the vectors that take part, each pair once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & some).distinct()


def build_index(rows: DataFrame, neighbours: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: distinct vectors, the ids that have them, and the layers of links.

    Equal vectors are one node; of its ids only the ``neighbours + 1`` smallest can ever be among that many
    results, so no others are stored. Vectors get one more coordinate that makes all lengths equal, which
    leaves inner products with queries as they are and lets graphs be built by nearness.
    """
    first = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= neighbours + 1)
    nodes = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    square = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    nodes = stage(nodes.withColumn("square", square).withColumn("dim", F.size("embedding")), "ann-nodes")
    count, longest = nodes.agg(F.count(F.lit(1)), F.max("square")).first()
    shards = max(1, math.ceil(count / shard_rows))
    longest = longest or 0.0

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        dim = group.column("dim")[0].as_py()
        order = np.argsort(pc.list_element(group.column("ids"), 0).to_numpy())
        group = group.take(pa.array(order)).combine_chunks()
        ids = group.column("ids").combine_chunks()
        exact = group.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        extra = np.sqrt(np.maximum(0.0, longest - (exact * exact).sum(axis=1)))
        scale = 1 / math.sqrt(longest)
        graph = Graph.build((np.column_stack([exact, extra]) * scale).astype(np.float32))
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "shard": group.column("shard").slice(0, 1).cast(pa.int32()),
                "vectors": pa.array([exact.tobytes()], pa.binary()),
                "ids": pa.array([ids.flatten().to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                "held": pa.array([pc.list_value_length(ids).to_numpy().astype(np.int32).tobytes()], pa.binary()),
                "links": pa.array([[layer.tobytes() for layer in graph.links]], pa.list_(pa.binary())),
                "entry": pa.array([graph.entry], pa.int32()),
            }
        )

    sharded = nodes.select("dim", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int").alias("shard"), "embedding", "ids")
    index = sharded.groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard int, vectors binary, ids binary, held binary, links array<binary>, entry int"
    )
    return stage(index, "ann-index")


def search(index: DataFrame, queries: DataFrame, neighbours: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: blocks of queries meet every shard, the best are merged."""
    rows = queries.select("vec_id", "embedding", F.size("embedding").alias("dim"))
    n, shards = rows.count(), max(1, index.count())
    # Large blocks carry a shard less often, smaller ones keep all cores busy where shards are few.
    busy = math.ceil(4 * index.sparkSession.sparkContext.defaultParallelism / shards)
    blocks = max(1, math.ceil(n / (BLOCKS * block_rows)), min(math.ceil(n / block_rows), busy))

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        vectors = group.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        columns = {c: group.column(c).slice(0, 1) for c in ("dim", "block")}
        packed = {"queries": vectors.tobytes(), "query_ids": group.column("vec_id").to_numpy().tobytes()}
        return pa.table(columns | {c: pa.array([data], pa.binary()) for c, data in packed.items()})

    blocked = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int"))
    packed = stage(blocked.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, queries binary, query_ids binary"), "ann-queries")
    meetings = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packed, ["dim", "block"])

    def find(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                dim = row["dim"]
                exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
                ids, held = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["held"], np.int32).astype(np.int64)
                firsts = np.cumsum(held) - held
                longest = float((exact * exact).sum(axis=1).max())
                layers = [np.frombuffer(layer, np.int32).reshape(len(exact), -1) for layer in row["links"]]
                graph = Graph((exact * np.float32(1 / math.sqrt(longest))).astype(np.float32), layers, row["entry"])
                every = np.frombuffer(row["queries"], np.float64).reshape(-1, dim)
                own = np.frombuffer(row["query_ids"], np.int64)
                for first in range(0, len(every), block_rows):
                    vectors = every[first : first + block_rows]
                    nodes = graph.search((vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32), neighbours + 1)
                    at, nth = np.nonzero(nodes >= 0)
                    node = nodes[at, nth]
                    score = np.concatenate([(exact[node[k : k + 20_000]] * vectors[at[k : k + 20_000]]).sum(axis=1) for k in range(0, len(node), 20_000)])
                    # Every id of a node, but for the query's own; of each query the best.
                    each = held[node]
                    place = np.repeat(firsts[node] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                    query, found, score = np.repeat(at, each), ids[place], np.repeat(score, each)
                    other = found != own[first + query]
                    query, found, score = query[other], found[other], score[other]
                    order = np.lexsort((found, -score, query))
                    query, found, score = query[order], found[order], score[order]
                    best = np.arange(len(query)) - np.searchsorted(query, query) < neighbours
                    query, found, score = query[best] + first, found[best], score[best]
                    number = query + (np.int64(row["block"]) << 32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[query]), pa.array(number), pa.array(np.full(len(query), dim, np.int32)), pa.array(found), pa.array(score)],
                        names=["query_id", "query", "dim", "vec_id", "score"],
                    )

    # A task holds few of these wide rows at a time.
    met = meetings.withColumn("deal", F.xxhash64("dim", "shard", "block")).drop("shard")
    met = met.repartition(F.col("deal")).drop("deal")
    found = met.mapInArrow(find, "query_id long, query long, dim int, vec_id long, score double")
    best = Window.partitionBy("dim", "query").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, neighbours: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``neighbours`` nearest rows found for each row whose vec_id is divisible by ``every``.

    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``: inner product in double precision, nearest first,
    ties to the smaller vec_id; a query never finds its own id. Every row is indexed. Vectors that are
    null, empty, zero or hold a null or non-finite component, and rows without vec_id, take no part;
    vectors of another dimension are never compared; repeated rows count once, equal vectors each;
    an empty table gives no rows. Extra columns are not carried.
    """
    rows = stage(usable(vectors), "ann-rows")
    index = build_index(rows, neighbours, shard_rows)
    return search(index, rows.where(F.pmod("vec_id", F.lit(every)) == 0), neighbours)
