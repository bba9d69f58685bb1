import numpy as np
import pytest

from pressloom.llm import ann
from pressloom.llm.queries import registry


def brute(ids, vectors, query, k):
    scores = (vectors * vectors[query]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]][:k]
    return [(int(ids[i]), float(scores[i])) for i in order]


def recall(found, ids, vectors, every, k):
    by, hits, wanted = {}, 0, 0
    for r in found:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for query in [i for i in range(len(ids)) if ids[i] % every == 0]:
        mine, best = sorted(by[ids[query]]), brute(ids, vectors, query, k)
        assert [m[0] for m in mine] == list(range(1, len(best) + 1))
        assert [m[1:] for m in mine] == sorted([m[1:] for m in mine], key=lambda m: (-m[1], m[0]))
        exact = dict(best)
        for _, i, score in mine:
            assert score == pytest.approx(float((vectors[list(ids).index(i)] * vectors[query]).sum()), abs=1e-12)
        hits, wanted = hits + len({m[1] for m in mine} & set(exact)), wanted + len(best)
    return hits / wanted


def test_recall_on_the_table(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    assert recall(registry()["op4_nearest_vectors"](spark, small_dir).collect(), ids, vectors, 20, 20) >= 0.9


def test_recall_over_shards_and_lengths(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 16)) * rng.uniform(0.2, 3, size=(3000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    assert recall(ann.nearest(df, shard_rows=800).collect(), np.arange(3000), vectors, 20, 20) >= 0.9


def test_common_vector_and_ties(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 400)] + [(i, [0.0, 1.0]) for i in range(400, 440)]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    own = {q: [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 20, 400)}
    assert own[0] == list(range(1, 21)) and own[20] == [*range(20)] and own[400] == list(range(401, 421))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]), (None, [1.0, 1.0]), (3, [2.0, 2.0]), (4, [1.0, 2.0, 3.0]), (5, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS shard", "2 AS score", "3 AS rank")
    found = ann.nearest(df).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [(0, 1, 3, 6.0), (0, 2, 5, 0.0)]
    assert ann.nearest(df.limit(0)).count() == 0


def test_queries_and_nodes_go_through_a_graph_together(monkeypatch):
    """A search takes one pass a layer for all its queries and a graph is built in batches, with what single steps find."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(2000, 8)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    passes, near = [], ann.Graph._near
    monkeypatch.setattr(ann.Graph, "_near", lambda self, queries, *rest: passes.append(len(queries)) or near(self, queries, *rest))
    graph = ann.Graph.build(vectors)
    assert len(passes) < 300
    passes.clear()
    queries = rng.normal(size=(300, 8)).astype(np.float32)
    found = graph.search(queries, 10)
    assert passes == [300] * len(graph.links)
    assert all(len(set(row)) == 10 for row in found.tolist())
    best = np.argsort(-(queries @ vectors.T), axis=1)[:, :10]
    assert np.mean([len({*a} & {*b}) / 10 for a, b in zip(found.tolist(), best.tolist())]) > 0.95


def test_small_shards_find_all(spark, monkeypatch):
    """Shards that are in sight as a whole: results are those of brute force, whatever the blocks; equal vectors keep their ids."""
    rng = np.random.default_rng(3)
    vectors = rng.integers(-3, 4, size=(400, 2)).astype(float)
    vectors[(vectors == 0).all(axis=1)] = 1
    ids = np.arange(400)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    for blocks in (1, 8):
        monkeypatch.setattr(ann, "BLOCKS", blocks)
        rows = ann.usable(df)
        found = ann.search(ann.build_index(rows, 20, 30), rows.where("vec_id % 4 = 0"), 20, block_rows=7).collect()
        by = {}
        for r in sorted(found, key=lambda r: r["rank"]):
            by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert by == {int(q): brute(ids, vectors, q, 20) for q in ids[::4]}
