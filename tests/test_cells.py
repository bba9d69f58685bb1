"""Nearest neighbours by stored cells against all vectors."""

from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressloom.operators import cells, search

VECTORS = "id string, content_vector array<float>, doc_category string, doc_published_at timestamp"
REQUESTS = "query_id long, qvec array<double>, category string, date_from string"
DAY = datetime(2024, 1, 1)


def points(n, seed, dims=12, clusters=20, spread=0.25):
    random = np.random.default_rng(seed)
    middles = np.random.default_rng(0).normal(size=(clusters, dims))
    return middles[random.integers(0, clusters, n)] + spread * random.normal(size=(n, dims))


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(str(i), v.tolist(), "en" if i % 10 == 0 else "fr", DAY + timedelta(days=i % 30)) for i, v in enumerate(points(3000, 1))]
    rows += [("none", None, "en", DAY), ("zero", [0.0] * 12, "en", DAY), ("odd", [float("nan")] * 12, "en", DAY), ("twin", rows[5][1], "fr", DAY)]
    return spark.createDataFrame(rows, VECTORS).repartition(5).cache()


@pytest.fixture(scope="module")
def store(spark, vectors, tmp_path_factory):
    return cells.write_cells(vectors, str(tmp_path_factory.mktemp("cells") / "store"), cells=40)


@pytest.fixture(scope="module")
def asked(spark):
    kinds = [(None, None), ("en", None), (None, "2024-01-20"), ("en", "2024-01-30"), ("de", None)]
    rows = [(i, v.tolist(), *kinds[i % 5]) for i, v in enumerate(points(60, 2))] + [(100, None, None, None), (101, [0.0] * 12, None, None)]
    return spark.createDataFrame(rows, REQUESTS).repartition(3)


def by_request(df):
    found = {}
    for row in df.collect():
        found.setdefault(row["query_id"], []).append((row["rank"], row["id"], row["score"]))
    return {q: sorted(rows) for q, rows in found.items()}


@pytest.mark.parametrize("per_pass", [1000, 4])
def test_exact_answers_equal_all_vectors(store, vectors, asked, per_pass):
    assert by_request(cells.knn_cells(asked, store, 10, exact=True, per_pass=per_pass)) == by_request(search.knn(asked, vectors, 10))


def test_recall_with_and_without_filters(store, vectors, asked):
    best, found = by_request(search.knn(asked, vectors, 20)), by_request(cells.knn_cells(asked, store, 20))
    shares = [len({r[1] for r in best[q]} & {r[1] for r in found.get(q, [])}) / len(best[q]) for q in best]
    assert np.mean(shares) >= 0.9
    assert {q for q in best} == {q for q in found}


def test_every_usable_vector_is_stored_once(store, vectors):
    assert sorted(r["id"] for r in store.vectors.select("id").collect()) == sorted(set(r["id"] for r in vectors.select("id").collect()) - {"none", "zero", "odd"})
    assert store.cells.agg(F.sum("n")).first()[0] == store.vectors.count()
    assert store.vectors.join(store.cells, "cell").where("angle > radius").count() == 0


def test_folders_of_other_cells_are_not_opened(spark, store, vectors, monkeypatch):
    opened = []
    whole = cells._meet

    def watched(asked, chosen, store, k, per_pass):
        opened.append({r["cell"] for r in chosen.collect()})
        return whole(asked, chosen, store, k, per_pass)

    monkeypatch.setattr(cells, "_meet", watched)
    one = spark.createDataFrame([(1, points(1, 3)[0].tolist(), None, None)], REQUESTS)
    assert by_request(cells.knn_cells(one, store, 5)) == by_request(search.knn(one, vectors, 5))
    assert len(opened[0]) == cells.FIRST_CELLS and len(opened[0] | opened[1]) < 20
    scanned = store.vectors.where(F.col("cell").isin(list(opened[0])))
    assert len(scanned.select("id").inputFiles()) >= 1
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan or "cell#" in plan.split("PartitionFilters")[1]


def test_empty_store_and_no_requests(spark, vectors, asked, store, tmp_path):
    nothing = cells.write_cells(vectors.limit(0), str(tmp_path / "store"))
    assert cells.knn_cells(asked, nothing, 3).count() == 0
    assert cells.knn_cells(asked.limit(0), store, 3).count() == 0


def test_candidates_below_a_known_bound_are_not_kept():
    vectors = points(3000, 5)
    ids = np.array([str(i) for i in range(3000)], dtype=object)
    cosines = np.round((vectors[:7] / np.linalg.norm(vectors[:7], axis=1)[:, None]) @ (vectors / np.linalg.norm(vectors, axis=1)[:, None]).T, 9)
    rows = [{"query_id": i, "qvec": vectors[i].tolist(), "least": None if i < 5 else float(np.sort(cosines[i])[-3])} for i in range(7)]
    take, results = search.nearest_start([], 10)(rows)
    for first in range(0, 3000, 800):
        part = slice(first, first + 800)
        take(pa.RecordBatch.from_arrays([pa.array(ids[part], pa.string()), pa.array(list(vectors[part]))], ["id", "content_vector"]))
    found = {}
    for batch in results():
        for row in batch.to_pylist():
            found.setdefault(row["query_id"], []).append((-row["score"], row["id"]))
    for i in range(7):
        want = sorted(zip((-cosines[i]).tolist(), ids))[: 10 if i < 5 else 3]
        assert [x for _, x in sorted(found[i])] == [x for _, x in want]
