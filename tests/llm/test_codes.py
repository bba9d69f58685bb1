import math

import numpy as np
import pytest

from pressloom.llm import codes
from pressloom.llm.queries import registry


def brute_force(rows, entries=256, rounds=4):
    """vec_id, code, error, label_error by the rule, over every pair of part and entry."""
    kept = [(i, [min(max(math.floor(1024 * x), -codes.LARGEST), codes.LARGEST) for x in v], label) for i, v, label in rows if v and len(v) % 4 == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // 4
    parts = np.array([r[1] for r in kept], object).reshape(len(kept), 4, width)
    books = parts[:entries].copy()

    def assign():
        distances = ((parts[:, None] - books[None]) ** 2).sum(axis=3)
        best = np.array([[min(range(len(books)), key=lambda e: (distances[n, e, p], e)) for p in range(4)] for n in range(len(kept))])
        return best, [sum(distances[n, best[n, p], p] for p in range(4)) for n in range(len(kept))]

    for _ in range(rounds):
        best, _ = assign()
        for p in range(4):
            for e in set(best[:, p]):
                mine = parts[best[:, p] == e, p]
                books[e, p] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    best, errors = assign()
    totals = {}
    for (_, _, label), error in zip(kept, errors):
        totals[label] = totals.get(label, 0) + error
    flat = books.transpose(1, 0, 2).reshape(-1).tolist()
    return [(r[0], "".join(f"{e:02x}" for e in b), error, totals[r[2]]) for r, b, error in zip(kept, best.tolist(), errors)], flat


def key(row):
    return (row[0] is None, row[0] or 0, row[1:])


@pytest.mark.parametrize("slab", [1, 3, 1024])
def test_trie_against_all_pairs(monkeypatch, slab):
    monkeypatch.setattr(codes, "SLAB", slab)
    random = np.random.default_rng(slab)
    for high, width in ((2, 6), (4, 3), (1000, 5), (1, 1)):
        parts, number = codes.distinct_rows(random.integers(-high, high + 1, (300, width)))
        entries = random.integers(-high, high + 1, (9, width))
        entries[7] = entries[2]
        best, distance = codes.Trie(parts).nearest(entries)
        every = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
        assert (np.diff(number.astype(np.int64)) != 0).any() or len(parts) == 1
    assert len(codes.Trie(np.zeros((0, 4), np.int64)).nearest(entries[:, :4])[0]) == 0


def test_whole_table_against_brute_force(spark, small_dir):
    table = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    want, flat = brute_force([(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()])
    got = registry()["op13_vector_codes"](spark, small_dir).collect()
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)
    import hashlib

    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()}


def test_awkward_vectors(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=8).tolist(), int(i % 3)) for i in range(40)]
    rows += [(5, rows[5][1], 2), (5, random.normal(size=8).tolist(), None), (None, random.normal(size=8).tolist(), None), (None, None, 1)]
    rows += [(50, None, 1), (51, [], 1), (52, [1.0] * 7, 1), (53, [1.0] * 12, 1), (54, [1.0, None] * 4, 0), (55, [float("nan")] * 8, 0), (56, [float("inf")] + [0.0] * 7, 0)]
    rows += [(57, [0.0] * 8, None), (58, [1e30, -1e30] + [0.5] * 6, 9)] + [(100 + i, rows[0][1], 0) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' AS code", "1 AS error", "2 AS whole", "3 AS position").repartition(5)
    stored = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    want, _ = brute_force(stored, entries=6, rounds=3)
    got = [tuple(r)[:4] for r in codes.compress(table, entries=6, rounds=3).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert codes.compress(table.limit(0)).collect() == []
    assert codes.compress(table.where("vec_id = 50")).collect() == []
