import random

import numpy as np
import pytest

from pressloom.llm import graphs, neardup
from pressloom.llm.queries import registry
from pressloom.llm.words import Powers


def shingles(text, k):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lower = lower.replace(space, " ")
    words = [w for w in lower.split(" ") if w]
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(texts, k, percent=80):
    sets = {d: shingles(t, k) for d, t in texts}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    where = {}
    for d in ids:
        for s in sets[d]:
            where.setdefault(s, []).append(d)
    for a in ids:
        met = {b for s in sets[a] for b in where[s] if b > a}
        for b in met:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def check(rows, texts, k):
    expected = brute(texts, k)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
        assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_whole_table(spark, small_dir, documents):
    check(registry()["op10_near_duplicates"](spark, small_dir).collect(), [(r["doc_id"], r["text"]) for r in documents.collect()], 4)


def family(draw, size, words, most):
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    for _ in range(size):
        own = list(base)
        for _ in range(draw.randrange(most + 1)):
            own[draw.randrange(words)] = f"w{draw.randrange(40)}"
        yield " ".join(own)


def test_large_group_of_near_copies(spark):
    """Members with many changes are near to few others or to none; every link counts."""
    draw = random.Random(4)
    texts = [*family(draw, 250, 120, 7), *family(draw, 60, 40, 4), *["one and the same text again and again"] * 80]
    texts += [f"a document of its own number {i} " * 5 for i in range(50)]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    check(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), k=4).collect(), rows, 4)


def test_short_texts_and_threshold(spark):
    words = [f"t{i}" for i in range(13)]
    rows = [(1, "one two"), (2, "ONE  two"), (3, "one two three"), (4, " ".join(words)), (5, " ".join(words[:-1])), (6, " ".join(words[:-3])), (7, "É é"), (8, "é é")]
    check(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect(), rows, 4)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    powers = Powers()
    del powers
    for shared, each in ((900, 100), (50, 50), (5, 2), (1, 0)):
        hits, size = [], 240
        for _ in range(12):
            both = rng.integers(0, 1 << 63, shared).astype(np.uint64)
            a, b = [np.concatenate([both, rng.integers(0, 1 << 63, each).astype(np.uint64)]) for _ in range(2)]
            bins = neardup.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), size)
            assert (bins != np.iinfo(np.uint64).max).all()
            hits.append((bins[0] == bins[1]).mean())
        assert np.mean(hits) == pytest.approx(shared / (shared + 2 * each), abs=0.05)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)] + [(1199, 500)]
    links = spark.createDataFrame(chain + star + [(7, 7), (None, 3)], "a long, b long")
    found = {r["node"]: r["root"] for r in graphs.components(links).collect()}
    assert all(found[i] == 0 for i in range(301))
    assert all(found[i] == 500 for i in [500, *range(1000, 1200)])
    assert len(found) == 301 + 201


def test_awkward_rows(awkward, empty):
    rows = neardup.near_duplicates(awkward).collect()
    assert len(rows) == 12
    assert {(r["n_shingles"], r["component_id"] == r["doc_id"], r["kept"]) for r in rows if r["doc_id"] in (1, 2, 3, 9)} == {(0, True, True)}
    assert {r["component_id"] for r in rows if r["doc_id"] in (6, 7)} == {6}
    left = neardup.dedup(awkward)
    assert left.columns == awkward.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in left.collect() if r["doc_id"] is not None) == [(False, i) for i in (1, 2, 3, 4, 5, 6, 8, 9)]
    assert neardup.near_duplicates(empty).count() == 0 and neardup.dedup(empty).count() == 0


def test_rows_without_id_are_read_once_and_one_of_a_group_stays(spark):
    words = [f"w{i}" for i in range(120)]
    rows = [(None, " ".join(words[:60] + [f"x{i}"] + words[61:])) for i in range(200)] + [(None, "quite another text of some words")] * 5 + [(7, "a b c d e f")] * 3
    docs = spark.createDataFrame([(d, t, f"note {t}") for d, t in rows], "doc_id long, text string, tie string")
    assert [r["n"] for r in neardup.dedup(docs).groupBy("doc_id").count().toDF("doc_id", "n").orderBy("doc_id").collect()] == [2, 1]
    classes = spark.createDataFrame([(i, None, h) for i, h in enumerate(r["h"] for r in docs.where("doc_id IS NULL").selectExpr("xxhash64(text) AS h").distinct().collect())], "node long, rep long, rep_tie long")
    wanted = classes.selectExpr("*", "0L AS low", "0L AS high")
    met = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"]) & (wanted["rep_tie"] == neardup.F.xxhash64("text")))
    assert met.count() == 205


def test_settled_links_take_one_round_and_one_file(spark, monkeypatch):
    """Links to the smallest node are seen to be settled after one round, and few links are one file of each round."""
    staged = []
    monkeypatch.setattr(graphs, "stage", lambda df, label, stage=graphs.stage: staged.append(stage(df, label)) or staged[-1])
    links = spark.createDataFrame([(i, 0) for i in range(1, 50)], "a long, b long").repartition(8)
    assert {r["root"] for r in graphs.components(links).collect()} == {0}
    assert len(staged) == 2 and len(staged[1].inputFiles()) == 1


def test_rounds_without_links_contract_nothing(spark, monkeypatch):
    """Links are contracted once where a later round finds no more."""
    calls = []
    monkeypatch.setattr(neardup, "components", lambda links, find=graphs.components: calls.append(links.count()) or find(links))
    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(60)]
    texts = [(i, " ".join([*base, f"x{i}"])) for i in range(12)]
    texts += [(20, " ".join([*base[:20], *(f"y{i}" for i in range(60))])), (21, " ".join([*base[:20], *(f"z{i}" for i in range(60))]))]
    rows = neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 4).collect()
    check(rows, texts, 4)
    assert len(calls) == 1
