import pytest

from pressloom.llm import mixing
from pressloom.llm.queries import oracle_registry, registry
from tools.compare import compare, connect


def test_against_sql(spark, small_dir):
    name = "op1_mix_sources"
    assert compare(spark, connect(small_dir), registry()[name], oracle_registry()[name], small_dir) is None


def filled(sizes, weights=(5, 2, 1), cap=3):
    """Targets by filling up step by step."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    full = set()
    while True:
        left = sum(sizes) - sum(cap * sizes[i] for i in full)
        share = left / sum(w for i, w in enumerate(weight) if i not in full)
        more = {i for i in range(len(sizes)) if i not in full and share * weight[i] > cap * sizes[i]}
        if not more:
            return [cap * s if i in full else share * weight[i] for i, s in enumerate(sizes)]
        full |= more


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 10, 1000, 5], [7, 900, 20, 1, 1, 300], [3, 1, 2, 50, 1, 1, 1, 1, 80]])
def test_targets(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes))]
    df = spark.createDataFrame(list(zip(names, sizes, sizes)), "source string, size long, n_docs long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert [found[n] for n in names] == pytest.approx(filled(sizes))
    assert sum(found.values()) == pytest.approx(sum(sizes))


def test_taken_is_near_target_with_a_hot_source(spark):
    rows = [(i, "w " * (1 + i % 17), "hot" if i % 3 else f"s{i % 12}") for i in range(3000)]
    found = mixing.mix_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == 3000 and all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    for source in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3 * max(r["size"] for r in own)


def test_reruns_agree(spark, documents):
    first, second = [sorted(map(tuple, mixing.mix_sizes(documents).collect())) for _ in range(2)]
    assert first == second


def test_awkward_rows(awkward, empty):
    found = mixing.mix(awkward)
    rows = found.collect()
    assert len(rows) == 12 and len(found.columns) == len(set(found.columns))
    assert {r["size"] for r in rows if not r["text"]} == {0}
    assert {r["source_size"] for r in rows if r["source"] is None} == {1}
    mixed = mixing.mixture(awkward)
    assert mixed.columns == awkward.columns
    made = [r["doc_id"] for r in mixed.collect()]
    for doc_id in (1, 2, 3, 4, 5, 7, 8, 9):
        assert made.count(doc_id) == sum(r["copies"] for r in rows if r["doc_id"] == doc_id)
    assert made.count(6) in (0, 2, 4, 6)
    assert {r["size"] for r in mixed.collect()} == {"extra size"}
    assert mixing.mix(empty).count() == 0 and mixing.mixture(empty).count() == 0


def test_equal_rows_are_planned_each_for_itself(spark):
    """A source of equal rows comes near its target, however many of them there are and at any rate."""
    rows = [(1, "a b c d", "hot")] * 300 + [(2, "e f", "cold")] * 200 + [(i, "one two three", "rest") for i in range(10, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    planned = {r["source"]: r["n"] for r in mixing.mix_sizes(docs).groupBy("source").sum("copies").toDF("source", "n").collect()}
    made = {r["source"]: r["n"] for r in mixing.mixture(docs).groupBy("source").count().toDF("source", "n").collect()}
    assert made == {s: n for s, n in planned.items() if n}
    assert made["hot"] != 300
