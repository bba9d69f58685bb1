from collections import Counter, defaultdict
from itertools import permutations

from pressloom.llm import audit

_SPACES = " \t\n\x0b\x0c\r"


def failures(text):
    words = "".join(" " if c in _SPACES else c for c in text).split(" ")
    words = [w for w in words if w]
    capitals = sum("A" <= c <= "Z" for c in text)
    fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * capitals > 2 * len(text), "D": any(c in "#$%&*|" for c in text)}
    return {letter for letter, failed in fails.items() if failed}


def brute_force(rows, labels):
    """Every filter applied to every document in every order, one after the other."""
    firsts = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            firsts[text or ""] = min(doc_id, firsts.get(text or "", doc_id))
    docs = defaultdict(list)
    for doc_id, text, source in rows:
        fails = failures(text or "")
        if doc_id is not None and doc_id > firsts[text or ""]:
            fails.add("E")
        docs[source or ""].append((fails, *(labels.get(doc_id, (0, 0)) if doc_id is not None else (0, 0))))
    out = {}
    for part, members in docs.items():
        shares = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[0]]
                redundant = sum(letter in m[0] for m in members) - len(gone)
                left = [m for m in left if letter not in m[0]]
                shares[letter] += len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(m[0] == {letter} for m in members), sum(m[1] == 1 for m in gone), sum(m[2] == 1 for m in gone)]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                out[part, order, step].append(shares[letter])
    return out


def as_dict(report):
    return {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in report.collect()}


def test_awkward_rows_against_brute_force(spark, awkward, awkward_rows, empty):
    labels = {1: (1, 0), 2: (0, 1), 6: (1, 1), 7: (1, 0), 99: (1, 1)}
    rows = [(k, *v) for k, v in labels.items()] + [(None, 1, 1), (2, None, None), (6, 0, 0)]
    table = spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS part", "1 AS mask")
    got = as_dict(audit.audit(awkward, table))
    assert got == brute_force([(d, t, s) for d, t, _, s, _ in awkward_rows], labels)
    assert audit.audit(empty, table).count() == 0
    assert as_dict(audit.audit(awkward, table.limit(0))) == brute_force([(d, t, s) for d, t, _, s, _ in awkward_rows], {})


def test_limits_of_each_filter(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [
        " ".join(words), " ".join(words[:199]), " ".join(words[:100] * 2), " ".join((words[:99] + words[:1]) * 2), "A" + "b" * 49, "A" + "b" * 48, "\x0b".join(words),
        *["a" + c for c in "#$%&*|!@^-_"], "Ä" * 9 + "a", "",
    ]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bits = {r["doc_id"]: r["mask"] for r in audit.masked(docs).collect()}
    assert bits == {i: sum(1 << "ABCD".index(c) for c in failures(t)) for i, t, _ in rows}


def test_sketch_clears_unique_texts_and_never_a_repeat(spark):
    from pyspark.sql import functions as F

    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50_000).alias("key")).select("key", F.xxhash64("key").alias("hash"))
    asked = {r["hash"] for r in audit.possible_repeats(rows.repartition(7), 60_000).collect()}
    counts = Counter(r["hash"] for r in rows.select("hash").collect())
    assert {h for h, n in counts.items() if n > 1} <= asked
    assert sum(counts[h] == 1 for h in asked) < 0.06 * len(counts)


def test_shapley_adds_up(spark, small_dir, documents):
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    report = audit.audit(documents, labels).collect()
    for part in {r["part"] for r in report}:
        mine = [r for r in report if r["part"] == part and r["filter_order"] == "ABCDE"]
        total = sum(r["removed"] for r in mine)
        assert sum(r["shapley"] for r in mine) == 120 * total
        assert mine[-1]["kept"] + total == mine[0]["kept"] + mine[0]["removed"]
