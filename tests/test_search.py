"""Search against brute force on a small corpus."""

import math
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressloom.functions.text import STOP_WORDS
from pressloom.operators import index, requests, search
from pressloom.session import scratch_path

AS_OF = datetime(2024, 1, 10)
DIMS = 8


def terms_of(text):
    return [w for w in re.findall(r"\w+", text.lower()) if w not in STOP_WORDS]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    words = "market storm vaccine chip election river bank energy rocket virus court wheat".split()
    docs = []
    for n in range(60):
        vector = [rng.gauss(0, 1) for _ in range(DIMS)] if n % 10 else ([0.0] * DIMS if n == 0 else None)
        docs.append(
            {
                "id": f"d{n:02d}",
                "url": f"u{n}",
                "title": " ".join(rng.choices(words, k=3)),
                "body_snippet": "the " + " ".join(rng.choices(words[:8], k=rng.randint(5, 30))),
                "source": rng.choice(["A", "B"]),
                "category": rng.choice(["technology", "science"]),
                "published_at": AS_OF - timedelta(days=rng.randint(0, 12), hours=3),
                "sentiment_label": rng.choice(["positive", "negative", None]),
                "sentiment_score_positive": 0.5,
                "entities": rng.choices(["Wheat", "Rocket"], k=rng.randint(0, 2)),
                "key_phrases": rng.choices(["energy bank", "court"], k=rng.randint(0, 2)),
                "content_vector": vector,
            }
        )
    docs[7]["content_vector"] = docs[8]["content_vector"]
    return docs


@pytest.fixture(scope="module")
def docs(spark, corpus):
    from pressloom import schemas

    names = schemas.SEARCH_DOC.fieldNames()
    return spark.createDataFrame([tuple(d[n] for n in names) for d in corpus], schemas.SEARCH_DOC).cache()


QUERIES = {1: "storm vaccine", 2: "the energy bank of wheat", 3: "unknown words", 4: "rocket"}


def asked(spark, **changes):
    """Valid requests; keyword arguments set a column for all, as a value or a dict by query id."""
    columns = dict(
        q=QUERIES, top=5, category=None, source=None, sentiment=None, semantic=False, vector=True,
        date_from=None, date_to=None, qvec=None,
    )
    columns.update(changes)
    kinds = dict(q="string", top="int", semantic="boolean", vector="boolean", qvec="array<float>")
    pick = [[v.get(i) if isinstance(v, dict) else v for v in columns.values()] for i in QUERIES]
    schema = "query_id bigint, " + ", ".join(f"{n} {kinds.get(n, 'string')}" for n in columns)
    return spark.createDataFrame([(i, *p) for i, p in zip(QUERIES, pick)], schema)


def brute_bm25(corpus, query, k1=1.2, b=0.75):
    fields = {
        name: [terms_of(" ".join(d[name]) if isinstance(d[name], list) else d[name]) for d in corpus]
        for name in index.FIELD_WEIGHTS
    }
    scores = Counter()
    for name, texts in fields.items():
        average = sum(map(len, texts)) / len(texts)
        for term in set(terms_of(query)):
            df = sum(term in text for text in texts)
            idf = math.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
            for doc, text in zip(corpus, texts):
                tf = text.count(term)
                if tf:
                    norm = tf + k1 * (1 - b + b * len(text) / average)
                    scores[doc["id"]] += index.FIELD_WEIGHTS[name] * idf * tf * (k1 + 1) / norm
    return scores


def as_scores(df):
    return {(r["query_id"], r["id"]): round(r["score"], 6) for r in df.collect()}


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("limit", [search.BROADCAST_TERMS, 0])
def test_bm25_matches_brute_force(spark, corpus, docs, stored, limit, monkeypatch):
    """Both index forms, and both with and without broadcasting the request terms."""
    monkeypatch.setattr(search, "BROADCAST_TERMS", limit)
    built = index.write_text_index(docs, scratch_path(spark, "t"), buckets=4) if stored else index.text_index(docs)
    expected = {
        (i, d): round(s, 6) for i, q in QUERIES.items() for d, s in brute_bm25(corpus, q).items()
    }
    assert as_scores(search.bm25(asked(spark), built)) == expected


def test_postings_count_each_term(spark):
    texts = spark.createDataFrame([("a", "b a b"), ("e", ""), ("n", None)], "id string, t string")
    built = index.build_postings(index.field_tokens(texts, {"t": F.col("t")}))
    rows = sorted((r["id"], r["term"], r["tf"], r["len"]) for r in built.collect())
    assert rows == [("a", "b", 2, 2)]  # "a" is a stop word


def brute_knn(corpus, vector, k, keep=lambda d: True):
    q = np.array(vector) / np.linalg.norm(vector)
    scored = []
    for d in corpus:
        v = d["content_vector"]
        if v is not None and np.linalg.norm(v) > 0 and keep(d):
            v = np.array(v, dtype=np.float32).astype(float)
            scored.append((-round(float(q @ (v / np.linalg.norm(v))), 6), d["id"]))
    return [d for _, d in sorted(scored)[:k]]


@pytest.mark.parametrize("per_pass", [100, 1])
def test_knn_matches_brute_force(spark, corpus, docs, per_pass):
    vectors = {i: [float((i * j) % 5 - 2) for j in range(1, DIMS + 1)] for i in QUERIES}
    vectors[4] = corpus[7]["content_vector"]
    found = search.knn(asked(spark, qvec=vectors), docs.select("id", "content_vector"), 7, per_pass)
    got = {i: [r["id"] for r in sorted(found.filter(F.col("query_id") == i).collect(), key=lambda r: r["rank"])] for i in QUERIES}
    assert got == {i: brute_knn(corpus, np.float32(v).astype(float), 7) for i, v in vectors.items()}
    assert got[4][:2] == ["d07", "d08"]  # equal vectors: by id


def test_knn_applies_filters_first(spark, corpus, docs):
    vectors = {i: [1.0, -1.0] * (DIMS // 2) for i in (1, 2, 4)}
    wanted = asked(
        spark, qvec=vectors, category={1: "science"}, sentiment={2: "negative"}, date_from={4: "2024-01-02"}, date_to={4: "2024-01-05"}
    )
    found = search.knn(wanted, search._doc_attributes(docs, "content_vector"), 60)
    tests = {
        1: lambda d: d["category"] == "science",
        2: lambda d: d["sentiment_label"] == "negative",
        4: lambda d: datetime(2024, 1, 2) <= d["published_at"] <= datetime(2024, 1, 5, 23, 59, 59),
    }
    for i, test in tests.items():
        got = {r["id"] for r in found.filter(F.col("query_id") == i).collect()}
        assert got == set(brute_knn(corpus, vectors[i], 60, test)) and got
    assert found.filter(F.col("query_id") == 3).isEmpty()


def test_knn_keeps_many_requests_off_the_driver(spark, corpus, docs, monkeypatch):
    """Blocks of requests meet the candidates in one scan, and nothing is collected while the plan is built."""
    ids = range(1, 41)
    vectors = {i: [float((i * j) % 7 - 3) or 0.5 for j in range(1, DIMS + 1)] for i in ids}
    categories = {i: "science" for i in ids if i % 3 == 0}
    rows = [(i, vectors[i], categories.get(i), "2024-01-02" if i % 4 == 0 else None) for i in ids]
    requests = spark.createDataFrame(rows, "query_id long, qvec array<double>, category string, date_from string")
    requests = requests.withColumn("date_from", F.to_date("date_from"))
    candidates = search._doc_attributes(docs, "content_vector")

    def refuse(*_):
        raise AssertionError("collected")

    with monkeypatch.context() as held:
        held.setattr(type(requests), "collect", refuse)
        found = search.knn(requests, candidates, 6, queries_per_pass=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    got = {i: [] for i in ids}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append(r["id"])

    def keep(i):
        return lambda d: (i not in categories or d["category"] == "science") and (i % 4 or d["published_at"] >= datetime(2024, 1, 2))

    assert got == {i: brute_knn(corpus, vectors[i], 6, keep(i)) for i in ids}


def test_knn_without_any_vector(spark, docs):
    assert search.knn(asked(spark), docs.select("id", "content_vector"), 5).isEmpty()


def test_rrf_ignores_the_order_of_lists(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "query_id bigint, id string, rank int")
    b = spark.createDataFrame([(1, "y", 1)], "query_id bigint, id string, rank int")
    assert as_scores(search.rrf(a, b)) == as_scores(search.rrf(b, a))
    assert as_scores(search.rrf(a, b))[(1, "y")] == round(1 / 62 + 1 / 61, 6)


def test_modes(spark, docs):
    vectors = {1: [1.0] * DIMS, 4: [1.0] * DIMS}
    wanted = asked(spark, qvec=vectors, vector={1: True, 2: True, 3: False, 4: True}, semantic={1: False, 2: False, 3: False, 4: True})
    results = search.search(wanted, docs, F.lit(AS_OF).cast("timestamp")).collect()
    by_query = {i: [r for r in results if r["query_id"] == i] for i in QUERIES}
    assert [r["rank"] for r in sorted(by_query[1], key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]
    assert {r["warning"] for r in by_query[1]} == {None}
    assert {r["warning"] for r in by_query[2]} == {search.WARNING}
    assert by_query[3] == []  # no vector asked for, no term known
    assert all(r["score"] < 0.04 for r in by_query[1]) and all(0 <= r["score"] <= 1 for r in by_query[4])


def test_freshness_counts_only_without_semantic(spark, corpus, docs):
    as_of = F.lit(AS_OF).cast("timestamp")
    boosted = as_scores(search.keyword_matches(asked(spark), docs, as_of))
    plain = as_scores(search.keyword_matches(asked(spark, semantic=True), docs, as_of))
    assert set(boosted) == set(plain)
    for (query, doc), score in plain.items():
        days = (AS_OF - next(d["published_at"] for d in corpus if d["id"] == doc)).total_seconds() / 86400
        factor = 1 + max(0.0, 1 - math.log(1 + days / 7 * (math.e - 1)) if days < 7 else 0.0)
        assert boosted[(query, doc)] == pytest.approx(score * factor, abs=2e-5)


def test_filters_and_report(spark, corpus, docs):
    as_of = F.lit(AS_OF).cast("timestamp")
    wanted = asked(spark, category="science", vector=False)
    counts = search.facet_counts(search.keyword_matches(wanted, docs, as_of))
    report = search.search_report(wanted, search.search(wanted, docs, as_of), counts)
    rows = {r["query_id"]: r for r in report.collect()}
    science = [d for d in corpus if d["category"] == "science"]
    hits = [d["id"] for d in corpus if d["id"] in brute_bm25(corpus, QUERIES[1]) and d in science]
    assert rows[1]["count"] == len(hits) and len(rows[1]["results"]) == 5
    assert {f["value"]: f["n"] for f in rows[1]["facets"] if f["facet"] == "category"} == {"science": len(hits)}
    assert rows[3]["count"] == 0 and rows[3]["results"] is None
    assert rows[1]["query"]["category"] == "science" and rows[1]["warning"] is None


def test_user_scorer(spark, docs):
    import pandas as pd

    @F.pandas_udf("double")
    def by_length(title: pd.Series) -> pd.Series:
        return title.str.len().astype(float)

    wanted = asked(spark, semantic=True, vector=False)
    results = search.search(wanted, docs, F.lit(AS_OF).cast("timestamp"), scorer=by_length("title")).collect()
    page = sorted((r for r in results if r["query_id"] == 1), key=lambda r: r["rank"])
    assert [len(r["title"]) for r in page] == sorted((len(r["title"]) for r in page), reverse=True)


def test_literal_filters_reach_the_scan(spark, docs):
    path = scratch_path(spark, "t")
    docs.write.parquet(path)
    kept = requests.apply_filters(
        spark.read.parquet(path), category="science", source="A", sentiment="positive", date_from="2024-01-01", entity="Wheat"
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(category,science)" in plan and "GreaterThanOrEqual(published_at" in plan
    assert all("Wheat" in r["entities"] and r["source"] == "A" for r in kept.collect())


BAD = {
    "missing": (dict(), "q: missing"),
    "blank": (dict(q="  "), "q: missing"),
    "long": (dict(q="x" * 501), "500 characters"),
    "top 51": (dict(q="a", top="51"), "more than 50"),
    "top 0": (dict(q="a", top="0"), "not a whole number"),
    "top text": (dict(q="a", top="5abc"), "not a whole number"),
    "category": (dict(q="a", category="sports"), "category: not among"),
    "sentiment": (dict(q="a", sentiment="happy"), "sentiment: not among"),
    "from": (dict(q="a", date_from="15-01-2024"), "date_from: not YYYY"),
    "order": (dict(q="a", date_from="2024-02-01", date_to="2024-01-01"), "later than date_to"),
    "first error wins": (dict(q="", top="99"), "q: missing"),
}
GOOD = {
    "defaults": (dict(q=" a "), dict(q="a", top=10, vector=True, semantic=False, category=None)),
    "all": (
        dict(q="a", top="50", category=" Science", sentiment="MIXED", semantic="1", vector="false", date_from="2024-01-01"),
        dict(top=50, category="science", sentiment="mixed", semantic=True, vector=False, date_from="2024-01-01"),
    ),
    "longest": (dict(q="x" * 500), dict(top=10)),
}


def test_validate_queries(spark):
    from pressloom import schemas

    cases = list(BAD.values()) + list(GOOD.values())
    names = schemas.REQUEST.fieldNames()[1:]
    raw = spark.createDataFrame([(i, *[c[0].get(n) for n in names]) for i, c in enumerate(cases)], schemas.REQUEST)
    got = {r["query_id"]: r for r in requests.validate_queries(raw).collect()}
    for i, (_, expected) in enumerate(cases):
        if isinstance(expected, str):
            assert expected in got[i]["error"]
        else:
            assert got[i]["error"] is None
            assert {k: got[i][k] for k in expected} == expected


def test_format_results(spark, docs):
    row = requests.format_results(docs.withColumn("score", F.lit(1.0))).filter("id = 'd01'").first().asDict()
    assert set(row) == {
        "score", "id", "url", "title", "source", "category", "publishedAt", "sentimentLabel", "sentimentScore", "entities", "keyPhrases"
    }


def test_stored_index_is_read_with_its_own_buckets(spark):
    docs = spark.createDataFrame([(str(i), f"word{i % 9} and word{i % 5}") for i in range(40)], "id string, body_snippet string")
    asked = spark.createDataFrame([(1, "word1 word4"), (2, "word8")], "query_id long, q string")
    fields = {"body_snippet": F.col("body_snippet")}
    path = scratch_path(spark, "buckets")
    index.write_text_index(docs, path, fields, buckets=8)
    stored = search.bm25(asked, index.read_text_index(spark, path)).collect()
    built = search.bm25(asked, index.text_index(docs, fields)).collect()
    rounded = [sorted((r["query_id"], r["id"], round(r["score"], 9)) for r in rows) for rows in (stored, built)]
    assert rounded[0] == rounded[1] and len(stored) > 8


def test_exact_ranks_of_listed_documents(spark):
    rows = [(q, f"d{i}", round(((i * 37 + q) % 101) / 7, 6)) for q in (1, 2) for i in range(150)]
    matches = spark.createDataFrame(rows, "query_id long, id string, score double")
    listed = spark.createDataFrame([(1, "d3"), (1, "d120"), (1, "nowhere"), (2, "d149"), (2, "d0")], "query_id long, id string")
    found = {(r["query_id"], r["id"]): r["rank"] for r in search.exact_ranks(listed, matches, listed).collect()}
    order = {q: [d for _, d in sorted((-s, d) for query, d, s in rows if query == q)] for q in (1, 2)}
    assert found == {(q, d): order[q].index(d) + 1 for q, d in [(1, "d3"), (1, "d120"), (2, "d149"), (2, "d0")]}
