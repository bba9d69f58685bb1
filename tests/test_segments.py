"""The segment index against an index built anew over the current documents, and block pages against all matches."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressloom.operators import index, search, segments, select
from pressloom.operators.pages import BlockMatches
from pressloom.sources.files import Folder

SCHEMA = "id string, title string, body_snippet string, key_phrases array<string>, entities array<string>, category string, source string, sentiment_label string, published_at timestamp, content_vector array<float>"
AS_OF = datetime(2024, 1, 31)
WORDS = [f"word{i}" for i in range(40)]


def make_docs(n, seed, first=0):
    rng = random.Random(seed)

    def text(k):
        return " ".join(rng.choices(WORDS, weights=[1 / (i + 1) for i in range(len(WORDS))], k=rng.randint(0, k)))

    return [
        (
            str(first + i), text(6), text(40), [text(2) for _ in range(rng.randint(0, 3))], [text(1)] if rng.random() < 0.5 else None,
            rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c"]), rng.choice(["positive", "negative", None]),
            rng.choice([None, AS_OF - timedelta(hours=rng.randint(0, 400))]), [rng.random() for _ in range(4)],
        )
        for i in range(n)
    ]


def make_requests(spark):
    rows = []
    for i in range(16):
        rng = random.Random(i)
        rows.append((
            i, " ".join(rng.sample(WORDS, rng.randint(1, 5))) if i != 7 else "unknown only", [3, 10, 50][i % 3],
            "en" if i % 4 == 1 else None, "a" if i % 5 == 2 else None, "positive" if i % 4 == 3 else None, i % 2 == 0, i % 3 != 0,
            "2024-01-20" if i % 4 == 2 else None, "2024-01-29" if i % 6 == 2 else None, [rng.random() for _ in range(4)] if i % 5 else None,
        ))
    schema = "query_id long, q string, top int, category string, source string, sentiment string, semantic boolean, vector boolean, date_from string, date_to string, qvec array<double>"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    """An index after a first load, three refreshes with updates and deletes, and the documents it now holds."""
    path = str(tmp_path_factory.mktemp("segments") / "index")
    current = {d[0]: d for d in make_docs(300, 1)}
    results = [segments.refresh(spark.createDataFrame(list(current.values()), SCHEMA), path, buckets=8, fan=3)]
    for day in range(3):
        changed = make_docs(20, 10 + day, first=40 * day) + make_docs(15, 20 + day, first=1000 + 100 * day)
        gone = [str(i) for i in range(200 + 10 * day, 205 + 10 * day)] + ["unknown", "", None]
        results.append(segments.refresh(spark.createDataFrame([*changed, (None, *changed[0][1:]), ("", *changed[0][1:])], SCHEMA), path, spark.createDataFrame([(g,) for g in gone], "id string"), fan=3))
        current |= {d[0]: d for d in changed}
        for g in gone:
            current.pop(g, None)
    return path, spark.createDataFrame(list(current.values()), SCHEMA).cache(), results


def test_counts_of_refreshes(refreshed):
    _, _, results = refreshed
    assert results[0] == {"total": 300, "succeeded": 300, "failed": 0, "inserted": 300, "updated": 0, "deleted": 0}
    assert results[1] == {"total": 37, "succeeded": 35, "failed": 2, "inserted": 15, "updated": 20, "deleted": 5}


def test_statistics_and_scores_equal_a_new_index(spark, refreshed):
    path, docs, _ = refreshed
    opened = segments.open_index(spark, path)
    fresh = index.text_index(docs)
    key = lambda rows: sorted(tuple(r) for r in rows)
    assert key(opened.frequencies().select("field", "term", "df", "occurrences").collect()) == key(fresh.frequencies.collect())
    assert key(opened.stats().select("field", "n_docs", F.round("avg_len", 9)).collect()) == key(fresh.stats.select("field", "n_docs", F.round("avg_len", 9)).collect())
    assert segments.document_count(opened) == docs.count() == opened.forward().count()
    asked = make_requests(spark)
    old, new = [search.bm25(asked, i).select("query_id", "id", F.round("score", 6)).collect() for i in (fresh, opened.text_index())]
    assert key(new) == key(old)


def test_a_refresh_writes_its_own_documents_only(spark, tmp_path):
    path = str(tmp_path / "index")
    segments.refresh(spark.createDataFrame(make_docs(200, 1), SCHEMA), path, fan=9)
    before = segments.open_index(spark, path)
    files = {f for kind in ("forward", "postings", "blocks") for f in before.read(kind).inputFiles()}
    old = before.text_index().postings.count()
    segments.refresh(spark.createDataFrame(make_docs(5, 2, first=3), SCHEMA), path, fan=9)
    after = segments.open_index(spark, path)
    assert files < {f for kind in ("forward", "postings", "blocks") for f in after.read(kind).inputFiles()}
    assert after.read("forward", (2,)).count() == 5
    changed = spark.createDataFrame(make_docs(5, 2, first=3), SCHEMA)
    own = index.build_postings(index.field_tokens(changed, index.field_texts(changed)))
    assert after.read("postings", (2,)).select(F.sum(F.size("entries"))).first()[0] == own.count()
    # The reader of the first version still sees what it saw.
    assert before.text_index().postings.count() == old
    assert segments.document_count(segments.open_index(spark, path, before.version)) == 200


def test_tiers_merge_and_unused_segments_go(spark, tmp_path):
    path = str(tmp_path / "index")
    for n in range(5):
        segments.refresh(spark.createDataFrame(make_docs(4, n, first=2 * n), SCHEMA), path, fan=2)
    opened = segments.open_index(spark, path)
    assert len(opened.segments) <= 2 and segments.document_count(opened) == 12
    current = {}
    for n in range(5):
        current |= {d[0]: d for d in make_docs(4, n, first=2 * n)}
    fresh = index.text_index(spark.createDataFrame(list(current.values()), SCHEMA))
    key = lambda rows: sorted(tuple(r) for r in rows)
    assert key(opened.frequencies().select("field", "term", "df").collect()) == key(fresh.frequencies.select("field", "term", "df").collect())
    gone = segments.vacuum(spark, path)
    assert gone and not any(Folder(spark, f"{path}/postings/segment={g}").exists() for g in gone)
    assert key(segments.open_index(spark, path).text_index().postings.select("id", "field", "term", "tf", "len").collect()) == key(fresh.postings.select("id", "field", "term", "tf", "len").collect())
    with pytest.raises(ValueError):
        segments.refresh(spark.createDataFrame(make_docs(1, 1), SCHEMA), path, fields={"title": F.col("title")})


def test_an_empty_index(spark, tmp_path):
    path = str(tmp_path / "index")
    empty = spark.createDataFrame([], SCHEMA)
    assert segments.refresh(empty, path)["inserted"] == 0
    opened = segments.open_index(spark, path)
    matches = BlockMatches(make_requests(spark), opened, F.lit(AS_OF))
    assert matches.counts().count() == 0 and matches.best().count() == 0
    segments.refresh(spark.createDataFrame(make_docs(3, 1), SCHEMA), path)
    segments.refresh(empty, path, spark.createDataFrame([("0",), ("1",), ("2",)], "id string"))
    opened = segments.open_index(spark, path)
    assert segments.document_count(opened) == 0 and opened.frequencies().count() == 0


def test_blocks_answer_like_all_matches(spark, refreshed):
    path, docs, _ = refreshed
    asked = make_requests(spark)
    blocks = BlockMatches(asked, segments.open_index(spark, path), F.lit(AS_OF))
    every = search.keyword_matches(asked, docs, F.lit(AS_OF)).cache()
    stored = search.StoredMatches(asked, every)
    key = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert key(blocks.counts().collect()) == key(stored.counts().collect())
    assert key(blocks.best().collect()) == key(stored.best().collect())
    listed = every.select("query_id", "id").where(F.pmod(F.xxhash64("id"), F.lit(9)) == 0)
    listed = listed.union(listed.select("query_id", F.lit("no such document")))
    assert key(blocks.ranks(listed).collect()) == key(stored.ranks(listed).collect())
    pages = [search.search(asked, docs, F.lit(AS_OF), matches=m).select("query_id", "rank", "id", "score", "warning").collect() for m in (blocks, every)]
    assert key(pages[0]) == key(pages[1]) and pages[0]


def test_pages_leave_most_blocks_unscored(spark, tmp_path):
    """A rare word's blocks reach the page; the many blocks of a frequent word alone are never read in full."""
    path = str(tmp_path / "index")
    rows = [(str(i), "", "common " * (1 + i % 2) + "filler " * 20 + ("rare rare rare" if i % 640 == 0 else ""), [], [], "en", "a", None, None, None) for i in range(6400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    segments.refresh(docs, path)
    asked = spark.createDataFrame([(1, "common rare", 5, None, None, None, True, False, None, None, None)], make_requests(spark).schema)
    matches = BlockMatches(asked, segments.open_index(spark, path), F.lit(AS_OF))
    assert matches.blocks.count() == 100
    read = []
    inner = matches.scored
    matches.scored = lambda chosen: (read.append(chosen.count()), inner(chosen))[1]
    page = matches.best(F.lit(5)).collect()
    assert sum(read) < 30
    assert {r["id"] for r in page} <= {str(i) for i in range(0, 6400, 640)}


def test_blocks_are_inverted_whole_from_batches_that_cut_them():
    schema = pa.schema([("block", pa.int64()), ("slot", pa.int32()), ("lens", pa.list_(pa.int32())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.list_(pa.int32())))])
    rows = [
        (0, 0, [3, 0], ["a b", ""], [[2, 1], []]), (0, 63, [0, 4], ["", "b"], [[], [4]]),
        (1, 1, [0, 0], ["", ""], [[], []]), (2, 5, [1, 1], ["c", "a"], [[1], [1]]),
    ]
    for cut in range(1, 5):
        parts = [rows[i : i + cut] for i in range(0, 4, cut)]
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in part], schema) for part in parts]
        found = {(r["term"], r["block"]): r for batch in segments.inverted(2)(iter(batches)) for r in batch.to_pylist()}
        assert sorted(found) == [("a", 0), ("a", 2), ("b", 0), ("c", 2)]
        both = found["b", 0]
        assert both["bits"] == 1 - (1 << 63) and both["tops"] == [(1 << 32) | 3, (4 << 32) | 4]
        assert both["entries"] == [1, (63 << 48) | (1 << 32) | 4] and both["lens"] == [3, 4]
        assert found["c", 2]["tops"] == [(1 << 32) | 1, None]


def test_only_rows_of_repeated_keys_are_ranked(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("c", 3, None), ("c", None, "z")]
    df = spark.createDataFrame(rows, "id string, at int, text string")
    order = [F.desc_nulls_last("at")]
    found = select.latest_of_repeated(df, ["id"], order)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, select.latest_per_key(df, ["id"], order).collect()))
    unique = df.where("id = 'b'")
    assert select.latest_of_repeated(unique, ["id"], order) is unique


def test_counted_texts_go_when_they_are_in_the_segment(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "scratch_path", lambda session, label: f"{tmp_path}/{label}")
    segments.refresh(spark.createDataFrame(make_docs(100, 3), SCHEMA), f"{tmp_path}/index", buckets=2)
    assert Folder(spark, f"{tmp_path}/replaced").exists() and not Folder(spark, f"{tmp_path}/counted").exists()
    assert segments.open_index(spark, f"{tmp_path}/index").forward().count() == 100
