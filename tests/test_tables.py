"""Writes: rerunning changes nothing, failures leave the old state, edge cases of the upsert."""

import glob
import os
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom import schemas
from pressloom.operators import index
from pressloom.session import scratch_path
from pressloom.sources import articles, publish, tables
from pressloom.sources.files import Folder


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def numbers(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v int, run_date string")


def test_overwrite_partition_is_idempotent(spark):
    path = scratch_path(spark, "t")
    one = numbers(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"))
    other = numbers(spark, ("c", 3, "2024-01-02"))
    assert tables.overwrite_partition(one, path, "run_date", "2024-01-01") == 2
    assert tables.overwrite_partition(other, path, "run_date", "2024-01-02") == 1
    before = rows(spark.read.parquet(path), "k", "v")
    assert tables.overwrite_partition(one, path, "run_date", "2024-01-01") == 2
    assert rows(spark.read.parquet(path), "k", "v") == before == [("a", 1), ("b", 2), ("c", 3)]


def test_overwrite_with_nothing_empties_the_partition(spark):
    path = scratch_path(spark, "t")
    tables.overwrite_partition(numbers(spark, ("a", 1, "2024-01-01")), path, "run_date", "2024-01-01")
    tables.overwrite_partition(numbers(spark, ("b", 1, "2024-01-02")), path, "run_date", "2024-01-02")
    nothing = numbers(spark, ("a", 1, "2024-01-01")).filter(F.lit(False))
    assert tables.overwrite_partition(nothing, path, "run_date", "2024-01-01") == 0
    assert rows(spark.read.parquet(path), "k") == [("b",)]


def test_overwrite_rejects_foreign_rows_and_keeps_the_old(spark):
    path = scratch_path(spark, "t")
    tables.overwrite_partition(numbers(spark, ("a", 1, "2024-01-01")), path, "run_date", "2024-01-01")
    mixed = numbers(spark, ("b", 1, "2024-01-01"), ("c", 1, "2024-01-02"))
    with pytest.raises(ValueError, match="1 rows"):
        tables.overwrite_partition(mixed, path, "run_date", "2024-01-01")
    assert rows(spark.read.parquet(path), "k") == [("a",)]


def test_swap_recovers_from_a_crash_between_its_moves(spark):
    path = scratch_path(spark, "t") + "/data"
    spark.range(3).write.parquet(path)
    folder = Folder(spark, path)
    folder._move(folder.path, folder.previous)
    folder.recover()
    assert spark.read.parquet(path).count() == 3


def test_merge_upsert(spark):
    path = scratch_path(spark, "t")
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 9, "n")], "k string, v int, w string")
    assert tables.merge_upsert(target, path, ["k"]) == {"inserted": 3, "updated": 0, "total": 3}
    source = spark.createDataFrame([("b", 20, "yy"), ("c", 30, "z"), (None, 90, "nn")], "k string, v int, w string")
    assert tables.merge_upsert(source, path, ["k"], ["v"]) == {"inserted": 2, "updated": 1, "total": 3}
    stored = {(r.k, r.v, r.w) for r in spark.read.parquet(path).collect()}
    assert stored == {("a", 1, "x"), ("b", 20, "y"), ("c", 30, "z"), (None, 9, "n"), (None, 90, "nn")}


def test_merge_updates_to_null_and_every_copy_in_the_target(spark):
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    source = spark.createDataFrame([("a", None)], "k string, v int")
    assert sorted(tables.merge_rows(target, source, ["k"]).select("k", "v", "_change").collect(), key=str) == sorted(
        [("a", None, "updated"), ("a", None, "updated"), ("b", 3, "kept")], key=str
    )


def test_merge_rejects_repeated_source_keys_and_unknown_columns(spark):
    path = scratch_path(spark, "t")
    tables.merge_upsert(spark.createDataFrame([("a", 1)], "k string, v int"), path, ["k"])
    with pytest.raises(ValueError, match="share a key"):
        tables.merge_upsert(spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int"), path, ["k"])
    with pytest.raises(ValueError, match="not in the target"):
        tables.merge_upsert(spark.createDataFrame([("b", 1)], "k string, z int"), path, ["k"])
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1)]


def test_merge_survives_a_hot_key(spark):
    """A third of the target under one key, a third under NULL."""
    target = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    source = spark.createDataFrame([("hot", -1), ("1", -2), ("new", -3)], "k string, v bigint")
    merged = tables.merge_rows(target, source, ["k"])
    counts = {r["_change"]: r["n"] for r in merged.groupBy("_change").agg(F.count("*").alias("n")).collect()}
    assert counts == {"updated": 3001, "kept": 5999, "inserted": 1}


def test_index_upsert_is_idempotent(spark):
    path = scratch_path(spark, "t")
    docs = spark.createDataFrame(
        [("1", "a", datetime(2024, 1, 1)), ("1", "b", datetime(2024, 1, 2)), ("", "c", None), (None, "d", None)],
        "id string, title string, published_at timestamp",
    )
    full = docs.select(
        *[
            F.col(f.name) if f.name in docs.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.SEARCH_DOC.fields
        ]
    )
    first = index.upsert_index(full, path)
    assert (first["total"], first["succeeded"], first["failed"], first["inserted"]) == (4, 2, 2, 1)
    again = index.upsert_index(full, path)
    assert (again["inserted"], again["updated"]) == (0, 1)
    assert rows(spark.read.parquet(path), "id", "title") == [("1", "b")]
    stats = publish.index_stats(spark, path).first()
    assert stats["document_count"] == 1 and stats["storage_bytes"] > 0


def test_publish_switches_versions(spark):
    root = scratch_path(spark, "t")
    for version in (1, 2):
        spark.range(version).write.parquet(f"{root}/v{version}")
        publish.publish(spark, "pressloom_test_alias", f"{root}/v{version}")
        assert spark.table("pressloom_test_alias").count() == version
    with pytest.raises(FileNotFoundError):
        publish.publish(spark, "pressloom_test_alias", f"{root}/v3")
    assert spark.table("pressloom_test_alias").count() == 2


def test_ingest_table_replays_a_batch(spark):
    path = scratch_path(spark, "t")
    seen = spark.createDataFrame([("ab12", "u", "c", "2"), ("ab12", "v", "c", "1")], "url_hash string, url string, category string, ingested_at string")
    for _ in range(2):
        assert tables.mark_ingested(seen, path, "b-0") == 1
    table = tables.read_ingested(spark, path)
    assert rows(tables.current_ingested(table), "partitionKey", "rowKey", "url") == [("ab", "ab12", "u")]
    assert tables.read_ingested(spark, path, except_batch="b-0").count() == 0


def test_pending_round_trip(spark):
    path = scratch_path(spark, "t")
    work = spark.createDataFrame(
        [("c/2024-01-01/h.json", "h", "c", datetime(2024, 1, 1)), ("c/2024-01-01/g.json", None, "c", datetime(2024, 1, 1))],
        "blob_path string, url_hash string, category string, ingested_at timestamp",
    )
    assert tables.write_pending(work, path) == {"total": 2, "enqueued": 1, "failed": 1}
    assert tables.pending_depth(spark, path) == 1
    message = tables.peek_pending(spark, path, 500).first()
    assert (message["blobPath"], message["urlHash"], message["malformed"]) == ("c/2024-01-01/h.json", "h", False)
    broken = spark.createDataFrame([("!!", None, 0), ("e30=", None, 0)], "body string, enqueued_at timestamp, attempts int")
    assert [r["malformed"] for r in tables.decode_pending(broken).collect()] == [True, True]


def test_audit_by_date(spark):
    root = scratch_path(spark, "t")
    events = spark.createDataFrame(
        [("h", datetime(2024, 1, 1, 5), True), ("h", datetime(2024, 1, 2, 5), False)], "url_hash string, ts timestamp, ok boolean"
    )
    tables.append_audit(tables.audit_rows(events, "enrich_complete", ["ok"]), root)
    found = tables.audits_by_date(spark, root, date(2024, 1, 1)).collect()
    assert [(r["rowKey"], r["details"]) for r in found] == [("h_enrich_complete_1704085200000", '{"ok":true}')]


def test_foreign_documents(spark, tmp_path):
    """Pretty-printed files, one per article; files elsewhere are no articles."""
    folder = tmp_path / "technology" / "2024-01-15"
    folder.mkdir(parents=True)
    (folder / "abc123.json").write_text('{\n  "title": "T",\n  "url": "u",\n  "source": {"id": null, "name": "P"}\n}\n')
    (tmp_path / "technology" / "loose.json").write_text('{"title": "x"}')
    found = articles.read_articles(spark, str(tmp_path)).collect()
    assert [(r["id"], r["category"], r["ingest_date"], r["title"], r["source"]["name"]) for r in found] == [
        ("abc123", "technology", date(2024, 1, 15), "T", "P")
    ]


def test_json_lines_round_trip(spark):
    path = scratch_path(spark, "t")
    data = spark.createDataFrame([("T", None)], "title string, content string")
    tables.write_json(data, path)
    assert spark.read.schema(data.schema).json(path).collect() == [("T", None)]


def test_silver_schema_survives_days_without_entities(spark):
    """An empty array reads as the same type as a filled one."""
    root = scratch_path(spark, "t")
    for day, entities in (("2024-01-01", []), ("2024-01-02", [("Apple", "Organization", None, 0.9)])):
        row = {f.name: None for f in schemas.SILVER.fields}
        row.update(id=day, category="business", article_date=date.fromisoformat(day), entities=entities, nlpStatus="ok")
        frame = spark.createDataFrame([tuple(row.values())], schemas.SILVER)
        tables.write_partitioned(frame, root, "category", "article_date")
    window = articles.read_silver_window(spark, root, date(2024, 1, 2), 7, ["business", "health"])
    assert rows(window.select("id", F.size("entities").alias("n")), "id", "n") == [("2024-01-01", 0), ("2024-01-02", 1)]
    assert articles.read_silver_window(spark, root, date(2023, 1, 2), 7, ["business"]).count() == 0


def test_parse_categories():
    assert articles.parse_categories(" a, ,b ") == ["a", "b"]
    assert articles.parse_categories("") == list(schemas.CATEGORIES)
    assert articles.default_run_date(date(2024, 1, 1)) == date(2023, 12, 31)
    assert articles.lookback_for(7, 3) == 7 and articles.lookback_for(7, 5) == 10


def test_search_schema_uses():
    assert set(schemas.SEARCH_FIELD_USES) == set(schemas.SEARCH_DOC.fieldNames())
    assert {f for f, uses in schemas.SEARCH_FIELD_USES.items() if "searchable" in uses} == set(index.FIELD_WEIGHTS)
    smaller = T.StructType([f for f in schemas.SEARCH_DOC.fields if f.name != "url"])
    assert index.schema_warnings(schemas.SEARCH_DOC, smaller) == ["field url exists in the live index but not in the new schema"]


MERGED = "k int, a string, b string"


def test_merge_buckets_equals_a_whole_merge(spark, tmp_path):
    random.seed(4)
    path, whole = str(tmp_path / "buckets"), str(tmp_path / "whole")
    for turn in range(4):
        keys = random.sample(range(300), 12 if turn else 200)
        rows = [(k, f"a{turn}", f"b{k}") for k in keys] + [(None, f"n{turn}", None)]
        source = spark.createDataFrame(rows, MERGED)
        if turn == 2:
            source = source.select("k", "a")
        got = tables.merge_buckets(source, path, ["k"], ["a"] if turn else None, buckets=16)
        assert got == tables.merge_upsert(source, whole, ["k"], ["a"] if turn else None)
        assert sorted(map(tuple, tables.bucketed_table(spark, path).collect()), key=str) == sorted(map(tuple, spark.read.parquet(whole).collect()), key=str)


def test_whole_rows_are_replaced_without_moving_the_others(spark, tmp_path, monkeypatch):
    random.seed(5)
    path, whole = str(tmp_path / "buckets"), str(tmp_path / "whole")
    joined = []
    merge = tables.merge_rows
    for turn in range(4):
        rows = [(k, f"a{turn}", f"b{k}") for k in random.sample(range(300), 40 if turn else 200)] + [(None, f"n{turn}", None)]
        source = spark.createDataFrame(rows, MERGED)
        if turn == 2:
            # From files that count as large: dealt by the tasks that read them.
            source.write.parquet(f"{tmp_path}/stored")
            source = spark.read.parquet(f"{tmp_path}/stored")
            monkeypatch.setattr(tables, "SMALL_FILE", 1)
        if turn == 3:
            monkeypatch.setattr(tables, "REPLACED_KEYS", 10)
        want = tables.merge_upsert(source, whole, ["k"])
        monkeypatch.setattr(tables, "merge_rows", lambda *args: (joined.append(turn), merge(*args))[1])
        assert tables.merge_buckets(source, path, ["k"], buckets=8) == want
        monkeypatch.setattr(tables, "merge_rows", merge)
        assert sorted(map(tuple, tables.bucketed_table(spark, path).collect()), key=str) == sorted(map(tuple, spark.read.parquet(whole).collect()), key=str)
    assert joined == []
    # Every stored copy of a key becomes the new row, by the general merge.
    for folder in glob.glob(f"{path}/_bucket=*"):
        spark.read.parquet(folder).where("k is not null").write.mode("append").parquet(folder)
    k = next(r["k"] for r in spark.read.parquet(whole).where("k is not null").collect())
    assert tables.merge_buckets(spark.createDataFrame([(k, "new", "new")], MERGED), path, ["k"])["updated"] == 2
    assert tables.bucketed_table(spark, path).where("a = 'new'").count() == 2


def test_merge_buckets_touches_only_folders_with_source_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "buckets")
    tables.merge_buckets(spark.createDataFrame([(k, "a", "b") for k in range(200)], MERGED), path, ["k"], buckets=16)
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/_bucket=*/*.parquet")}
    read = []
    whole = tables.merge_rows
    monkeypatch.setattr(tables, "merge_rows", lambda target, *rest: (read.extend(target.inputFiles()), whole(target, *rest))[1])
    source = spark.createDataFrame([(7, "new", "b"), (1000, "new", "b")], MERGED)
    touched = {r[0] for r in source.select(tables.key_bucket(["k"], source.columns, 16)).collect()}
    assert tables.merge_buckets(source, path, ["k"], ["a"]) == {"inserted": 1, "updated": 1, "total": 2}
    folder = lambda f: int(f.split("_bucket=")[1].split("/")[0])
    assert {folder(f) for f in read} <= touched
    left = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/_bucket=*/*.parquet")}
    assert {f for f in files if folder(f) not in touched} == {f for f in left if folder(f) not in touched and f in files}
    assert all(left[f] == files[f] for f in left if folder(f) not in touched)
    assert glob.glob(f"{path}/_merge*") == []


def test_merge_buckets_refuses_ambiguous_keys_and_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "buckets")
    tables.merge_buckets(spark.createDataFrame([(1, "a", "b")], MERGED), path, ["k"], buckets=4)
    with pytest.raises(ValueError):
        tables.merge_buckets(spark.createDataFrame([(1, "x", "b"), (1, "y", "b")], MERGED), path, ["k"])
    assert [tuple(r) for r in tables.bucketed_table(spark, path).collect()] == [(1, "a", "b")]
