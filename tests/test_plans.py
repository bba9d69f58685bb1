"""What plans must not do, and that they hold when one key has a third of the rows."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from pressloom import schemas
from pressloom.operators import enrich, gold, index, matching, search
from pressloom.session import scratch_path, small
from pressloom.sources import tables
from workloads import tables as t

#: Queries whose result is read back from files: their plans are plain scans.
LAZY = (
    "sentiment_trends sentiment_rolling top_entities top_entities_articles trending_keywords data_quality date_spine "
    "latest_per_key dedup_new new_only backfill_candidates backfill_stats merge_counts merge_annotations "
    "entities_extract rake_phrases search_docs corpus_stats postings bm25_top knn_top rrf_hybrid rerank facets "
    "search_report filter_docs classification_report daily_alerts alerts_5m_1m hourly_latency"
).split()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins_and_no_row_udfs(spark, small_dir, name):
    plan = plan_of(queries()[name](spark, small_dir))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)


def test_gold_reads_only_its_columns(spark):
    path = scratch_path(spark, "t")
    empty = spark.createDataFrame([], schemas.SILVER)
    empty.write.parquet(path)
    silver = spark.read.schema(schemas.SILVER).parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = plan_of(gold.sentiment_trends(gold.project_silver(silver), datetime(2024, 1, 1).date()))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "content_vector" not in schema and "entities" not in schema and "EqualTo(nlpStatus,ok)" in plan


def test_dedup_with_a_hot_url(spark):
    """A third of the events are one URL: each partition sends at most one row of it."""
    events = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url_hash"),
        F.timestamp_seconds("id").alias("ingested_at"),
    )
    known = spark.createDataFrame([("1",), ("unrelated",)], "rowKey string")
    fresh = matching.drop_seen(events, known)
    assert "WindowGroupLimit" in plan_of(fresh)
    assert fresh.count() == 6000 and fresh.filter("url_hash = 'hot'").count() == 1


def test_entities_with_a_hot_name(spark, monkeypatch):
    """A third of all words is one name, with and without broadcasting the gazetteer."""
    texts = spark.range(30).select(F.col("id").cast("string"), F.expr("repeat('Bob met Alice ', 50)").alias("text"))
    names = spark.createDataFrame([("Bob", "Person", None), ("met Alice", "Event", None)], "name string, category string, subcategory string")
    for limit in (enrich.BROADCAST_NAMES, 0):
        monkeypatch.setattr(enrich, "BROADCAST_NAMES", limit)
        found = enrich.extract_entities(enrich.cluster_by_id(texts), names)
        assert {tuple(r) for r in found.select("id", F.size("entities")).collect()} == {(str(i), 100) for i in range(30)}


def test_search_with_a_hot_term_and_copies(spark):
    """Every document has the term, a third are copies of one text."""
    docs = spark.range(300).select(
        F.format_string("d%03d", "id").alias("id"),
        F.when(F.col("id") % 3 == 0, "market copy").otherwise(F.concat(F.lit("market news "), F.col("id"))).alias("body_snippet"),
    )
    asked = spark.createDataFrame([(1, "market"), (2, "copy market")], "query_id bigint, q string")
    stored = index.write_text_index(docs, scratch_path(spark, "t"), {"body_snippet": F.col("body_snippet")}, buckets=4)
    ranked = search.top_k(search.bm25(asked, stored).withColumn("score", F.round("score", 6)), 5)
    assert plan_of(ranked).count("WindowGroupLimit") == 2
    got = {q: [r["id"] for r in ranked.filter(F.col("query_id") == q).orderBy("rank").collect()] for q in (1, 2)}
    copies = [f"d{n:03d}" for n in range(0, 15, 3)]
    assert got == {1: copies, 2: copies}


def test_stored_index_opens_only_needed_folders(spark):
    docs = spark.createDataFrame([("a", "alpha"), ("b", "beta"), ("c", "gamma delta")], "id string, t string")
    stored = index.write_text_index(docs, scratch_path(spark, "t"), {"body_snippet": F.col("t")}, buckets=64)
    asked = spark.createDataFrame([(1, "beta")], "query_id bigint, q string")
    plan = plan_of(search.bm25(asked, stored))
    assert re.search(r"PartitionFilters: \[.*bucket", plan)
    assert [r["id"] for r in search.bm25(asked, stored).collect()] == ["b"]


def test_folder_write_splits_by_size_not_by_key(spark):
    path = scratch_path(spark, "t")
    frame = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, "big").otherwise((F.col("id") % 2).cast("string")).alias("day"))
    tables.write_partitioned(frame, path, "day")
    assert "RebalancePartitions" in frame.hint("rebalance", "day")._jdf.queryExecution().analyzed().toString()
    assert spark.read.parquet(path).count() == 1000


def test_small(spark):
    assert small(spark.range(10), 10) and not small(spark.range(11), 10)


def test_texts_stay_where_few_labels_and_vectors_meet_them(spark, tmp_path, monkeypatch):
    sf_dir = str(tmp_path)
    spark.createDataFrame([(i, f"Text {i}.", "en", "a", 7) for i in range(200)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 3)], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([(i, [0.5, float(i)], 1) for i in range(0, 200, 7)], "vec_id long, embedding array<float>, label int").write.parquet(f"{sf_dir}/embeddings.parquet")
    monkeypatch.setattr(t, "spread", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = t.search_corpus(spark, sf_dir)
        assert "Exchange hashpartitioning" not in near._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(t, "BROADCAST_ROWS", 10)
        met = t.search_corpus(spark, sf_dir)
        assert "Exchange hashpartitioning" in met._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, near.collect())) == sorted(map(str, met.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
