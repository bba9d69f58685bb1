"""Gold aggregates on small fixtures, and the nightly job."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom import schemas
from pressloom.operators import gold, select
from pressloom.plans.gold_job import run_gold
from pressloom.session import scratch_path
from pressloom.sources.tables import write_partitioned

RUN = date(2024, 1, 10)


def silver(spark, *articles):
    rows = []
    for n, a in enumerate(articles):
        row = {f.name: None for f in schemas.SILVER.fields}
        p, g, u = a.pop("scores", (0.2, 0.1, 0.7))
        row.update(
            id=f"a{n}", category="science", article_date=RUN, nlpStatus="ok", hasPii=False,
            sentiment=("neutral", (p, g, u)), entities=[], keyPhrases=[],
        )
        row.update(a)
        row["entities"] = row["entities"] and [(e, "Person", None, 0.9) for e in row["entities"]]
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, schemas.SILVER)


def test_sentiment_trends(spark):
    frame = silver(
        spark,
        dict(scores=(0.9, 0.05, 0.05)),
        dict(scores=(0.1, 0.05, 0.85)),
        dict(scores=(0.9, 0.0, 0.1), nlpStatus="failed"),
        dict(category="health", scores=(0.1, 0.6, 0.3)),
    )
    got = {r["category"]: r for r in gold.sentiment_trends(gold.project_silver(frame), RUN).collect()}
    assert got["science"]["article_count"] == 2
    assert (got["science"]["avg_positive"], got["science"]["dominant_sentiment"]) == (0.5, "positive")
    assert got["health"]["dominant_sentiment"] == "negative" and got["health"]["run_date"] == RUN


def test_sentiment_rolling_weights_by_article(spark):
    frame = silver(
        spark,
        dict(article_date=RUN - timedelta(days=6), scores=(1.0, 0.0, 0.0)),
        dict(article_date=RUN - timedelta(days=6), scores=(1.0, 0.0, 0.0)),
        dict(article_date=RUN, scores=(0.25, 0.5, 0.25)),
        dict(article_date=RUN + timedelta(days=1), scores=(0.0, 1.0, 0.0)),
    )
    got = {r["article_date"]: r for r in gold.sentiment_rolling(gold.project_silver(frame)).collect()}
    assert (got[RUN]["article_count"], got[RUN]["avg_positive"]) == (3, 0.75)
    assert got[RUN + timedelta(days=1)]["avg_positive"] == 0.125


def test_top_entities_modes_and_ties(spark):
    frame = gold.project_silver(silver(spark, dict(entities=["Bob", "Bob", "Al", "x"]), dict(entities=["Al"]), dict(entities=None)))
    for mode, expected in (("mentions", [("Al", 2, 1), ("Bob", 2, 2)]), ("articles", [("Al", 2, 1), ("Bob", 1, 2)])):
        got = gold.top_entities(frame, RUN, count_mode=mode).orderBy("rank").collect()
        assert [(r["entity_text"], r["entity_count"], r["rank"]) for r in got] == expected
    assert gold.top_entities(frame, RUN, n=1).count() == 1


def test_entities_as_strings_and_without_text(spark):
    flat = spark.createDataFrame([("a", "c", ["Bob", None])], "id string, category string, entities array<string>")
    assert [r["entity_text"] for r in gold.explode_entities(flat).collect()] == ["Bob"]
    untexted = spark.createDataFrame(
        [("a", "c", [(None, "Person", None, 0.5)])],
        T.StructType([T.StructField("id", T.StringType()), T.StructField("category", T.StringType()), T.StructField("entities", T.ArrayType(schemas.ENTITY))]),
    )
    assert gold.explode_entities(untexted).count() == 0
    assert "Person" in gold.explode_entities(untexted, keep_untexted=True).first()["entity_text"]


def test_trending_keywords(spark):
    ago = lambda n: RUN - timedelta(days=n)
    frame = silver(
        spark,
        dict(keyPhrases=["Rate Cut", "ab ", "ab"]),
        dict(keyPhrases=["rate cut "], article_date=ago(2)),
        dict(keyPhrases=["rate cut", "gone"], article_date=ago(3)),
        dict(keyPhrases=["rate cut"], article_date=ago(6)),
        dict(keyPhrases=["later"], article_date=ago(-1)),
    )
    got = gold.trending_keywords(gold.project_silver(frame), RUN, 3).orderBy("rank").collect()
    assert [(r["key_phrase"], r["count_current"], r["count_prior"], r["trend_score"]) for r in got] == [
        ("rate cut", 2, 1, 1.0), ("ab", 1, 0, 1.0)
    ]


def test_windows_are_adjacent_and_disjoint():
    for days in (1, 3, 7):
        first, last = select.window_bounds(RUN, days)
        prior_first, prior_last = select.window_bounds(RUN, days, back=1)
        assert last == RUN and (last - first).days == days - 1 == (prior_last - prior_first).days
        assert prior_last + timedelta(days=1) == first


def test_window_filters(spark):
    frame = spark.createDataFrame([(RUN - timedelta(days=n),) for n in range(-1, 8)], "d date")
    current = {r["d"] for r in select.rolling_window(frame, "d", RUN, 3).collect()}
    prior = {r["d"] for r in select.prior_window(frame, "d", RUN, 3).collect()}
    assert current == {RUN - timedelta(days=n) for n in range(3)}
    assert prior == {RUN - timedelta(days=n) for n in range(3, 6)}


def test_date_spine(spark):
    spine = select.date_spine(spark, RUN, RUN + timedelta(days=1), ["a", "b"])
    assert spine.count() == 4
    assert select.date_spine(spark, RUN, RUN - timedelta(days=1), ["a"]).count() == 0


def test_data_quality(spark):
    frame = silver(spark, dict(hasPii=True), dict(nlpStatus="failed"))
    row = gold.data_quality(frame, "x").first()
    assert (row["total_rows"], row["nlp_ok"], row["nlp_failed"], row["pii_rows"], row["warning"]) == (2, 1, 1, 1, "HIGH_FAILURE_RATE")
    assert gold.data_quality(frame.drop("hasPii").filter("id = 'zz'"), "x").first()["warning"] == "NO_ROWS"


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['sentiment'\]"):
        select.assert_columns(silver(spark, dict()).drop("sentiment"), schemas.SILVER_REQUIRED)


def test_union_fills_missing_columns(spark):
    joined = select.union_sources([spark.range(1).withColumn("x", F.lit(1)), spark.range(1)])
    assert sorted(r["x"] is None for r in joined.collect()) == [False, True]


def test_gold_job(spark):
    root = scratch_path(spark, "t")
    frame = silver(
        spark,
        dict(entities=["Bob"], keyPhrases=["rate cut"]),
        dict(article_date=RUN - timedelta(days=5), keyPhrases=["rate cut"]),
        dict(article_date=RUN - timedelta(days=40)),
        dict(nlpStatus="failed"),
    )
    write_partitioned(frame, f"{root}/silver", "category", "article_date")
    for _ in range(2):
        summary = run_gold(spark, f"{root}/silver", f"{root}/gold", RUN)
        assert summary["silver_articles"] == 2
        assert summary["rows"] == {"sentiment_trends": 2, "top_entities": 1, "trending_keywords": 1}
        assert spark.read.parquet(f"{root}/gold/sentiment_trends").count() == 2
    empty = run_gold(spark, f"{root}/silver", f"{root}/gold", RUN - timedelta(days=300))
    assert empty["outcome"] == "NO_DATA"
    assert spark.read.parquet(f"{root}/gold/sentiment_trends").count() == 2


def test_ranking_cuts_before_the_shuffle(spark):
    """The plan keeps n rows per group and partition, so a hot group does not meet in one task."""
    ranked = select.top_n(spark.range(100).withColumn("g", F.col("id") % 2), ["g"], [F.desc("id")], 3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [r["id"] for r in ranked.orderBy("g", "rank").collect()] == [98, 96, 94, 99, 97, 95]
