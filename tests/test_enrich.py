"""Annotators against brute force, status rules, and the bronze-to-silver job."""

import re
from collections import defaultdict
from datetime import date, datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from pressloom import schemas
from pressloom.functions.text import STOP_WORDS
from pressloom.operators import enrich, index, matching
from pressloom.plans.enrich_job import run_enrich
from pressloom.plans.refresh_job import refresh_index, run_backfill
from pressloom.session import scratch_path
from pressloom.sources import tables

TEXTS = {
    "a": "Compatibility of systems of linear constraints over the set of natural numbers. Criteria of compatibility.",
    "b": "Linear systems, linear numbers; natural systems of strict inequations!",
    "c": "  ",
}


def texts(spark, values=TEXTS):
    return spark.createDataFrame(list(values.items()), "id string, text string")


def brute_rake(text, max_words=5):
    runs, run = [], []
    for token in re.findall(r"\w+|[^\w\s]", text.lower()) + ["."]:
        if not re.match(r"\w", token) or token in STOP_WORDS:
            if run:
                runs.append(run)
            run = []
        else:
            run.append(token)
    runs = [r for r in runs if len(r) <= max_words]
    lengths = defaultdict(list)
    for r in runs:
        for w in r:
            lengths[w].append(len(r))
    return {" ".join(r): round(sum(np.mean(lengths[w]) for w in r), 6) for r in runs}


def test_phrases_match_brute_force(spark):
    got = defaultdict(dict)
    for r in enrich.phrase_scores(enrich.cluster_by_id(texts(spark))).collect():
        got[r["id"]][r["phrase"]] = r["score"]
    assert got == {i: brute_rake(t) for i, t in TEXTS.items() if t.strip()}


def test_phrases_are_ordered_and_cut(spark):
    row = enrich.extract_phrases(texts(spark), n=2).filter("id = 'a'").first()
    expected = sorted(brute_rake(TEXTS["a"]).items(), key=lambda p: (-p[1], p[0]))[:2]
    assert row["keyPhrases"] == [p for p, _ in expected]


def test_phrase_scoring_shuffles_text_once(spark):
    """One shuffle by id serves every grouping of an article's words."""
    plan = enrich.top_phrases(enrich.cluster_by_id(texts(spark)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(
    "text, label",
    [("good good day", "positive"), ("bad awful loss", "negative"), ("good bad", "mixed"), ("plain day", "neutral"), ("", "neutral")],
)
def test_sentiment(spark, text, label):
    row = texts(spark, {"x": text}).select(enrich.score_sentiment("text").alias("s")).first()["s"]
    assert row["label"] == label
    assert sum(row["scores"]) == pytest.approx(1.0)


def test_entities(spark):
    names = spark.createDataFrame(
        [("New York", "Location", None), ("York", "Location", None), ("Bob", "Person", None)], "name string, category string, subcategory string"
    )
    found = enrich.extract_entities(texts(spark, {"x": "Bob left New York: bob@x.org, 555-867-5309, http://x.org/a", "y": "none"}), names)
    got = {r["id"]: [(e["category"], e["text"]) for e in r["entities"]] for r in found.collect()}
    assert got == {
        "x": [
            ("Email", "bob@x.org"), ("PhoneNumber", "555-867-5309"), ("URL", "http://x.org/a"),
            ("Person", "Bob"), ("Location", "New York"), ("Location", "York"),
        ],
        "y": [],
    }


def test_embedding_matches_hashing_by_hand(spark):
    dims = 16
    frame = spark.createDataFrame([("a", "Big big dog"), ("b", None), ("c", "?!")], "id string, embedding_text string")
    got = {r["id"]: r for r in enrich.embed(frame, dims).collect()}
    hasher = HashingTF(numFeatures=dims)
    expected = np.zeros(dims)
    for feature in ("big", "big", "dog", "big big", "big dog"):
        expected[hasher.indexOf(feature)] += 1
    assert got["a"]["content_vector"] == pytest.approx(expected / np.linalg.norm(expected), abs=1e-6)
    for i in "bc":
        assert (got[i]["content_vector"], got[i]["vectorStatus"]) == (None, "empty_content")


def test_merge_annotations(spark):
    ids = spark.createDataFrame([("all",), ("error",), ("none",), ("only",)], "id string")
    sentiment = spark.createDataFrame([("all", "positive", None), ("error", None, "too long")], "id string, sentiment string, error string")
    entities = spark.createDataFrame([("all", ["E"]), ("error", ["F"])], "id string, entities array<string>")
    phrases = spark.createDataFrame([("only", ["p"])], "id string, keyPhrases array<string>")
    got = {r["id"]: r for r in matching.merge_annotations(ids, sentiment, entities, phrases).collect()}
    assert (got["all"]["nlpStatus"], got["all"]["entities"], got["all"]["keyPhrases"]) == ("ok", ["E"], [])
    assert (got["error"]["nlpStatus"], got["error"]["nlpError"]) == ("failed", "too long")
    assert (got["none"]["nlpStatus"], got["none"]["nlpError"]) == ("failed", "No result returned by annotator")
    assert got["only"]["nlpStatus"] == "ok" and got["only"]["sentiment"] is None


BRONZE = [
    ("a1", "science", date(2024, 1, 1), "Good news from Bob", "<p>Great win.</p> Write to bob@x.org [+99 chars]", "P"),
    ("a2", "science", date(2024, 1, 1), None, " ", "P"),
    ("a3", "health", date(2024, 1, 2), "Bad day", "Terrible loss in the bank sector", None),
]
PATHS = [f"{c}/{d}/{i}.json" for i, c, d, *_ in BRONZE]


def bronze(spark):
    frame = spark.createDataFrame(BRONZE, "id string, category string, article_date date, title string, content string, publisher string")
    return frame.select(
        "id", "category", "article_date", "title", "content", F.struct(F.lit(None).cast("string").alias("id"), F.col("publisher").alias("name")).alias("source"),
        F.concat(F.lit("u/"), "id").alias("url"), F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("author"), F.lit("2024-01-01T00:00:00Z").alias("publishedAt"),
    )


def pending(spark, *paths):
    rows = [(p, p.split("/")[2].removesuffix(".json"), p.split("/")[0], "2024-01-03T00:00:00Z") for p in paths]
    return spark.createDataFrame(rows, schemas.QUEUE_MSG)


def test_job_end_to_end(spark):
    root = scratch_path(spark, "t")
    work = pending(spark, *PATHS, PATHS[0], "science/2024-01-01/missing.json", "science/unknown/a9.json")
    at = F.lit(datetime(2024, 1, 3)).cast("timestamp")

    def run(batch):
        return run_enrich(spark, work, bronze(spark), f"{root}/silver", f"{root}/work", batch, enriched_at=at)

    assert run("1") == {"enriched": 3}
    assert run("1") == {"enriched": 0} and run("2") == {"enriched": 0}
    silver = {r["id"]: r for r in spark.read.schema(schemas.SILVER).parquet(f"{root}/silver").collect()}
    assert set(silver) == {"a1", "a2", "a3"}
    a1 = silver["a1"]
    assert a1["body_snippet"] == "Great win. Write to bob@x.org" and a1["contentTruncated"] and a1["source"] == "P"
    assert a1["sentiment"]["label"] == "positive" and a1["hasPii"] and a1["vectorStatus"] == "ok"
    assert (silver["a2"]["nlpStatus"], silver["a2"]["nlpError"], silver["a2"]["vectorStatus"]) == ("failed", enrich.EMPTY_TEXT, "empty_content")
    assert silver["a3"]["sentiment"]["label"] == "negative" and not silver["a3"]["hasPii"]
    errors = spark.read.parquet(f"{root}/work/errors").collect()
    assert [(r["urlHash"], r["errorMeta"]["stage"], r["blobPath"]) for r in errors] == [("a2", "enrichment", "science/2024-01-01/a2.json")]
    assert spark.read.parquet(f"{root}/work/audit").count() == 3
    assert {r["blobPath"] for r in spark.read.parquet(f"{root}/work/rejected").collect()} == {"science/unknown/a9.json"}

    summary = refresh_index(spark, f"{root}/silver", f"{root}/index", date(2024, 1, 1), ["science"])
    assert (summary["processed"], summary["succeeded"], summary["outcome"]) == (2, 2, 200)
    again = refresh_index(spark, f"{root}/silver", f"{root}/index", date(2024, 1, 1), ["science"])
    assert again == summary and spark.read.parquet(f"{root}/index").count() == 2


def test_model_hook(spark):
    """A user model over Arrow batches takes the place of an annotator."""

    def model(batches):
        for batch in batches:
            sizes = [[float(len(t or ""))] for t in batch.column("embedding_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.list_(pa.float32()))], ["id", "content_vector"])

    def annotator(prepared):
        vectors = enrich.apply_model(prepared.select("id", "embedding_text"), model, "id string, content_vector array<float>")
        return enrich.annotate(prepared).drop("content_vector").join(vectors, "id")

    root = scratch_path(spark, "t")
    run_enrich(spark, pending(spark, PATHS[2]), bronze(spark), f"{root}/silver", f"{root}/work", "1", annotator)
    stored = spark.read.schema(schemas.SILVER).parquet(f"{root}/silver").first()
    assert stored["content_vector"] == [float(len("Bad day\n\nTerrible loss in the bank sector"))]


def test_backfill(spark):
    path = scratch_path(spark, "t")
    done = bronze(spark).filter("id = 'a1'")
    first, last = date(2024, 1, 1), date(2024, 1, 2)
    expected = {"total": 3, "already_enriched": 1, "queued": 2, "failed": 0}
    assert run_backfill(bronze(spark), done, path, first, last, dry_run=True) == expected
    assert run_backfill(bronze(spark), done, path, first, last) == expected
    assert tables.pending_depth(spark, path) == 2
    assert run_backfill(bronze(spark), done, path, first, last, force=True, dry_run=True)["queued"] == 3
    assert run_backfill(bronze(spark), done, path, last, last, ["health"], dry_run=True)["total"] == 1


def test_search_document(spark):
    schema = schemas.SILVER
    row = {f.name: None for f in schema.fields}
    rows = [
        tuple({**row, "id": i, "publishedAt": "2024-01-15T10:00:00Z", "entities": [("Apple", "Organization", None, 0.9)]}.values())
        for i in ("x", "", None)
    ]
    docs = index.to_search_doc(spark.createDataFrame(rows, schema)).collect()
    assert [(d["id"], d["entities"], d["key_phrases"], d["published_at"]) for d in docs] == [
        ("x", ["Apple"], [], datetime(2024, 1, 15, 10))
    ]


def test_phrases_of_any_length_are_scored(spark):
    long = "big red shiny old wooden sailing boats drifting slowly"
    found = enrich.top_phrases(texts(spark, {"a": f"{long}. boats win"})).collect()
    assert [r["phrase"] for r in found] == [long, "boats win"]
    # "boats" is in phrases of nine and two words, "win" in one of two.
    assert [r["score"] for r in found] == [8 * 9 + 5.5, 5.5 + 2]


def test_names_of_any_length_are_found(spark):
    names = spark.createDataFrame([("Federal Reserve Bank of New York", "Organization", None)], "name string, category string, subcategory string")
    found = enrich.gazetteer_mentions(texts(spark, {"a": "The Federal Reserve Bank of New York met.", "b": "Federal Reserve Bank"}), names)
    assert [(r["id"], r["text"]) for r in found.collect()] == [("a", "Federal Reserve Bank of New York")]
    assert enrich.gazetteer_mentions(texts(spark), names.limit(0)).count() == 0


def test_ties_do_not_depend_on_input_order(spark):
    rows = [("h", "t1", "catA", "p1"), ("h", "t1", "catB", "p2"), ("h", "t2", "catC", "p0")]
    stored = spark.createDataFrame([], "rowKey string")
    winners = set()
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        events = spark.createDataFrame(order, "url_hash string, ingested_at string, category string, path string").coalesce(1)
        winners |= {r["category"] for r in matching.drop_seen(events, stored).collect()}
    assert len(winners) == 1 and winners <= {"catA", "catB"}


def test_a_long_name_costs_nothing_where_its_first_word_is_missing(spark):
    long_name = " ".join(["Zebra", *[f"word{i}" for i in range(29)]])
    gazetteer = spark.createDataFrame([(n, "Organization", None) for n in ("New York", "York", long_name)], "name string, category string, subcategory string")
    text = "In New York the York mint met. " + "plain words " * 200
    plain = enrich.candidate_runs(texts(spark, {"a": text}), gazetteer).collect()
    assert {r["name"] for r in plain} >= {"New York", "York"} and len(plain) <= 8
    found = enrich.gazetteer_mentions(texts(spark, {"a": text, "b": f"The {long_name} met", "c": long_name[:-1]}), gazetteer).collect()
    assert sorted((r["id"], r["text"]) for r in found) == [("a", "New York"), ("a", "York"), ("a", "York"), ("b", long_name)]
    short = enrich.gazetteer_mentions(texts(spark, {"b": f"The {long_name} met"}), gazetteer, max_words=5)
    assert short.count() == 0


def test_texts_keep_their_partitions(spark):
    """Adaptive execution would merge them by the size of the texts, not of the word rows made of them."""
    docs = spark.createDataFrame([("1", "some words")], "id string, text string")
    plan = enrich.cluster_by_id(docs)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_key_phrases_need_no_shuffle_of_words(spark):
    """Phrases are scored and ranked inside the row: one shuffle of the article, no window and no join."""
    prepared = spark.createDataFrame([("a", "Solar farms win. solar cells", "t")], "id string, text string, embedding_text string")
    plan = enrich.annotate(prepared)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Join" not in plan
