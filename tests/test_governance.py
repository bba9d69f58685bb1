from pyspark.sql import functions as F

from pressloom.functions.pii import RULES
from pressloom.operators import governance
from pressloom.session import scratch_path


def test_scan_scope_and_report(spark):
    bronze = spark.createDataFrame([("1", "mail a@b.co"), ("2", "nothing")], "id string, content string")
    silver = spark.createDataFrame([("1", True, [("x", "Person")])], "id string, hasPii boolean, entities array<struct<text string, category string>>")
    labelled = governance.scan({"bronze": bronze, "silver": silver, "gold": bronze})
    got = {(r["layer"], r["id"]): (r["labels"], r["sensitivity"]) for r in labelled.collect()}
    assert got == {
        ("bronze", "1"): (["NLP_Pipeline_Email_Pattern"], "Confidential"),
        ("bronze", "2"): ([], "Public"),
        ("silver", "1"): (["NLP_Pipeline_PII_Article", "NLP_Pipeline_Person_Entity"], "Confidential"),
    }
    report = {(r["layer"], r["rule"]): r["documents"] for r in governance.classification_report(labelled).collect()}
    assert report == {("bronze", RULES[3].name): 1, ("silver", RULES[0].name): 1, ("silver", RULES[1].name): 1}


def test_lineage(spark):
    path = scratch_path(spark, "lineage")
    for process, inputs, outputs in governance.PROCESSES:
        governance.record_lineage(governance.lineage_edges(spark, "r", process, inputs, outputs, 5), path)
    edges = spark.read.schema(governance.LINEAGE).parquet(path)
    found = {r["asset"]: r["hops"] for r in governance.reachable(edges, "news-api").collect()}
    assert found == {"articles-bronze": 1, "articles-silver": 2, "search-index": 3}
    assert governance.reachable(edges, "search-index").isEmpty()


def test_reachable_handles_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "input string, output string")
    assert {(r["asset"], r["hops"]) for r in governance.reachable(edges, "a").collect()} == {("b", 1), ("c", 2)}


def test_reachable_follows_long_chains(spark):
    edges = spark.createDataFrame([(f"a{i}", f"a{i + 1}") for i in range(40)], "input string, output string")
    assert {(r["asset"], r["hops"]) for r in governance.reachable(edges, "a0").collect()} == {(f"a{i}", i) for i in range(1, 41)}
    assert governance.reachable(edges, "a0", max_hops=3).count() == 3


def test_report_takes_the_rules_of_the_scan(spark):
    labelled = spark.createDataFrame([("bronze", ["own rule"])], "layer string, labels array<string>")
    rule = RULES[0]._replace(name="own rule") if hasattr(RULES[0], "_replace") else type(RULES[0])(**{**vars(RULES[0]), "name": "own rule"})
    assert governance.classification_report(labelled, [rule]).first()["sensitivity"] == rule.label
