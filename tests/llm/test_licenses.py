from pressloom.llm import licenses
from pressloom.llm.queries import oracle_registry, registry
from tools.compare import compare, connect


def test_against_sql(spark, small_dir):
    name = "op5_scan_licenses"
    assert compare(spark, connect(small_dir), registry()[name], oracle_registry()[name], small_dir) is None


def labels(spark, texts):
    return [r for r in sorted(licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect(), key=lambda r: r["doc_id"])]


def test_quotes_with_changed_words(spark):
    whole = dict((i, t) for i, (_, t) in enumerate(licenses.TEMPLATES))[1]
    words = whole.split()
    changed = words[:10] + ["really", "truly"] + words[10:30] + words[31:]
    rows = labels(spark, [whole, " ".join(changed), " ".join(words[: len(words) // 3]), "permission is hereby refused", "Licensed under CC BY-NC 4.0."])
    assert [r["labels"] for r in rows] == ["mit", "mit", "", "", "cc-by-nc"]
    assert rows[0]["score"] == 1.0 and 0.8 <= rows[1]["score"] < 1 and 0 < rows[2]["score"] < 0.8


def test_scattered_grams_are_no_quote(spark):
    words = licenses.TEMPLATES[7][1].split()
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    text = " filler words that separate them ".join(reversed(grams))
    assert labels(spark, [text])[0]["labels"] == ""


def test_words_strewn_between_a_template_are_no_quote(spark):
    words = next(t for name, t in licenses.TEMPLATES if name == "bsd").split()
    strewn = " ".join(f"{' '.join(words[i : i + 3])} filler" for i in range(len(words) - 2))
    rows = labels(spark, [strewn, " ".join(words), " ".join(words).upper() + " \u0130\u212a"])
    assert [r["labels"] for r in rows] == ["", "bsd", "bsd"] and rows[0]["score"] < 0.5


def test_phrases(spark):
    rows = labels(spark, ["MIT-License, mit\nlicense! a mit license", "the Apache  License and the GENERAL public license", "mit", "license mit"])
    assert [(r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows] == [(3, 0, 5, "mit"), (2, 1, 5, "apache,gpl"), (0, None, None, ""), (0, None, None, "")]
    assert [r["score"] for r in rows[:3]] == [1.0, 1.0, 0.0]


def test_awkward_rows(awkward, empty):
    rows = licenses.scan(awkward).collect()
    assert len(rows) == 12
    assert {(r["n_words"], r["labels"], r["score"]) for r in rows if r["doc_id"] in (1, 2, 3, 9)} == {(0, "", 0.0)}
    assert [r["base_labels"] for r in rows if r["doc_id"] == 8] == ["mit"]
    assert licenses.scan(empty).count() == 0
