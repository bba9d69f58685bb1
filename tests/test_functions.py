import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom import schemas
from pressloom.functions import paths, pii, scores, text

SUBJECT = "/blobServices/default/containers/articles-bronze/blobs/technology/2024-01-15/abc123.json"


def one(spark, expression, **values):
    """Evaluate a column expression on one row of string columns."""
    row = spark.range(1).select(*[F.lit(value).cast("string").alias(name) for name, value in values.items()])
    return row.select(expression.alias("out")).first()["out"]


def test_url_hash_trims(spark):
    expected = hashlib.sha256(b"https://example.com/a").hexdigest()[:16]
    assert one(spark, text.url_hash("u"), u="https://example.com/a") == expected
    assert one(spark, text.url_hash("u"), u=" \t https://example.com/a \n") == expected
    assert one(spark, text.url_hash("u"), u=" ") is None
    assert one(spark, text.url_hash("u"), u=None) is None


@pytest.mark.parametrize(
    "content, description, title, expected, source",
    [
        ("Rates rose again [+77 chars]", None, None, "Rates rose again", "content"),
        ("<h1>Harbour</h1><i>reopens</i>", None, None, "Harbour reopens", "content"),
        ("<tr><td>left</td>\r\n<td>right</td></tr> [+31 chars]", None, None, "left right", "content"),
        ("\t ", "  a summary ", "t", "a summary", "description"),
        (None, " ", " a headline\n", "a headline", "title"),
        (None, None, None, "", "title"),
        ("a [+9 chars] b", None, None, "a [+9 chars] b", "content"),
        (" a  b \n c\td \u00a0e\u00a0f\n", None, None, "a b c d e f", "content"),
        ("<br>", "d", None, "", "content"),
    ],
)
def test_extract_text(spark, content, description, title, expected, source):
    values = dict(c=content, d=description, t=title)
    assert one(spark, text.extract_text("c", "d", "t"), **values) == expected
    assert one(spark, text.text_source("c", "d"), **values) == source


@pytest.mark.parametrize("content, expected", [("cut off [+8 chars]", True), ("whole [8 chars]", False), (None, False)])
def test_content_truncated(spark, content, expected):
    assert one(spark, text.content_truncated("c"), c=content) is expected


@pytest.mark.parametrize(
    "value, limit, expected",
    [
        ("aaaa bbbb cc dd", 11, "aaaa bbbb"),  # last space at 9 of 11 > 80 %
        ("aaaa bbbbbbbbbbb", 11, "aaaa bbbbbb"),  # last space too early
        ("aaaaaaaaaaaaaaa", 11, "aaaaaaaaaaa"),
        ("short", 11, "short"),
        (None, 11, ""),
    ],
)
def test_truncate_words(spark, value, limit, expected):
    assert one(spark, text.truncate_words("t", limit), t=value) == expected


def test_embedding_input(spark):
    assert one(spark, text.embedding_input("t", "s"), t="T", s="S") == "T\n\nS"
    assert one(spark, text.embedding_input("t", "s"), t=None, s="S") == "S"
    assert one(spark, text.embedding_input("t", "s"), t="", s=" ") is None
    assert len(one(spark, text.embedding_input("t", "s"), t="x" * 40000, s=None)) == 32000


def test_strip_publisher(spark):
    clean = text.strip_publisher("t", "s")
    assert one(spark, clean, t="Big news - The Paper", s="The Paper") == "Big news"
    assert one(spark, clean, t="Big news - part two", s="The Paper") == "Big news - part two"
    assert one(spark, clean, t="Big news - The Paper", s=None) == "Big news - The Paper"


def test_tokenize(spark):
    assert one(spark, text.tokenize("t"), t="The Éclair's 2nd bite, of...") == ["éclair", "s", "2nd", "bite"]


def test_event_subject(spark):
    container = paths.container_from_subject("s")
    path = paths.path_from_subject("s")
    assert one(spark, container, s=SUBJECT) == "articles-bronze"
    assert one(spark, path, s=SUBJECT) == "technology/2024-01-15/abc123.json"
    for bad in ("nonsense", None):
        assert one(spark, container, s=bad) is None
        assert one(spark, path, s=bad) is None
    assert one(spark, path, s="/no/blob/marker") is None


@pytest.mark.parametrize(
    "path, expected",
    [
        ("technology/2024-01-15/abc123.json", ("technology", "2024-01-15", "abc123")),
        ("technology/abc123.json", None),
        ("raw/technology/2024-01-15/abc123.json", None),
        ("technology/2024-01-15/abc123.txt", None),
        (None, None),
    ],
)
def test_parse_bronze_path(spark, path, expected):
    got = one(spark, paths.parse_bronze_path("p"), p=path)
    assert (tuple(got) if got else None) == expected


@pytest.mark.parametrize(
    "value, ok", [("2024-02-29", True), ("2024-02-30", False), ("15-01-2024", False), ("2024-1-5", False), (None, False)]
)
def test_valid_date(spark, value, ok):
    assert one(spark, paths.valid_date("d"), d=value) is ok


def entities(*categories):
    return [{"text": "x", "category": c, "subcategory": None, "confidenceScore": 0.9} for c in categories]


@pytest.mark.parametrize(
    "categories, expected",
    [(["Person"], True), (["PhoneNumber"], True), (["Email"], True), (["Organization", "Location"], False), ([], False)],
)
def test_has_pii(spark, categories, expected):
    schema = T.StructType([T.StructField("entities", T.ArrayType(schemas.ENTITY))])
    frame = spark.createDataFrame([(entities(*categories),)], schema)
    assert frame.select(pii.has_pii("entities").alias("out")).first()["out"] is expected


@pytest.mark.parametrize(
    "value, rule",
    [
        ('{"hasPii": true}', "NLP_Pipeline_PII_Article"),
        ('{"category":"Person"}', "NLP_Pipeline_Person_Entity"),
        ("555-867-5309", "NLP_Pipeline_Phone_Pattern"),
        ("(555) 867-5309", "NLP_Pipeline_Phone_Pattern"),
        ("+1 555 867 5309", "NLP_Pipeline_Phone_Pattern"),
        ("user@example.com", "NLP_Pipeline_Email_Pattern"),
        ("user.name+tag@domain.co", "NLP_Pipeline_Email_Pattern"),
        ("notanemail", None),
        ("@nodomain", None),
    ],
)
def test_rules(spark, value, rule):
    matched = one(spark, pii.classify("t"), t=value)
    assert matched == ([rule] if rule else [])
    expected = "Confidential" if rule else "Public"
    assert one(spark, pii.sensitivity(pii.classify("t")), t=value) == expected


@pytest.mark.parametrize(
    "p, n, u, cascade, argmax",
    [
        (0.2, 0.1, 0.7, "positive", "neutral"),
        (0.1, 0.6, 0.3, "negative", "negative"),
        (0.1, 0.3, 0.6, "neutral", "neutral"),
        (None, None, None, "neutral", None),
    ],
)
def test_dominant_sentiment(spark, p, n, u, cascade, argmax):
    frame = spark.createDataFrame([(p, n, u)], "p double, n double, u double")
    columns = [F.col(c) for c in "pnu"]
    assert frame.select(scores.dominant_sentiment(*columns)).first()[0] == cascade
    assert frame.select(scores.dominant_sentiment(*columns, mode="argmax")).first()[0] == argmax


def test_freshness(spark):
    frame = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP'2024-01-10'), (TIMESTAMP'2024-01-03'), (TIMESTAMP'2024-01-11'), (NULL), "
        "(TIMESTAMP'2024-01-06 12:00:00') AS t(p)"
    )
    factor = scores.freshness(F.col("p"), F.lit("2024-01-10").cast("timestamp"))
    got = [row[0] for row in frame.select(factor).collect()]
    assert got[:4] == [2.0, 1.0, 2.0, 1.0]
    assert 1.0 < got[4] < 1.5
