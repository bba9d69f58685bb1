import pytest


@pytest.fixture(scope="session")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


#: Names the operators use inside or add; a table may have them, too.
CLASHING = ("size", "target", "copies", "taken", "row", "node", "n", "score", "lang_pred", "tie", "spans", "n_lines", "place", "part", "base", "start", "word", "hash")


@pytest.fixture(scope="session")
def awkward_rows():
    """doc_id, text, lang, source, n_chars with nulls everywhere, empty, long, repeated and odd texts."""
    long_text = " ".join(f"word{i % 700} of a very long text." for i in range(9000))
    return [
        (1, None, "en", "a", 0),
        (2, "", None, "a", 0),
        (3, "   \n\t ", "en", None, 6),
        (None, "no id at all, but words", "en", "b", None),
        (4, long_text, "en", "a", len(long_text)),
        (5, "x" * 30000, None, None, 30000),
        (6, "same text twice\nwith a second line", "de", "b", 33),
        (6, "same text twice\nwith a second line", "de", "b", 33),
        (7, "same text twice\nwith a second line", "de", "b", 33),
        (8, "1234 @@ ++ .. 5.5.5.5 éß \U0001f600 mit license", "fr", "c", 40),
        (9, "\n\n\n", "fr", "c", 3),
        (None, None, None, None, None),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"extra {name}").alias(name) for name in CLASHING])


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
