"""Validation of a table of search requests, and formatting of what they return."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.paths import ISO_DATE
from pressloom.functions.text import trim_all
from pressloom.schemas import CATEGORIES, SENTIMENT_LABELS

# Limits of a request.
MAX_QUERY_CHARS = 500
DEFAULT_TOP = 10
MAX_TOP = 50


def validate_queries(requests: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Normalised requests plus ``error``; the first rule broken, in the order below, names the error.

    All parameters arrive as strings, as in a query string. A non-numeric ``top`` is an error as a
    whole; no leading digits are salvaged.
    """
    q = F.coalesce(trim_all("q"), F.lit(""))
    top = F.when(F.col("top").isNull(), F.lit(DEFAULT_TOP)).otherwise(trim_all("top").try_cast("int"))
    category = F.lower(trim_all("category"))
    sentiment = F.lower(trim_all("sentiment"))
    first, last = trim_all("date_from"), trim_all("date_to")

    def given(column: Column) -> Column:
        return F.length(column) > 0

    def one_of(values: Sequence[str]) -> str:
        return "not among " + ", ".join(values)

    rules: list[tuple[Column, str]] = [
        (q == "", 'q: missing or blank'),
        (F.length(q) > MAX_QUERY_CHARS, f'q: longer than {MAX_QUERY_CHARS} characters'),
        (top.isNull() | (top < 1), 'top: not a whole number above zero'),
        (top > MAX_TOP, f'top: more than {MAX_TOP}'),
        (given(category) & ~category.isin(list(categories)), f'category: {one_of(categories)}'),
        (given(sentiment) & ~sentiment.isin(list(SENTIMENT_LABELS)), f'sentiment: {one_of(SENTIMENT_LABELS)}'),
        (given(first) & ~first.rlike(ISO_DATE), 'date_from: not YYYY-MM-DD'),
        (given(last) & ~last.rlike(ISO_DATE), 'date_to: not YYYY-MM-DD'),
        (given(first) & given(last) & (first > last), 'date_from: later than date_to'),
    ]
    error = F.coalesce(*[F.when(broken, F.lit(message)) for broken, message in rules])
    empty = F.lit("")
    return requests.select(
        "query_id",
        q.alias("q"),
        top.alias("top"),
        F.nullif(category, empty).alias("category"),
        F.nullif(trim_all("source"), empty).alias("source"),
        F.nullif(sentiment, empty).alias("sentiment"),
        F.coalesce(F.col("semantic").isin("true", "1"), F.lit(False)).alias("semantic"),
        F.coalesce(~F.col("vector").isin("false", "0"), F.lit(True)).alias("vector"),
        F.nullif(first, empty).alias("date_from"),
        F.nullif(last, empty).alias("date_to"),
        error.alias("error"),
    )


def day_start(day: Column) -> Column:
    return day.try_cast("date").cast("timestamp")


def day_end(day: Column) -> Column:
    """The last whole second of a day: fractions after 23:59:59 are outside."""
    return F.date_add(day.try_cast("date"), 1).cast("timestamp") - F.expr("INTERVAL 1 SECOND")


def filter_matches(
    category: Column, source: Column, sentiment: Column, date_from: Column, date_to: Column
) -> Column:
    """Predicate over a document's columns and a request's filters; a NULL filter admits everything."""
    return (
        (category.isNull() | (F.col("doc_category") == category))
        & (source.isNull() | (F.col("doc_source") == source))
        & (sentiment.isNull() | (F.col("doc_sentiment") == sentiment))
        & (date_from.isNull() | (F.col("doc_published_at") >= day_start(date_from)))
        & (date_to.isNull() | (F.col("doc_published_at") <= day_end(date_to)))
    )


def apply_filters(
    docs: DataFrame,
    category: str | None = None,
    source: str | None = None,
    sentiment: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    entity: str | None = None,
) -> DataFrame:
    """One request's filters as literals, so that they reach the Parquet scan. All are ANDed."""
    if category is not None:
        docs = docs.filter(F.col("category") == category)
    if source is not None:
        docs = docs.filter(F.col("source") == source)
    if sentiment is not None:
        docs = docs.filter(F.col("sentiment_label") == sentiment)
    if date_from is not None:
        docs = docs.filter(F.col("published_at") >= F.to_timestamp(F.lit(f"{date_from} 00:00:00")))
    if date_to is not None:
        docs = docs.filter(F.col("published_at") <= F.to_timestamp(F.lit(f"{date_to} 23:59:59")))
    if entity is not None:
        docs = docs.filter(F.array_contains("entities", entity))
    return docs


def format_results(results: DataFrame) -> DataFrame:
    """The public result row: camel case, empty arrays for missing ones, neither snippet nor vector."""
    return results.select(
        *[c for c in ("query_id", "rank") if c in results.columns],
        "score",
        "id",
        "url",
        "title",
        "source",
        "category",
        F.col("published_at").alias("publishedAt"),
        F.col("sentiment_label").alias("sentimentLabel"),
        F.col("sentiment_score_positive").alias("sentimentScore"),
        F.coalesce("entities", F.array().cast("array<string>")).alias("entities"),
        F.coalesce("key_phrases", F.array().cast("array<string>")).alias("keyPhrases"),
    )
