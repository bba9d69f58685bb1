"""File events and file paths as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of an event subject and of a document path.
CONTAINER_PATTERN = "containers/([^/]+)/"
BLOBS_MARKER = "/blobs/"
JSON_SUFFIX = ".json"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def container_from_subject(subject: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_column(subject), CONTAINER_PATTERN, 1), F.lit(""))


def path_from_subject(subject: Column | str) -> Column:
    """Everything after the first ``/blobs/``; NULL without that marker."""
    text = _column(subject)
    start = F.instr(text, BLOBS_MARKER)
    return F.when(start > 0, F.substring(text, start + len(BLOBS_MARKER), F.length(text)))


def parse_bronze_path(path: Column | str) -> Column:
    """``category/date/hash.json`` as struct(category, date_str, url_hash); NULL for any other shape."""
    text = _column(path)
    parts = F.split(text, "/")
    name = F.get(parts, F.lit(2))
    suffix_at = F.instr(name, JSON_SUFFIX)
    # Only the first ".json" of the name goes.
    stem = F.concat(
        F.substring(name, F.lit(1), suffix_at - 1),
        F.substring(name, suffix_at + len(JSON_SUFFIX), F.length(name)),
    )
    return F.when(
        (F.size(parts) == 3) & name.endswith(JSON_SUFFIX),
        F.struct(
            F.get(parts, F.lit(0)).alias("category"),
            F.get(parts, F.lit(1)).alias("date_str"),
            stem.alias("url_hash"),
        ),
    )


def bronze_path(category: Column | str, date: Column | str, url_hash: Column | str) -> Column:
    return F.concat(
        _column(category), F.lit("/"), _column(date).cast("string"), F.lit("/"), _column(url_hash), F.lit(JSON_SUFFIX)
    )


def valid_date(value: Column | str) -> Column:
    """True for ``YYYY-MM-DD`` that is also a day of the calendar."""
    text = _column(value)
    return F.coalesce(text.rlike(ISO_DATE) & text.try_cast("date").isNotNull(), F.lit(False))
