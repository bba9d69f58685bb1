"""Article text as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and limits article text is cleaned with.
# \s differs between regex dialects, so the whitespace class is spelled out.
WHITESPACE = r"[\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
VISIBLE = "[^" + WHITESPACE[1:]
# Every whitespace run but a single space, which collapsing would replace by itself.
COLLAPSIBLE = "(?:[" + WHITESPACE[1:-1].replace(" ", "") + "]" + WHITESPACE + "*| " + WHITESPACE + "+)"
TRUNCATION_MARKER = WHITESPACE + r"*\[\+\d+ chars\]" + WHITESPACE + r"*\z"
HTML_TAG = r"<[^>]+>"
WORD = r"[\p{L}\p{N}]+"
SNIPPET_CHARS = 500
ANNOTATOR_CHARS = 5000
WORD_BOUNDARY_SHARE = 0.8
EMBEDDING_CHARS = 32000
URL_HASH_CHARS = 16

#: Function words of the four article languages, for indexing and phrase splitting (fixed values).
STOP_WORDS = (
    "a an and are as at be but by for from has have if in into is it its no not of on or "
    "that the their then there these they this to was were which will with "
    "au aux avec ce ces dans de des du elle en est et il la le les ne nous ou par pas pour que qui "
    "se sur un une vous "
    "aber als am auch auf aus bei bin bis das dem den der die ein eine einen einer es für hat ich ihr "
    "im ist mit nach nicht noch oder sich sie sind so und von vor wie wir zu zum zur "
    "al como con del el ella ellos era las lo los más o para pero por porque su sus también una y"
).split()


def _optional(col: Column | str | None) -> Column:
    if col is None:
        return F.lit(None).cast("string")
    return F.col(col) if isinstance(col, str) else col


def trim_all(col: Column | str) -> Column:
    """Trim every kind of whitespace; the built-in ``trim`` takes spaces only."""
    return F.regexp_replace(_optional(col), f"^{WHITESPACE}+|{WHITESPACE}+\\z", "")


def has_text(col: Column | str | None) -> Column:
    """Whether there is anything but whitespace; stops at the first such character."""
    return F.coalesce(_optional(col).rlike(VISIBLE), F.lit(False))


def url_hash(url: Column | str) -> Column:
    """Article key: first 16 hex digits of SHA-256 over the trimmed URL; NULL for a blank URL."""
    trimmed = trim_all(url)
    return F.when(F.length(trimmed) > 0, F.substring(F.sha2(trimmed, 256), 1, URL_HASH_CHARS))


def clean_content(content: Column | str) -> Column:
    """Drop the trailing ``[+N chars]`` marker and tags, collapse whitespace."""
    unmarked = F.regexp_replace(_optional(content), TRUNCATION_MARKER, "")
    untagged = F.regexp_replace(unmarked, HTML_TAG, " ")
    return F.trim(F.regexp_replace(untagged, COLLAPSIBLE, " "))


def text_source(content: Column | str, description: Column | str) -> Column:
    """Name of the field the best text comes from."""
    return (
        F.when(has_text(content), "content").when(has_text(description), "description").otherwise("title")
    )


def extract_text(content: Column | str, description: Column | str, title: Column | str) -> Column:
    """Best text of an article: cleaned content, else description, else title, else empty."""
    return (
        F.when(has_text(content), clean_content(content))
        .when(has_text(description), trim_all(description))
        .otherwise(F.coalesce(trim_all(title), F.lit("")))
    )


def content_truncated(content: Column | str) -> Column:
    text = _optional(content)
    return F.coalesce(text.contains("[+") & text.contains("chars]"), F.lit(False))


def body_snippet(text: Column | str, chars: int = SNIPPET_CHARS) -> Column:
    return F.substring(_optional(text), 1, chars)


def truncate_words(text: Column | str, limit: int = ANNOTATOR_CHARS) -> Column:
    """Cut at ``limit`` characters, at the last space if that keeps more than 80 % of the limit."""
    whole = _optional(text)
    head = F.substring(whole, 1, limit)
    # Characters before the last space; equals the limit when there is no space at all.
    before_space = limit - F.locate(" ", F.reverse(head))
    at_space = (before_space < limit) & (before_space > limit * WORD_BOUNDARY_SHARE)
    return (
        F.when(F.coalesce(F.length(whole), F.lit(0)) <= limit, F.coalesce(whole, F.lit("")))
        .when(at_space, F.substring(head, F.lit(1), before_space))
        .otherwise(head)
    )


def embedding_input(title: Column | str, snippet: Column | str, limit: int = EMBEDDING_CHARS) -> Column:
    """Non-empty parts joined by a blank line; NULL when there is nothing to embed."""
    parts = F.concat_ws(
        "\n\n", F.nullif(_optional(title), F.lit("")), F.nullif(_optional(snippet), F.lit(""))
    )
    return F.when(has_text(parts), F.substring(parts, 1, limit))


def strip_publisher(title: Column | str, source: Column | str) -> Column:
    """Headline without a trailing `` - Publisher``, removed only if it names the article's source."""
    headline = _optional(title)
    suffix = F.concat(F.lit(" - "), _optional(source))
    cut = F.length(headline) - F.length(suffix)
    return F.when(headline.endswith(suffix), F.substring(headline, F.lit(1), cut)).otherwise(headline)


def source_name(source: Column | str, source_type) -> Column:
    """Publisher name from a ``struct<id,name>`` or a plain string column."""
    column = _optional(source)
    return column.getField("name") if hasattr(source_type, "fields") else column.cast("string")


def tokenize(text: Column | str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lower-cased runs of letters and digits without stop words. No stemming."""
    words = F.regexp_extract_all(F.lower(_optional(text)), F.lit(WORD), F.lit(0))
    stops = list(stop_words)
    return F.filter(words, lambda word: ~word.isin(stops)) if stops else words
