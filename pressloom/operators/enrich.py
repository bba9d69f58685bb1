"""Annotation of article text: sentiment, entities, key phrases, vectors, status, silver rows.

Annotators read whole texts. Work that stays within one article is written as array expressions, or
as grouping below a single ``cluster_by_id``: the text is shuffled once and every later grouping by
(id, ...) reuses that partitioning, so exploded tokens never travel.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom import schemas
from pressloom.functions import pii
from pressloom.functions.text import (
    STOP_WORDS,
    WHITESPACE,
    WORD,
    body_snippet,
    content_truncated,
    embedding_input,
    extract_text,
    source_name,
    tokenize,
    truncate_words,
)
from pressloom.session import small

EMPTY_TEXT = "Document text is empty"


@dataclass(frozen=True)
class Lexicon:
    """Polar words. Kept in the plan as literals, hence for lists of some hundred words."""

    positive: Sequence[str]
    negative: Sequence[str]


#: Small general-purpose lexicon (fixed values).
DEFAULT_LEXICON = Lexicon(
    positive=(
        "good great excellent positive success successful win wins gain gains growth rise record strong "
        "best better improve improved profit benefit hope happy safe breakthrough award praise"
    ).split(),
    negative=(
        "bad poor terrible negative failure failed loss losses decline fall drop weak worst worse crisis "
        "risk fear death dead attack fraud lawsuit threat crash sad unsafe scandal warning"
    ).split(),
)

MIXED_THRESHOLD = 0.3


def cluster_by_id(df: DataFrame) -> DataFrame:
    """Hash-partition by article id, once, ahead of groupings by (id, ...).

    The number is given, so that adaptive execution does not merge partitions by the size of the texts: the rows of
    their words take many times as much.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")


def score_sentiment(text: Column | str, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Sentiment struct from counts of polar words; the three scores add up to 1.

    A share above the threshold on both sides is ``mixed``, else the largest score names the label.
    """

    def count(tokens: Column, words: Sequence[str]) -> Column:
        return F.size(F.filter(tokens, lambda t: t.isin(list(words))))

    def counts(tokens: Column) -> Column:
        return F.struct(count(tokens, lexicon.positive).alias("p"), count(tokens, lexicon.negative).alias("n"))

    counted = _once(tokenize(text, ()), counts)
    return _once(counted, lambda c: sentiment_struct(c.p, c.n))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time.

    Written out, a value used several times below a condition is computed as many times.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sentiment_struct(n_positive: Column, n_negative: Column) -> Column:
    total = n_positive + n_negative + F.lit(1)
    positive, negative, neutral = n_positive / total, n_negative / total, F.lit(1) / total
    label = (
        F.when((positive >= MIXED_THRESHOLD) & (negative >= MIXED_THRESHOLD), F.lit("mixed"))
        .when((positive > negative) & (positive > neutral), F.lit("positive"))
        .when((negative > positive) & (negative > neutral), F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )
    scores = F.struct(
        positive.cast("double").alias("positive"),
        negative.cast("double").alias("negative"),
        neutral.cast("double").alias("neutral"),
    )
    return F.struct(label.alias("label"), scores.alias("scores"))


#: Entities found by pattern: category and regular expression.
ENTITY_PATTERNS = (("Email", pii.EMAIL_PATTERN), ("PhoneNumber", pii.PHONE_PATTERN), ("URL", pii.URL_PATTERN))


def _entity(text: Column, category: Column, subcategory: Column, confidence: float) -> Column:
    return F.struct(
        text.alias("text"),
        category.alias("category"),
        subcategory.alias("subcategory"),
        F.lit(confidence).alias("confidenceScore"),
    )


def pattern_entities(text: Column | str, patterns: Iterable[tuple[str, str]] = ENTITY_PATTERNS) -> Column:
    """Entities that a regular expression recognises, by category and then in order of appearance."""
    column = F.col(text) if isinstance(text, str) else text
    found = [
        F.transform(F.regexp_extract_all(column, F.lit(pattern), F.lit(0)), _as_entity(category))
        for category, pattern in patterns
    ]
    return F.coalesce(F.concat(*found), F.array().cast(T.ArrayType(schemas.ENTITY)))


def _as_entity(category: str) -> Callable[[Column], Column]:
    return lambda hit: _entity(hit, F.lit(category), F.lit(None).cast("string"), 1.0)


BROADCAST_NAMES = 1_000_000


#: Bits that tell whether a name of some length may begin with a word.
OPENING_BITS = 1 << 16


def _openings(names: DataFrame) -> dict[int, list[int]]:
    """For each length of a name in words, the bits of the words such names begin with; of bounded size per length."""
    words = F.split("name", " ")
    place = F.pmod(F.xxhash64(F.get(words, F.lit(0))), F.lit(OPENING_BITS))
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")))
    found: dict[int, list[int]] = {}
    for row in names.groupBy(F.size(words).alias("n"), F.floor(place / 64).alias("at")).agg(bits.alias("bits")).toLocalIterator():
        found.setdefault(row["n"], [0] * (OPENING_BITS // 64))[row["at"]] = row["bits"]
    return found


def _opens(bits: list[int]) -> Callable[[Column], Column]:
    known = F.array(*map(F.lit, bits))

    def opens(start):
        place = F.pmod(F.xxhash64(F.get("words", start - 1)), F.lit(OPENING_BITS))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        return F.get(known, F.floor(place / 64).cast("int")).bitwiseAND(one) != 0

    return opens


def candidate_runs(df: DataFrame, names: DataFrame, max_words: int | None = None) -> DataFrame:
    """``id, position, name``: the word runs of each text that can be a name, by length and first word.

    A run of n words is made only where a word stands that some name of n words begins with, so a long name costs
    nothing in texts without its first word. The bits can let a run too many through, never one too few.
    """
    words = df.select("id", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    runs = [F.array().cast("array<struct<position:int,name:string>>")]
    for n, bits in sorted(_openings(names).items()):
        if max_words is not None and n > max_words:
            continue
        places = F.when(F.size("words") >= n, F.sequence(F.lit(1), F.size("words") - (n - 1))).otherwise(F.array().cast("array<int>"))
        runs.append(F.transform(F.filter(places, _opens(bits)), _word_run(n)))
    return words.select("id", F.explode(F.concat(*runs)).alias("g")).select("id", "g.position", "g.name")


def gazetteer_mentions(df: DataFrame, gazetteer: DataFrame, max_words: int | None = None) -> DataFrame:
    """Name mentions: id, position, text, category, subcategory.

    Joins the word runs of each text that may be a name (:func:`candidate_runs`) with gazetteer names, as written;
    ``max_words`` leaves longer names out. Names are unique on their side, so the join adds no rows. A gazetteer of
    bounded size is broadcast; for a larger one the runs are shuffled and adaptive execution splits the frequent words.
    """
    names = gazetteer.dropDuplicates(["name"]).select("name", "category", "subcategory")
    grams = candidate_runs(df, names, max_words)
    if small(names, BROADCAST_NAMES):
        names = F.broadcast(names)
    return grams.join(names, "name").select("id", "position", F.col("name").alias("text"), "category", "subcategory")


def _word_run(n: int) -> Callable[[Column], Column]:
    return lambda start: F.struct(
        start.alias("position"), F.array_join(F.slice(F.col("words"), start, F.lit(n)), " ").alias("name")
    )


def extract_entities(df: DataFrame, gazetteer: DataFrame | None = None, max_words: int | None = None) -> DataFrame:
    """``id, entities`` for articles with ``id, text``: pattern hits, then gazetteer names in text order."""
    if gazetteer is None:
        return df.select("id", pattern_entities("text").alias("entities"))
    mentions = gazetteer_mentions(df, gazetteer, max_words)
    as_entity = _entity(F.col("text"), F.col("category"), F.col("subcategory"), 0.9)
    ordered = F.sort_array(F.collect_list(F.struct("position", F.length("text").alias("chars"), as_entity.alias("e"))))
    named = mentions.groupBy("id").agg(F.transform(ordered, lambda m: m.e).alias("_named"))
    joined = df.select("id", pattern_entities("text").alias("_patterned")).join(named, "id", "left")
    merged = F.concat("_patterned", F.coalesce("_named", F.array().cast(T.ArrayType(schemas.ENTITY))))
    return joined.select("id", merged.alias("entities"))


#: Phrases kept per article unless the caller says otherwise.
PHRASES_PER_ARTICLE = 10
_BREAK = "|"


def candidate_phrases(text: Column | str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Word runs between stop words and punctuation, lower-cased."""
    column = F.col(text) if isinstance(text, str) else text
    marked = F.regexp_replace(F.lower(column), r"[^\p{L}\p{N}" + WHITESPACE[1:], f" {_BREAK} ")
    tokens = F.split(marked, WHITESPACE + "+")
    stops = list(stop_words)
    kept = F.transform(tokens, lambda t: F.when(t.isin(stops), F.lit(_BREAK)).otherwise(t))
    runs = F.transform(F.split(F.array_join(kept, " "), r"\|"), lambda run: F.trim(run))
    return F.filter(runs, lambda run: run != "")


def phrase_scores(
    df: DataFrame, stop_words: Iterable[str] = STOP_WORDS, max_words: int | None = None
) -> DataFrame:
    """RAKE (Rose et al. 2010): ``id, phrase, score`` for every candidate phrase of every article.

    A word scores degree / frequency, which is the mean length of the phrases it occurs in; a phrase
    scores the sum over its words. ``max_words`` drops longer phrases before scoring; by default none. ``df`` has ``id, text``, one row per article.
    """
    scored = df.select("id", F.explode(_scored("text", stop_words, max_words)).alias("p"))
    return scored.select("id", "p.phrase", "p.score")


def _scored(text: Column | str, stop_words: Iterable[str], max_words: int | None) -> Column:
    """Distinct phrases of a text with their rounded scores."""
    phrases = candidate_phrases(text, stop_words)
    if max_words is not None:
        phrases = F.filter(phrases, lambda phrase: F.size(F.split(phrase, " ")) <= max_words)
    scored = F.arrow_udf(_rake(), "array<struct<phrase:string,score:double>>")(phrases)
    return F.transform(scored, lambda p: F.struct(p.phrase.alias("phrase"), F.round(p.score, 6).alias("score")))


def _best(text: Column | str, n: int, stop_words: Iterable[str], max_words: int | None) -> Column:
    """The ``n`` best phrases of a text as (-score, phrase), in order; only they leave its row."""
    keyed = F.transform(_scored(text, stop_words, max_words), lambda p: F.struct((-p.score).alias("less"), p.phrase.alias("phrase")))
    return F.slice(F.sort_array(keyed), 1, n)


def _rake() -> Callable:
    """Distinct phrases of each article with their scores; the words of an article never leave its row."""

    def some(articles: pa.Array) -> pa.Array:
        ends, found, scores = [0], [], []
        for article in articles:
            degree, frequency, parts = defaultdict(int), defaultdict(int), {}
            for phrase in article.as_py() or ():
                words = parts.get(phrase) or parts.setdefault(phrase, phrase.split(" "))
                n = len(words)
                for word in words:
                    degree[word] += n
                    frequency[word] += 1
            weight = {word: total / frequency[word] for word, total in degree.items()}
            found += parts
            scores += [sum(map(weight.__getitem__, words)) for words in parts.values()]
            ends.append(len(found))
        rows = pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=["phrase", "score"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    def scored(articles: pa.Array) -> pa.Array:
        parts = [some(articles.slice(first, 200)) for first in range(0, len(articles), 200)]
        return pa.concat_arrays(parts) if parts else some(articles)

    return scored


def top_phrases(
    df: DataFrame,
    n: int = PHRASES_PER_ARTICLE,
    stop_words: Iterable[str] = STOP_WORDS,
    max_words: int | None = None,
) -> DataFrame:
    """Best ``n`` phrases per article with their rank."""
    best = df.select("id", F.posexplode(_best("text", n, stop_words, max_words)).alias("place", "p"))
    return best.select("id", "p.phrase", (-F.col("p.less")).alias("score"), (F.col("place") + 1).alias("rank"))


def extract_phrases(
    df: DataFrame,
    n: int = PHRASES_PER_ARTICLE,
    stop_words: Iterable[str] = STOP_WORDS,
    max_words: int | None = None,
) -> DataFrame:
    """``id, keyPhrases`` with the best phrase first; articles without a phrase have no row."""
    best = df.select("id", _best("text", n, stop_words, max_words).phrase.alias("keyPhrases"))
    return best.filter(F.size("keyPhrases") > 0)


EMBEDDING_DIMS = 256


def embed(df: DataFrame, dims: int = EMBEDDING_DIMS, text_col: str = "embedding_text") -> DataFrame:
    """Adds ``content_vector, vectorStatus, vectorError``: hashed word uni- and bigrams, unit length.

    Feature hashing (Weinberger et al. 2009) needs no vocabulary and no second pass. Text without a
    single word gets no vector and the status ``empty_content``.
    """
    words = df.withColumn("_words", F.coalesce(tokenize(text_col, ()), F.array().cast("array<string>")))
    pairs = F.zip_with("_words", F.slice("_words", F.lit(2), F.size("_words")), lambda a, b: F.concat(a, F.lit(" "), b))
    features = words.withColumn("_features", F.concat("_words", F.array_compact(pairs)))
    counted = HashingTF(inputCol="_features", outputCol="_counts", numFeatures=dims).transform(features)
    scaled = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0).transform(counted)
    has_words = F.size("_words") > 0
    return scaled.select(
        *[F.col(c) for c in df.columns],
        F.when(has_words, vector_to_array("_unit", "float32")).alias("content_vector"),
        F.when(has_words, F.lit("ok")).otherwise(F.lit("empty_content")).alias("vectorStatus"),
        F.lit(None).cast("string").alias("vectorError"),
    )


def apply_model(df: DataFrame, model: Callable, schema: T.StructType | str) -> DataFrame:
    """Run a user model over Arrow batches: ``model`` maps an iterator of record batches to another."""
    return df.mapInArrow(model, schema)


def combine_status(sentiment_error: Column, has_result: Column) -> tuple[Column, Column]:
    """``nlpStatus`` and ``nlpError``: only a sentiment failure, or no result at all, fails an article."""
    error = F.when(has_result, sentiment_error).otherwise(F.lit("No result returned by annotator"))
    return F.when(error.isNull(), F.lit("ok")).otherwise(F.lit("failed")), error


def prepare(articles: DataFrame, snippet_vectors: bool = False) -> DataFrame:
    """Adds ``text, body_snippet, embedding_text`` to raw articles.

    Vectors are made of title and whole text; ``snippet_vectors`` takes the display snippet, with the limits
    of a hosted service, instead.
    """
    text = extract_text("content", "description", "title")
    with_text = articles.withColumn("text", text)
    snippet = body_snippet("text")
    whole = F.concat_ws("\n\n", F.nullif("title", F.lit("")), F.nullif("text", F.lit("")))
    with_snippet = with_text.withColumn("body_snippet", snippet)
    return with_snippet.withColumn("embedding_text", embedding_input("title", "body_snippet") if snippet_vectors else whole)


def annotate(
    prepared: DataFrame,
    lexicon: Lexicon = DEFAULT_LEXICON,
    gazetteer: DataFrame | None = None,
    dims: int = EMBEDDING_DIMS,
    max_chars: int | None = None,
    phrases: int = PHRASES_PER_ARTICLE,
) -> DataFrame:
    """Built-in annotators over ``id, text, embedding_text, ...``, one row per article in and out.

    ``max_chars`` imposes the text limit of a hosted annotator; by default whole texts are read.
    ``phrases`` is how many key phrases an article keeps.
    """
    if max_chars is not None:
        prepared = prepared.withColumn("text", truncate_words("text", max_chars))
    clustered = cluster_by_id(prepared)
    texts = clustered.select("id", "text")
    readable = F.length("text") > 0
    error = F.when(~readable, F.lit(EMPTY_TEXT))
    status, message = combine_status(error, F.lit(True))
    scored = embed(clustered, dims).select(
        "*",
        F.when(readable, score_sentiment("text", lexicon)).alias("sentiment"),
        status.alias("nlpStatus"),
        message.alias("nlpError"),
    )
    if gazetteer is None:
        named = scored.withColumn("entities", pattern_entities("text"))
    else:
        named = scored.join(extract_entities(texts, gazetteer), "id", "left")
    return named.withColumn("keyPhrases", _best("text", phrases, STOP_WORDS, None).phrase)


def build_silver(annotated: DataFrame, enriched_at: Column) -> DataFrame:
    """Silver rows with their defaults: missing arrays are empty, missing statuses ``unknown``."""
    source_type = annotated.schema["source"].dataType
    no_entities = F.array().cast(T.ArrayType(schemas.ENTITY))
    columns = {
        "source": source_name("source", source_type),
        "nlpStatus": F.coalesce("nlpStatus", F.lit("unknown")),
        "entities": F.coalesce("entities", no_entities),
        "keyPhrases": F.coalesce("keyPhrases", F.array().cast("array<string>")),
        "hasPii": pii.has_pii("entities"),
        "vectorStatus": F.coalesce("vectorStatus", F.lit("unknown")),
        "ingestedAt": F.col("ingested_at").cast("string"),
        "enrichedAt": enriched_at.cast("string"),
        "contentTruncated": content_truncated("content"),
    }
    return annotated.select(
        *[columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.SILVER.fields]
    )
