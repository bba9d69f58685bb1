"""Line dedup: chunks of lines with content-defined boundaries, repeated chunks removed after comparing bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pressloom.llm.common import returning_memory, stage
from pressloom.llm.words import Powers, chunks, mix64, span_hashes, text_bytes, word_spans

#: Lines the rolling hash looks at, chunkings tried, and a chance of 1 in this of a boundary after a line.
WINDOW, CHUNKINGS, SPREAD = 2, 4, 2
#: A chunk counts from this many lines on; a line of so many words is a chunk of its own.
MIN_LINES, LONG_LINE = 2, 50
#: Bits of the filter that says which chunks may be repeated: 8 MB whatever the input.
FILTER_BITS = 1 << 26


def line_chunks(data: np.ndarray, offsets: np.ndarray, powers: Powers):
    """All chunks of all texts: text number, first line, last line, two hashes, begin and end byte.

    A boundary stands after a line if the rolling hash of the last ``WINDOW`` line hashes falls on it.
    The same lines are thus cut alike wherever they stand. A passage of few lines may hold no whole chunk of
    any chunking, so the shortest runs from and to each line, see :func:`short_runs`, are chunks as well.
    """
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    texts = np.concatenate([np.arange(n), owner])
    order = np.lexsort((starts, texts))
    starts, texts = starts[order], texts[order]
    last = np.append(texts[1:] != texts[:-1], True)
    ends = np.where(last, offsets[1:][texts], np.append(starts[1:], 1) - 1)
    opens = np.append(True, last[:-1])
    first_line = np.flatnonzero(opens)
    number = np.arange(len(texts)) - first_line[texts]
    hashes = span_hashes(data, starts, ends, powers)
    word_starts, _, _ = word_spans(data, offsets)
    words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
    long_line = words >= LONG_LINE
    rolling = hashes.copy()
    for back in range(1, WINDOW):
        same = number[back:] >= back  # the window does not reach into the text before
        rolling[back:][same] += np.uint64(2 * back + 1) * mix64(hashes[:-back][same] + np.uint64(back))
    forced = last | long_line | np.append(long_line[1:], False)
    found = []
    for seed in range(CHUNKINGS):
        cut = forced | (mix64(rolling + np.uint64(0x9E37 + seed)) % np.uint64(SPREAD) == 0)
        to = np.flatnonzero(cut)
        since = np.append(0, to[:-1] + 1)
        wanted = (to - since + 1 >= MIN_LINES) | (long_line[to] & (seed == 0))
        since, to = since[wanted], to[wanted]
        found.append((since, to))
    found.append(short_runs(words, texts))
    since, to = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    # Chunkings often agree; the same span counts once.
    _, once = np.unique(since * np.int64(len(texts) + 1) + to, return_index=True)
    since, to = since[once], to[once]
    low = span_hashes(hashes, since, to + 1, powers)
    high = span_hashes(mix64(hashes ^ np.uint64(0xD1B54A32D192ED03)), since, to + 1, powers)
    return texts[since], number[since], number[to], low, high, starts[since], ends[to]


def short_runs(words: np.ndarray, texts: np.ndarray):
    """First and last line of the shortest run from each line, and of the shortest one to each line, that has two
    lines with words and ``LONG_LINE`` words; ``words`` and ``texts`` are each line's words and text number.

    What depends on nothing outside the run: a repeated passage of that size holds, for each of its lines with
    words, the run to it or the one from the passage's first line, so together they cover all of it.
    """
    line = np.flatnonzero(words)
    text, before, own = texts[line], np.append(0, np.cumsum(words[line])), np.arange(len(line))
    to = np.maximum(np.searchsorted(before, before[:-1] + LONG_LINE) - 1, own + 1)
    since = np.minimum(np.searchsorted(before, before[1:] - LONG_LINE, side="right") - 1, own - 1)
    first, last = np.concatenate([own, since]), np.concatenate([to, own])
    inside = (first >= 0) & (last < len(line))
    first, last = first[inside], last[inside]
    same = text[first] == text[last]
    return line[first[same]], line[last[same]]


_KEY = ("doc_id", "tie")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").where(F.col("text") != "")


def _scan(docs: DataFrame, wanted=None, bodies: bool = False) -> DataFrame:
    """``chunk`` of every chunk; with a filter (broadcast bits), the chunks it may hold and their places or bytes."""
    fields = "chunk long"
    if wanted is not None:
        fields += ", check long, doc_id long, tie long, first int, last int" + (", body binary" if bodies else "")

    def cut(batches):
        powers = Powers()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                base = offsets[a]
                text, first, last, low, high, begin, end = line_chunks(data[base : offsets[b]], offsets[a : b + 1] - base, powers)
                if wanted is None:
                    yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64))], names=["chunk"])
                    continue
                bit = low & np.uint64(FILTER_BITS - 1)
                kept = (wanted.value[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                text, first, last, low, high, begin, end = [x[kept] for x in (text, first, last, low, high, begin, end)]
                body = [pa.array([data[base + x : base + y].tobytes() for x, y in zip(begin, end)], pa.binary())] if bodies else []
                own = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), batch.column("doc_id").cast(pa.int64()).take(own), batch.column("tie").take(own), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), *body],
                    names=["chunk", "check", *_KEY, "first", "last", *["body"][: len(body)]],
                )

    return _keyed(docs).mapInArrow(returning_memory(cut), fields)


def _filter(spark: SparkSession, repeated: DataFrame):
    """Bits of the repeated hashes, in a broadcast of fixed size."""
    bit = F.col("chunk").bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = repeated.groupBy(F.bitmap_bucket_number(bit + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit + 1)).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows.toLocalIterator():
        own = np.frombuffer(row["bits"], np.uint8)
        at = (row["bucket"] - 1) * len(own)
        bits[at : at + len(own)] = own
    return spark.sparkContext.broadcast(bits)


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tie`` and ``spans`` (first and last line) of all that goes from each document.

    Three scans: hashes of all chunks, counted; bytes of chunks whose hash repeats, grouped by hash and compared;
    their places, of which all but the first by (doc_id, text hash, line) go. Two hashes of 64 bits
    name a chunk; should chunks with equal names differ in bytes, they stay.
    """
    repeated = _scan(docs).groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wanted = _filter(docs.sparkSession, repeated)
    place = F.struct(F.coalesce("doc_id", F.lit(1 << 62)).alias("doc_id"), "tie", "first").alias("place")
    bodies = _scan(docs, wanted, bodies=True).select("chunk", "check", place, "body")
    same = bodies.groupBy("chunk", "check").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("kept"), F.min("body").alias("low"), F.max("body").alias("high")
    )
    same = stage(same.where("n > 1 AND low = high").select("chunk", "check", "kept"), "lines-repeated")
    gone = _scan(docs, wanted).withColumn("place", place).join(same, ["chunk", "check"]).where(F.col("place") != F.col("kept"))
    return gone.groupBy(*_KEY).agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Documents without the lines of repeated chunks, and ``n_lines``, ``removed_lines`` of each.

    A chunk is a run of two or more whole lines, or one line of 50 words or more. The first occurrence
    by doc_id (null last) stays; the others lose their lines, the rest keeps its order. Every repeated run of
    two lines with words and 50 words in all goes, whatever stands around it, save wordless lines at its rim;
    shorter ones go where the rolling hash happens to cut them out. ``text`` and, if
    there, ``n_chars`` are those of what is left; added columns replace columns of the same name.
    Null and empty texts pass as they are (0 lines); rows equal in doc_id and text are treated alike;
    a document of which nothing is left keeps its row, with an empty text. An empty table stays empty.
    """
    added = ("n_lines", "removed_lines")
    kept = [c for c in docs.columns if c.lower() not in added]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text"), F.xxhash64("text").alias("_tie"))
    gone = removals(docs).select(F.col("doc_id").alias("_gone"), F.col("tie").alias("_gone_tie"), "spans")
    joined = whole.join(gone, F.col("_doc").eqNullSafe(F.col("_gone")) & (F.col("_tie") == F.col("_gone_tie")), "left")

    def rebuild(batches):
        for batch in batches:
            texts, spans = batch.column("_text").to_pylist(), batch.column("spans").to_pylist()
            lines_of, removed_of = [], []
            for i, (text, own) in enumerate(zip(texts, spans)):
                lines_of.append(text.count("\n") + 1 if text else 0)
                removed_of.append(0)
                if own and text:
                    lines = text.split("\n")
                    stays = np.ones(len(lines), bool)
                    for span in own:
                        stays[span["first"] : span["last"] + 1] = False
                    texts[i] = "\n".join([line for line, stay in zip(lines, stays) if stay])
                    removed_of[i] = int(len(lines) - stays.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(lines_of, pa.int64()), pa.array(removed_of, pa.int64())],
                names=["row", "_text", *added],
            )

    schema = StructType([StructField("row", whole.schema["row"].dataType), StructField("_text", docs.schema["text"].dataType)])
    for name in added:
        schema = schema.add(name, "long")
    rebuilt = joined.select("row", "_text", "spans").mapInArrow(returning_memory(rebuild), schema)

    def column(name):
        if name.lower() == "text":
            return F.col("_text").alias(name)
        if name.lower() == "n_chars":
            kind = docs.schema[name].dataType
            return F.when(F.col("removed_lines") > 0, F.length("_text").cast(kind)).otherwise(F.col(f"row.`{name}`")).alias(name)
        return F.col(f"row.`{name}`").alias(name)

    return rebuilt.select(*[column(c) for c in kept], *added)
