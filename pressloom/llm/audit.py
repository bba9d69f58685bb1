"""Audit of document filters: what each one removes in every order, from additive counts of failure masks."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import maybe_broadcast, returning_memory, stage
from pressloom.llm.words import mix64

#: Filters in the order of their mask bits; the last one is told by the whole table, the others by the text alone.
LETTERS = "ABCDE"
REPEATED = 1 << LETTERS.index("E")
ORDERS = ["".join(order) for order in permutations(LETTERS)]

#: Texts per block of the sketch, and counters of a block: eight for each text.
BLOCK_TEXTS = 1 << 14
BLOCK_COUNTERS = 8 * BLOCK_TEXTS
#: Counters that each text adds to; about 1 text in 40 without a repeat is not cleared.
PROBES = 4
#: Rows whose hashes a task holds at once.
ROWS = 1 << 20


def text_mask(text: Column, words: Column) -> Column:
    """The bits of the filters A to D: what of them the text fails."""
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    fails = [n_words < 200, 100 * distinct < 50 * n_words, 100 * capitals > 2 * F.length(text), text.rlike(r"[#$%&*|]")]
    mask = F.lit(0)
    for bit, failed in enumerate(fails):
        mask = mask + F.when(failed, 1 << bit).otherwise(0)
    return mask.cast("int")


def masked(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` (A to D) and ``hash`` of the text; staged without the text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    return stage(rows.select("doc_id", "part", text_mask(F.col("text"), F.col("words")).alias("mask"), F.xxhash64("text").alias("hash")), "audit-masks")


def _counters(hashes: np.ndarray) -> np.ndarray:
    """The counters (within their block) that each hash adds to, one row per hash."""
    return np.stack([mix64(hashes + np.uint64(0x9E3779B97F4A7C15 * i % 2**64)) % np.uint64(BLOCK_COUNTERS) for i in range(1, PROBES + 1)], axis=1)


def _blocks(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return (mix64(hashes) % np.uint64(blocks)).astype(np.int64)


def sketches(hashes: DataFrame, blocks: int) -> DataFrame:
    """Counting filters of what each task reads: one row per block it has texts of.

    ``cells`` and ``counts`` are the counters above zero, each full at two; ``hashes`` are the texts the
    filter was made of, to be asked for once all tasks' filters are one. A text that a task reads a
    million times adds one hash and counts as two.
    """

    def sketch(parts):
        own, times = np.unique(np.concatenate(parts), return_counts=True)
        block = _blocks(own, blocks)
        order = np.argsort(block, kind="stable")
        own, times, block = own[order], np.minimum(times[order], 2), block[order]
        cells = _counters(own)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        out = {"block": [], "cells": [], "counts": [], "hashes": []}
        for a, b in zip(starts[:-1], starts[1:]):
            found, at = np.unique(cells[a:b], return_inverse=True)
            counts = np.minimum(np.bincount(at.reshape(-1), weights=np.repeat(times[a:b], PROBES), minlength=len(found)), 2)
            out["block"].append(int(block[a]))
            out["cells"].append(found.astype("<u4").tobytes())
            out["counts"].append(counts.astype(np.uint8).tobytes())
            out["hashes"].append(own[a:b].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if k == "block" else pa.binary()) for k, v in out.items()], names=list(out))

    def read(batches):
        parts, rows = [], 0
        for batch in batches:
            parts.append(batch.column(0).to_numpy().view(np.uint64).copy())
            rows += batch.num_rows
            if rows >= ROWS:
                yield sketch(parts)
                parts, rows = [], 0
        if rows:
            yield sketch(parts)

    return hashes.mapInArrow(returning_memory(read), "block long, cells binary, counts binary, hashes binary")


def possible_repeats(hashes: DataFrame, texts: int) -> DataFrame:
    """Hashes of the texts that the merged filters cannot clear; each once.

    A block of the filter holds about ``BLOCK_TEXTS`` texts, so blocks, not their size, grow with the
    table. The tasks' filters of a block are added up; a text of which some counter is one stands once.
    """
    blocks = max(1, -(-texts // BLOCK_TEXTS))

    def clear(rows):
        counters = np.zeros(BLOCK_COUNTERS, np.uint8)
        for cells, counts in zip(rows.column("cells").to_pylist(), rows.column("counts").to_pylist()):
            at = np.frombuffer(cells, "<u4")
            counters[at] = np.minimum(counters[at] + np.frombuffer(counts, np.uint8), 2)
        own = np.unique(np.concatenate([np.frombuffer(h, np.uint64) for h in rows.column("hashes").to_pylist()]))
        left = own[(counters[_counters(own)] > 1).all(axis=1)]
        return pa.table({"hash": left.view(np.int64)})

    return stage(sketches(hashes.select("hash"), blocks).groupBy("block").applyInArrow(clear, "hash long"), "audit-possible")


def with_repeats(docs: DataFrame, masks: DataFrame) -> DataFrame:
    """Add the bit of filter E to ``masks``: the text also stands under a smaller id.

    Only texts that may repeat are shuffled, whole, one copy per task; their smallest ids come back.
    """
    possible = possible_repeats(masks, masks.count())
    possible = maybe_broadcast(possible, possible.count())
    text = F.coalesce("text", F.lit(""))
    asked = docs.select(F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash")).join(possible, "hash", "left_semi")
    firsts = asked.groupBy("text", "hash").agg(F.min("doc_id").alias("doc_id")).where(F.col("doc_id").isNotNull())
    firsts = stage(firsts.select("doc_id", "hash").distinct().withColumn("first", F.lit(True)), "audit-firsts")
    asked_rows = masks.where(F.col("doc_id").isNotNull()).join(possible.withColumn("asked", F.lit(True)), "hash", "left")
    known = asked_rows.join(maybe_broadcast(firsts, firsts.count()), ["doc_id", "hash"], "left")
    repeated = F.col("asked").isNotNull() & F.col("first").isNull()
    known = known.select("doc_id", "part", (F.col("mask") + F.when(repeated, REPEATED).otherwise(0)).alias("mask"))
    return known.union(masks.where(F.col("doc_id").isNull()).select("doc_id", "part", "mask"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of each part and mask: ``n``, and how many are labelled ``good`` and ``toxic``."""
    is_one = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    # Rows without an id have no label; they would all meet in one task of the join.
    with_id = rows.where(F.col("doc_id").isNotNull()).join(known, "doc_id", "left").select("part", "mask", "good", "toxic")
    without = rows.where(F.col("doc_id").isNull()).select("part", "mask", F.lit(None).cast("boolean").alias("good"), F.lit(None).cast("boolean").alias("toxic"))
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return with_id.union(without).groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


def report(counts: DataFrame) -> DataFrame:
    """All orders and steps of every part, from its counts (32 masks at most)."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = cells.select("part", "cells", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")
    )

    def bits(letters: Column) -> Column:
        mask = F.lit(0)
        for i, letter in enumerate(LETTERS):
            mask = mask + F.when(F.contains(letters, F.lit(letter)), 1 << i).otherwise(0)
        return mask

    steps = steps.withColumns(
        {
            "own": bits(F.substr("filter_order", F.col("step"), F.lit(1))),
            "before": bits(F.substr("filter_order", F.lit(1), F.col("step") - 1)),
        }
    )

    def add(value, condition) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda total, c: total + F.when(condition(c["mask"]), value(c)).otherwise(F.lit(0).cast("long")))

    has = lambda mask, some: mask.bitwiseAND(F.col(some)) != 0
    removed = lambda mask: has(mask, "own") & ~has(mask, "before")
    return steps.select(
        "part",
        "filter_order",
        "step",
        add(lambda c: c["n"], lambda m: ~has(m, "own") & ~has(m, "before")).alias("kept"),
        add(lambda c: c["n"], removed).alias("removed"),
        add(lambda c: c["n"], lambda m: has(m, "own") & has(m, "before")).alias("redundant"),
        add(lambda c: c["n"], lambda m: m == F.col("own")).alias("unique_fails"),
        add(lambda c: c["good"], removed).alias("good_lost"),
        add(lambda c: c["toxic"], removed).alias("toxic_lost"),
        # Of the filters a document fails, each comes first in an equal share of the orders.
        add(lambda c: (c["n"] * len(ORDERS) / F.bit_count(c["mask"])).cast("long"), lambda m: has(m, "own")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What five filters remove of each source (``part``) in each of their 120 orders.

    A: under 200 words; B: fewer than half of the words distinct; C: over 2 % capitals A-Z; D: a
    character of ``#$%&*|``; E: the same text under a smaller doc_id. Columns: ``part``,
    ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley``.

    A null text is empty (it fails A only, and is a repeat of other empty ones); a null source belongs to
    the part of the empty string. A row without an id neither repeats nor is repeated and has no
    label. Rows equal in id and text are counted each, none of them repeats the other. Several labels of
    one id count as one, good or toxic if any is. Extra columns are not read; an empty table gives no rows.
    """
    return report(stage(mask_counts(with_repeats(docs, masked(docs)), labels), "audit-counts"))


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
), masks AS (
  SELECT doc_id, part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
  FROM texts
), known AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM masks LEFT JOIN known USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM orders, range(1, 6) AS r(step)
), told AS (
  SELECT *, mask & own > 0 AS fails, mask & before > 0 AS gone FROM counts, steps
), reported AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT fails AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE fails AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (WHERE fails AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = own), 0) AS unique_fails, coalesce(sum(good) FILTER (WHERE fails AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE fails AND NOT gone), 0) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM reported
"""
