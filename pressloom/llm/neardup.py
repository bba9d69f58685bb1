"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import BROADCAST_ROWS, keyed, maybe_broadcast, returning_memory, stage
from pressloom.llm.graphs import components
from pressloom.llm.words import Powers, chunks, mix64, text_bytes, word_hashes

#: Words of a shingle and the least similarity of near-duplicates, in percent.
SHINGLE, PERCENT = 5, 80
#: At similarity 0.8 two sketches share none of 40 bands of 6 coordinates with probability 5e-6.
BANDS, ROWS = 40, 6
#: Rounds in which every bucket checks its members against one of them, and the share of checks that must
#: confirm a link for another such round; what is left is paired by rare shingles.
STAR_ROUNDS, STAR_YIELD = 3, 0.1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, powers: Powers):
    """Distinct shingle hashes of each text, sorted within it, and n + 1 places where the texts begin."""
    words, counts = word_hashes(data, offsets, powers)
    per = np.diff(counts)
    rolled = np.zeros(len(words), np.uint64)
    for j in range(k):
        part = words[j:] * np.uint64(2 * j + 3) ^ (words[j:] >> np.uint64(29))
        rolled[: len(part)] += mix64(part + np.uint64(j))
    n_each = np.where(per >= k, per - k + 1, (per > 0).astype(per.dtype))
    owner = np.repeat(np.arange(len(per)), n_each)
    places = np.repeat(counts[:-1], n_each) + np.arange(len(owner)) - np.repeat(np.cumsum(n_each) - n_each, n_each)
    hashes = mix64(rolled[places])
    for i in np.flatnonzero((per > 0) & (per < k)):
        short = words[counts[i] : counts[i + 1]]
        steps = np.arange(len(short), dtype=np.uint64)
        whole = (mix64(short + steps) * (2 * steps + np.uint64(1))).sum(keepdims=True, dtype=np.uint64)
        hashes[np.searchsorted(owner, i)] = mix64(whole + np.uint64(len(short)))[0]
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order], kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(per) + 1))


def sketch(hashes: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketches, (sets, size): coordinate by coordinate, two agree with chance near the similarity.

    In round i every element is thrown into a random bin with a random value above those of all
    earlier rounds, and bins keep their smallest. A set whose bins are all full is done. After ``size``
    rounds, round size + b throws all elements into bin b, so every coordinate of a non-empty set fills.
    """
    n = len(places) - 1
    bins = np.full((n, size), np.iinfo(np.uint64).max, np.uint64)
    flat = bins.ravel()
    owner = np.repeat(np.arange(n), np.diff(places))
    for round_ in range(2 * size):
        if not len(hashes):
            break
        drawn = mix64(hashes + np.uint64(0x9E3779B97F4A7C15 * (round_ + 1) & (1 << 64) - 1))
        if round_ < size:
            into = (drawn % np.uint64(size)).astype(np.int64)
        else:
            into = round_ - size
        np.minimum.at(flat, owner * size + into, (np.uint64(round_) << np.uint64(48)) | (mix64(drawn) >> np.uint64(16)))
        unfilled = (bins == np.iinfo(np.uint64).max).any(axis=1)
        left = unfilled[owner]
        hashes, owner = hashes[left], owner[left]
    return bins


def band_keys(bins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(bins), bands), np.uint64)
    grouped = bins.reshape(len(bins), bands, rows)
    for r in range(rows):
        keys = mix64(keys * np.uint64(31) + grouped[:, :, r])
    return mix64(keys + np.arange(bands, dtype=np.uint64))


def set_names(hashes: np.ndarray, places: np.ndarray):
    """Two sums over each set; equal sets have equal names."""
    def sums(values):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        return (total[places[1:]] - total[places[:-1]]).view(np.int64)

    return sums(mix64(hashes)), sums(mix64(hashes ^ np.uint64(0xA0761D6478BD642F)))


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id``, ``tie``, ``n``, name of the set (``low``, ``high``) and ``bands`` of every row, and its key if it has one."""
    keys_of = [c for c in ("__file", "__row") if c in docs.columns]

    def compute(batches):
        powers = Powers()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                base = offsets[a]
                hashes, places = shingle_sets(data[base : offsets[b]], offsets[a : b + 1] - base, k, powers)
                low, high = set_names(hashes, places)
                keys = band_keys(sketch(hashes, places, BANDS * ROWS), BANDS, ROWS).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(a, b - a) for c in ("doc_id", "tie", *keys_of)], pa.array(np.diff(places).astype(np.int64)), pa.array(low), pa.array(high), lists],
                    names=["doc_id", "tie", *keys_of, "n", "low", "high", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), *keys_of, "text")
    schema = ["doc_id long", "tie long", *[f"{c} long" for c in keys_of], "n long", "low long", "high long", "bands array<long>"]
    return rows.mapInArrow(returning_memory(compute), ", ".join(schema))


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``node`` and its whole ``shingles`` (sorted as unsigned 64-bit hashes) for classes of ``wanted`` (node, rep, rep_tie, low, high)."""
    side = maybe_broadcast(wanted, wanted.count())
    same = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.xxhash64("text") == F.col("rep_tie"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(side, same).select("node", "low", "high", "text")

    def compute(batches):
        powers = Powers()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                base = offsets[a]
                hashes, places = shingle_sets(data[base : offsets[b]], offsets[a : b + 1] - base, k, powers)
                low, high = set_names(hashes, places)
                own = batch.slice(a, b - a)
                same = (low == own.column("low").to_numpy()) & (high == own.column("high").to_numpy())
                lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([own.column("node"), lists], names=["node", "shingles"]).filter(pa.array(same))

    return rows.mapInArrow(returning_memory(compute), "node long, shingles array<long>").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, n_pairs: int) -> DataFrame:
    """The ``a``-``b`` pairs, of which there are ``n_pairs``, with 100 * intersection >= percent * union, on full sets."""

    def check(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = [batch.column(side)[i].values.to_numpy().view(np.uint64) for side in ("left", "right")]
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    if n_pairs <= BROADCAST_ROWS:
        # Only sets of pairs travel, each dealt by its pair.
        left = sets.join(F.broadcast(pairs), F.col("node") == F.col("a")).select("a", "b", F.col("shingles").alias("left"))
        right = sets.join(F.broadcast(pairs), F.col("node") == F.col("b")).select("a", "b", F.col("shingles").alias("right"))
        sides = left.join(right, ["a", "b"])
    else:
        sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
        sides = sides.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    return sides.select("a", "b", "left", "right").mapInArrow(returning_memory(check), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``tie`` (hash of the text), ``n_shingles``, ``component_id``, ``kept`` of every row.

    Rows with equal shingle sets are one class from the start. Classes that share a band of their
    sketches meet in a bucket; those with too few shingles in common with any other class leave it. A
    bucket checks all members against one of them, drawn anew in each round, which joins a group of copies
    with as many checks as members. Members still apart are then paired by their rarest shingles, an
    exact filter, unless already connected, so no link between groups is lost and the members of a
    connected group are never paired with each other.

    A text that is null or has no word has an empty set and stands alone; with fewer words than a
    shingle the whole sequence is one. component_id is the smallest doc_id of the group (null ids last;
    alone: its own), kept says whether the row has it. Rows equal in doc_id and text are one document.
    Extra columns are not carried; an empty table gives no rows.
    """
    joined = _grouped(docs, k, percent)
    component = F.when(F.col("_found"), F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "tie", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _grouped(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows of :func:`sketches` with ``root`` (a number of their group) and ``component`` (its smallest doc_id); ``_found``: not alone by rule."""
    rows = stage(sketches(docs, k), "near-sketches")
    filled = rows.where("n > 0")
    # The row that stands for a class: the smallest id, null last, and of these the smallest hash of the text.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("first")
    classes = filled.groupBy("low", "high").agg(first, F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = classes.select("low", "high", F.col("first.doc_id").alias("rep"), F.col("first.tie").alias("rep_tie"), "n", "bands")
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    roots = _roots(docs, classes, k, percent)
    ids = classes.select("node", "low", "high", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = ids.groupBy("root").agg(F.min("rep").alias("component"))
    named = ids.join(smallest, "root").select(F.col("low").alias("_low"), F.col("high").alias("_high"), "root", "component", F.lit(True).alias("_found"))
    return rows.drop("bands").join(named, (F.col("low") == F.col("_low")) & (F.col("high") == F.col("_high")) & (F.col("n") > 0), "left")


def _promising(members: DataFrame, wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members that can have a link in their bucket at all, with ``shared``: shingles that other classes have, too.

    An intersection is no larger than ``shared``, and no other member is smaller than the smallest of the bucket.
    """
    seen = sets.select("node", F.explode("shingles").alias("shingle"))
    alone = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("node")).where("times = 1")
    alone = alone.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    shared = wanted.select("node", "n").join(alone, "node", "left").select("node", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))
    least = members.groupBy("bucket").agg(F.min("n").alias("least"))
    able = members.join(shared, "node").join(least, "bucket").where((100 + percent) * F.col("shared") >= percent * (F.col("n") + F.col("least")))
    able = stage(able.drop("least"), "near-able")
    left = able.groupBy("bucket").agg(F.min("node").alias("_one"), F.max("node").alias("_other")).where("_one < _other").select("bucket")
    return stage(able.join(left, "bucket"), "near-able")


def _prefix_pairs(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of nodes of different groups that may be near, as ``x``, ``y``, ``nx``, ``ny``.

    In one order of all shingles, rarest first, two near sets must share one among their first n - least
    overlap + 1, and what follows it must still hold the overlap that their sizes ask for. Within a
    shingle only members outside its largest group are paired, with all others not of their own.
    """
    seen = sets.join(apart, "node").select("node", "n", "root", F.explode("shingles").alias("shingle"))
    times = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    order = Window.partitionBy("node").orderBy("times", "shingle")
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # A shingle nobody else has takes its place in the order but meets no one.
    heads = seen.join(times, "shingle").withColumn("left", F.col("n") - F.row_number().over(order) + 1)
    heads = heads.where((F.col("n") - F.col("left") < length) & (F.col("times") > 1)).drop("times")
    heads = stage(heads, "near-heads")
    groups = heads.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = groups.groupBy("shingle").agg(F.max_by("root", F.struct("size", "root")).alias("largest"), F.count(F.lit(1)).alias("groups"))
    heads = heads.join(largest.where("groups > 1").drop("groups"), "shingle")
    one = heads.where("root <> largest").select("shingle", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("root").alias("rx"), F.col("left").alias("lx"))
    other = heads.select("shingle", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("root").alias("ry"), F.col("left").alias("ly"))
    enough = (100 + percent) * F.least("lx", "ly") >= percent * (F.col("nx") + F.col("ny"))
    return one.join(other, (one["shingle"] == other["shingle"]) & (F.col("rx") != F.col("ry")) & enough).select("x", "y", "nx", "ny")


def _roots(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``node`` and ``root`` of all classes that have a link; a round's links are added to the groups found before."""
    spread = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("_one"), F.max("node").alias("_other")).where("_one < _other").select("bucket")
    members = stage(spread.join(shared, "bucket"), "near-buckets")
    wanted = members.select("node").distinct().join(classes.select("node", "rep", "rep_tie", "low", "high", "n"), "node")
    wanted = stage(wanted, "near-wanted")
    sets = stage(full_sets(docs, wanted, k), "near-sets")
    members = _promising(members, wanted, sets, percent)
    roots = tested = None
    labelled = members.withColumn("root", F.col("node"))
    stars, round_ = STAR_ROUNDS, 0
    while True:
        # First the member with the largest part of its set in others, which is the likeliest to be near to many.
        draw = F.xxhash64("node", F.lit(round_)) if round_ else -F.col("shared") / F.col("n")
        head = F.min(F.struct(draw.alias("draw"), "node", "root", "n"))
        buckets = labelled.groupBy("bucket").agg(head.alias("head"), F.min("root").alias("_one"), F.max("root").alias("_other"))
        buckets = buckets.where("_one < _other").drop("_one", "_other")
        if stars:
            found = labelled.join(buckets, "bucket").where("root <> head.root").select(
                F.col("node").alias("x"), F.col("head.node").alias("y"), F.col("n").alias("nx"), F.col("head.n").alias("ny")
            )
        else:
            apart = labelled.join(buckets.select("bucket"), "bucket").select("node", "n", "root").distinct()
            found = _prefix_pairs(stage(apart, "near-apart"), sets, percent)
        # No similarity can exceed the ratio of the sizes.
        pairs = found.where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "near-pairs")
        checks, confirms = pairs.count(), 0
        if checks:
            new = stage(confirmed(pairs, sets, percent, checks), "near-links")
            confirms = new.count()
            tested = pairs if tested is None else tested.unionByName(pairs)
        if confirms:
            if roots is not None:
                new = new.unionByName(roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
            roots = components(new)
        if not stars:
            break
        if confirms:
            labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            labelled = stage(labelled, "near-labelled")
        stars = stars - 1 if confirms > STAR_YIELD * checks else 0
        round_ += 1
    return roots if roots is not None else members.select("node", F.col("node").alias("root")).limit(0)


def dedup(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` per group of :func:`near_duplicates`, with its columns, and every row without words.

    Of a group stays the row with the smallest doc_id (null last), of these the one with the smallest hash of its
    text, of these the first; so of rows equal in all columns one stays.
    """
    rows = keyed(docs)
    grouped = stage(_grouped(rows, k, percent).where("_found").select("root", "doc_id", "tie", "__file", "__row"), "near-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "__file", "__row")
    firsts = grouped.groupBy("root").agg(F.min(order).alias("first")).select("first.__file", "first.__row")
    # The rows of a group of copies are dealt by themselves, not by their group.
    gone = stage(grouped.select("__file", "__row").join(firsts, ["__file", "__row"], "left_anti"), "near-gone")
    return rows.join(maybe_broadcast(gone, gone.count()), ["__file", "__row"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
