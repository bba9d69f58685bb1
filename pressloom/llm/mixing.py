"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import keyed, index_within, maybe_broadcast, ordered, stage

#: Weights dealt to the sources in code-point order, over and over; null comes last.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MAX_EPOCHS = 3
_GRID = 1 << 20  # offsets are multiples of 1 / _GRID, so sums with whole numbers stay exact


def n_words(text: Column) -> Column:
    """Number of runs without ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to one row per source with ``source``, ``size`` and ``n_docs``.

    Sources share the total by weight; what exceeds ``max_epochs`` times a source's size is shared anew
    by weight among the others until none is above. The share per unit of weight only grows, so a
    source that is full stays full and each pass needs two sums.
    """
    ranked = index_within(ordered(sizes.withColumn("_all", F.lit(0)), F.col("source").asc_nulls_last(), label="mix-sources"), "_all", index="_rank")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = stage(ranked.withColumn("weight", F.get(cycle, (F.col("_rank") % len(weights)).cast("int"))).drop("_all", "_rank", "position"), "mix-weights")
    total = ranked.agg(F.sum("size")).first()[0] or 0
    cap, level, full = max_epochs * F.col("size"), 0.0, F.lit(False)
    known = -1
    while True:
        capped, taken, left = ranked.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))
        ).first()
        if capped == known or not left:
            break
        known, level = capped, (total - taken) / left
        full = F.lit(level) * F.col("weight") > cap
    return ranked.withColumn("target", F.when(full, cap.cast("double")).otherwise(F.lit(level) * F.col("weight")))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """How often the mix takes each document.

    The columns of ``docs`` and, replacing any of the same name, ``size`` (words), ``source_size``,
    ``target`` (words the mix wants of the source), ``copies`` and ``taken`` (words taken). Documents of
    a source stand in order of size, then doc_id; each expects target / source_size copies, prefix sums
    of that start at one offset per source, and a document is emitted once for each whole number its
    span crosses. So a source misses its target by about one document at most, and reruns agree.

    Null text counts 0 words; null is a source of its own; empty documents follow their source; a
    source without words has target 0 and is not taken; repeated rows are rows of their own. An empty
    table gives an empty result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = stage(
        docs.select(
            row.alias("row"),
            F.col("doc_id").alias("_doc"),
            F.col("source").alias("_source"),
            n_words(F.col("text")).alias("_size"),
            F.xxhash64("text").alias("_tie"),
        ),
        "mix-sized",
    )
    return _mixed(sized, weights, max_epochs, seed).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in _ADDED], *_ADDED
    )


_ADDED = ("size", "source_size", "target", "copies", "taken")


def mix_sizes(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """As :func:`mix`, without carrying the texts: ``doc_id``, ``source`` and the added columns."""
    return _mixed(_sized(docs), weights, max_epochs, seed).select(F.col("_doc").alias("doc_id"), F.col("_source").alias("source"), *_ADDED)


def _sized(docs: DataFrame, *more: str) -> DataFrame:
    columns = [F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), n_words(F.col("text")).alias("_size"), F.xxhash64("text").alias("_tie")]
    return stage(docs.select(*columns, *more), "mix-sized")


def _mixed(sized: DataFrame, weights, max_epochs: int, seed: str) -> DataFrame:
    totals = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n_docs"))
    targets = stage(source_targets(totals, weights, max_epochs), "mix-targets")
    place = ordered(sized, F.col("_source").asc_nulls_last(), "_size", F.col("_doc").asc_nulls_last(), "_tie", label="mix-order")
    tag = F.concat(F.lit(seed), F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit("")))
    targets = targets.select(
        "source",
        F.col("size").alias("source_size"),
        "target",
        F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0).alias("_rate"),
        (F.conv(F.substring(F.md5(tag), 1, 5), 16, 10).cast("long") / F.lit(_GRID)).alias("_offset"),
    )
    numbered = index_within(place, "_source", index="_index").join(
        maybe_broadcast(targets, targets.count()), F.col("_source").eqNullSafe(F.col("source"))
    ).drop("source")

    def crossed(index: Column) -> Column:
        return F.floor(F.col("_offset") + index.cast("double") * F.col("_rate"))

    return (
        numbered.withColumn("copies", crossed(F.col("_index") + 1) - crossed(F.col("_index")))
        .withColumn("size", F.col("_size"))
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mixture(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it is taken, with its own columns.

    Copies are planned on row keys and sizes; the texts meet the plan once, where they are read if the plan is
    small enough to broadcast. Rows equal in doc_id and text are planned each for itself, like others.
    """
    rows = keyed(docs)
    planned = _mixed(_sized(rows, "__file", "__row"), weights, max_epochs, seed).where("copies > 0")
    planned = stage(planned.select(F.col("__file").alias("_in"), F.col("__row").alias("_at"), F.col("copies").cast("int").alias("_copies")), "mix-plan")
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole"), "__file", "__row")
    taken = whole.join(maybe_broadcast(planned, planned.count()), (F.col("__file") == F.col("_in")) & (F.col("__row") == F.col("_at")))
    repeated = taken.select("_whole", F.explode(F.array_repeat(F.lit(0), F.col("_copies"))))
    return repeated.select(*[F.col(f"_whole.`{c}`").alias(c) for c in docs.columns])
