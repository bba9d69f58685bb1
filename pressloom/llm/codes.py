"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, found along a trie of parts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import maybe_broadcast, returning_memory, stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Larger components are set to this, so that every sum of squares fits 64 bits.
LARGEST = 1 << 28
#: Leaves of the trie whose distances are in memory at once.
SLAB = 1024


class Trie:
    """The trie of distinct parts, given as rows in lexicographic order.

    A node holds the squared distances of its prefix to all codebook entries; its children add one
    dimension each to a shared copy. The walk is depth-first: a subtree of more than ``SLAB`` leaves is
    entered child by child, smaller neighbours are finished level by level as one block. In memory are
    the nodes of one block and one vector of distances per dimension above it.
    """

    def __init__(self, parts: np.ndarray):
        self.parts = parts
        different = parts[1:] != parts[:-1]
        #: Leading components that a row has in common with the row before it.
        self.shared = np.concatenate([[0], different.argmax(axis=1)]) if len(parts) else np.zeros(0, np.int64)

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry of every row, ties to the lower number."""
        self.entries = entries
        self.best = np.zeros(len(self.parts), np.int64)
        self.distance = np.zeros(len(self.parts), np.int64)
        if len(self.parts):
            self._enter(0, len(self.parts), 0, np.zeros(len(entries), np.int64))
        return self.best, self.distance

    def _enter(self, low: int, high: int, depth: int, sums: np.ndarray) -> None:
        """Rows low..high have their first ``depth`` components in common, at distances ``sums``."""
        if high - low <= SLAB or depth == self.parts.shape[1]:
            self._finish(low, high, depth, sums)
            return
        starts = np.concatenate([[low], low + 1 + np.flatnonzero(self.shared[low + 1 : high] <= depth), [high]])
        first = 0
        while first < len(starts) - 1:
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + SLAB, side="right")) - 1)
            if last - first == 1:
                step = self.parts[starts[first], depth] - self.entries[:, depth]
                self._enter(starts[first], starts[last], depth + 1, sums + step * step)
            else:
                self._finish(starts[first], starts[last], depth, sums)
            first = last

    def _finish(self, low: int, high: int, depth: int, sums: np.ndarray) -> None:
        """All leaves of rows low..high, one dimension after the other."""
        sums = sums[None, :]
        node = np.zeros(high - low, np.int64)
        for at in range(depth, self.parts.shape[1]):
            new = self.shared[low:high] <= at
            new[0] = True
            rows = np.flatnonzero(new)
            step = self.parts[low + rows, at][:, None] - self.entries[:, at]
            sums = sums[node[rows]] + step * step
            node = np.cumsum(new) - 1
        best = sums.argmin(axis=1)
        self.best[low:high] = best[node]
        self.distance[low:high] = sums[np.arange(len(best)), best][node]


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and for every row its number among them."""
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])[: len(rows)]
    number = np.empty(len(rows), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], number


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``whole``, the components as integers, of the rows that can be cut into parts.

    Left out are vectors that are null, hold a null or non-finite component, or whose length is zero or
    no multiple of the number of parts.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    floor = F.transform(
        "embedding",
        lambda x: F.greatest(F.least(F.floor(x.cast("double") * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"),
    )
    size = F.size("embedding")
    usable = F.col("embedding").isNotNull() & (size > 0) & (size % PARTS == 0) & ~bad
    return vectors.select("vec_id", "label", "embedding").where(usable).select("vec_id", "label", floor.alias("whole"))


def distinct_parts(whole: DataFrame, width: int) -> DataFrame:
    """``position``, ``part`` and how many vectors hold it (``weight``), staged in lexicographic order.

    Equal parts are counted where they are read, so a vector that fills a third of the table is one row of each task.
    """
    cut = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.slice("whole", i * width + 1, width))
    counted = whole.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight"))
    order = ["position", "part"]
    return stage(counted.repartitionByRange(*order).sortWithinPartitions(*order), "code-parts")


def _sums(parts: DataFrame, books: np.ndarray) -> DataFrame:
    """Number of vectors and sum of their parts for every used entry."""
    _, entries, width = books.shape

    def assign(batches):
        counts = np.zeros((PARTS, entries), np.int64)
        sums = np.zeros((PARTS, entries, width), np.int64)
        for batch in batches:
            position = batch.column(0).to_numpy()
            rows, weight = _matrix(batch.column(1), width), batch.column(2).to_numpy()
            for p in np.unique(position):
                mine = np.flatnonzero(position == p)
                best, _ = Trie(rows[mine]).nearest(books[p])
                np.add.at(counts[p], best, weight[mine])
                np.add.at(sums[p], best, rows[mine] * weight[mine, None])
        p, entry = np.nonzero(counts)
        flat = pa.array(sums[p, entry].reshape(-1), pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * width, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[p, entry]), lists], names=["position", "entry", "n", "sums"]
        )

    partial = parts.mapInArrow(returning_memory(assign), "position int, entry int, n long, sums array<long>")
    return partial.groupBy("position", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])


def train(whole: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width) after ``rounds`` rounds over all vectors of :func:`whole_vectors`.

    They start as the parts of the vectors with the smallest ids (null last, ties by content), fewer if
    there are fewer rows. The driver gets those rows and one row per position and entry and round, no more.
    """
    assert entries <= 256, "a code has two hex digits a part"
    order = [F.asc_nulls_last("vec_id"), F.asc("whole")]
    first = whole.select("vec_id", "whole").orderBy(*order).limit(1).collect()
    if not first:
        return np.zeros((PARTS, 0, 0), np.int64)
    length = len(first[0]["whole"])
    width = length // PARTS
    same = whole.where(F.size("whole") == length)
    start = same.select("vec_id", "whole").orderBy(*order).limit(entries).collect()
    books = np.array([row["whole"] for row in start], np.int64).reshape(-1, PARTS, width).transpose(1, 0, 2).copy()
    parts = distinct_parts(same, width)
    for _ in range(rounds):
        for row in _sums(parts, books).collect():
            books[row["position"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return books


def encode(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of every vector of the codebooks' length."""
    _, _, width = books.shape

    def assign(batches):
        for batch in batches:
            rows = _matrix(batch.column(2), PARTS * width)
            best, error = np.zeros((len(rows), PARTS), np.uint8), np.zeros(len(rows), np.int64)
            for p in range(PARTS):
                parts, number = distinct_rows(rows[:, p * width : (p + 1) * width])
                entry, distance = Trie(parts).nearest(books[p])
                best[:, p] = entry[number]
                error += distance[number]
            codes = [row.tobytes().hex() for row in best]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    kept = whole.where(F.size("whole") == PARTS * width)
    label = kept.schema["label"].dataType.simpleString()
    ident = kept.schema["vec_id"].dataType.simpleString()
    return kept.select("vec_id", "label", "whole").mapInArrow(returning_memory(assign), f"vec_id {ident}, label {label}, code string, error long")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of all vectors (vec_id, embedding, label) and how far they are from their entries.

    Columns: ``vec_id``, ``code`` (two hex digits per part), ``error`` (squared distances of the
    scaled integer parts), ``label_error`` (errors added over equal labels, nulls together) and
    ``codebooks_sha256``.

    Vectors that are null, hold null or non-finite components, have no component or a number that is no
    multiple of four are left out, as are those of another length than the vector of the smallest
    id. Components beyond 2^28 / 1024 count as that. Null and repeated ids are rows like others; null
    ids come last in the start. Extra columns are not carried; an empty table gives no rows.
    """
    whole = whole_vectors(vectors)
    books = train(whole, entries, rounds)
    coded = stage(encode(whole, books), "codes")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    totals = stage(totals, "code-labels")
    joined = coded.join(maybe_broadcast(totals, totals.count()), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle(rounds: int = ROUNDS) -> str:
    """The same in SQL, one block of CTEs per round."""
    books = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS whole FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, position, whole[position * len(whole) // {PARTS} + 1:(position + 1) * len(whole) // {PARTS}] AS part
  FROM kept, range({PARTS}) AS r(position)
), book0 AS MATERIALIZED (
  SELECT position, (dense_rank() OVER (ORDER BY vec_id) - 1)::INT AS entry, part AS center
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})
)"""
    ]
    for i in range(rounds + 1):
        books.append(f"""assigned{i} AS MATERIALIZED (
  SELECT vec_id, label, position, part, min(distance) AS distance, arg_min(entry, distance * {ENTRIES} + entry) AS entry FROM (
    SELECT p.*, b.entry, list_inner_product(part, part) - 2 * list_inner_product(part, center) + list_inner_product(center, center) AS distance
    FROM parts p JOIN book{i} b USING (position))
  GROUP BY vec_id, label, position, part
)""")
        if i < rounds:
            books.append(f"""means{i} AS MATERIALIZED (
  SELECT position, entry, list(mean ORDER BY place) AS center FROM (
    SELECT position, entry, place, floor(sum(value) / count(*)) AS mean
    FROM (SELECT position, entry, unnest(part) AS value, generate_subscripts(part, 1) AS place FROM assigned{i}) GROUP BY position, entry, place)
  GROUP BY position, entry
), book{i + 1} AS MATERIALIZED (
  SELECT position, entry, coalesce(m.center, b.center) AS center FROM book{i} b LEFT JOIN means{i} m USING (position, entry)
)""")
    return "WITH " + ",\n".join(books) + f""",
digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(center, lambda x: x::BIGINT), ','), ',' ORDER BY position, entry)) AS codebooks_sha256 FROM book{rounds}
), coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY position) AS code, sum(distance)::BIGINT AS error
  FROM assigned{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""
