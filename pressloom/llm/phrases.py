"""Document fingerprints from the phrases of a Lempel-Ziv parse."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import stage
from pressloom.llm.words import Powers, mix64, span_hashes

#: Slots of a signature and hexadecimal digits of a slot.
SLOTS, DIGITS = 64, 4
_EMPTY = np.iinfo(np.uint64).max


def parse(text: str, start: int, known: set[str], ends: list[int], stop: int) -> int:
    """Cut ``text`` from ``start`` into phrases: the longest known one and the character after it.

    New phrases join ``known``, their ends ``ends``. Stops before a phrase would end beyond ``stop`` and
    returns where that phrase begins. All prefixes of a known phrase are known, so the search may start
    at the usual length and go either way.
    """
    usual = 4
    at = start
    while True:
        size = usual
        if text[at : at + size] in known:
            size += 1
            while text[at : at + size] in known:
                size += 1
                if at + size > stop:
                    return at
        else:
            size -= 1
            while size and text[at : at + size] not in known:
                size -= 1
            size += 1
        if at + size > stop:
            return at
        known.add(text[at : at + size])
        at += size
        ends.append(at)


def signature(text: str, ends: list[int], powers: Powers) -> np.ndarray:
    """Smallest hash per slot over the set of phrases; what is left at the end of a text is a phrase too."""
    if not text:
        return np.full(SLOTS, _EMPTY, np.uint64)
    to = np.array(ends if ends and ends[-1] == len(text) else [*ends, len(text)], np.int64)
    since = np.concatenate([[0], to[:-1]])
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    hashes = span_hashes(codes, since, to, powers)
    slots = np.full(SLOTS, _EMPTY, np.uint64)
    np.minimum.at(slots, (hashes >> np.uint64(58)).astype(np.int64), mix64(hashes))
    # A slot without phrases borrows from the slot that a fixed sequence of hashes leads to.
    empty = np.flatnonzero(slots == _EMPTY)
    if len(empty):
        full = slots.copy()
        for slot in empty:
            step = 1
            while True:
                other = int(mix64(np.array([slot * 1000003 + step], np.uint64))[0] % np.uint64(SLOTS))
                if full[other] != _EMPTY:
                    slots[slot] = mix64(full[other : other + 1] + np.uint64(step))[0]
                    break
                step += 1
    return slots


def written(slots: np.ndarray) -> str:
    """Hexadecimal digits of the slots; a text without phrases has an empty fingerprint."""
    if slots[0] == _EMPTY and (slots == _EMPTY).all():
        return ""
    return (mix64(slots) >> np.uint64(64 - 4 * DIGITS)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal slots, an estimate of the shared part of both phrase sets; two empty texts are alike."""
    if not a or not b:
        return float(a == b)
    same = sum(a[i : i + DIGITS] == b[i : i + DIGITS] for i in range(0, len(a), DIGITS))
    return same / SLOTS


class Fingerprints:
    """Fingerprint of a text and of the text with its last half replaced, sharing the parse of the first."""

    def __init__(self):
        self.powers = Powers()

    def both(self, text: str, edited: str, common: int) -> tuple[str, str]:
        known, ends = set(), []
        at = parse(text, 0, known, ends, common)
        known_too, ends_too = set(known), list(ends)
        parse(text, at, known, ends, len(text))
        parse(edited, at, known_too, ends_too, len(edited))
        return written(signature(text, ends, self.powers)), written(signature(edited, ends_too, self.powers))

    def one(self, text: str) -> str:
        ends: list[int] = []
        parse(text, 0, set(), ends, len(text))
        return written(signature(text, ends, self.powers))


_OUT = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def edit(text: str, other: str) -> tuple[str, int]:
    """The text with its last half replaced by the start of another, and how much of it stays."""
    half = len(text) // 2
    stays = len(text) - half
    return text[:stays] + other[:half], stays


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, both fingerprints and their likeness, per document.

    The edited text replaces the last half of a text by the start of the next document's, by descending
    doc_id (null last, equal ids by text hash); the last is followed by the first. Texts are dealt to
    tasks by ranges of doc_id and sorted there, which is the only shuffle; each task then meets a text's
    next one as it goes, and only the first and last document of every task are joined again.

    Null text is empty: no phrases, fingerprint "". Two empty texts have likeness 1, an empty and a
    non-empty one 0. A table of one document is followed by itself; an empty table gives no rows; rows
    repeated in full are neighbours and alike. Extra columns are not carried.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    fields = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def walk(batches):
        """Finished rows; the last document lacks its next one and comes as text, as the first does too."""
        part, make = TaskContext.get().partitionId(), Fingerprints()
        first = head = before = None  # first text, its fingerprint, the document whose next one is awaited
        waiting = None  # a row that only lacks the likeness to the document before the current one
        done = []
        for some in batches:
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                if before is None:
                    first = text
                else:
                    row = _row(make, *before, text)
                    if waiting is None:
                        head = row["fingerprint"]
                    else:
                        done.append(waiting | {"near_next": likeness(waiting["fingerprint"], row["fingerprint"])})
                    waiting = row
                before = (doc_id, text)
                if len(done) >= 500:
                    yield pa.RecordBatch.from_pylist(done, schema=_schema(True))
                    done = []
        if before is not None:
            own = make.one(before[1])
            if waiting is not None:
                done.append(waiting | {"near_next": likeness(waiting["fingerprint"], own)})
            edge = {"doc_id": before[0], "fingerprint": own, "part": part, "first": first, "last": before[1]}
            done.append(edge | {"first_fingerprint": own if head is None else head})
            yield pa.RecordBatch.from_pylist(done, schema=_schema(True))

    staged = stage(dealt.mapInArrow(walk, fields + ", part int, first string, last string, first_fingerprint string"), "phrase-rows")
    done = staged.where("last IS NULL").select("doc_id", *_OUT)
    # One row per task from here on.
    edges = staged.where("last IS NOT NULL").select("doc_id", "part", "first", "last", "first_fingerprint", "fingerprint")
    following = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    places = edges.select("part", F.coalesce(F.lead("part").over(following), F.first("part").over(whole)).alias("next"))
    heads = edges.select(F.col("part").alias("next"), F.col("first").alias("after"), F.col("first_fingerprint").alias("after_fingerprint"))
    pairs = edges.select("doc_id", "part", "last", "fingerprint").join(places, "part").join(heads, "next").drop("part", "next")

    def close(batches):
        make = Fingerprints()
        for some in batches:
            rows = [
                _row(make, r["doc_id"], r["last"], r["after"]) | {"near_next": likeness(r["fingerprint"], r["after_fingerprint"])}
                for r in some.to_pylist()
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_schema(False))

    return done.unionByName(pairs.select("doc_id", "last", "fingerprint", "after", "after_fingerprint").mapInArrow(close, fields))


def _schema(edges: bool) -> pa.Schema:
    text, whole, real = pa.string(), pa.int64(), pa.float64()
    kinds = [("doc_id", whole), *zip(_OUT, (whole, text, text, text, real, real))]
    return pa.schema(kinds + [("part", pa.int32()), ("first", text), ("last", text), ("first_fingerprint", text)] * edges)


def _row(make: Fingerprints, doc_id, text: str, after: str) -> dict:
    changed, stays = edit(text, after)
    own, other = make.both(text, changed, stays)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": digest, "fingerprint": own, "edited_fingerprint": other, "near_edited": likeness(own, other)}
