"""Packing token sequences: concatenate all documents and cut every ``length`` tokens."""

from __future__ import annotations

import itertools
import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import maybe_broadcast, returning_memory, stage
from pressloom.llm.lookup import ChunkIds, ragged
from pressloom.llm.words import chunks, text_bytes

LENGTH = 2048
END_ID = 1
#: Bytes of text handled at a time.
BLOCK = 1 << 20
#: New words given to the tokenizer in one text, and texts in one call.
TOGETHER, AT_ONCE = 64, 64
#: Stands between new words that are not of ASCII letters alone; the tokenizer has one id for it.
BETWEEN = "~"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Token ids of texts by way of their words: what a blank or line end precedes, up to the next word.

    This needs a tokenizer that drops white space, joins nothing across it, lower-cases by itself and parts
    a final stop or comma from letters. Some texts are tried on load; another tokenizer is refused.
    """

    _TRIED = "Ab, cd. \n\n EF  g,h. a.b ,c, d..e ÄB. ß, X9. don't, I'LL. <|x|> \U0001f600. \u01c5. z"

    def __init__(self, path: str, kept: int | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = {mark: self.tokenizer.encode(mark, add_special_tokens=False).ids if mark else [] for mark in ("", ".", ",")}
        self.between = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.table = ChunkIds(self._ids, *([kept] if kept else []))
        ids, _ = self.encode(*text_bytes(pa.array([self._TRIED])))
        if ids.tolist() != self.tokenizer.encode(self._TRIED, add_special_tokens=False).ids:
            raise ValueError(f"{path}: this tokenizer's ids of a text are not those of its words in a row")

    @classmethod
    def of_worker(cls, path: str) -> WordIds:
        """One per Python worker, kept from task to task."""
        kept = sys.__dict__.setdefault("_pressloom_word_ids", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the n + 1 places where the texts begin."""
        places = np.zeros(len(offsets), np.int64)
        if not len(data):
            return np.zeros(0, np.int32), places
        blank = (data == 32) | (data == 10)
        starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
        cut = np.zeros(len(data) + 1, bool)
        cut[starts] = cut[offsets] = True
        cuts = np.flatnonzero(cut)
        ids, each = self.table.of(np.where(data == 10, np.uint8(32), data), cuts)
        owner = np.searchsorted(offsets, cuts[:-1], side="right") - 1
        np.cumsum(np.bincount(owner, weights=each, minlength=len(offsets) - 1).astype(np.int64), out=places[1:])
        return ids, places

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks in a row, and how many each has: of ASCII words, with or without a mark, all at once."""
        words = pc.ascii_trim(words.cast(pa.string()), " ")
        ascii_word = pc.match_substring_regex(words, "^[A-Za-z]+[.,]?$")
        plain = words.filter(ascii_word)
        cores = pc.ascii_lower(pc.ascii_rtrim(plain, ".,")).dictionary_encode()
        parts = [self._of_letters(cores.dictionary.to_pylist()), ragged(self._others(words.filter(pc.invert(ascii_word)).to_pylist())), ragged([self.marks["."], self.marks[","], []])]
        pool, each = (np.concatenate(x) for x in zip(*parts))
        starts = np.cumsum(each) - each
        # A chunk is one entry of the pool, and one for its mark.
        here = ascii_word.to_numpy(zero_copy_only=False)
        entry = np.full((len(words), 2), len(each) - 1)
        entry[here, 0] = cores.indices.to_numpy()
        entry[~here, 0] = len(cores.dictionary) + np.arange(len(words) - len(plain))
        stop, comma = (pc.ends_with(plain, mark).to_numpy(zero_copy_only=False) for mark in (".", ","))
        entry[here, 1] -= 2 * stop + comma
        sizes = each[entry].ravel()
        ends = np.cumsum(sizes)
        flat = pool[np.repeat(starts[entry].ravel() - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        return flat, sizes.reshape(-1, 2).sum(axis=1)

    def _others(self, words: list[str]) -> list[list[int]]:
        plain = [_plain(word) for word in words]
        cores = list({core for core, _ in plain})
        apart = [core for core in cores if core and BETWEEN not in core]
        found = dict(zip(apart, self._apart(apart)))
        rest = [core for core in cores if core not in found]
        found |= zip(rest, self._encoded(rest))
        return [found[core] + self.marks[mark] for core, mark in plain]

    def _encoded(self, texts: list[str]):
        """Ids of each text; the tokenizer's results are much larger and kept for some texts at a time."""
        for first in range(0, len(texts), AT_ONCE):
            for found in self.tokenizer.encode_batch_fast(texts[first : first + AT_ONCE], add_special_tokens=False):
                yield found.ids

    def _apart(self, cores: list[str]) -> list[list[int]]:
        """Ids of words without :data:`BETWEEN`, many in one text with it between them."""
        texts = ["".join(f"{core} {BETWEEN} " for core in cores[i : i + TOGETHER]) for i in range(0, len(cores), TOGETHER)]
        flat = np.fromiter(itertools.chain.from_iterable(self._encoded(texts)), np.int32)
        ends = np.flatnonzero(flat == self.between[0]) if len(self.between) == 1 else []
        if len(ends) != len(cores):
            return list(self._encoded(cores))
        ends, flat = ends.tolist(), flat.tolist()
        return [flat[a + 1 : b] for a, b in zip([-1, *ends], ends)]

    def _of_letters(self, cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, many in one text: each word ends with the only id of it that ends a word."""
        texts = [" ".join(cores[i : i + TOGETHER]) for i in range(0, len(cores), TOGETHER)]
        flat = np.fromiter(itertools.chain.from_iterable(self._encoded(texts)), np.int32)
        ends = np.flatnonzero(self.ends_word[flat]) + 1
        return (flat, np.diff(ends, prepend=0)) if len(ends) == len(cores) else ragged(list(self._encoded(cores)))


def _plain(chunk: str) -> tuple[str, str]:
    """A chunk without a stop or comma after its last letter, in lower case if it is all ASCII letters.

    The tokenizer lower-cases and parts letters from marks by itself, so the ids stay the same.
    """
    mark = chunk[-1:] if chunk[-1:] in (".", ",") and chunk[-2:-1].isalpha() else ""
    core = chunk[:-1] if mark else chunk
    return core.lower() if core.isascii() and core.isalpha() else core, mark


def token_rows(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """First pass: the ids of each document and where they begin within its input partition.

    ``doc_id``, ``part``, ``local`` (tokens before it in the partition), ``doc_tokens`` and ``ids``, packed
    as unsigned numbers of 16 bits where all ids fit, else of 32, told by ``wide``.
    """
    def encode(batches):
        part, local = TaskContext.get().partitionId(), 0
        words = WordIds.of_worker(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets, BLOCK):
                ids, places = words.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ids, places = np.insert(ids, places[1:], end_id), places + np.arange(b - a + 1)
                wide = np.maximum.reduceat(ids, places[:-1]) >= 1 << 16
                short, long = ids.astype("<u2").tobytes(), ids.astype("<u4").tobytes() if wide.any() else b""
                cuts = zip(wide.tolist(), places[:-1].tolist(), places[1:].tolist())
                rows = [long[4 * x : 4 * y] if w else short[2 * x : 2 * y] for w, x, y in cuts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(local + places[:-1]), pa.array(np.diff(places)), pa.array(wide), pa.array(rows, pa.binary())],
                    names=["doc_id", "part", "local", "doc_tokens", "wide", "ids"],
                )
                local += int(places[-1])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(returning_memory(encode), "doc_id long, part int, local long, doc_tokens long, wide boolean, ids binary")


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens, without any padding but in the last.

    Pass one stages the ids with running totals inside each input partition. Totals of the partitions
    (one row each) give their global offsets; pass two cuts each document where its span crosses a
    multiple of ``length``. No text and no id is shuffled; the order is that of the input's splits.

    Columns: ``doc_id``, ``start`` (ids of the document before the piece), ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids`` (array<int>). A null or empty text is the end
    id alone; null and repeated doc_ids are documents like others; extra columns are not carried; an
    empty table gives no pieces.
    """
    staged = stage(token_rows(docs, path or tokenizer_path(), end_id), "pack-ids")
    totals = staged.groupBy("part").agg(F.sum("doc_tokens").alias("_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per input partition, so one task can number them.
    totals = stage(totals.select("part", F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)).alias("_before")), "pack-parts")
    placed = staged.join(maybe_broadcast(totals, totals.count()), "part").select(
        "doc_id", (F.col("_before") + F.col("local")).alias("place"), "wide", "ids"
    )

    def cut(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                some = batch.slice(first, 500)
                out = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
                for doc, place, wide, packed in zip(*[some.column(i).to_pylist() for i in range(4)]):
                    ids = np.frombuffer(packed, "<u4" if wide else "<u2").astype("<u4")
                    start = 0
                    while start < len(ids):
                        sequence, offset = divmod(place + start, length)
                        piece = ids[start : start + length - offset]
                        for name, value in zip(out, (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), sequence, offset, piece.astype(np.int32))):
                            out[name].append(value)
                        start += len(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.list_(pa.int32()) if k == "ids" else pa.int64()) for k, v in out.items()], names=list(out)
                )

    return placed.mapInArrow(returning_memory(cut), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>")


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``doc_ids`` and ``ids`` of each sequence; a group holds one sequence's tokens."""
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("_rows"))
    return rows.select("sequence_id", F.col("_rows.doc_id").alias("doc_ids"), F.flatten(F.col("_rows.ids")).alias("ids"))
