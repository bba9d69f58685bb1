"""Token ids of pieces of text that come again and again, looked up for whole blocks at once."""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks whose ids are kept; when there are more, the less used half goes.
KEPT = 1 << 18
#: Longer chunks are not kept.
LONGEST = 64


def ragged(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids in a row, and their lengths."""
    return np.fromiter(itertools.chain.from_iterable(lists), np.int32), np.fromiter(map(len, lists), np.int64, len(lists))


class ChunkIds:
    """Ids of chunks of bytes by ``encode``, which is asked for chunks that are not in the table only.

    ``encode`` returns the ids of all its chunks in a row and how many each chunk has.

    The table is a few flat arrays. A block's chunks are matched with it in one call, exactly, by their bytes.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], kept: int = KEPT):
        self.encode, self.kept = encode, kept
        self.words = pa.array([], pa.binary())
        self.flat, self.sizes, self.uses = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks data[cuts[i]:cuts[i+1]] in a row, and how many each chunk has."""
        n = len(cuts) - 1
        chunks = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        found = pc.index_in(chunks, value_set=self.words)
        number = found.fill_null(-1).to_numpy().astype(np.int64)
        words, flat, sizes = self.words, self.flat, self.sizes
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new = chunks.take(pa.array(missing)).dictionary_encode()
            more, each = self.encode(new.dictionary)
            number[missing] = len(words) + new.indices.to_numpy()
            flat, sizes = np.concatenate([flat, more]), np.concatenate([sizes, each])
            words = pa.concat_arrays([words, new.dictionary])
        uses = np.bincount(number, minlength=len(words))
        uses[: len(self.uses)] += self.uses
        each = sizes[number]
        ends = np.cumsum(each)
        total = int(ends[-1]) if n else 0
        starts = np.cumsum(sizes) - sizes
        ids = flat[np.repeat(starts[number] - (ends - each), each) + np.arange(total)]
        if len(missing):
            self._keep(words, flat, sizes, starts, uses)
        else:
            self.uses = uses
        return ids, each

    def _keep(self, words, flat, sizes, starts, uses) -> None:
        lengths = pc.binary_length(words).to_numpy(zero_copy_only=False)
        stay = lengths <= LONGEST
        if stay.sum() > self.kept:
            # The most used half of the places, first seen first where uses are equal.
            order = np.argsort(-uses * stay, kind="stable")[: self.kept // 2]
            stay = np.zeros(len(stay), bool)
            stay[order] = True
            stay &= lengths <= LONGEST
            uses = uses // 2
        if not stay.all():
            rows = np.flatnonzero(stay)
            words = words.take(pa.array(rows))
            kept = sizes[rows]
            ends = np.cumsum(kept)
            flat = flat[np.repeat(starts[rows] - (ends - kept), kept) + np.arange(int(kept.sum()))]
            sizes, uses = kept, uses[rows]
        self.words, self.flat, self.sizes, self.uses = words, flat, sizes, uses
