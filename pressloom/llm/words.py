"""Words of many texts at once, as 64-bit hashes, over Arrow's own buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes handled at a time, so that the work arrays stay in a core's cache.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: False for the ASCII white space of the contracts.
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, len(self.up) * 5 // 4, CHUNK + 1)
            step = np.full(size, _BASE, np.uint64)
            step[0] = 1
            self.up = np.cumprod(step)
            step[1:] = pow(_BASE, -1, 1 << 64)
            self.down = np.cumprod(step)
        return self.up, self.down


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the n + 1 places where they begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK):
    """Ranges of texts of about ``limit`` bytes; one longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IN_WORD):
    """Start and end of every word, and the number of words before each text (n + 1 values)."""
    inside = in_word[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hashes of codes[start:end], from one prefix sum."""
    up, down = powers.get(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers):
    """Hashes of the lower-cased words (A-Z only) and the number of words before each text."""
    starts, ends, counts = word_spans(data, offsets)
    return span_hashes(LOWER[data], starts, ends, powers), counts
