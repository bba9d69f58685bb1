"""SentencePiece ids of texts with the bytes of the text that each piece stands for, and texts from ids."""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pressloom.llm.common import returning_memory
from pressloom.llm.lookup import ChunkIds, ragged
from pressloom.llm.words import chunks, text_bytes

#: Bytes of text handled at a time.
BLOCK = 2 << 20
#: The sign that stands for a space within pieces, in UTF-8.
SPACE_SIGN = np.frombuffer("▁".encode(), np.uint8)
_SPACE = 32


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _signs(text: np.ndarray) -> np.ndarray:
    """Where the space sign begins."""
    a, b, c = SPACE_SIGN
    return np.flatnonzero((text[:-2] == a) & (text[1:-1] == b) & (text[2:] == c))


class CharacterMap:
    """A compiled character map: a double-array trie of byte strings and the strings they turn into.

    The blob begins with the trie's size in bytes; a unit of the trie is 32 bits (label, offset, a flag for
    "a string ends here"); the strings follow, each closed by a zero byte.
    """

    def __init__(self, blob: bytes):
        size = int(np.frombuffer(blob[:4], "<u4")[0])
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4")
        self.pool = np.frombuffer(blob[4 + size :], np.uint8)
        zeros = np.flatnonzero(self.pool == 0)
        self.ends = zeros if len(zeros) else np.array([len(self.pool)])

    def longest(self, data: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of the longest string of the map at each place (0 if none, not past the limit), and its replacement's place.

        All places walk down the trie together, one byte a step; few are left after the first steps.
        """
        length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        root = self._offset(self.units[:1])[0]
        alive, node, depth = np.arange(len(starts)), np.full(len(starts), root, np.int64), 0
        while True:
            inside = starts[alive] + depth < limits[alive]
            alive, node = alive[inside], node[inside]
            if not len(alive):
                return length, value
            byte = data[starts[alive] + depth].astype(np.int64)
            node = node ^ byte
            known = node < len(self.units)
            unit = self.units[np.where(known, node, 0)].astype(np.int64)
            hit = known & ((unit & 0x800000FF) == byte)
            alive, node, unit = alive[hit], node[hit], unit[hit]
            node = node ^ self._offset(unit)
            depth += 1
            leaf = (unit >> 8) & 1 == 1
            length[alive[leaf]] = depth
            value[alive[leaf]] = self.units[node[leaf]].astype(np.int64) & 0x7FFFFFFF

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        unit = unit.astype(np.int64)
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def sizes(self, values: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.ends, values)] - values


class Normalizer:
    """Texts as the model sees them, and for each byte of them the place in the text it comes from."""

    def __init__(self, spec):
        if not spec.escape_whitespaces:
            raise ValueError("models that keep spaces as they are can't be read")
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """Bytes of all texts in a row, the n + 1 places where texts begin in them, the source of each byte
        (bytes of its own text before the character or string it comes from) and where each text's last source ends.
        """
        n = len(offsets) - 1
        begin = np.flatnonzero((data & 0xC0) != 0x80)
        used = np.diff(np.append(begin, len(data)))
        out, owner = data, np.searchsorted(offsets, begin, side="right") - 1
        width = used
        if self.map is not None:
            out, begin, used, width, owner = self._replaced(data, offsets, begin, used, owner)
        source = np.repeat((begin - offsets[owner]).astype(np.int32), width)
        ends = offsets[1:] - offsets[:-1]
        at = np.zeros(n + 1, np.int64)
        np.cumsum(np.bincount(owner, weights=width, minlength=n).astype(np.int64), out=at[1:])
        if self.squeeze:
            out, source, at, ends = self._squeezed(out, source, at, ends, width, owner)
        return self._escaped(out, source, at) + (ends,)

    def _replaced(self, data, offsets, begin, used, owner):
        length, value = self.map.longest(data, begin, offsets[1:][owner])
        taken, until = np.ones(len(begin), bool), 0
        for i in np.flatnonzero(length > used):
            if begin[i] >= until:
                until = begin[i] + length[i]
                taken[i + 1 : np.searchsorted(begin, until)] = False
        begin, owner, length, value = begin[taken], owner[taken], length[taken], value[taken]
        mapped = length > 0
        used = np.where(mapped, length, used[taken])
        width = np.where(mapped, self.map.sizes(value), used)
        first = np.where(mapped, len(data) + value, begin)
        both = np.concatenate([data, self.map.pool])
        ends = np.cumsum(width)
        return both[np.repeat(first - (ends - width), width) + np.arange(int(width.sum()))], begin, used, width, owner

    def _squeezed(self, out, source, at, ends, width, owner):
        """Without spaces at the start and end of a text and after another space."""
        some = width > 0
        seg_at = (np.cumsum(width) - width)[some]
        seg_len, seg_text = width[some], owner[some]
        blank = out == _SPACE
        before = np.concatenate([[True], blank[seg_at[1:] - 1] | (seg_text[1:] != seg_text[:-1])])[: len(seg_at)]
        # Spaces that lead a replaced string go if what stands before it ends in a space.
        other = np.flatnonzero(~blank)
        next_other = other[np.minimum(np.searchsorted(other, seg_at), len(other) - 1)] if len(other) else seg_at
        next_other = np.where(next_other >= seg_at, next_other, len(out)) if len(other) else np.full(len(seg_at), len(out))
        run = np.where(before, np.minimum(next_other - seg_at, seg_len), 0)
        mark = np.zeros(len(out) + 1, np.int64)
        np.add.at(mark, seg_at, 1)
        np.add.at(mark, seg_at + run, -1)
        keep = np.cumsum(mark[:-1]) == 0
        # Then what is left of blanks at the end; its source no longer counts.
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        last = np.full(len(at) - 1, -1, np.int64)
        sign = np.zeros(len(out), bool)
        starts = _signs(out)
        sign[starts] = sign[starts + 1] = sign[starts + 2] = True
        solid = np.flatnonzero(~blank & ~sign)
        np.maximum.at(last, text[solid], solid)
        tail = keep & (np.arange(len(out)) > last[text])
        first_tail = np.full(len(at) - 1, len(out), np.int64)
        np.minimum.at(first_tail, text[tail], np.flatnonzero(tail))
        ends = np.where(first_tail < len(out), np.append(source, 0)[np.minimum(first_tail, len(out))], ends)
        keep &= ~tail
        counts = np.zeros(len(at), np.int64)
        np.cumsum(np.bincount(text[keep], minlength=len(at) - 1), out=counts[1:])
        return out[keep], source[keep], counts, np.where(np.diff(counts) > 0, ends, 0)

    def _escaped(self, out, source, at):
        blank = out == _SPACE
        wide = np.ones(len(out), np.int64)
        wide[blank] = len(SPACE_SIGN)
        sizes = np.diff(at)
        extra = len(SPACE_SIGN) * (sizes > 0) if self.prefix else np.zeros(len(sizes), np.int64)
        place = np.cumsum(wide) - wide + np.repeat(np.cumsum(extra), sizes)
        total = int(wide.sum() + extra.sum())
        new, origin = np.empty(total, np.uint8), np.empty(total, np.int32)
        new[place[~blank]] = out[~blank]
        origin[place] = source
        for i, byte in enumerate(SPACE_SIGN):
            new[place[blank] + i] = byte
            origin[place[blank] + i] = source[blank]
        if self.prefix:
            filled = np.flatnonzero(sizes)
            heads = place[at[:-1][filled]] - len(SPACE_SIGN)
            for i, byte in enumerate(SPACE_SIGN):
                new[heads + i] = byte
                origin[heads + i] = source[at[:-1][filled]]
        ends = np.concatenate([[0], np.cumsum(wide)])[at]
        return new, ends + np.concatenate([[0], np.cumsum(extra)]), origin


class Pieces:
    """Encoder and decoder of one model file; the model must be a BPE model whose pieces hold spaces at their start only."""

    def __init__(self, path: str, kept: int | None = None):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        pieces = [p.piece for p in model.pieces]
        if model.trainer_spec.model_type != 2 or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models that put the space before the word can be read")
        if any(p.type == 4 for p in model.pieces) or any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("models with user-defined symbols or pieces across words can't be read")
        self.normalizer = Normalizer(model.normalizer_spec)
        # Bytes of normalized text that a piece stands for; an unknown character has its own length.
        self.lengths = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == 2), -1)
        self.decoder = SentencePieceProcessor(model_proto=model.SerializeToString())
        spec = model.normalizer_spec
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = b"", False, False
        merging = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.table = ChunkIds(lambda words: ragged(merging.encode([w.decode() for w in words.to_pylist()], num_threads=1)), *([kept] if kept else []))
        self.fallback = bool(model.trainer_spec.byte_fallback)

    @classmethod
    def of_worker(cls, path: str) -> Pieces:
        """One per Python worker, kept from task to task."""
        kept = sys.__dict__.setdefault("_pressloom_pieces", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Ids of all texts in a row, the n + 1 places where texts begin in them, and the bytes begin:end of each piece in its text."""
        text, at, source, consumed = self.normalizer(data, offsets)
        if not len(text):
            none = np.zeros(0, np.int32)
            return none, np.zeros(len(offsets), np.int64), none, none
        signs = _signs(text)
        # A chunk begins at a sign with something else before it, and at each text.
        signs = signs[np.append(True, np.diff(signs) != len(SPACE_SIGN))[: len(signs)]]
        cut = np.zeros(len(text) + 1, bool)
        cut[signs] = cut[at] = True
        cuts = np.flatnonzero(cut)
        ids, each = self.table.of(text, cuts)
        owner = np.searchsorted(at, cuts[:-1], side="right") - 1
        places = np.zeros(len(at), np.int64)
        np.cumsum(np.bincount(owner, weights=each, minlength=len(at) - 1).astype(np.int64), out=places[1:])
        lengths = self.lengths[ids]
        if not self.fallback and (ids == self.unknown).any():
            lengths = self._with_unknown(ids, lengths, each, cuts)
        begin = source[np.cumsum(lengths) - lengths]
        end = np.empty_like(begin)
        end[:-1] = begin[1:]
        filled = np.flatnonzero(np.diff(places))
        end[places[1:][filled] - 1] = consumed[filled]
        return ids, places, begin, end

    def _with_unknown(self, ids, lengths, each, cuts):
        """Unknown pieces of a chunk share what its known ones leave; only the last of a run is given bytes if there are several."""
        lengths = np.where(ids == self.unknown, 0, lengths)
        chunk = np.repeat(np.arange(len(each)), each)
        left = np.diff(cuts) - np.bincount(chunk, weights=lengths, minlength=len(each)).astype(np.int64)
        unknown = np.flatnonzero(ids == self.unknown)
        last = unknown[np.append(chunk[unknown][1:] != chunk[unknown][:-1], True)]
        lengths[last] += left[chunk[last]]
        return lengths

    def decode(self, lists: list[list[int]]) -> list[str]:
        return self.decoder.decode(lists, num_threads=1) if lists else []


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids of every whole text, where each piece comes from, and the text that the ids decode to.

    Columns: ``doc_id``, ``ids``, ``begins`` and ``ends`` (bytes of the text's UTF-8 before and after each
    piece; pieces tile the text, so of several pieces of one replaced or spelled-out character all but the last
    are empty, as is the space put before the text) and ``decoded``.

    The text is normalised by the longest strings of the model's character map, with the source of every byte;
    what begins at a space is one chunk, and each distinct chunk of a block is merged once. A null text is empty and
    has no ids; null and repeated ids are rows like others; extra columns are not carried. A text has to fit
    into a task's memory about twenty times.
    """
    path = path or model_path()
    ident = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = Pieces.of_worker(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets, BLOCK):
                ids, places, begins, ends = model.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                flat = ids.tolist()
                decoded = model.decode([flat[x:y] for x, y in zip(places[:-1].tolist(), places[1:].tolist())])
                at = pa.array(places, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (ids, begins, ends)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "begins", "ends", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(returning_memory(run), f"doc_id {ident}, ids array<int>, begins array<int>, ends array<int>, decoded string")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Add ``decoded``, the text of each row's ``ids``; null ids give null, none an empty text."""
    from pyspark.sql.types import StringType, StructField, StructType

    path = path or model_path()
    kept = [f for f in rows.schema.fields if f.name.lower() != "decoded"]
    at = [f.name for f in kept].index("ids")

    def run(batches):
        model = Pieces.of_worker(path)
        for batch in batches:
            lists = batch.column(at).to_pylist()
            texts = iter(model.decode([x for x in lists if x is not None]))
            decoded = [None if x is None else next(texts) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], names=[*batch.schema.names, "decoded"])

    return rows.select(*[f"`{f.name}`" for f in kept]).mapInArrow(returning_memory(run), StructType([*kept, StructField("decoded", StringType())]))
