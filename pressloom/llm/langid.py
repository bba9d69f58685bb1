"""Language identification: a bidirectional gated recurrent network that labels every byte."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import returning_memory
from pressloom.llm.words import chunks, text_bytes

UNKNOWN = "und"
#: Bound of the training sample: documents of each language (a fifth more are drawn on average, twice as many
#: over all languages at most), pieces of a document, characters of a piece.
SAMPLE_DOCS, SAMPLE_PIECES, PIECE_CHARS = 400, 8, 256
#: Bytes the network reads in one go; its states begin anew at every window.
WINDOW = 64
HIDDEN = 8
_BLOCK = 2048  # windows computed side by side
_LETTER = re.compile(r"[^\W\d_]")


class Direction:
    """One gated recurrent layer. Arrays are (features, windows); gates in order update, reset, candidate."""

    def __init__(self, rng, hidden: int):
        self.table = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        self.inner = rng.normal(0, 0.5 / np.sqrt(hidden), (3 * hidden, hidden)).astype(np.float32)

    def params(self):
        return [self.table, self.inner]

    def run(self, codes, valid=None, keep=False):
        """States after each step of codes (steps, windows); where not valid the state stays zero."""
        hidden = self.inner.shape[1]
        n = codes.shape[1]
        # With these signs a gate is 1 / (1 + exp(a)) and the candidate 2 / (1 + exp(a)) - 1, its tanh.
        scale = np.repeat(np.float32([-1, -1, -2]), hidden)[:, None]
        table, inner = self.table * scale, self.inner * scale
        h = np.zeros((hidden, n), np.float32)
        states, kept = np.empty((len(codes), hidden, n), np.float32), []
        for t in range(len(codes)):
            x = np.take(table, codes[t], axis=1, mode="clip")
            a = inner @ h
            gates = x[: 2 * hidden]
            gates += a[: 2 * hidden]
            np.minimum(gates, 80, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:hidden], gates[hidden:]
            rest = a[2 * hidden :]
            if keep:
                kept.append((z, r, rest / -2, h))
            rest *= r
            rest += x[2 * hidden :]
            np.minimum(rest, 80, out=rest)
            np.exp(rest, out=rest)
            rest += 1
            np.divide(2, rest, out=rest)
            rest -= 1
            if keep:
                kept[-1] += (rest.copy(),)
            h = h - rest
            h *= z
            h += rest
            if valid is not None:
                h *= valid[t]
            states[t] = h
        return states, kept

    def back(self, codes, kept, d_states, valid):
        """Gradients of table and inner weights by backpropagation through time."""
        hidden = self.inner.shape[1]
        d_inner = np.zeros_like(self.inner)
        d_inputs = np.empty((len(codes), 3 * hidden, codes.shape[1]), np.float32)
        carry = np.zeros_like(d_states[0])
        for t in range(len(codes) - 1, -1, -1):
            z, r, raw, before, candidate = kept[t]
            dh = (d_states[t] + carry) * valid[t]
            dn = dh * (1 - z) * (1 - candidate * candidate)
            dz = dh * (before - candidate) * z * (1 - z)
            dr = dn * raw * r * (1 - r)
            d_inputs[t, :hidden], d_inputs[t, hidden : 2 * hidden], d_inputs[t, 2 * hidden :] = dz, dr, dn
            d_a = np.concatenate([dz, dr, dn * r])
            d_inner += d_a @ before.T
            carry = dh * z + self.inner.T @ d_a
        flat = codes.ravel()
        rows = d_inputs.transpose(1, 0, 2).reshape(3 * hidden, -1)
        d_table = np.stack([np.bincount(flat, weights=row, minlength=256) for row in rows]).astype(np.float32)
        return [d_table, d_inner]


class Network:
    """Two directions and a softmax over languages at every position."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.ahead, self.back = Direction(rng, hidden), Direction(rng, hidden)
        self.out = rng.normal(0, 0.1, (len(labels), 2 * hidden)).astype(np.float32)
        self.bias = np.zeros((len(labels), 1), np.float32)

    def params(self):
        return [*self.ahead.params(), *self.back.params(), self.out, self.bias]

    def probabilities(self, codes, valid=None):
        """Sums over each window's positions of the probability of every language, (windows, languages)."""
        ahead, _ = self.ahead.run(codes, valid)
        back, _ = self.back.run(codes[::-1], None if valid is None else valid[::-1])
        back = back[::-1]
        hidden = ahead.shape[1]
        left, right = np.ascontiguousarray(self.out[:, :hidden]), np.ascontiguousarray(self.out[:, hidden:])
        total = np.zeros((len(self.labels), codes.shape[1]), np.float32)
        for t in range(len(codes)):
            scores = left @ ahead[t]
            scores += right @ back[t]
            scores += self.bias
            scores -= scores.max(axis=0)
            np.exp(scores, out=scores)
            scores /= scores.sum(axis=0)
            if valid is not None:
                scores *= valid[t]
            total += scores
        return total.T

    def gradients(self, codes, valid, labels):
        ahead, kept_ahead = self.ahead.run(codes, valid, keep=True)
        back, kept_back = self.back.run(codes[::-1], valid[::-1], keep=True)
        states = np.concatenate([ahead, back[::-1]], axis=1)  # steps, features, windows
        scores = np.einsum("lf,tfn->tln", self.out, states, optimize=True) + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        probs = np.exp(scores)
        probs /= probs.sum(axis=1, keepdims=True)
        probs[:, labels, np.arange(codes.shape[1])] -= 1
        probs *= valid[:, None, :] / max(1.0, float(valid.sum()))
        d_out = np.einsum("tln,tfn->lf", probs, states, optimize=True)
        d_states = np.einsum("lf,tln->tfn", self.out, probs, optimize=True)
        hidden = ahead.shape[1]
        return [
            *self.ahead.back(codes, kept_ahead, d_states[:, :hidden], valid),
            *self.back.back(codes[::-1], kept_back, d_states[::-1, hidden:], valid[::-1]),
            d_out,
            probs.sum(axis=(0, 2))[:, None],
        ]

    def fit(self, pieces: list[bytes], labels: list[int], steps: int = 200, windows: int = 256, rate: float = 0.02, seed: int = 7) -> Network:
        """Adam on random windows; every language is drawn equally often."""
        rng = np.random.default_rng(seed)
        by_label = [[p for p, y in zip(pieces, labels) if y == k and p] for k in range(len(self.labels))]
        drawn = [k for k, own in enumerate(by_label) if own]
        if not drawn:
            return self
        first = [np.zeros_like(p) for p in self.params()]
        second = [np.zeros_like(p) for p in self.params()]
        for step in range(1, steps + 1):
            ys = np.array([drawn[i % len(drawn)] for i in range(windows)])
            codes, valid = np.zeros((WINDOW, windows), np.uint8), np.zeros((WINDOW, windows), np.float32)
            for i, y in enumerate(ys):
                piece = by_label[y][rng.integers(len(by_label[y]))]
                at = int(rng.integers(max(1, len(piece) - WINDOW + 1)))
                part = np.frombuffer(piece[at : at + WINDOW], np.uint8)
                codes[: len(part), i], valid[: len(part), i] = part, 1
            pace = rate * min(1.0, step / 20) * (0.05 + 0.95 * (1 - step / steps))
            for p, g, m, v in zip(self.params(), self.gradients(codes, valid, ys), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probability of each language over all bytes of each text; (texts, languages)."""
        sizes = np.diff(offsets)
        counts = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(sizes)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = offsets[:-1][owner] + WINDOW * number
        lengths = np.minimum(WINDOW, offsets[1:][owner] - starts)
        sums = np.zeros((len(sizes), len(self.labels)))
        order = np.argsort(lengths != WINDOW, kind="stable")
        for at in range(0, len(order), _BLOCK):
            some = order[at : at + _BLOCK]
            steps = np.arange(WINDOW)[:, None]
            places = starts[some] + steps
            if (lengths[some] == WINDOW).all():
                codes, valid = data[places], None
            else:
                valid = (steps < lengths[some]).astype(np.float32)
                codes = data[np.minimum(places, len(data) - 1)] * (valid > 0)
            np.add.at(sums, owner[some], self.probabilities(codes, valid))
        return sums / np.maximum(sizes, 1)[:, None]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_sample(labelled: DataFrame, docs_per_lang: int = SAMPLE_DOCS) -> tuple[list[str], list[bytes], list[int]]:
    """Pieces at hashed places of about ``docs_per_lang`` hashed documents of each language.

    What reaches the driver is bounded: languages x documents x pieces x characters of a piece.
    """
    known = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", "text")
    counts = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(counts)
    if not labels:
        return [], [], []
    rates = F.create_map(*[x for lang in labels for x in (F.lit(lang), F.lit(min(1.0, 1.2 * docs_per_lang / counts[lang])))])
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 30))
    span = F.greatest(F.length("text") - PIECE_CHARS, F.lit(0)) + 1
    pieces = F.transform(
        F.sequence(F.lit(1), F.lit(SAMPLE_PIECES)),
        lambda i: F.substr("text", (1 + F.pmod(F.xxhash64("doc_id", i), span)).cast("int"), F.lit(PIECE_CHARS)),
    )
    chosen = known.where(draw < rates[F.col("lang")] * (1 << 30)).select("lang", draw.alias("draw"), pieces.alias("pieces"))
    rows = chosen.orderBy("draw", "lang").limit(2 * docs_per_lang * len(labels)).collect()
    flat = [(piece.encode(), labels.index(row["lang"])) for row in rows for piece in row["pieces"]]
    return labels, [p for p, _ in flat], [y for _, y in flat]


def train(labelled: DataFrame, docs_per_lang: int = SAMPLE_DOCS, hidden: int = HIDDEN, steps: int = 200) -> Network:
    """A network fitted on the bounded sample of ``labelled`` (doc_id, text, lang)."""
    labels, pieces, ys = training_sample(labelled, docs_per_lang)
    return Network(labels, hidden).fit(pieces, ys, steps)


def predict(docs: DataFrame, network: Network) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row, replacing columns of these names.

    Every byte of the text is labelled, in windows of 64 bytes; a document's probabilities are the means
    over its bytes, its score the largest, ties going to the first language in order. A text that is
    null, empty or has no letter is ``und`` with score 0, as is every text if no language was learned.
    """
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    kept = [f for f in docs.schema.fields if f.name.lower() not in ("lang_pred", "score")]
    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    text_at = [f.name for f in kept].index("text")

    def label(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                some = batch.slice(start, 2000)
                texts = some.column(text_at)
                data, offsets = text_bytes(texts)
                best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if network.labels and len(data):
                    found = np.concatenate(
                        [network.documents(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets, 4 << 20)]
                    )
                    top = found.argmax(axis=1)
                    for i, text in enumerate(texts.to_pylist()):
                        if text and _LETTER.search(text):
                            best[i], score[i] = network.labels[top[i]], min(1.0, found[i, top[i]])
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(best, pa.string()), pa.array(score)], names=[*some.schema.names, "lang_pred", "score"]
                )

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(returning_memory(label), schema)


def identify(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Predict all documents with a network that has learned from the folds other than ``held``.

    ``doc_id``, ``held_out``, ``lang_pred``, ``score``; see :func:`predict` for the special cases. Repeated
    rows are predicted alike; a null lang is never learned; extra columns are not carried.
    """
    held_out = fold(F.col("doc_id"), folds) == held
    network = train(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return predict(rows, network).drop("text")
