import numpy as np
import pytest

from pressloom.llm import langid
from pressloom.llm.queries import registry


def test_held_out_accuracy(spark, documents, small_dir):
    langs = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = registry()["op8_identify_language"](spark, small_dir).collect()
    assert len(rows) == len(langs) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and langs[r["doc_id"]]]
    assert len(held) > 30 and sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    network = langid.Network(["a", "b", "c"], hidden=3)
    for p in network.params():
        p += rng.normal(0, 0.3, p.shape)
    codes, ys = rng.integers(0, 5, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    valid = np.ones((6, 4), np.float32)
    valid[4:, 2] = 0

    def loss():
        ahead, _ = network.ahead.run(codes, valid)
        back, _ = network.back.run(codes[::-1], valid[::-1])
        scores = np.einsum("lf,tfn->tln", network.out, np.concatenate([ahead, back[::-1]], axis=1)) + network.bias
        logs = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return -(logs[:, ys, np.arange(4)] * valid).sum() / valid.sum()

    for p, g in zip(network.params(), network.gradients(codes, valid, ys)):
        for place in zip(*[rng.integers(0, s if s < 256 else 5, 6) for s in p.shape]):
            old = p[place]
            p[place] = old + 1e-2
            up = loss()
            p[place] = old - 1e-2
            down = loss()
            p[place] = old
            assert (up - down) / 2e-2 == pytest.approx(g[place], abs=3e-3)


def test_documents_label_every_byte():
    network = langid.Network(["a", "b"], hidden=4)
    texts = [b"", b"abc", bytes(range(32, 127)) * 3]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    found = network.documents(data, offsets)
    assert found[0].sum() == 0 and found[1:].sum(axis=1) == pytest.approx([1, 1], abs=1e-5)
    for i in (1, 2):
        alone = network.documents(np.frombuffer(texts[i], np.uint8), np.array([0, len(texts[i])]))
        assert alone[0] == pytest.approx(found[i], abs=1e-5)


def test_awkward_rows(awkward, empty):
    rows = langid.identify(awkward).collect()
    assert len(rows) == 12
    assert {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (1, 2, 3, 9)} == {("und", 0.0)}
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 5} <= {"en", "de", "fr"}
    assert len({(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (6, 7)}) == 1
    assert langid.identify(empty).count() == 0


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(df).collect()] == [("und", 0.0)]
