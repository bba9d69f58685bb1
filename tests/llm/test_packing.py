import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pressloom.llm import packing
from pressloom.llm.queries import registry
from pressloom.llm.words import text_bytes


def expected_ids(texts):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    return [[*e.ids, 1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(pieces, documents):
    """Pieces put together again are the ids of every document; sequences have no gaps."""
    ids = {}
    for doc_id, text in documents:
        ids.setdefault(doc_id, expected_ids([text])[0])
    parts = {}
    for p in pieces:
        assert p["ids_crc32"] == zlib.crc32(np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4").tobytes())
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
        parts.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    fills = []
    for number in sorted(parts):
        at = 0
        for offset, length in sorted(parts[number]):
            assert offset == at
            at += length
        fills.append(at)
    assert all(f == packing.LENGTH for f in fills[:-1]) and fills[-1] <= packing.LENGTH
    assert sum(fills) == sum(len(ids[d]) for d, _ in documents)


def test_whole_table(spark, small_dir, documents):
    check(registry()["op2_pack_sequences"](spark, small_dir).collect(), [(r["doc_id"], r["text"]) for r in documents.collect()])


def test_several_partitions_and_sequences(documents):
    pieces = packing.pack(documents.repartition(5), length=64)
    lengths = {r["sequence_id"]: len(r["ids"]) for r in packing.sequences(pieces).collect()}
    assert sorted(lengths) == list(range(len(lengths)))
    assert all(n == 64 for s, n in lengths.items() if s < len(lengths) - 1)
    total = sum(len(i) for i in expected_ids([r["text"] for r in documents.collect()]))
    assert sum(lengths.values()) == total


def test_awkward_rows(awkward, awkward_rows, empty):
    odd = [(d, t) for d, t, *_ in awkward_rows if d is not None]
    check(packing.pack(awkward.where("doc_id IS NOT NULL")).collect(), odd)
    assert sum(p["length"] for p in packing.pack(awkward).where("doc_id IS NULL").collect()) == sum(map(len, expected_ids([awkward_rows[3][1], None])))
    assert packing.pack(empty).count() == 0


def test_ids_by_word_equal_ids_of_the_text():
    texts = ["", " ", "It's. foo.'s ...,,a.b, <|endoftext|>. <|ENDOFTEXT|> Straße, ΣΑΣ. İstanbul 5.3, x..", "ǅ. é, É. don't, I'LL. a\tb\x1cc d", "A.B,C. ,. d,e"]
    ids, places = packing.WordIds(packing.tokenizer_path(), kept=3).encode(*text_bytes(pa.array(texts * 3)))
    assert [[*ids[a:b].tolist(), 1] for a, b in zip(places[:-1], places[1:])] == expected_ids(texts * 3)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        packing.WordIds(packing.tokenizer_path("byte_bpe_50k.json"))


def test_a_table_that_forgets(documents):
    """Ids stay the same while words come, go and come again."""
    texts = [r["text"] or "" for r in documents.limit(60).collect()]
    words = packing.WordIds(packing.tokenizer_path(), kept=100)
    for some in (texts[:20], texts[20:], texts):
        ids, places = words.encode(*text_bytes(pa.array(some)))
        assert [[*ids[a:b].tolist(), 1] for a, b in zip(places[:-1], places[1:])] == expected_ids(some)
        assert len(words.table.words) <= 100


def test_new_words_are_given_many_together(documents):
    """The tokenizer gets far fewer texts than there are new words, whatever they are made of, and each word keeps its ids."""
    odd = ["{0}-{0}x", "é{0}", "({0}", "~{0}", "a~b{0}.", "n{0}'s", "{0}\tö{0}", "<|endoftext|>{0}", "Σ{0}ς,"]
    texts = [" ".join(word.format(i) for i in range(300) for word in odd)]
    words = packing.WordIds(packing.tokenizer_path())
    given, encoded = [], words._encoded
    words._encoded = lambda texts: given.extend(texts) or encoded(texts)
    ids, _ = words.encode(*text_bytes(pa.array(texts)))
    assert [*ids.tolist(), 1] == expected_ids(texts)[0]
    alone = sum("~" in w for w in set(texts[0].split(" ")))
    assert len(given) < alone + 100


def test_words_of_ascii_letters_need_no_step_each():
    """ASCII words, marked or not, in any case, share one way through whole arrays."""
    texts = ["Word word. word, WORD, other Other. x. y, z"]
    words = packing.WordIds(packing.tokenizer_path())
    others = []
    words._others = lambda some, plain=words._others: others.extend(some) or plain(some)
    ids, _ = words.encode(*text_bytes(pa.array(texts)))
    assert [*ids.tolist(), 1] == expected_ids(texts)[0] and not others
