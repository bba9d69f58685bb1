import hashlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from pressloom.llm import pieces
from pressloom.llm.queries import registry
from pressloom.llm.words import text_bytes

ODD = ["", " ", "   ", "  a  b ", "▁x▁", "▁▁", "\x00a\x01", "\U0001f600 ok\n\n\tß", "a" * 5000, "é" * 300, "ﬁ　Ａb  c  ", "　　", "Ⅷ ㍿ é x​y", "ｶﾞ ̈́", " a  \r\n b", "¨ x", " ¨ ¨x¨", "<s> </s> <unk> <0x41>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def test_whole_table_against_the_library(spark, small_dir, documents, library):
    got = {r["doc_id"]: r for r in registry()["op12_sentence_pieces"](spark, small_dir).collect()}
    for row in documents.collect():
        ids = library.encode(row["text"] or "")
        found = got.pop(row["doc_id"])
        assert found["n_tokens"] == len(ids)
        assert found["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert not got


def test_spans_of_pieces_equal_the_library_and_tile_the_text(documents, library):
    texts = [r["text"] or "" for r in documents.limit(40).collect()] + ODD
    model = pieces.Pieces(pieces.model_path(), kept=50)
    for _ in range(2):
        ids, places, begins, ends = model.encode(*text_bytes(pa.array(texts)))
        for i, text in enumerate(texts):
            mine = slice(places[i], places[i + 1])
            known = library.encode(text, return_type="proto").pieces
            assert ids[mine].tolist() == [p.id for p in known]
            assert list(zip(begins[mine].tolist(), ends[mine].tolist())) == [(p.begin, p.end) for p in known]
            if text:
                assert begins[mine][0] == 0 and ends[mine][-1] == len(text.encode()) and (begins[mine][1:] == ends[mine][:-1]).all()


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_longest_prefixes_of_the_compiled_map(documents, rule, squeeze, prefix):
    known = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze, escape_whitespaces=True)
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(known.serialized_model_proto())
    texts = [r["text"] or "" for r in documents.limit(20).collect()] + [t for t in ODD if t.strip("▁")]
    out, at, source, ends = pieces.Normalizer(model.normalizer_spec)(*text_bytes(pa.array(texts)))
    for i, text in enumerate(texts):
        normal, offsets = known.normalize(text, with_offsets=True)
        mine = out[at[i] : at[i + 1]]
        assert mine.tobytes().decode() == normal
        if len(text) < 2000:
            heads = source[at[i] : at[i + 1]][(mine & 0xC0) != 0x80]
            assert [len(text.encode()[:x].decode()) for x in [*heads, ends[i]]] == list(offsets)


def test_awkward_rows(awkward, awkward_rows, empty, library):
    found = pieces.encode(awkward).collect()
    assert len(found) == len(awkward_rows)
    for (doc_id, text, *_), row in zip(awkward_rows, found):
        assert row["doc_id"] == doc_id and row["ids"] == library.encode(text or "") and row["decoded"] == library.decode(row["ids"])
    assert pieces.encode(empty).count() == 0


def test_decoding_any_ids(spark, library):
    lists = [None, [], [0, 1, 2], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9, 261], [3 + 0xFF, 262, 3 + 0xE2, 3 + 0x96]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "n int, ids array<int>").selectExpr("*", "'old' AS decoded")
    got = {r["n"]: r["decoded"] for r in pieces.decode(rows).collect()}
    assert got == {i: None if x is None else library.decode(x) for i, x in enumerate(lists)}


def test_models_with_other_rules_are_refused(tmp_path):
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.model_path(), "rb") as file:
        model.ParseFromString(file.read())
    model.pieces[300].type = 4
    (tmp_path / "odd.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.Pieces(str(tmp_path / "odd.model"))


def test_models_with_another_map_encode_as_the_library(tmp_path):
    """The same pieces behind a map that changes letters, spaces and lengths."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.model_path(), "rb") as file:
        model.ParseFromString(file.read())
    other = sentencepiece_model_pb2.ModelProto()
    other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    model.normalizer_spec.precompiled_charsmap = other.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "mapped.model").write_bytes(model.SerializeToString())
    known = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "mapped.model"))
    texts = [t for t in ODD if t.strip("▁")]
    ids, places, begins, ends = pieces.Pieces(str(tmp_path / "mapped.model")).encode(*text_bytes(pa.array(texts)))
    for i, text in enumerate(texts):
        found = known.encode(text, return_type="proto").pieces
        assert ids[places[i] : places[i + 1]].tolist() == [p.id for p in found]
        assert list(zip(begins[places[i] : places[i + 1]].tolist(), ends[places[i] : places[i + 1]].tolist())) == [(p.begin, p.end) for p in found]
    assert np.all(ends >= begins)
