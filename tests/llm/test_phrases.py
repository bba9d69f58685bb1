import hashlib
import random

import pytest

from pressloom.llm import phrases
from pressloom.llm.queries import registry


def plain_parse(text):
    known, ends, phrase = set(), [], ""
    for i, c in enumerate(text):
        phrase += c
        if phrase not in known:
            known.add(phrase)
            ends.append(i + 1)
            phrase = ""
    return ends


def plain(text):
    return phrases.written(phrases.signature(text, plain_parse(text), phrases.Powers()))


def check(rows, texts):
    """texts: (doc_id, text) by descending doc_id."""
    found = {r["doc_id"]: r for r in rows}
    assert len(found) == len(texts)
    for i, (doc_id, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[doc_id]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (row["fingerprint"], row["edited_fingerprint"]) == (plain(text), plain(edited))
        assert row["near_edited"] == phrases.likeness(plain(text), plain(edited))
        assert row["near_next"] == phrases.likeness(plain(text), plain(after))


def test_whole_table(spark, small_dir, documents):
    texts = sorted([(r["doc_id"], r["text"] or "") for r in documents.collect()], reverse=True)
    check(registry()["op6_phrase_fingerprints"](spark, small_dir).collect(), texts)


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_few_rows_in_many_partitions(spark, n):
    draw = random.Random(n)
    texts = [(i, "".join(draw.choice("abé\U0001f600") for _ in range(draw.randrange(0, 60)))) for i in range(n)]
    check(phrases.fingerprints(spark.createDataFrame(texts, "doc_id long, text string").repartition(7)).collect(), texts[::-1])


def test_parse_from_any_state():
    draw = random.Random(5)
    for _ in range(200):
        text = "".join(draw.choice("aab") for _ in range(draw.randrange(0, 80)))
        stop = draw.randrange(0, len(text) + 1)
        known, ends = set(), []
        at = phrases.parse(text, 0, known, ends, stop)
        phrases.parse(text, at, known, ends, len(text))
        assert ends == plain_parse(text)


def test_likeness_follows_shared_text(documents):
    texts = [r["text"] for r in documents.collect() if r["text"] and len(r["text"]) > 2000][:20]
    make = phrases.Fingerprints()
    same = [phrases.likeness(make.one(t), make.one(t[: len(t) // 10] + t[len(t) // 10 + 5 :])) for t in texts]
    other = [phrases.likeness(make.one(a), make.one(b)) for a, b in zip(texts, texts[1:])]
    assert min(same) > 0.3 and sum(same) / len(same) > 2 * sum(other) / len(other)


def test_awkward_rows(awkward, empty):
    rows = phrases.fingerprints(awkward).collect()
    assert len(rows) == 12
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {""}
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (6, 7)}) == 1
    assert phrases.fingerprints(empty).count() == 0
