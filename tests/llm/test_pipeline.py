import collections
import os
import re

import pytest

import corpus_pipeline
from pressloom.llm.common import stage
from tests.llm.test_linededup import brute as left_lines
from tests.llm.test_neardup import brute as groups
from tests.llm.test_packing import check as check_pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, documents, small_dir):
    """Input and output of every stage, as lists of rows."""
    found, docs = [], documents
    for name, apply in corpus_pipeline.STAGES:
        made = stage(apply(spark, docs, small_dir), f"test-{name}")
        found.append((docs.collect(), made.collect(), made.columns))
        docs = made
    return found


def test_order_and_columns(results):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["identify_language", "dedup_lines", "dedup_documents", "mix_sources", "pack_sequences"]
    assert all(columns == COLUMNS for _, _, columns in results[:-1])


def test_language_stage_keeps_clean_documents(results):
    before, after, _ = results[0]
    kept = {r["doc_id"]: r for r in after}
    gone = [r for r in before if r["doc_id"] not in kept]
    assert all(r["lang"] for r in after) and not any(r["lang"] and any(c.isalpha() for c in r["text"] or "") for r in gone)
    assert all(kept[r["doc_id"]]["text"] == r["text"] for r in before if r["doc_id"] in kept)


def test_line_stage(results):
    before, after, _ = results[1]
    expected = left_lines([(r["doc_id"], r["text"]) for r in before])
    whole = {r["doc_id"]: r["text"] for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == {d: t for d, t in expected.items() if t or not whole[d]}
    assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] != whole[r["doc_id"]])


def test_document_stage(results):
    before, after, _ = results[2]
    expected = groups([(r["doc_id"], r["text"]) for r in before], 5)
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, (_, root) in expected.items() if d == root)


def test_mixing_stage(results):
    before, after, _ = results[3]
    def size(row):
        return len(re.findall(r"[^\x20\x09-\x0D]+", row["text"] or ""))

    own, mixed, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in before:
        own[r["source"]] += size(r)
        largest[r["source"]] = max(largest[r["source"]], size(r))
    for r in after:
        mixed[r["source"]] += size(r)
    times = collections.Counter(r["doc_id"] for r in after)
    assert max(times.values()) <= 3 and set(times) <= {r["doc_id"] for r in before}
    from tests.llm.test_mixing import filled

    names = sorted(own)
    for name, target in zip(names, filled([own[n] for n in names])):
        assert abs(mixed[name] - target) <= 3 * largest[name]


def test_packing_stage(results):
    before, after, _ = results[4]
    check_pieces(after, [(r["doc_id"], r["text"]) for r in before])


def test_run_gives_the_last_stage(spark, small_dir, results):
    names = ("doc_id", "start", "length", "ids_crc32")
    found = sorted(tuple(r[n] for n in names) for r in corpus_pipeline.run(spark, small_dir).collect())
    assert found == sorted(tuple(r[n] for n in names) for r in results[-1][1])


def test_awkward_and_empty_input(spark, awkward, empty, small_dir):
    for name, apply in corpus_pipeline.STAGES:
        for docs in (awkward, empty):
            made = apply(spark, docs, small_dir)
            assert name == "pack_sequences" or made.columns == docs.columns
            assert (made.count() == 0) == (docs is empty)


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in names) if m} == set(range(1, 14)) and "pipeline" in names
    assert {"op1_mix_sources", "op5_scan_licenses"} <= set(entry.oracle_sql()) <= names
    assert os.path.exists(entry.__file__)
