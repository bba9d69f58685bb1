import numpy as np
import pyarrow as pa

from pressloom.llm import linededup
from pressloom.llm.queries import registry
from pressloom.llm.words import Powers, text_bytes


def chunk_spans(text):
    """(first line, last line, bytes) of every chunk of one text."""
    data, offsets = text_bytes(pa.array([text]))
    _, first, last, _, _, begin, end = linededup.line_chunks(data, offsets, Powers())
    return [(int(a), int(b), data[x:y].tobytes()) for a, b, x, y in zip(first, last, begin, end)]


def brute(texts):
    """What is left of each text: (doc_id, text) with distinct ids."""
    seen = {}
    for doc_id, text in sorted(texts):
        for first, last, body in chunk_spans(text) if text else []:
            seen.setdefault(body, []).append((doc_id, first, last))
    left = {}
    for doc_id, text in texts:
        lines = (text or "").split("\n")
        gone = {i for places in seen.values() for d, a, b in places if d == doc_id and (d, a) != places[0][:2] for i in range(a, b + 1)}
        left[doc_id] = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text
    return left


def test_whole_table_against_brute_force(spark, small_dir, documents):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    expected = brute(texts)
    found = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(documents).collect()}
    assert found == expected and any(found[d] != t for d, t in texts)
    digests = registry()["op7_dedup_lines"](spark, small_dir).collect()
    assert {r["doc_id"]: r["left_chars"] for r in digests} == {d: len(t or "") for d, t in expected.items()}


def test_chunks_are_the_same_wherever_they_stand():
    passage = [f"line {i} of a passage that many documents share" for i in range(30)]
    alone = {body for _, _, body in chunk_spans("\n".join(passage))}
    moved = {body for _, _, body in chunk_spans("\n".join(["other", "lines", "before"] + passage + ["and after"]))}
    assert len(alone & moved) > 0.7 * len(alone)


def test_long_passages_go_from_all_but_one(spark):
    rng = np.random.default_rng(0)

    def own(n):
        return [" ".join(f"w{rng.integers(10**6)}" for _ in range(9)) for _ in range(n)]

    block, line = own(8), " ".join(f"shared{i}" for i in range(60))
    rows = [(i, "\n".join(own(3) + (block if i % 3 == 0 else [line] if i % 3 == 1 else []) + own(4))) for i in range(60)]
    before = dict(rows)
    found = {r["doc_id"]: r for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i]["text"] == before[i] and found[i]["removed_lines"] == 0 for i in range(2, 60, 3))
    assert [i for i in range(60) if line in found[i]["text"]] == [1]
    kept = [sum(b in found[i]["text"] for b in block) for i in range(0, 60, 3)]
    assert kept[0] == 8 and np.mean(kept[1:]) <= 4
    assert all(set(before[i].split("\n")) - set(block) - {line} <= set(found[i]["text"].split("\n")) for i in range(60))


def repeats(texts):
    """(doc_id, line) of every line in a run of two lines with words and 50 words that stands earlier, too."""
    earlier, gone = set(), set()
    for doc_id, text in sorted(texts):
        lines = text.split("\n")
        sizes = [len(line.split()) for line in lines]
        for first in range(len(lines)):
            for last in range(first + 1, len(lines)):
                if sizes[first] and sizes[last] and sum(sizes[first : last + 1]) >= 50:
                    run = tuple(lines[first : last + 1])
                    if run in earlier:
                        gone |= {(doc_id, i) for i in range(first, last + 1)}
                    earlier.add(run)
    return gone


def test_all_repeated_passages_of_few_lines_go(spark):
    """Against all whole-line repeats, not against the operator's own chunks."""
    rng = np.random.default_rng(4)

    def own(sizes):
        return [" ".join(f"w{rng.integers(10**9)}" for _ in range(n)) for n in sizes]

    passages = [own([30, 25]), own([49, 1]), own([1, 49]), own([20, 20, 15]), own([40, 10, 5]), own([5, 10, 40]), own([25, 0, 30]), own([49, 49]), own([60, 0, 0, 0, 60]), own([13, 13, 13, 13]), own([9] * 11)]
    rows, inside = [], []
    for i in range(20 * len(passages)):
        before, after = own(rng.integers(0, 15, rng.integers(0, 5))), own(rng.integers(0, 15, rng.integers(0, 5)))
        passage = passages[i % len(passages)]
        rows.append((i, "\n".join(before + passage + after)))
        inside += [(i, len(before) + n) for n in range(len(passage)) if i >= len(passages)]
    expected = repeats(rows)
    assert set(inside) <= expected
    found = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        left = [line for i, line in enumerate(text.split("\n")) if (doc_id, i) not in expected]
        # Blank lines alone may go as shorter repeats.
        assert [line for line in found[doc_id].split("\n") if line] == [line for line in left if line]


def test_awkward_rows(awkward, awkward_rows, empty):
    found = linededup.dedup_lines(awkward)
    rows = found.collect()
    assert len(rows) == 12 and set(found.columns) == set(awkward.columns) | {"removed_lines"}
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    # Rows equal in doc_id and text are alike: both are the first occurrence, the other document is not.
    assert [r["text"] for r in by_id[6]] == ["same text twice\nwith a second line"] * 2
    assert [(r["text"], r["n_chars"], r["removed_lines"], r["n_lines"]) for r in by_id[7]] == [("", 0, 2, 2)]
    assert by_id[1][0]["text"] is None and by_id[2][0]["text"] == "" and by_id[4][0]["n_chars"] == awkward_rows[4][4]
    assert linededup.dedup_lines(empty).count() == 0
