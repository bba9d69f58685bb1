import hashlib
import random
import re

from pressloom.llm import private
from pressloom.llm.queries import registry

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base(text):
    found = []
    for number, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if valid():
                found.append((m.start(), number, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def check(row, text):
    expected = base(text or "")
    assert row["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
    assert [row[f"n_{k}"] for k in RULES] == [sum(e.startswith(k) for e in expected) for k in RULES]
    assert set(expected) <= set(row["spans"].split(",")) or not expected


def test_whole_table(spark, small_dir, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = registry()["op3_find_private"](spark, small_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        check(row, texts[row["doc_id"]])


def test_random_texts(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("0123456789  ..--@@++()abé%_\n\U0001f600") for _ in range(draw.randrange(90))) for _ in range(500)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "+1 (212) 555-2368", "999.1.1.1 0001.2.3.4", "x@y", "a@b.c.", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6"]
    for row in private.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        check(row, texts[row["doc_id"]])


def test_contexts_reveal_identifiers(spark):
    rows = [(i, f"word{i} dial +1 (212) 555-{2000 + i} today") for i in range(20)]
    rows += [(100, "please dial 415-555-{} today".format(1234)), (101, "in 2024 there were 1999 people"), (102, "dial tone 1999")]
    found = {r["doc_id"]: r["spans"] for r in private.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[100] == "phone:12:24"
    assert found[101] == "" and found[102] == ""


def test_identifiers_of_several_tokens(spark):
    rows = [(i, f"word{i} dial +1 (212) 555-{2000 + i} today") for i in range(60)]
    rows += [(60 + i, f"text{i} card {luhn_number(i)} used") for i in range(20)]
    phones = ["(017) 555-7713", "415 555 1234", "415.555.1234", "(017)555-7713", "(017) 555 77 13", "017 - 555 - 7713", "1 (212) 555-2368"]
    rows += [(100 + i, f"please dial {phone} today") for i, phone in enumerate(phones)]
    rows += [(200 + i, f'please dial "{phone}", today') for i, phone in enumerate(phones)]
    rows += [(300, "my card 4111 1111 1111 1112 used"), (301, "rows 415 555 1234 of 12 34"), (302, "dial tone 415 555 1234")]
    found = {r["doc_id"]: r["spans"] for r in private.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, phone in enumerate(phones):
        assert found[100 + i] == f"phone:12:{12 + len(phone)}", phone
        assert found[200 + i] == f"phone:13:{13 + len(phone)}", phone
    assert found[300] == "card:8:27"
    assert found[301] == found[302] == ""


def luhn_number(i):
    return next(n for n in range(4111111111110000 + 100 * i, 4111111111120000) if luhn(str(n)))


def test_runs_take_no_quadratic_time(spark):
    texts = ["1 1 " * 20_000 + "1a", "(1" * 40_000, "(1)" * 30_000, "1.-" * 30_000 + "x", "+" * 90_000, "1 2a " * 20_000, "(" + "1" * 80_000]
    assert private.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == len(texts)


def test_no_text_takes_quadratic_time(spark):
    texts = ["a" * 100_000, "1" * 60_000, "1 " * 30_000, "a@" * 20_000, "1." * 30_000, "+1-" * 20_000]
    assert private.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == len(texts)


def test_awkward_rows(awkward, empty):
    rows = private.find(awkward).collect()
    assert len(rows) == 12
    assert {r["spans"] for r in rows if r["doc_id"] in (1, 2, 3)} == {""}
    assert [r["spans"] for r in rows if r["doc_id"] == 8] == ["ip:14:21"]
    assert private.find(empty).count() == 0
