"""Personal data: exact rules as seeds, contexts learned from them, and identifiers the contexts reveal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import maybe_broadcast, stage

#: Kinds in the order of the result.
KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring, least distinct seeds (summed scores) behind a pattern, least confidence of a pattern.
ROUNDS, MIN_SUPPORT, MIN_CONFIDENCE = 3, 4.0, 0.8
#: Characters on either side in which the neighbouring word is looked for.
REACH = 64

# The rules' patterns, written so that no text takes quadratic time: a run is tried from its first
# character or from the end of the match before, and never given back.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SPACE = r"\x20\x09-\x0D"
_TOKEN = rf"(?<![^{_SPACE}])[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+"
# Groups of digits, some in round brackets, with up to three spaces, dots and hyphens between two of them.
_GROUP = r"(?:[0-9]++(?![\p{L}@_])|\([0-9]++\))"
_RUN = rf"(?<![\p{{L}}0-9@_+])\+?+{_GROUP}(?:[\x20.-]{{0,3}}+{_GROUP})++"
#: Numbers of the kinds that are candidates after the rules' matches, and digits a run may have.
TOKEN, RUN, RUN_DIGITS = len(KINDS), len(KINDS) + 1, (4, 19)


def _hits(text: Column, kind: int, pattern: str) -> Column:
    """array<struct<kind, place, gap, value, left, right>> of all matches; gap is what lies before one."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    marks = rf"[^{_SPACE}A-Za-z0-9]*" if kind == RUN else ""
    zipped = F.arrays_zip(pieces.alias("piece"), found.alias("value"), F.slice(pieces, F.lit(2), F.size(pieces)).alias("next"))

    def look(hit, place):
        return F.struct(
            F.lit(kind).alias("kind"),
            place.alias("place"),
            F.length(hit["piece"]).alias("gap"),
            hit["value"].alias("value"),
            F.lower(F.regexp_extract(F.right(hit["piece"], F.lit(REACH)), rf"([^{_SPACE}]+)[{_SPACE}]+{marks}$", 1)).alias("left"),
            F.lower(F.regexp_extract(F.left(hit["next"], F.lit(REACH)), rf"^[^{_SPACE}]*[{_SPACE}]+([^{_SPACE}]+)", 1)).alias("right"),
        )

    return F.filter(F.transform(zipped, look), lambda hit: hit["value"].isNotNull())


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    n = F.length(digits)

    def worth(i):
        digit = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + worth(i))
    return n.between(12, 19) & (total % 10 == 0)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        short = F.transform(F.split(value, r"\."), lambda part: F.regexp_replace(part, "^0+", ""))
        return F.forall(short, lambda part: (F.length(part) <= 3) & (F.concat(F.lit("0"), F.substring(part, 1, 3)).cast("int") <= 255))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _apart(marked: Column) -> Column:
    """Whether a span overlaps none of the marked ones of its row."""
    # The farthest end of a marked span that begins no later, and the next one's start.
    along = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.when(marked, F.col("end"))).over(along)
    following = F.min(F.when(marked, F.col("start"))).over(back)
    return (F.coalesce(reached, F.lit(0)) <= F.col("start")) & (F.coalesce(following, F.col("end")) >= F.col("end"))


def occurrences(rows: DataFrame) -> DataFrame:
    """``row``, ``start``, ``end``, ``kind``, ``value``, ``left``, ``right``: valid matches of the rules, and, with null
    kind, what overlaps none of them: runs of digit groups that have 4 to 19 digits, and, apart from those, tokens
    with a digit or an @, without the marks around them."""
    hits = rows.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    before = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("value")).over(before).cast("int")
    hits = hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    token, run, rule = F.col("kind") == TOKEN, F.col("kind") == RUN, F.col("kind") < len(KINDS)
    lead = F.length(F.regexp_extract("value", "^[^A-Za-z0-9+]*+", 0))
    tail = F.length(F.regexp_extract("value", "(?<![^A-Za-z0-9])[^A-Za-z0-9]*+$", 0))
    hits = hits.withColumn("lead", F.when(token, lead).otherwise(0)).withColumn("tail", F.when(token, tail).otherwise(0))
    hits = hits.withColumn("value", F.substr("value", F.col("lead") + 1, F.greatest(F.length("value") - F.col("lead") - F.col("tail"), F.lit(0))))
    hits = hits.withColumn("start", F.col("start") + F.col("lead")).withColumn("end", F.col("end") - F.col("tail"))
    valid = F.length(_digits(F.col("value"))).between(*RUN_DIGITS)
    for number, kind in enumerate(KINDS):
        valid = F.when(F.col("kind") == number, _valid(kind, F.col("value"))).otherwise(valid)
    hits = hits.where(F.when(token, F.col("end") > F.col("start")).otherwise(valid))
    hits = hits.withColumn("free", _apart(rule)).where(rule | F.col("free"))
    hits = hits.withColumn("free", _apart(run)).where(~token | F.col("free"))
    return hits.select("row", "start", "end", F.when(rule, F.col("kind")).alias("kind"), "value", "left", "right")


def _fits(kind: Column, value: Column) -> Column:
    """Whether a value could be of the kind at all: an @, or four digits."""
    return F.when(kind == 0, F.contains(value, F.lit("@"))).otherwise(F.length(_digits(value)) >= 4)


def patterns(seen: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pattern``, ``kind``, ``confidence`` of the contexts that reveal a kind.

    ``seen`` has ``pattern``, ``value`` and, for seeds, ``kind``. A pattern's confidence in a kind is the mean score
    of the distinct values it stands around, a value's score that of its best pattern; seeds score 1.
    """
    edges = stage(seen.select("pattern", "value").distinct(), "private-edges")
    seeds = stage(seen.where("kind IS NOT NULL").select("value", "kind", F.lit(1.0).alias("score")).distinct(), "private-seeds")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"))
    scores = seeds
    for round_ in range(rounds):
        support = edges.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("support")).where(F.col("support") >= MIN_SUPPORT)
        good = support.join(sizes, "pattern").withColumn("confidence", F.col("support") / F.col("values")).where(F.col("confidence") >= MIN_CONFIDENCE)
        good = stage(good.select("pattern", "kind", "confidence"), "private-patterns")
        if round_ < rounds - 1:
            found = edges.join(good, "pattern").where(_fits(F.col("kind"), F.col("value"))).groupBy("value", "kind").agg(F.max("confidence").alias("score"))
            scores = seeds.unionByName(found.join(seeds.select("value").distinct(), "value", "left_anti"))
    return good


def find(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Personal data in each text: spans by rule, and spans that learned contexts add.

    ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (rules), ``base_sha256``, ``spans`` and ``n_found``
    (added). Contexts are the word before, the word after, and both. Seeds are the rules' values; over some
    rounds patterns and values score each other; a token with a digit or @, or a run of digit groups with spaces,
    dots, hyphens and round brackets between them, that stands in a pattern of high confidence, and could be of its
    kind, is added. A run is one candidate with the words around all of it; of runs of more than 19 digits, as of
    several numbers in a row, only the tokens are candidates. Nothing the rules found is taken away and added
    spans never overlap them.

    Null text is empty: no spans, and the hash of the empty string. Every row stands for itself; repeated
    rows count their values once. Extra columns are not carried; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("body"))
    # Nothing can be found without a digit or an @; most texts stop here.
    hint = {"email": F.contains("body", F.lit("@")), "phone": F.contains("body", F.lit("+"))}
    body, digits = F.col("body"), F.col("body").rlike("[0-9]")
    none = F.expr("cast(array() as array<struct<kind:int,place:int,gap:int,value:string,left:string,right:string>>)")
    parts = [F.when(hint.get(kind, digits), _hits(body, number, PATTERNS[kind])).otherwise(none) for number, kind in enumerate(KINDS)]
    parts.append(F.when(digits | hint["email"], _hits(body, TOKEN, _TOKEN)).otherwise(none))
    parts.append(F.when(digits, _hits(body, RUN, _RUN)).otherwise(none))
    rows = stage(read.select("row", "doc_id", F.concat(*parts).alias("hits")), "private-rows")

    every = stage(occurrences(rows), "private-spans")
    seen = every
    pattern = F.array(
        F.when(F.col("left") != "", F.concat(F.lit("L "), "left")),
        F.when(F.col("right") != "", F.concat(F.lit("R "), "right")),
        F.when((F.col("left") != "") & (F.col("right") != ""), F.concat(F.lit("B "), "left", F.lit(" "), "right")),
    )
    seen = stage(seen.withColumn("pattern", F.explode(F.array_compact(pattern))).drop("left", "right"), "private-seen")
    good = patterns(seen, rounds).withColumnRenamed("kind", "found")
    added = seen.where("kind IS NULL").join(maybe_broadcast(good, good.count()), "pattern").where(_fits(F.col("found"), F.col("value")))
    best = Window.partitionBy("row", "start").orderBy(F.col("confidence").desc(), "found", "pattern")
    added = added.withColumn("place", F.row_number().over(best)).where("place = 1")
    added = added.groupBy("row").agg(F.collect_list(F.struct("start", F.col("found").alias("kind"), "end")).alias("more"))

    names = F.array(*map(F.lit, KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    base = every.where("kind IS NOT NULL").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("base"))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    result = rows.select("row", "doc_id").join(base, "row", "left").join(added, "row", "left")
    result = result.select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("more", none).alias("more"))

    def count(number):
        return F.size(F.filter("base", lambda b: b["kind"] == number)).cast("long")

    counts = [count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)]
    return result.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "more"))).alias("spans"),
        F.size("more").cast("long").alias("n_found"),
    )
