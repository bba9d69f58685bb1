"""A stored search index of immutable segments: a refresh writes what it changes and nothing else.

A segment numbers its documents in blocks of 64, in order of category, sentiment and time, so that a set of
documents of a block is one 64-bit number. Each kind of file lies in a folder per segment:

* ``forward``: a row per document with its place, attributes and counted terms, in folders by id; the terms of a
  field are one text, their counts one array;
* ``postings``: a row per term and block with the documents that hold the term, per field the largest count and
  the smallest length (what bounds any score in the block), and the single counts, each with slot and field in one
  number (:func:`slot_of`, :func:`field_of`, :func:`count_of`), and their fields' lengths; in folders by term;
* ``blocks``: a row per block with ids, times and the bits of every category and source;
* ``frequencies``, ``stats``: what the segment adds to the statistics, less what it takes out of older segments;
* ``dead``: the bits of documents in older segments that it replaces or deletes.

A version is a list of live segments. Readers keep the version they opened. Segments of about one size are
merged, from the forward rows and without reading texts again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.text import tokenize
from pressloom.operators.index import TERM_BUCKETS, TextIndex, field_texts, term_bucket
from pressloom.operators.select import latest_of_repeated
from pressloom.session import scratch_path, small
from pressloom.sources.files import Folder

#: Documents of a block: the bits of a long.
BLOCK_DOCS = 64
#: Folders of the forward rows, by id.
ID_SLICES = 32
#: So many segments of one tier become one of the next.
FAN = 4
#: Changed ids and blocks with dead documents up to this many rows are broadcast.
BROADCAST_IDS = 500_000

_ATTRIBUTES = ("category", "sentiment_label", "source")
_SCHEMAS = {
    "forward": "id string, block long, slot int, category string, sentiment_label string, source string, published_at timestamp, "
    "lens array<int>, words array<string>, counts array<array<int>>, segment int, slice int",
    "postings": "term string, block long, bits long, tops array<bigint>, entries array<bigint>, lens array<int>, segment int, bucket int",
    "blocks": "block long, ids array<string>, dates array<timestamp>, newest timestamp, "
    "groups array<struct<category:string,sentiment:string,bits:bigint>>, sources array<struct<source:string,bits:bigint>>, segment int",
    "frequencies": "field int, term string, df long, occurrences long, segment int, bucket int",
    "stats": "n_docs long, lengths array<bigint>, fields array<string>, buckets int, segment int",
    "dead": "target int, block long, bits long, segment int",
}


def bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), slot.cast("int"))


def slot_of(entry: Column) -> Column:
    return F.shiftrightunsigned(entry, 48).cast("int")


def field_of(entry: Column) -> Column:
    return F.shiftrightunsigned(entry, 32).cast("int").bitwiseAND(F.lit(0xFFFF))


def count_of(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def top_count(top: Column) -> Column:
    return F.shiftrightunsigned(top, 32)


def top_length(top: Column) -> Column:
    return top.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def bits_where(array: str | Column, condition, value=lambda x: x["bits"]) -> Column:
    """The bits of all items of an array that meet a condition, as one number."""
    none = F.lit(0).cast("long")
    return F.aggregate(array, none, lambda bits, x: bits.bitwiseOR(F.when(condition(x), value(x)).otherwise(none)))


@dataclass(frozen=True)
class SegmentIndex:
    """One version of a stored index."""

    spark: SparkSession
    path: str
    version: int
    segments: tuple[int, ...]
    fields: tuple[str, ...]
    buckets: int

    def read(self, kind: str, segments: tuple[int, ...] | None = None) -> DataFrame:
        """Rows of some segments; the folders of others are not opened."""
        names = self.segments if segments is None else segments
        reader = self.spark.read.schema(_SCHEMAS[kind]).option("basePath", f"{self.path}/{kind}")
        if not names:
            return self.spark.createDataFrame([], _SCHEMAS[kind])
        return reader.parquet(*[f"{self.path}/{kind}/segment={number}" for number in names])

    def dead(self) -> DataFrame:
        """``segment, block, dead``: the bits that no longer count."""
        rows = self.read("dead").where(F.col("target").isin(list(self.segments)))
        return rows.groupBy(F.col("target").alias("segment"), "block").agg(F.bit_or("bits").alias("dead"))

    def _live(self, rows: DataFrame) -> DataFrame:
        """Add ``dead`` to rows of (segment, block)."""
        dead = self.dead()
        side = F.broadcast(dead) if small(dead, BROADCAST_IDS) else dead
        return rows.join(side, ["segment", "block"], "left").withColumn("dead", F.coalesce("dead", F.lit(0).cast("long")))

    def forward(self, segments: tuple[int, ...] | None = None) -> DataFrame:
        """Forward rows of the documents that count."""
        return self._live(self.read("forward", segments)).where(F.col("dead").bitwiseAND(bit(F.col("slot"))) == 0).drop("dead")

    def blocks(self) -> DataFrame:
        return self._live(self.read("blocks"))

    def postings(self) -> DataFrame:
        return self.read("postings")

    def frequencies(self) -> DataFrame:
        """``field, term, df, occurrences`` over the documents that count."""
        rows = self.read("frequencies").groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("occurrences").alias("occurrences"))
        return rows.where(F.col("df") > 0).withColumn("field", self._name())

    def stats(self) -> DataFrame:
        """``field, n_docs, avg_len`` of every field with any term."""
        rows = self.read("stats").agg(
            F.sum("n_docs").alias("n_docs"), *[F.sum(F.col("lengths")[i]).alias(name) for i, name in enumerate(self.fields)]
        )
        fields = F.array(*[F.struct(F.lit(name).alias("field"), F.col(name).alias("length")) for name in self.fields])
        return rows.select("n_docs", F.inline(fields)).where(F.col("length") > 0).select(
            "field", "n_docs", (F.col("length") / F.col("n_docs")).alias("avg_len")
        )

    def _name(self) -> Column:
        return F.element_at(F.array(*map(F.lit, self.fields)), F.col("field") + 1)

    def text_index(self) -> TextIndex:
        """The same index as single postings, for scoring that reads every match."""
        entry = F.col("entry")
        live = self._live(self.postings().select("segment", "bucket", "term", "block", "lens", F.posexplode("entries").alias("nth", "entry")))
        live = live.withColumn("len", F.get("lens", F.col("nth"))).select("*", slot_of(entry).alias("slot"), field_of(entry).alias("field"), count_of(entry).cast("int").alias("tf"))
        live = live.where(F.col("dead").bitwiseAND(bit(F.col("slot"))) == 0)
        named = live.join(self.read("blocks").select("segment", "block", "ids"), ["segment", "block"])
        postings = named.select(F.get("ids", F.col("slot")).alias("id"), self._name().alias("field"), "term", "tf", "len", "bucket")
        return TextIndex(postings, self.frequencies(), self.stats(), self.buckets)


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    if not Folder(spark, f"{path}/versions").exists():
        return None
    return spark.read.schema("segment int, docs long, version int").parquet(f"{path}/versions")


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[int, int]]:
    """Number and live segments of a version, the last one by default; one small row per segment."""
    rows = _versions(spark, path)
    if rows is None:
        return 0, {}
    wanted = rows.agg(F.max("version").alias("v")).first()["v"] if version is None else version
    if wanted is None:
        return 0, {}
    listed = {row["segment"]: row["docs"] for row in rows.where(F.col("version") == wanted).collect()}
    return wanted, {number: docs for number, docs in listed.items() if number}


def _commit(spark: SparkSession, path: str, version: int, listed: Mapping[int, int]) -> None:
    """Write a new version; of two writers that start from one version the second fails.

    The row of segment 0 keeps an empty list apart from a missing one.
    """
    rows = spark.createDataFrame([(0, 0), *sorted(listed.items())], "segment int, docs long").coalesce(1)
    rows.write.mode("errorifexists").parquet(f"{path}/versions/version={version}")


def open_index(spark: SparkSession, path: str, version: int | None = None) -> SegmentIndex:
    """A version of the index; what later refreshes write does not show in it."""
    number, listed = _manifest(spark, path, version)
    segments = tuple(sorted(listed))
    index = SegmentIndex(spark, path, number, segments, (), TERM_BUCKETS)
    row = index.read("stats").select("fields", "buckets").first()
    return SegmentIndex(spark, path, number, segments, tuple(row["fields"]) if row else (), row["buckets"] if row else TERM_BUCKETS)


def _next_segment(spark: SparkSession, path: str) -> int:
    rows = _versions(spark, path)
    return 1 if rows is None else 1 + (rows.agg(F.max("segment").alias("n")).first()["n"] or 0)


def searched_texts(docs: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """``id``, attributes and the texts of the fields."""
    return docs.select("id", *_ATTRIBUTES, "published_at", F.array(*fields.values()).alias("texts"))


def count_terms(rows: DataFrame, n_fields: int) -> DataFrame:
    """In place of ``texts``: ``lens`` (tokens per field), ``words`` (the distinct ones, sorted, as one text per field)
    and ``counts``, all made within the row."""
    none = F.array().cast("array<string>")
    kept = [c for c in rows.columns if c != "texts"]
    names = [f"_tokens{i}" for i in range(n_fields)]
    rows = rows.select(*kept, *[F.sort_array(F.coalesce(tokenize(F.col("texts")[i]), none)).alias(name) for i, name in enumerate(names)])

    def starts(name):
        places = F.when(F.size(name) > 0, F.sequence(F.lit(0), F.size(name) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda i: (i == 0) | (F.get(name, i) != F.get(name, i - 1)))

    rows = rows.select("*", *[starts(name).alias(f"_starts{i}") for i, name in enumerate(names)])

    def counted(i):
        first = f"_starts{i}"
        return F.transform(first, lambda start, nth: F.coalesce(F.get(first, nth + 1), F.size(names[i])) - start)

    return rows.select(
        *kept, F.array(*[F.size(name) for name in names]).alias("lens"),
        F.array(*[F.array_join(F.array_distinct(name), " ") for name in names]).alias("words"),
        F.array(*[counted(i) for i in range(n_fields)]).alias("counts"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Give stored counted documents their blocks and slots. The numbers hold for one write: what else needs them reads what that stored."""
    order = ["category", "sentiment_label", "published_at", "id"]
    place = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    return dealt.select(
        "*", F.floor(F.col("_place") / BLOCK_DOCS).alias("block"), F.pmod("_place", F.lit(BLOCK_DOCS)).cast("int").alias("slot")
    ).drop("_place")


def _folders(df: DataFrame, path: str, column: str, *order: str) -> None:
    """A file per task and folder: the tasks come from a shuffle, so files have a share of its partition size however much there is."""
    df.sortWithinPartitions(column, *order).write.partitionBy(column).option("compression", "zstd").parquet(path)


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _slice(ident: Column) -> Column:
    return F.pmod(F.xxhash64(ident), F.lit(ID_SLICES)).cast("int")


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by block, cut so that no block is in two tables; a block has 64 rows at most."""
    left = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if left is None else pa.concat_tables([left, table])
        left = None
        if not table.num_rows:
            continue
        blocks = table.column("block").to_numpy()
        cut = int(np.searchsorted(blocks, blocks[-1]))
        left = table.slice(cut)
        if cut:
            yield table.slice(0, cut)
    if left is not None and left.num_rows:
        yield left


def inverted(n_fields: int):
    """Batch function from documents sorted by (block, slot) to rows of (term, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            columns = {name: table.column(name).combine_chunks() for name in ("lens", "words", "counts")}
            lens = columns["lens"].flatten().to_numpy().astype(np.int64)
            texts, counts = columns["words"].flatten(), columns["counts"].flatten()
            used = np.flatnonzero(lens)
            if not len(used):
                continue
            terms = pc.split_pattern(texts.take(pa.array(used)), " ")
            # Each number tells a document and a field; from here on there is one per posting.
            pair = np.repeat(used, pc.list_value_length(terms).to_numpy())
            code = terms.flatten().dictionary_encode()
            known, code = code.dictionary, code.indices.to_numpy().astype(np.int64)
            tf = counts.flatten().to_numpy().astype(np.int64)
            blocks, nth = np.unique(table.column("block").to_numpy(), return_inverse=True)
            order = np.argsort(nth[pair // n_fields] * len(known) + code, kind="stable")
            pair, code, tf = pair[order], code[order], tf[order]
            slot, field, length = table.column("slot").to_numpy()[pair // n_fields].astype(np.int64), pair % n_fields, lens[pair]
            place = nth[pair // n_fields]
            first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (code[1:] != code[:-1])])
            most = [np.maximum.reduceat(np.where(field == i, tf, 0), first) for i in range(n_fields)]
            least = [np.minimum.reduceat(np.where(field == i, length, np.iinfo(np.int32).max), first) for i in range(n_fields)]
            tops = np.stack([(m << 32) | x for m, x in zip(most, least)], axis=1).ravel()
            absent = np.stack([m == 0 for m in most], axis=1).ravel()
            ends = np.r_[first, len(code)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    known.take(pa.array(code[first])),
                    pa.array(blocks[place[first]], pa.int64()),
                    pa.array(np.bitwise_or.reduceat(np.left_shift(np.int64(1), slot), first), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * n_fields), pa.array(tops, pa.int64(), mask=absent)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array((slot << 48) | (field << 32) | tf, pa.int64())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(length, pa.int32())),
                ],
                ["term", "block", "bits", "tops", "entries", "lens"],
            )

    return run


def _write_documents(index: SegmentIndex, number: int, docs: DataFrame) -> DataFrame:
    """Forward rows, postings and blocks of counted documents that have their places; the stored forward rows."""
    columns = ["id", "block", "slot", *_ATTRIBUTES, "published_at", "lens", "words", "counts"]
    _folders(docs.select(*columns, _slice(F.col("id")).alias("slice")), f"{index.path}/forward/segment={number}", "slice", "id")
    docs = index.read("forward", (number,))
    rows = docs.select("block", "slot", "lens", "words", "counts").repartition("block").sortWithinPartitions("block", "slot")
    rows = rows.mapInArrow(inverted(len(index.fields)), "term string, block long, bits long, tops array<bigint>, entries array<bigint>, lens array<int>")
    _folders(rows.withColumn("bucket", term_bucket(F.col("term"), index.buckets)), f"{index.path}/postings/segment={number}", "bucket", "term", "block")
    listed = docs.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("slot", "id", "published_at", "category", "sentiment_label", "source"))).alias("docs")
    )
    pairs = F.array_distinct(F.transform("docs", lambda d: F.struct(d.category.alias("category"), d.sentiment_label.alias("sentiment"))))
    sources = F.array_distinct(F.transform("docs", lambda d: d.source))

    def group(pair):
        same = lambda d: d.category.eqNullSafe(pair.category) & d.sentiment_label.eqNullSafe(pair.sentiment)
        return F.struct(pair.category.alias("category"), pair.sentiment.alias("sentiment"), bits_where("docs", same, lambda d: bit(d.slot)).alias("bits"))

    def source(name):
        return F.struct(name.alias("source"), bits_where("docs", lambda d: d.source.eqNullSafe(name), lambda d: bit(d.slot)).alias("bits"))

    listed.select(
        "block", F.transform("docs", lambda d: d.id).alias("ids"), F.transform("docs", lambda d: d.published_at).alias("dates"),
        F.array_max(F.transform("docs", lambda d: d.published_at)).alias("newest"),
        F.transform(pairs, group).alias("groups"), F.transform(sources, source).alias("sources"),
    ).write.parquet(f"{index.path}/blocks/segment={number}")
    return docs


def _write_statistics(index: SegmentIndex, number: int, frequencies: DataFrame, totals: DataFrame, dead: DataFrame) -> int:
    """What the segment adds to and takes from the statistics, and its dead bits."""
    # A term meets once with all its fields.
    of_field = [F.col("field") == i for i in range(len(index.fields))]
    sums = [
        F.struct(F.lit(i).alias("field"), F.sum(F.when(own, F.col("df"))).alias("df"), F.sum(F.when(own, F.col("occurrences"))).alias("occurrences"))
        for i, own in enumerate(of_field)
    ]
    summed = frequencies.groupBy("term").agg(F.array(*sums).alias("sums")).select("term", F.inline("sums"))
    summed = summed.where((F.col("df") != 0) | (F.col("occurrences") != 0)).withColumn("bucket", term_bucket(F.col("term"), index.buckets))
    _folders(summed.select("field", "term", "df", "occurrences", "bucket"), f"{index.path}/frequencies/segment={number}", "bucket", "term")
    lengths = [F.coalesce(F.sum(F.col("lengths")[i]), F.lit(0)) for i in range(len(index.fields))]
    row = totals.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.array(*lengths).alias("lengths"))
    row.select(
        "n_docs", "lengths", F.array(*map(F.lit, index.fields)).alias("fields"), F.lit(index.buckets).alias("buckets")
    ).write.parquet(f"{index.path}/stats/segment={number}")
    dead.groupBy("target", "block").agg(F.bit_or("bits").alias("bits")).write.parquet(f"{index.path}/dead/segment={number}")
    return row.first()["n_docs"]


def _terms(rows: DataFrame, sign: int) -> DataFrame:
    """``field, term, df, occurrences`` of single documents."""
    fields = rows.select(F.posexplode(F.arrays_zip("words", "counts")).alias("field", "own")).where(F.col("own.words") != "")
    flat = fields.select("field", F.col("own.counts").alias("counts"), F.posexplode(F.split("own.words", " ")).alias("nth", "term"))
    tf = F.get("counts", F.col("nth")).cast("long")
    return flat.select("field", "term", F.lit(sign).cast("long").alias("df"), (tf * sign).alias("occurrences"))


def _totals(rows: DataFrame, n_fields: int, sign: int) -> DataFrame:
    lengths = [F.coalesce(F.sum(F.col("lens")[i]), F.lit(0)) * sign for i in range(n_fields)]
    return rows.agg((F.count(F.lit(1)) * sign).alias("n_docs"), F.array(*lengths).alias("lengths"))


def _replaced(index: SegmentIndex, ids: DataFrame) -> DataFrame:
    """Forward rows that count and whose id is among ``ids``, of the folders that can hold them."""
    slices = [row["slice"] for row in ids.select(_slice(F.col("id")).alias("slice")).distinct().collect()]
    side = F.broadcast(ids) if small(ids, BROADCAST_IDS) else ids
    return index.forward().where(F.col("slice").isin(slices)).join(side, "id", "left_semi")


def refresh(
    docs: DataFrame,
    path: str,
    deleted: DataFrame | None = None,
    fields: Mapping[str, Column] | None = None,
    buckets: int = TERM_BUCKETS,
    fan: int = FAN,
) -> dict[str, int]:
    """Merge or upload documents by id, delete the ids of ``deleted``, and commit a new version.

    Writes one segment with the new documents, and the bits and counts of the older ones they replace; then
    merges segments if a tier is full. ``docs`` has the columns of search documents that are indexed. Documents
    whose id is blank are reported as failed and left out; of several with one id the most recently published
    wins; an id that is both changed and deleted is deleted. Unknown deleted ids are ignored.
    """
    spark = docs.sparkSession
    index = open_index(spark, path)
    texts = fields or field_texts(docs)
    if not index.segments:
        index = SegmentIndex(spark, path, index.version, (), tuple(texts), buckets)
    if tuple(texts) != index.fields:
        raise ValueError(f"the index has the fields {index.fields}, not {tuple(texts)}")
    keyed = F.coalesce(F.length("id") > 0, F.lit(False))
    counted = docs.agg(F.count(F.lit(1)).alias("total"), F.count_if(~keyed).alias("failed")).first()
    ties = [F.asc_nulls_last(c) for c in ("url", "title") if c in docs.columns]
    latest = latest_of_repeated(docs.where(keyed), ["id"], [F.desc_nulls_last("published_at"), *ties])
    gone = None if deleted is None else deleted.select("id").where(F.length("id") > 0).distinct()
    if gone is not None:
        latest = latest.join(gone, "id", "left_anti")
    number, n = _next_segment(spark, path), len(index.fields)
    # Counted once, before the rows are sampled and travel: they are smaller than their texts.
    staged = scratch_path(spark, "counted")
    own = _write_documents(index, number, _numbered(_staged(count_terms(searched_texts(latest, texts), n), staged)))
    Folder(spark, staged).remove()
    touched = own.select("id") if gone is None else own.select("id").union(gone)
    replaced = _staged(_replaced(index, touched), scratch_path(spark, "replaced"))
    _write_statistics(
        index, number, _terms(own, 1).union(_terms(replaced, -1)), _totals(own, n, 1).union(_totals(replaced, n, -1)),
        replaced.select(F.col("segment").alias("target"), "block", bit(F.col("slot")).alias("bits")),
    )
    _, listed = _manifest(spark, path)
    added, removed = own.count(), replaced.count()
    updated = replaced.join(own.select("id"), "id", "left_semi").count()
    _commit(spark, path, index.version + 1, {**listed, number: added})
    while merge_tier(spark, path, fan):
        pass
    return {
        "total": counted["total"], "succeeded": counted["total"] - counted["failed"], "failed": counted["failed"],
        "inserted": added - updated, "updated": updated, "deleted": removed - updated,
    }


def tier(docs: int, fan: int = FAN) -> int:
    """Number of times that a segment's documents can be divided by ``fan``."""
    level = 0
    while docs >= fan:
        docs, level = docs // fan, level + 1
    return level


def merge_tier(spark: SparkSession, path: str, fan: int = FAN) -> bool:
    """Merge the segments of the lowest tier that has ``fan`` of them; whether there was one.

    A document is so rewritten once per tier, not once per refresh. Counts are added up as they are: what one
    merged segment took out of another is out of their sum.
    """
    version, listed = _manifest(spark, path)
    tiers: dict[int, list[int]] = {}
    for number, docs in listed.items():
        tiers.setdefault(tier(docs, fan), []).append(number)
    full = sorted(level for level, numbers in tiers.items() if len(numbers) >= fan)
    if not full:
        return False
    merged = tuple(sorted(tiers[full[0]]))
    index = open_index(spark, path, version)
    number = _next_segment(spark, path)
    own = _write_documents(index, number, _numbered(index.forward(merged).drop("block", "slot", "segment", "slice")))
    dead = index.read("dead", merged).where(F.col("target").isin([s for s in index.segments if s not in merged]))
    _write_statistics(
        index, number, index.read("frequencies", merged).select("field", "term", "df", "occurrences"),
        index.read("stats", merged).select("n_docs", "lengths"), dead.select("target", "block", "bits"),
    )
    left = {s: docs for s, docs in listed.items() if s not in merged}
    _commit(spark, path, version + 1, {**left, number: own.count()})
    return True


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Remove the segments that none of the last ``keep`` versions lists, and the older versions themselves."""
    rows = _versions(spark, path)
    if rows is None:
        return []
    listed: dict[int, set[int]] = {}
    for row in rows.collect():
        listed.setdefault(row["version"], set()).add(row["segment"])
    kept = sorted(listed)[-keep:]
    needed = set().union(*[listed[v] for v in kept])
    unused = sorted(set().union(*listed.values()) - needed)
    # Versions go first: no reader can then open one whose segments are gone.
    for version in sorted(set(listed) - set(kept)):
        Folder(spark, f"{path}/versions/version={version}").remove()
    for number in unused:
        for kind in _SCHEMAS:
            Folder(spark, f"{path}/{kind}/segment={number}").remove()
    return unused


def document_count(index: SegmentIndex) -> int:
    return index.read("stats").agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n")).first()["n"]

