"""A corpus from raw documents to packed sequences, as stages that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import langid, linededup, mixing, neardup, packing
from pressloom.llm.common import stage, table
from pressloom.session import tune

#: Least mean probability of the language of a document that has no label.
SURE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents and fill in missing labels; drop texts of no language, and unlabelled ones unsure of theirs.

    A document with a label goes only if its text has no letter.
    """
    network = langid.train(docs)
    if not network.labels:
        return docs
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    known = F.col("row.lang").isNotNull() | (F.col("score") >= SURE)
    sure = langid.predict(packed, network).where((F.col("lang_pred") != langid.UNKNOWN) & known)

    def column(name):
        own = F.col(f"row.`{name}`")
        return (F.coalesce(own, "lang_pred") if name == "lang" else own).alias(name)

    return sure.select(*map(column, docs.columns))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated chunks of lines; documents of which nothing is left go."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text", "n_chars")
    left = linededup.dedup_lines(packed).where((F.col("removed_lines") == 0) | (F.col("text") != ""))
    return left.select(*[F.col(c) if c in ("text", "n_chars") else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return neardup.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out documents so that sources come near their target weights."""
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the concatenated token ids every 2048 tokens; one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("identify_language", identify_language),
    ("dedup_lines", dedup_lines),
    ("dedup_documents", dedup_documents),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Tokenization and the stages before it have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read as the next one's input."""
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
