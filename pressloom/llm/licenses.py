"""License scans by diagonal voting: word k-grams joined to template positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import stage

#: Words of a gram, farthest distance of diagonals that are merged, least share of a template's grams.
GRAM, NEAR, SHARE = 3, 3, 0.8

# Phrases that name a license for certain.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# Notices as their licenses word them, reduced to words.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _gram(words: Column, at: Column) -> Column:
    return F.concat_ws(" ", *[F.get(words, at + j) for j in range(GRAM)])


def template_grams(spark, templates=TEMPLATES) -> DataFrame:
    """``template``, ``label``, ``grams``, ``spot`` and ``hash`` / ``gram`` of every position of every template."""
    rows = []
    for number, (label, text) in enumerate(templates):
        words = text.split()
        n = len(words) - GRAM + 1
        rows += [(number, label, n, spot, " ".join(words[spot : spot + GRAM])) for spot in range(n)]
    grams = spark.createDataFrame(rows, "template int, label string, grams int, spot int, gram string")
    return grams.withColumn("hash", F.xxhash64("gram"))


def _places(words: Column, joined: Column, phrase: str) -> Column:
    """Word numbers where the phrase begins; texts without it are told by a plain search."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    here = F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.forall(F.sequence(F.lit(0), F.lit(len(parts) - 1)), lambda j: F.get(words, i + j) == F.get(F.array(*map(F.lit, parts)), j)),
    )
    return F.when(F.contains(joined, F.lit(phrase)) & (last >= 0), here).otherwise(F.array().cast("array<int>"))


#: Only these letters are lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Licenses named or quoted in each text.

    ``doc_id``, ``n_words``, ``n_base`` (places of the phrases), ``first_word`` and ``last_word`` of them,
    ``base_labels``, ``labels``, ``score``. All grams of three words of every text meet the template positions in
    a hash join, with the gram itself compared; hits vote for the diagonal (word minus template word);
    diagonals at most three apart are one span, a few words lost or added. A span is verified by the template
    positions it holds: they have to be 80 % of the template's grams and of the grams between the span's first and
    last word in the text, so words strewn between the template's cost as much as words left out. Such a span
    carries its label. ``score`` is 1 with a phrase, else the largest share of a span.

    Null and empty texts have no words, no labels and score 0; a text shorter than a gram can still hold
    a phrase; every row stands for itself, repeated ones too; extra columns are not carried; an empty
    table gives no rows. Only A-Z is lower-cased.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower()), F.lit(WORD), F.lit(0))
    read = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))
    read = read.withColumn("joined", F.concat_ws(" ", "words"))
    for label, phrase in PHRASES.items():
        read = read.withColumn(f"at_{label}", _places(F.col("words"), F.col("joined"), phrase))
    places = F.concat(*[F.col(f"at_{label}") for label in PHRASES])
    named = F.array_sort(F.array_compact(F.array(*[F.when(F.size(f"at_{label}") > 0, F.lit(label)) for label in PHRASES])))
    last = F.size("words") - GRAM
    grams = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: _gram(F.col("words"), i)))
    spread = read.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        named.alias("named"),
        F.posexplode_outer(grams).alias("spot_in_text", "gram_in_text"),
    )
    # The templates are constants, so their grams may always be broadcast.
    known = F.broadcast(template_grams(spark, templates))
    met = spread.withColumn("own", F.xxhash64("gram_in_text")).join(known, (F.col("own") == F.col("hash")) & (F.col("gram_in_text") == F.col("gram")), "left")
    kept = met.where(F.col("template").isNotNull() | F.coalesce(F.col("spot_in_text") == 0, F.lit(True)))
    rows = stage(kept.drop("own", "hash", "gram", "gram_in_text"), "license-hits")

    hits = rows.where(F.col("template").isNotNull()).select("row", "template", "label", "grams", "spot", "spot_in_text", (F.col("spot_in_text") - F.col("spot")).alias("diagonal"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    before = F.lag("diagonal").over(along)
    apart = hits.withColumn("new", F.when(F.col("diagonal") - before <= NEAR, 0).otherwise(1))
    extent = F.max("spot_in_text") - F.min("spot_in_text") + 1
    spans = apart.withColumn("span", F.sum("new").over(along)).groupBy("row", "template", "label", "grams", "span").agg(
        (F.count_distinct("spot") / F.greatest(F.first("grams"), extent)).alias("share")
    )
    found = spans.groupBy("row").agg(
        F.collect_set(F.when(F.col("share") >= SHARE, F.col("label"))).alias("quoted"), F.max("share").alias("best")
    )
    base = rows.where(F.col("spot_in_text").isNull() | (F.col("spot_in_text") == 0)).select("row", "doc_id", "n_words", "n_base", "first_word", "last_word", "named")
    joined = base.dropDuplicates(["row"]).join(found, "row", "left")
    both = F.array_sort(F.array_union("named", F.coalesce("quoted", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.concat_ws(",", "named").alias("base_labels"),
        F.concat_ws(",", both).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def oracle() -> str:
    """The same in DuckDB's SQL."""
    templates = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{label}', '{phrase}')" for label, phrase in PHRASES.items())
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS words FROM documents
), spots AS (
  SELECT id, words, unnest(range(1, len(words) + 1)) AS spot FROM docs
), named AS (
  SELECT id, spot - 1 AS spot, label FROM spots, (VALUES {phrases}) AS p(label, phrase)
  WHERE words[spot] = split_part(phrase, ' ', 1) AND array_to_string(words[spot:spot + len(string_split(phrase, ' ')) - 1], ' ') = phrase
), base AS (
  SELECT id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list_sort(list(DISTINCT label)) AS named FROM named GROUP BY id
), templates AS (
  SELECT number, label, string_split(body, ' ') AS words FROM (VALUES {templates}) AS t(number, label, body)
), template_spots AS (
  SELECT number, label, len(words) - {GRAM - 1} AS grams, unnest(range(1, len(words) - {GRAM - 2})) AS spot, words FROM templates
), template_grams AS (
  SELECT number, label, grams, spot - 1 AS spot, array_to_string(words[spot:spot + {GRAM - 1}], ' ') AS gram FROM template_spots
), hits AS (
  SELECT s.id, t.number, t.label, t.grams, t.spot, s.spot AS here, s.spot - 1 - t.spot AS diagonal
  FROM spots s JOIN template_grams t ON array_to_string(s.words[s.spot:s.spot + {GRAM - 1}], ' ') = t.gram
), marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER along <= {NEAR} THEN 0 ELSE 1 END AS fresh FROM hits
  WINDOW along AS (PARTITION BY id, number ORDER BY diagonal)
), spans AS (
  SELECT *, sum(fresh) OVER (PARTITION BY id, number ORDER BY diagonal) AS span FROM marked
), shares AS (
  SELECT id, label, count(DISTINCT spot)::DOUBLE / greatest(any_value(grams), max(here) - min(here) + 1) AS share FROM spans GROUP BY id, number, label, span
), quoted AS (
  SELECT id, list(DISTINCT label) FILTER (WHERE share >= {SHARE}) AS labels, max(share) AS best FROM shares GROUP BY id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(array_to_string(named, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(named, []), coalesce(labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0) END AS score
FROM docs LEFT JOIN base USING (id) LEFT JOIN quoted USING (id)
"""
