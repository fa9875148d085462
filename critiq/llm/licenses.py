"""Operator 1: license scans by diagonal voting, in DataFrame functions only.

Every rolling word k-gram of every text is hashed and joined to the positions of
the same hash in the templates, a fixed list small enough to be broadcast. A match
at word p of the text and place q of the template votes for diagonal p - q. Votes
are a bit mask over template places, combined per diagonal and then over
neighbouring diagonals (up to DRIFT words apart), so an inserted or missing word
does not break a match. A span is verified by comparing the words themselves, not
the hashes, and by its share of the template's places.

A document's own row decides everything that is kept of it (only matches and one
row per document leave the task that reads the text). Null and empty texts have no
words and score 0; a null doc_id stays null; repeated rows give a row each; an
empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# What separates words, and the letters lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of a gram, words that neighbouring diagonals may lie apart, least share of a template's places.
GRAM, DRIFT, LEAST = 2, 3, 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


# The base phrases and wordings of public licenses.
TEMPLATES = [
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("gpl", "this work is licensed under the gnu general public license version"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc", "creative commons attribution"),
    Template("cc", "licensed under cc by"),
    Template("mpl", "mozilla public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Template("proprietary", "all rights reserved"),
]


def template_rows(templates: list[Template], k: int) -> list[tuple]:
    """(template, label, base, places, place, gram) for every gram of every template."""
    out = []
    for number, t in enumerate(templates):
        words = t.text.split()
        places = len(words) - k + 1
        if not 0 < places < 63:
            raise ValueError(f"a template needs {k} to {62 + k - 1} words: {t.text!r}")
        out += [(number, t.label, t.base, places, q, " ".join(words[q:q + k])) for q in range(places)]
    return out


def scan(docs: DataFrame, templates: list[Template] | None = None, k: int = GRAM) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_base, first_word, last_word,
    base_labels, labels, score, and spans (label, first and last word, share) as verified."""
    spark = docs.sparkSession
    rows = template_rows(TEMPLATES if templates is None else templates, k)
    places = spark.createDataFrame(rows, "template int, label string, base boolean, places int, place int, gram string")
    places = places.withColumn("hash", F.xxhash64(*[F.split("gram", " ")[i] for i in range(k)]))

    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    words = F.array_remove(F.split(lower, SEPARATORS), "")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words.alias("words"))
    grams = texts.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), "words", F.posexplode_outer("words").alias("at", "word"))
    gram_words = [F.col("word"), *[F.get("words", F.col("at") + i) for i in range(1, k)]]
    grams = grams.select("row", "doc_id", "n_words", "at", F.concat_ws(" ", *gram_words).alias("words_there"),
                         F.xxhash64(*gram_words).alias("hash"))
    # Rows of texts without any match stay as the one of their first word.
    hits = grams.join(F.broadcast(places), "hash", "left").where("template is not null or at is null or at = 0")

    document = ["row", "doc_id", "n_words"]
    template = ["template", "label", "base", "places"]
    vote = F.expr("if(words_there = gram, shiftleft(1L, place), 0L)")
    diagonals = hits.groupBy(*document, *template, (F.col("at") - F.col("place")).cast("long").alias("diagonal")) \
        .agg(F.bit_or(vote).alias("votes"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT).cast("int")
    spans = diagonals.withColumn("apart", F.coalesce(apart, F.lit(0))) \
        .withColumn("span", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))) \
        .withColumn("whole", F.expr("base and bit_count(votes) = places"))
    spans = spans.groupBy(*document, *template, "span").agg(
        F.bit_or("votes").alias("votes"),
        F.count_if("whole").alias("n_base"),
        F.min(F.expr("if(whole, diagonal, null)")).alias("first_word"),
        F.max(F.expr("if(whole, diagonal, null)")).alias("last_word"),
        F.min("diagonal").alias("start"), F.max("diagonal").alias("stop"))
    spans = spans.withColumn("share", F.expr("coalesce(bit_count(votes) / places, 0.0)")) \
        .withColumn("verified", F.col("share") >= LEAST)
    span = F.struct("label", "start", (F.col("stop") + F.col("places") + (k - 2)).alias("end"), "share")
    return spans.groupBy(*document).agg(
        F.sum("n_base").alias("n_base"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.expr("if(n_base > 0, label, null)")))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.expr("if(verified or n_base > 0, label, null)")))).alias("labels"),
        F.max(F.expr("if(verified, share, 0.0)")).cast("double").alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("verified"), span))).alias("spans")).drop("row")


def oracle_sql(templates: list[Template] | None = None, k: int = GRAM) -> str:
    """DuckDB SQL of the registered columns over ``documents``."""
    rows = ", ".join(f"({t}, '{label}', {base}, {n}, {q}, '{gram}')"
                     for t, label, base, n, q, gram in template_rows(TEMPLATES if templates is None else templates, k))
    gram = " || ' ' || ".join(f"words[p + {i}]" for i in range(1, k + 1))
    return rf"""
WITH places(template, label, base, places, place, gram) AS (VALUES {rows}),
texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
grams AS (
  SELECT doc_id, p, {gram} AS gram
  FROM (SELECT doc_id, words, unnest(range(len(words))) AS p FROM texts)),
diagonals AS (
  SELECT doc_id, template, label, base, places, p - place AS diagonal, bit_or(CAST(1 AS BIGINT) << place) AS votes
  FROM grams JOIN places USING (gram) GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {DRIFT} THEN 1 ELSE 0 END AS apart
  FROM diagonals),
numbered AS (
  SELECT *, base AND bit_count(votes) = places AS whole,
         sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked),
spans AS (
  SELECT doc_id, label, count(*) FILTER (WHERE whole) AS n_base, min(diagonal) FILTER (WHERE whole) AS first_word,
         max(diagonal) FILTER (WHERE whole) AS last_word, CAST(bit_count(bit_or(votes)) AS DOUBLE) / places AS share
  FROM numbered GROUP BY doc_id, template, label, base, places, span),
found AS (
  SELECT doc_id, sum(n_base) AS n_base, min(first_word) AS first_word, max(last_word) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE n_base > 0) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE share >= {LEAST} OR n_base > 0) AS labels,
         max(share) FILTER (WHERE share >= {LEAST}) AS score
  FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM texts LEFT JOIN found USING (doc_id)
"""
