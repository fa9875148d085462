"""Operator 7: document fingerprints as Merkle trees, in DataFrame functions only.

Leaves are the sentence-sized pieces of paragraphs (a paragraph is a line); their
hashes make a paragraph's node, runs of SECTION paragraphs make a section's node,
and the sections make the root. The pieces keep every character, so equal roots
mean equal texts. A fingerprint is written as root ':' leaves, with '.' between the
leaves of a paragraph, ',' between paragraphs and ';' between sections: inner nodes
follow from it, and the branches in which two fingerprints differ locate an edit.
The likeness of two fingerprints is the share of common leaves among all distinct
leaves of both.

The next document needs the documents in order, not in one task: ids are dealt into
as many ranges as there are shuffle partitions by approximate quantiles, texts move
once to their range, and the first text of each range is also sent to the range
before it, as a guest that ends the order there (the first of all to the last range).

Null texts are empty; the empty text has one empty leaf. Null ids come last in the
order, rows with one doc_id in the order of their texts' hashes. A single row is its
own next document. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTION = 8
# Hexadecimal digits of a node; a piece ends after these signs and a blank.
DIGITS = 16
PIECE_END = r"(?<=[.!?][ \t])"


def tree(text: Column) -> Column:
    """Leaves of each paragraph: an array of arrays of hashes."""
    return F.transform(F.split(text, "\n", -1),
                       lambda p: F.transform(F.split(p, PIECE_END, -1), lambda s: F.substring(F.sha2(s, 256), 1, DIGITS)))


def root(leaves: Column) -> Column:
    """Root hash of a tree: paragraphs, sections of SECTION paragraphs, root."""
    paragraphs = F.transform(leaves, lambda p: F.substring(F.sha2(F.array_join(p, ""), 256), 1, DIGITS))
    return F.sha2(F.array_join(_sections(paragraphs, lambda x: F.substring(F.sha2(F.array_join(x, ""), 256), 1, DIGITS)), ""), 256)


def _sections(items: Column, join) -> Column:
    """``join`` of each run of SECTION items."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / SECTION).cast("int")),
                       lambda i: join(F.slice(items, i * SECTION + 1, SECTION)))


def written(leaves: Column) -> Column:
    """The fingerprint as a string."""
    paragraphs = F.transform(leaves, lambda p: F.array_join(p, "."))
    return F.concat(root(leaves), F.lit(":"), F.array_join(_sections(paragraphs, lambda x: F.array_join(x, ",")), ";"))


def likeness(a: Column, b: Column) -> Column:
    """Common leaves of two trees among their distinct leaves."""
    a, b = F.flatten(a), F.flatten(b)
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs in which two written fingerprints differ."""
    x, y = (F.split(F.substring_index(c, ":", -1), "[,;]", -1) for c in (a, b))
    longest = F.greatest(F.size(x), F.size(y))
    return F.filter(F.sequence(F.lit(0), longest - 1), lambda i: ~F.get(x, i).eqNullSafe(F.get(y, i)))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the text of the next document by descending doc_id."""
    spark = docs.sparkSession
    least = -(1 << 63)
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(least)).alias("key"))
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = keyed.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] or []
    cut = sorted(set(cut))
    # A key's range is the number of cuts below it, found over every width-th cut first.
    width = max(1, math.isqrt(len(cut)))
    fine = F.array(*[F.lit(x) for x in cut]) if cut else F.array().cast("array<bigint>")
    coarse = F.array(*[F.lit(x) for x in cut[width - 1::width]]) if cut else F.array().cast("array<bigint>")
    whole = F.size(F.filter(coarse, lambda x: x < F.col("key"))) * width
    keyed = keyed.withColumn("whole", whole).withColumn(
        "range", F.col("whole") + F.size(F.filter(F.slice(fine, F.col("whole") + 1, width), lambda x: x < F.col("key"))))
    # The first key of each range; at most as many rows as there are ranges.
    firsts = sorted(map(tuple, keyed.groupBy("range").agg(F.max("key")).collect()))
    if not firsts:
        return docs.select("doc_id", "text", F.col("text").alias("next"))
    guests = [(first, firsts[(i + 1) % len(firsts)][0]) for i, (_, first) in enumerate(firsts)]
    guests = spark.createDataFrame(guests, "key long, target int")
    places = F.expr("if(target is null, array(struct(range as range, false as guest)), "
                    "array(struct(range as range, false as guest), struct(target as range, true as guest)))")
    dealt = keyed.join(F.broadcast(guests), "key", "left").select("key", "doc_id", "text", F.inline(places))
    order = Window.partitionBy("range").orderBy("guest", F.desc("key"), F.xxhash64("text"))
    return dealt.withColumn("next", F.lead("text").over(order)).where("not guest").select("doc_id", "text", "next")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text, edited, fingerprint, edited_fingerprint, near_edited and near_next of each row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pairs = with_next(texts).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.expr("concat(left(text, cast(n_chars - n_chars div 2 as int)), left(next, cast(n_chars div 2 as int)))")
    pairs = pairs.withColumn("edited", edited)
    trees = pairs.withColumn("own", tree(F.col("text"))).withColumn("changed", tree(F.col("edited"))) \
        .withColumn("following", tree(F.col("next")))
    return trees.select(
        "doc_id", "n_chars", "text", "edited", written(F.col("own")).alias("fingerprint"),
        written(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"))


def oracle_sql() -> str:
    """DuckDB SQL of the registered columns over ``documents``."""

    def node(x: str) -> str:
        return f"left(sha256(list_aggregate({x}, 'string_agg', '')), {DIGITS})"

    def leaves(text: str) -> str:
        pieces = "string_split(regexp_replace(p, '([.!?][ \\t])', '\\1' || chr(30), 'g'), chr(30))"
        return f"list_transform(string_split({text}, chr(10)), lambda p: list_transform({pieces}, lambda s: left(sha256(s), {DIGITS})))"

    def runs(items: str, join: str) -> str:
        return (f"list_transform(range(0, (len({items}) - 1) // {SECTION} + 1), "
                f"lambda i: {join.format(f'{items}[i * {SECTION} + 1 : i * {SECTION} + {SECTION}]')})")

    def text_of(t: str) -> str:
        lines = f"list_transform({t}, lambda p: list_aggregate(p, 'string_agg', '.'))"
        nodes = f"list_transform({t}, lambda p: {node('p')})"
        top = f"sha256(list_aggregate({runs(nodes, node('{}'))}, 'string_agg', ''))"
        body = runs(lines, "list_aggregate({}, 'string_agg', ',')")
        return f"{top} || ':' || list_aggregate({body}, 'string_agg', ';')"

    def near(a: str, b: str) -> str:
        return (f"CAST(len(list_distinct(list_intersect(flatten({a}), flatten({b})))) AS DOUBLE) / "
                f"len(list_distinct(list_concat(flatten({a}), flatten({b}))))")

    return f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next FROM documents),
changed AS (
  SELECT *, left(text, n_chars - n_chars // 2) || left(next, n_chars // 2) AS edited FROM ordered),
trees AS (
  SELECT doc_id, n_chars, edited, {leaves('text')} AS own, {leaves('edited')} AS other, {leaves('next')} AS following FROM changed)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {text_of('own')} AS fingerprint,
       {text_of('other')} AS edited_fingerprint, {near('own', 'other')} AS near_edited, {near('own', 'following')} AS near_next
FROM trees
"""
