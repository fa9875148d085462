"""Registered keyword queries and their DuckDB oracles.

Input: every document (all languages); publisher = lang, version = source.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from critiq.functions.text import STOPWORDS
from critiq.operators import keywords as K
from critiq.plans.oracle_views import with_views
from critiq.sources import tables


def _phrases(spark, sf):
    return K.rake_phrases(tables.texts(spark, sf), group_cols=["publisher", "version"])


def q_rake_phrases(spark, sf):
    p = _phrases(spark, sf)
    return p.select("doc_id", "publisher", "version", "phrase", F.round("score", 6).alias("score"),
                    "n_occurrences", F.col("first_pos").cast("bigint").alias("first_pos"),
                    F.col("n_words").cast("bigint").alias("n_words"))


def q_rake_by_group(spark, sf):
    g = K.group_scores(_phrases(spark, sf), min_score=1.0)
    return g.withColumn("score", F.round("score", 6))


def q_rake_top10(spark, sf):
    g = K.unversioned_scores(_phrases(spark, sf))
    g = g.withColumn("score", F.round("score", 6))
    return K.top_k(g, ["publisher"], 10).withColumn("rank", F.col("rank").cast("bigint"))


def q_rake_last_write(spark, sf):
    return K.last_write_scores(_phrases(spark, sf)).withColumn("score", F.round("score", 6))


def q_rake_last_write_version(spark, sf):
    return K.last_write_scores(_phrases(spark, sf), group_cols=["publisher", "version"]).withColumn(
        "score", F.round("score", 6))


def _title_scores(spark, sf, unversioned=False):
    titles = tables.allow_list(spark, sf).select(F.col("item").alias("review_item"), "title")
    return K.title_scores(titles, tables.reviews(spark, sf), unversioned=unversioned).withColumn("score", F.round("score", 6))


def q_title_keywords(spark, sf):
    return _title_scores(spark, sf)


def q_keywords_ordered(spark, sf):
    text = K.unversioned_scores(_phrases(spark, sf)).withColumn("score", F.round("score", 6))
    both = text.withColumn("kind", F.lit("text")).unionByName(_title_scores(spark, sf, unversioned=True).withColumn("kind", F.lit("title")))
    return K.ordered_keywords(both, ["kind", "publisher"])


QUERIES = {
    "rake_phrases": q_rake_phrases,
    "rake_by_group": q_rake_by_group,
    "rake_top10": q_rake_top10,
    "rake_last_write": q_rake_last_write,
    "rake_last_write_version": q_rake_last_write_version,
    "title_keywords": q_title_keywords,
    "keywords_ordered": q_keywords_ordered,
}


def _stop_list() -> str:
    return "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"


def rake_ctes(docs: str = "docs", prefix: str = "") -> list[tuple[str, str]]:
    """DuckDB form of P3: phrase rows per row of ``docs`` (see critiq.operators.keywords)."""
    names = ["cands", "cand", "words", "wstat", "occ", "phr"]
    ctes = _rake_ctes()
    if docs != "docs":
        ctes = [(n, re.sub(rf"\b(FROM|JOIN) ({'|'.join(names)})\b", rf"\1 {prefix}\2", sql).replace("FROM docs", f"FROM {docs}"))
                for n, sql in ctes]
    return [(prefix + n, sql) for n, sql in ctes]


def _rake_ctes() -> list[tuple[str, str]]:
    return [
        ("cands", rf"""
SELECT doc_id, publisher, version,
       list_filter(list_transform(string_split_regex(array_to_string(list_transform(
           regexp_extract_all(lower(text), '\p{{L}}+|[^\p{{L}}\s]+'),
           lambda t: CASE WHEN regexp_full_match(t, '\p{{L}}+') AND NOT list_contains({_stop_list()}, t)
                          THEN t ELSE '|' END), ' '), '\|'), lambda p: trim(p)), lambda p: p <> '') AS c
FROM docs
"""),
        ("cand", """
SELECT doc_id, publisher, version, unnest(c) AS phrase, unnest(range(len(c))) AS cand_pos FROM cands
"""),
        ("words", """
SELECT doc_id, publisher, version, cand_pos, phrase, len(string_split(phrase, ' ')) AS n_words,
       unnest(string_split(phrase, ' ')) AS word
FROM cand
"""),
        ("wstat", """
SELECT doc_id, word, sum(n_words) / count(*) AS wscore FROM words GROUP BY doc_id, word
"""),
        ("occ", """
SELECT w.doc_id, w.publisher, w.version, w.cand_pos, w.phrase, w.n_words, sum(s.wscore) AS score
FROM words w JOIN wstat s ON s.doc_id = w.doc_id AND s.word = w.word
GROUP BY w.doc_id, w.publisher, w.version, w.cand_pos, w.phrase, w.n_words
"""),
        ("phr", """
SELECT doc_id, publisher, version, phrase, max(score) AS score, count(*) AS n_occurrences,
       min(cand_pos) AS first_pos, max(n_words) AS n_words
FROM occ GROUP BY doc_id, publisher, version, phrase
"""),
    ]


_GROUPED = """
SELECT publisher, version, phrase, sum(score) AS score, count(*) AS n_docs FROM phr
GROUP BY GROUPING SETS ((publisher, phrase), (publisher, version, phrase))
"""

_TITLES = [
    ("titles", "SELECT p_partkey AS doc_id, NULL AS publisher, NULL AS version, p_name AS text FROM part"),
    *rake_ctes("titles", "t_"),
    ("t_grouped", """
SELECT r.publisher, r.version, p.phrase, sum(p.score) AS score, count(*) AS n_docs
FROM reviews r JOIN t_phr p ON p.doc_id = r.review_item
GROUP BY GROUPING SETS ((r.publisher, p.phrase), (r.publisher, r.version, p.phrase))
"""),
]

ORACLE = {
    "rake_phrases": with_views(["docs"], """
SELECT doc_id, publisher, version, phrase, round(score, 6) AS score, n_occurrences, first_pos, n_words FROM phr
""", rake_ctes()),
    "rake_by_group": with_views(["docs"], """
SELECT publisher, version, phrase, round(score, 6) AS score, n_docs FROM grouped WHERE score > 1.0
""", rake_ctes() + [("grouped", _GROUPED)]),
    "rake_top10": with_views(["docs"], """
SELECT publisher, phrase, score, n_docs, rank FROM (
  SELECT publisher, phrase, round(score, 6) AS score, n_docs,
         row_number() OVER (PARTITION BY publisher ORDER BY round(score, 6) DESC, phrase ASC) AS rank
  FROM grouped WHERE version IS NULL) t WHERE rank <= 10
""", rake_ctes() + [("grouped", _GROUPED)]),
    "rake_last_write": with_views(["docs"], """
SELECT publisher, phrase, round(arg_max(score, doc_id), 6) AS score FROM phr GROUP BY publisher, phrase
""", rake_ctes()),
    "rake_last_write_version": with_views(["docs"], """
SELECT publisher, version, phrase, round(arg_max(score, doc_id), 6) AS score FROM phr GROUP BY publisher, version, phrase
""", rake_ctes()),
    "title_keywords": with_views(["reviews"], """
SELECT publisher, version, phrase, round(score, 6) AS score, n_docs FROM t_grouped
""", _TITLES),
    "keywords_ordered": with_views(["docs", "reviews"], """
SELECT 'text' AS kind, publisher, phrase, round(score, 6) AS score, n_docs FROM grouped WHERE version IS NULL
UNION ALL
SELECT 'title', publisher, phrase, round(score, 6), n_docs FROM t_grouped WHERE version IS NULL
ORDER BY kind, publisher, score DESC, phrase
""", rake_ctes() + [("grouped", _GROUPED)] + _TITLES),
}
