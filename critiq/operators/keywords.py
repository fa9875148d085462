"""RAKE keyword extraction and keyword aggregation.

RAKE (Rose, Engel, Cramer, Cowley 2010), as pinned in SURVEY §2.9 P3: a
candidate is a maximal run of content words; per text, freq(w) = occurrences of
w in candidates, deg(w) = sum of the lengths of the candidates it occurs in,
score(w) = deg/freq, and a phrase scores the sum of its words' scores.

Plan shape: documents are hash-partitioned by their key once (the raw text
is the smallest form of the data), into partitions of a bounded size; candidates and words are exploded inside
that partitioning, and every later per-document step (word statistics by
window, phrase sums, phrase de-duplication) is keyed by (doc, ...), which the
existing partitioning already satisfies — no further shuffle of token rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from critiq.functions import text as T
from critiq.operators.common import dealt_by_size


def rake_phrases(docs: DataFrame, key: str = "doc_id", group_cols: Sequence[str] = (),
                 text_col: str = "text", stopwords: list[str] | None = None) -> DataFrame:
    """One row per distinct (document, phrase) with its RAKE score.

    Output: key, group_cols..., phrase, score, n_occurrences, first_pos, n_words.
    """
    group_cols = list(group_cols)
    d = dealt_by_size(docs.select(key, *group_cols, text_col), key, text_col)
    cands = d.select(key, *group_cols,
                     F.posexplode(T.rake_candidates(F.col(text_col), stopwords)).alias("cand_pos", "phrase"))
    words = cands.select(key, *group_cols, "cand_pos", "phrase",
                         F.size(F.split("phrase", " ")).alias("n_words"),
                         F.explode(F.split("phrase", " ")).alias("word"))
    per_word = Window.partitionBy(key, "word")
    scored = words.withColumn(
        "wscore", F.sum("n_words").over(per_word) / F.count(F.lit(1)).over(per_word))
    occ = scored.groupBy(key, *group_cols, "cand_pos", "phrase", "n_words").agg(F.sum("wscore").alias("score"))
    return occ.groupBy(key, *group_cols, "phrase").agg(
        F.max("score").alias("score"),
        F.count(F.lit(1)).alias("n_occurrences"),
        F.min("cand_pos").alias("first_pos"),
        F.max("n_words").alias("n_words"))


def group_scores(phrases: DataFrame, publisher: str = "publisher", version: str = "version",
                 min_score: float | None = None, uses: str | None = None) -> DataFrame:
    """K3-K6: summed phrase scores per (publisher, keyword) and per (publisher, version, keyword).

    One aggregation with two grouping sets; ``version`` is NULL on publisher
    rows. ``min_score`` applies F10 (the reference keeps scores > 1). ``uses``
    names a column with the number of texts that a row stands for (default 1).
    """
    n = F.col(uses) if uses else F.lit(1).cast("bigint")
    out = phrases.withColumn("n_docs", n).withColumn("score", F.col("score") * F.col("n_docs")).groupingSets(
        [[publisher, "phrase"], [publisher, version, "phrase"]], publisher, version, "phrase"
    ).agg(F.sum("score").alias("score"), F.sum("n_docs").alias("n_docs"))
    if min_score is not None:
        out = out.filter(F.col("score") > min_score)
    return out


def unversioned_scores(phrases: DataFrame, publisher: str = "publisher", version: str = "version", uses: str | None = None) -> DataFrame:
    """The rows of ``group_scores`` without a version, with the other rows left out before the shuffle.

    These are the publisher rows, and those of (publisher, version, keyword) whose version is null.
    """
    n = F.col(uses) if uses else F.lit(1).cast("bigint")
    level = F.explode(F.when(F.col(version).isNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = phrases.select(publisher, "phrase", (F.col("score") * n).alias("score"), n.alias("n_docs"), level.alias("_level"))
    return rows.groupBy(publisher, "phrase", "_level").agg(F.sum("score").alias("score"), F.sum("n_docs").alias("n_docs")).drop("_level")


def title_scores(titles: DataFrame, reviews: DataFrame, item: str = "review_item", publisher: str = "publisher",
                 version: str = "version", stopwords: list[str] | None = None, unversioned: bool = False) -> DataFrame:
    """K3/K4: title keyword sums over all reviews, from ``titles`` (item, title).

    Reviews of one item share its title, so RAKE runs once per item and meets the
    review counts per (publisher, version, item), pre-summed in every task.
    """
    phrases = rake_phrases(titles, key=item, text_col="title", stopwords=stopwords).select(item, "phrase", "score")
    uses = reviews.groupBy(item, publisher, version).agg(F.count(F.lit(1)).alias("uses"))
    return (unversioned_scores if unversioned else group_scores)(phrases.join(uses, item), publisher, version, uses="uses")


def last_write_scores(phrases: DataFrame, key: str = "doc_id", group_cols: Sequence[str] = ("publisher",)) -> DataFrame:
    """K5/K6 as written in the reference: a keyword's score is the one of its last
    occurrence in processing order (documents by key, phrases by position)."""
    return phrases.groupBy(*group_cols, "phrase").agg(
        F.max_by("score", F.struct(F.col(key), F.col("first_pos"))).alias("score"))


def top_k(scores: DataFrame, group_cols: Sequence[str], k: int = 10, score: str = "score",
          tie: str = "phrase") -> DataFrame:
    """The k best keywords per group (score descending, keyword ascending on ties).

    ``row_number() <= k`` is planned with a partial group limit before the
    shuffle, so each task sends at most k rows per group.
    """
    w = Window.partitionBy(*group_cols).orderBy(F.col(score).desc(), F.col(tie).asc())
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ordered_keywords(scores: DataFrame, group_cols: Sequence[str] = (), score: str = "score",
                     tie: str = "phrase") -> DataFrame:
    """All keywords by group and own score descending (global sort, range-partitioned)."""
    return scores.orderBy(*group_cols, F.col(score).desc(), F.col(tie).asc())
