"""RAKE, TextRank and extraction micro cases (FIXTURES.md §3, SURVEY §2.9)."""

import math

from pyspark.sql import functions as F

from critiq.functions import html as H
from critiq.operators import extract as X
from critiq.operators import keywords as K
from critiq.operators import textrank as TR


def _docs(spark, texts, group=("g", "v")):
    return spark.createDataFrame([(i, group[0], group[1], t) for i, t in enumerate(texts)],
                                 ["doc_id", "publisher", "version", "text"])


def test_rake_golden(spark):
    p = K.rake_phrases(_docs(spark, ["the cat is stinky"]), stopwords=["the", "is"])
    assert sorted((r.phrase, r.score) for r in p.collect()) == [("cat", 1.0), ("stinky", 1.0)]


def test_rake_degree_and_frequency(spark):
    p = K.rake_phrases(_docs(spark, ["big red dog. red dog"]), stopwords=[])
    assert sorted((r.phrase, r.score) for r in p.collect()) == [("big red dog", 8.0), ("red dog", 5.0)]


def test_top_k_per_group(spark):
    df = spark.createDataFrame([("a", "x", 3.0), ("a", "y", 2.0), ("a", "z", 2.0), ("b", "q", 1.0)],
                               ["g", "phrase", "score"])
    out = sorted((r.g, r.phrase) for r in K.top_k(df, ["g"], 2).collect())
    assert out == [("a", "x"), ("a", "y"), ("b", "q")]


def test_sentences_break_only_on_terminators(spark):
    s = TR.sentences(_docs(spark, ["alpha beta | gamma. delta!? epsilon\nzeta"]), ["publisher", "version"])
    rows = sorted((r.sent_idx, r.words) for r in s.collect())
    assert rows == [(0, ["alpha", "beta", "gamma"]), (1, ["delta"]), (2, ["epsilon", "zeta"])]


def test_edges_window_and_self_loops(spark):
    s = TR.sentences(_docs(spark, ["aaa bbb aaa ccc ddd eee."]), ["publisher", "version"])
    e = {(r.src, r.dst): r.weight for r in TR.cooccurrence_edges(s, ["publisher", "version"]).collect()}
    # window 3 over kept words; aaa->ccc occurs from both aaa positions (offsets 3 and 1)
    assert ("aaa", "aaa") not in e
    assert e[("aaa", "ccc")] == 2 and e[("bbb", "ddd")] == 1 and ("aaa", "eee") in e
    assert ("bbb", "eee") not in e


def _brute_pagerank(nodes, edges, d=0.85, it=10):
    n = len(nodes)
    r = {v: 1.0 / n for v in nodes}
    out = {}
    for (s, t), w in edges.items():
        out[s] = out.get(s, 0) + w
    for _ in range(it):
        dang = sum(r[v] for v in nodes if v not in out)
        nr = {v: (1 - d) / n + d * dang / n for v in nodes}
        for (s, t), w in edges.items():
            nr[t] += d * r[s] * w / out[s]
        r = nr
    return r


def test_pagerank_matches_brute_force_and_sums_to_one(spark):
    texts = ["apple banana cherry apple. banana durian apple!", "cherry durian eggplant fig"]
    g = ["publisher", "version"]
    s = TR.sentences(_docs(spark, texts), g)
    e = TR.cooccurrence_edges(s, g)
    edges = {(r.src, r.dst): r.weight for r in e.collect()}
    nodes = sorted({r.node for r in TR.graph_nodes(s, g).collect()})
    ranks = {r.node: r.rank for r in TR.pagerank(TR.graph_nodes(s, g), e, g, 10).collect()}
    expect = _brute_pagerank(nodes, edges)
    assert math.isclose(sum(ranks.values()), 1.0, rel_tol=1e-9)
    for v in nodes:
        assert math.isclose(ranks[v], expect[v], rel_tol=1e-9)


def test_minhash_close_to_exact(spark):
    g = ["publisher", "version"]
    texts = ["orange lemon lime grape melon. melon berry grape lime.",
             "lemon lime kiwi mango papaya. berry melon grape orange kiwi."]
    s = TR.sentences(_docs(spark, texts), g)
    kern = spark.createDataFrame([("g", "v", "lemon lime grape", 0.6), ("g", "v", "melon berry", 0.4)],
                                 ["publisher", "version", "phrase", "rank"]).withColumn(
        "kwords", F.array_distinct(F.split("phrase", " ")))
    exact = {(r.doc_id, r.sent_idx): r.score for r in TR.sentence_scores(s, kern, g).collect()}
    approx = {(r.doc_id, r.sent_idx): r.score
              for r in TR.sentence_scores_minhash(s, kern, g, num_hashes=256).collect()}
    for k, v in exact.items():
        assert abs(approx.get(k, 0.0) - v) < 0.2


def test_word_budget_stops_at_first_overflow(spark):
    g = ["publisher", "version"]
    sents = spark.createDataFrame(
        [("g", "v", 1, i, ["w"] * n, "t") for i, n in enumerate([100, 40, 30, 5])],
        ["publisher", "version", "doc_id", "sent_idx", "words", "text"])
    scores = spark.createDataFrame([("g", "v", 1, i, 10.0 - i) for i in range(4)],
                                   ["publisher", "version", "doc_id", "sent_idx", "score"])
    chosen = sorted(r.sent_idx for r in TR.top_sentences(scores, sents, g, word_budget=150).collect())
    assert chosen == [0, 1]


def test_extraction_scalars(spark):
    df = spark.createDataFrame([("on March 5, 2017", "4.0 out of 5 stars", " 1,234 "),
                                ("on May 1, 2020", "5 out of 5 stars", "7"),
                                ("", "none", "")], ["d", "r", "n"])
    out = df.select(H.review_epoch(F.concat(F.lit('<span class="review-date">'), "d", F.lit("</span>"))).alias("ts"),
                    H.rating(F.col("r")).alias("rating"), H.stated_total(F.col("n")).alias("n")).collect()
    assert out[0].ts == 1488672000 and out[0].rating == 4.0 and out[0].n == 1234
    assert out[1].rating == 5.0
    assert out[2].rating is None and out[2].ts is None


def test_edition_falls_back_to_page_item(spark):
    df = spark.createDataFrame([('<a href="/product-reviews/B00X">', "P1"), ("<a href='#'>", "P2")], ["b", "page"])
    assert [r.e for r in df.select(H.edition(F.col("b"), F.col("page")).alias("e")).collect()] == ["B00X", "P2"]


def test_page_frontier_counts(spark):
    cat = spark.createDataFrame([("P", "V", 1, n) for n in (0, 10, 11, 25000)],
                                ["publisher", "version", "item", "num_reviews"])
    cat = cat.withColumn("item", F.col("num_reviews"))
    counts = {r.item: r.c for r in X.page_frontier(cat).groupBy("item").agg(F.count("*").alias("c")).collect()}
    assert counts == {10: 1, 11: 2, 25000: 1999}


def test_short_page_stop(spark):
    counts = spark.createDataFrame([("P", "V", 1, p, n) for p, n in [(1, 10), (2, 10), (3, 7), (4, 10)]],
                                   ["publisher", "version", "umbrella_item", "page", "n_records"])
    assert sorted(r.page for r in X.short_page_stop(counts).collect()) == [1, 2, 3]


def test_title_keywords_orderings_and_last_write(spark):
    """K3/K4 count a title once per review; T2 sorts by own score; K6 keeps the last text's score per version."""
    titles = spark.createDataFrame([(1, "big red dog. red dog"), (2, "red dog"), (3, None), (4, "")], "review_item int, title string")
    reviews = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("a", "y", 1), ("a", "y", 2), ("b", "x", 3), ("b", "x", 4), ("b", "x", 9)],
                                    "publisher string, version string, review_item int")
    got = K.title_scores(titles, reviews, stopwords=[])
    rows = {(r.publisher, r.version, r.phrase): (r.score, r.n_docs) for r in got.collect()}
    assert rows == {("a", None, "big red dog"): (24.0, 3), ("a", None, "red dog"): (19.0, 4),
                    ("a", "x", "big red dog"): (16.0, 2), ("a", "x", "red dog"): (10.0, 2),
                    ("a", "y", "big red dog"): (8.0, 1), ("a", "y", "red dog"): (9.0, 2)}
    scores = spark.createDataFrame([("b", "k", 1.0), ("a", "z", 2.0), ("a", "m", 2.0), ("a", "c", 9.0)], "publisher string, phrase string, score double")
    assert [r.phrase for r in K.ordered_keywords(scores, ["publisher"]).collect()] == ["c", "m", "z", "k"]
    seen = spark.createDataFrame([(1, "a", "x", "p", 5.0, 0), (2, "a", "x", "p", 3.0, 0), (3, "a", "y", "p", 4.0, 0)],
                                 "doc_id int, publisher string, version string, phrase string, score double, first_pos int")
    last = K.last_write_scores(seen, group_cols=["publisher", "version"])
    assert {(r.version, r.score) for r in last.collect()} == {("x", 3.0), ("y", 4.0)}
    assert K.title_scores(titles.limit(0), reviews, stopwords=[]).count() == 0
