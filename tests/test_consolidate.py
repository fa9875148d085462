"""Hand-made cases for consolidation quirks (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from critiq.operators import consolidate as C
from critiq.sources.tables import LISTING


def _reviews(spark, rows):
    """rows: (publisher, version, vrank, umbrella_item, review_item, user_id, ts)."""
    cols = ["publisher", "version", "vrank", "umbrella_item", "review_item", "user_id", "review_ts"]
    df = spark.createDataFrame(rows, cols)
    return df.select(*cols, F.lit(1.0).alias("rating"), F.col("review_ts").alias("l_orderkey"),
                     F.lit(1).alias("l_linenumber"), F.lit(1).cast("bigint").alias("l_suppkey"),
                     F.lit(1.0).alias("l_extendedprice"))


def test_upsert_replaces_whole_keys(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], ["k", "v"])
    new = spark.createDataFrame([("b", 3), ("b", 4), ("c", 5)], ["k", "v"])
    out = sorted(tuple(r) for r in C.upsert_merge(old, [new], ["k"]).collect())
    assert out == [("a", 1), ("b", 3), ("b", 4), ("c", 5)]


def test_upsert_last_batch_wins(spark):
    old = spark.createDataFrame([("a", 1)], ["k", "v"])
    b1 = spark.createDataFrame([("a", 2), ("b", 3)], ["k", "v"])
    b2 = spark.createDataFrame([("a", 9)], ["k", "v"])
    out = sorted(tuple(r) for r in C.upsert_merge(old, [b1, b2], ["k"]).collect())
    assert out == [("a", 9), ("b", 3)]


def test_merge_conflict_detects_changed_counts(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], ["k", "v"])
    new = spark.createDataFrame([("b", 3), ("b", 4), ("c", 5)], ["k", "v"])
    out = [(r.k, r.n_old, r.n_new) for r in C.merge_conflicts(old, new, ["k"]).collect()]
    assert out == [("b", 1, 2)]


def test_pooled_filter_intersects_titles(spark):
    # t1 = {x, y}, t2 = {x, z}; listing x with reviews on x, y, z keeps only x.
    allow = spark.createDataFrame([("t1", 10), ("t1", 11), ("t2", 10), ("t2", 12)], ["title", "item"])
    r = _reviews(spark, [("P", "Paperback", 0, 10, 10, 1, 1), ("P", "Paperback", 0, 10, 11, 2, 2),
                         ("P", "Paperback", 0, 10, 12, 3, 3)])
    kept = sorted(x.review_item for x in C.pooled_filter(r, allow).collect())
    assert kept == [10]


def test_pooled_filter_leaves_unlisted(spark):
    allow = spark.createDataFrame([("t1", 10), ("t1", 11)], ["title", "item"])
    r = _reviews(spark, [("P", "Paperback", 0, 20, 10, 1, 1), ("P", "Paperback", 0, 20, 20, 2, 2)])
    assert C.pooled_filter(r, allow).count() == 2


def test_pooled_filter_idempotent(spark):
    allow = spark.createDataFrame([("t1", 10), ("t1", 11), ("t2", 10), ("t2", 12)], ["title", "item"])
    r = _reviews(spark, [("P", "Paperback", 0, 10, i, i, i) for i in (10, 11, 12)])
    once = C.pooled_filter(r, allow)
    twice = C.pooled_filter(once, allow)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_format_dedup_case(spark):
    # Paperback p1 sig s, p2 sig s; Kindle k1 sig s, k2 sig t; Omnibus o1 sig t -> keep p1, p2, k2.
    rows = [("P", "Paperback", 0, 1, 100, 7, 1), ("P", "Paperback", 0, 2, 100, 7, 1),
            ("P", "Kindle", 2, 3, 100, 7, 1), ("P", "Kindle", 2, 4, 200, 8, 1),
            ("P", "Omnibus", 3, 5, 200, 8, 1)]
    r = _reviews(spark, rows)
    sigs = C.listing_signatures(r, [F.col("user_id").alias("u"), F.col("review_item").alias("i")])
    st = {x.umbrella_item: x.status for x in C.format_dedup(sigs).collect()}
    assert st == {1: "base", 2: "base", 3: "dup_of_base", 4: "kept", 5: "dup_of_listing"}


def test_first_review_defines_signature(spark):
    r = _reviews(spark, [("P", "Kindle", 2, 3, 100, 7, 5), ("P", "Kindle", 2, 3, 101, 9, 1)])
    sig = C.listing_signatures(r, [F.col("user_id").alias("u")]).first().sig
    assert sig.u == 9


def test_review_dedup_prefers_earliest_version(spark):
    r = _reviews(spark, [("P", "Kindle", 2, 3, 100, 7, 1), ("P", "Paperback", 0, 3, 100, 7, 5)])
    out = C.review_dedup(r).collect()
    assert len(out) == 1 and out[0].version == "Paperback"


def test_resume_plan(spark):
    r = _reviews(spark, [("P", "Paperback", 0, 1, 1, u, u) for u in range(23)])
    row = C.resume_plan(r).first()
    assert (row.n_collected, row.n_kept, row.start_page) == (23, 20, 3)


def test_skip_known_drops_whole_listing(spark):
    known = _reviews(spark, [("P", "Paperback", 0, 1, 1, 5, 1)])
    new = _reviews(spark, [("P", "Kindle", 2, 1, 1, 5, 1), ("P", "Kindle", 2, 1, 2, 6, 2),
                           ("P", "Kindle", 2, 9, 9, 7, 1)])
    out = sorted(x.umbrella_item for x in C.skip_known_items(new, known).collect())
    assert out == [9]


def test_count_reconciliation_and_pending(spark):
    catalog = spark.createDataFrame([("P", "Paperback", 1, 1, 4.0, 3), ("P", "Paperback", 2, 2, 4.0, 5),
                                     ("P", "Paperback", 3, 3, 4.0, 0)],
                                    ["publisher", "version", "rank", "item", "avg_rating", "num_reviews"])
    coll = _reviews(spark, [("P", "Paperback", 0, 1, 1, 1, 1), ("P", "Paperback", 0, 1, 1, 2, 2)])
    rec = {x.item: (x.n_collected, x.shortfall) for x in C.count_reconciliation(catalog, coll).collect()}
    assert rec == {1: (2, 1), 2: (0, 5), 3: (0, 0)}
    pend = [x.item for x in C.pending_items(catalog, coll).collect()]
    assert pend == [2]  # item 3 states zero reviews (F8), item 1 is collected


def test_listing_columns_constant():
    assert LISTING == ["publisher", "version", "umbrella_item"]
