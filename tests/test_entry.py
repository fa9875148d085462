"""Driver contract: entry() runs, every query has a callable, oracles name registered queries."""

import __spark_entry__ as E
from critiq.plans import all_oracles, all_queries

# Queries without SQL (randomised or iterative with randomised parts): rows-only checks.
NO_ORACLE = {"lfm_rmse", "grid_search", "sentence_scores_minhash", "sgd_grid_search", "cross_publisher_lfm"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3
    assert set(df.columns) == {"publisher", "n_reviews", "n_users", "n_review_items", "n_pooled_items",
                               "mean_rating"}


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # The optional queries come on top; the review queries are there with or without them.
    own, own_oracles = all_queries(), all_oracles()
    assert set(own) <= set(q) and set(own_oracles) <= set(o)
    assert set(own) - set(own_oracles) == NO_ORACLE
    assert len(own) == 58


def test_golden_metrics_sf001(spark):
    df = E.queries()["dataset_metrics_rollup"](spark, "/root/testdata/sf0.01")
    got = {r.publisher: (r.n_reviews, r.n_users, r.n_review_items, r.n_pooled_items, round(r.mean_rating, 6))
           for r in df.collect()}
    assert got == {"PUB_A": (29988, 1500, 1000, 250, 2.992264), "PUB_B": (30012, 1500, 1000, 250, 2.987005),
                   None: (60000, 1500, 2000, 500, 2.989633)}


def test_format_dedup_golden_sf001(spark):
    df = E.queries()["format_dedup"](spark, "/root/testdata/sf0.01")
    st = {r.status: r.c for r in df.groupBy("status").count().withColumnRenamed("count", "c").collect()}
    assert sum(st.values()) == 2500
    assert st["base"] + st["kept"] == 2427
    assert st["dup_of_base"] == 22


def test_stream_matches_batch(spark):
    df = E.queries()["incremental_ingest"](spark, "/root/testdata/sf0.001")
    from critiq.sources import tables
    r = tables.reviews(spark, "/root/testdata/sf0.001")
    assert df.count() == r.count()
    assert df.exceptAll(r.select(*df.columns)).count() == 0
