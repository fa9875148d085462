"""What a query moves and holds grows with its input: listings that move once, signatures read once, landing files by size."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from critiq.operators import consolidate as C
from critiq.operators import metrics
from critiq.plans import consolidate_queries as Q
from critiq.plans import metrics_queries, stream_queries
from critiq.session import size_partitions, stage_path, table_bytes
from critiq.sources.tables import LISTING
from critiq.streaming.ingest import ingest

SF = "/root/testdata/sf0.001"
ORDER = ["review_ts", "seq"]


def listings(spark):
    """Listings of 1 to 34 rows with equal rows, rows without a place in the order, and listings without a name."""
    rows = [("P", "V", n, j // 2, j, float(j)) for n in range(1, 35) for j in range(n)]
    rows += [("P", "V", 33, 16, 32, 99.0)] * 3 + [("P", "V", 12, None, 5, 1.0), ("P", "V", 12, 9, None, 2.0)]
    rows += [("P", None, 7, j, j, 0.0) for j in range(14)] + [(None, "V", None, 1, 1, 0.0)]
    return spark.createDataFrame(rows, "publisher string, version string, umbrella_item int, review_ts long, seq int, rating double").repartition(5)


@pytest.mark.parametrize("long_listing", [0, 15, 10**9])
def test_kept_rows_of_ordinary_and_long_listings_are_the_same(spark, long_listing):
    rows = listings(spark)
    key = lambda df: sorted(map(str, df.collect()))
    want = C._kept_of_long(rows, 10, ORDER)
    got = C.kept_rows(rows, order=ORDER, long_listing=long_listing)
    assert got.columns == want.columns and key(got) == key(want) and 0 < got.count() < rows.count()


def test_partial_resume_moves_the_whole_reviews_by_listing_once(spark):
    plan = Q.q_partial_resume_rows(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan[:plan.index("Join LeftAnti")].count("Window [") == 2  # places and sizes of listings from the same rows


def test_signatures_are_computed_once(spark):
    for query in (Q.q_format_dedup, Q.q_blocked_items):
        plan = query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "min_by" not in plan
    stored = {tuple(r) for r in Q._signatures(spark, SF).collect()}
    assert stored == {tuple(r) for r in C.listing_signatures(Q.tables.reviews(spark, SF), Q.fixture_signature()).collect()} and stored


def test_runs_land_in_few_files_and_settings_stay(spark):
    run = stage_path(spark, f"land-{uuid.uuid4().hex}")
    rows = spark.range(400).select("id", (F.col("id") * 86_400 * 5).alias("review_ts")).repartition(12)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    stream_queries.land_overlapping_runs(rows, f"{run}/landing", tasks=2)
    assert spark.conf.get(name) == before
    files = [f for _, _, names in os.walk(f"{run}/landing".removeprefix("file:")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 7
    assert spark.read.parquet(f"{run}/landing").count() == 800
    got = ingest(spark, f"{run}/landing/run=*", rows.schema, ["id"], f"{run}/out", f"{run}/_checkpoint", files_per_trigger=8,
                 state_partitions=2, count_keys=False)
    assert got.count() == 400 and got.exceptAll(rows).isEmpty()


def test_bytes_of_tables(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 10)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "c").write_bytes(b"x" * 7)
    assert table_bytes(spark, str(tmp_path / "a"), str(tmp_path / "b")) == 17


def test_stages_of_distinct_counts_are_dealt_by_the_input(spark, tmp_path):
    """A stage that gathers distinct ids reads at most about the advised bytes, however many there are."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                             "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
              if spark.conf.get(k, None)}
    with open(tmp_path / "t", "wb") as f:
        f.truncate(400 << 20)
    try:
        size_partitions(spark, str(tmp_path))
        for query in (metrics_queries.q_user_union, metrics_queries.q_dataset_metrics_rollup):
            plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" in plan and ", 100)" in plan and ", 4)" not in plan
    finally:
        for k in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                  "spark.sql.files.maxPartitionBytes"):
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_a_review_is_copied_once_per_set_for_the_distinct_counts(spark):
    """distinct counts over a rollup made eight rows of a review before any was folded."""
    plan = metrics_queries.q_dataset_metrics_rollup(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    expands = [line for line in plan.splitlines() if "Expand [" in line]
    assert len(expands) == 1 and expands[0].count("], [") == 3  # three rows of a review, then the names
    assert plan.count("Join Inner") == 1  # the reviews are read once


def test_metrics_of_null_and_repeated_ids_are_those_of_the_rollup(spark):
    rows = [("A", 1, "x", 4, 5.0), ("A", 1, "x", 4, 4.0), ("A", None, "y", 8, None), ("B", 1, "x", 4, 1.0), ("B", 2, None, None, 2.5),
            (None, 3, "z", 4, 3.0), (None, None, None, 12, None), ("C", None, None, None, None)]
    df = spark.createDataFrame(rows, "publisher string, user_id int, review_item string, umbrella_item long, rating double").repartition(3)
    want = df.rollup("publisher").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.countDistinct("user_id").alias("n_users"), F.countDistinct("review_item").alias("n_review_items"),
        F.countDistinct("publisher", "umbrella_item").alias("n_pooled_items"), F.round(F.avg("rating"), 6).alias("mean_rating"))
    got = metrics.dataset_metrics(df)
    key = lambda d: sorted(map(str, d.collect()))
    assert got.dtypes == want.dtypes and key(got) == key(want) and len(key(got)) == 5
    none = df.where("false")
    assert key(metrics.dataset_metrics(none)) == key(none.rollup("publisher").agg(F.count(F.lit(1))))
