"""Mergeable distinct counts: sets of any ids, merging, plans without Expand, sketches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from critiq.operators import metrics as M

SCHEMA = "publisher string, user_id long, review_item long, umbrella_item long, rating double"


def rows_of(df):
    return sorted((tuple(r[c] for c in ("publisher", "n_reviews", "n_users", "n_review_items", "n_pooled_items", "mean_rating")) for r in df.collect()),
                  key=repr)


@pytest.fixture(scope="module")
def reviews(spark):
    rng = np.random.default_rng(0)
    rows = [(str(rng.choice(["A", "B", "C"])), int(rng.integers(0, 70_000)), int(rng.integers(-40_000, 40_000)), int(rng.integers(0, 50)) * 32_768,
             float(rng.integers(1, 6))) for _ in range(3000)]
    return spark.createDataFrame(rows, SCHEMA).checkpoint()


def test_equal_to_distinct_counts(spark, reviews):
    whole = rows_of(M.dataset_metrics(reviews))
    assert rows_of(M.dataset_metrics_merged(M.metric_state(reviews))) == whole
    parts = [M.metric_state(reviews.where(f"pmod(user_id, 3) = {i}")) for i in range(3)]
    assert rows_of(M.dataset_metrics_merged(*parts)) == whole


def test_no_expand(reviews):
    state = M.distinct_state(reviews, "publisher", ["user_id", "review_item"])
    counts = M.distinct_counts(M.merge_states(state, state), "publisher", {"user_id": "u", "review_item": "i"}, ["user_id"])
    assert "Expand" not in counts._jdf.queryExecution().executedPlan().toString()


def test_nulls_and_empty(spark):
    rows = spark.createDataFrame([("A", None, 0, 1, None), ("A", 0, None, 1, 4.0), ("B", 32_768, 5, None, 2.0)], SCHEMA)
    got = {r[0]: r[1:] for r in rows_of(M.dataset_metrics_merged(M.metric_state(rows)))}
    assert got == {"A": (2, 1, 1, 1, 4.0), "B": (1, 1, 1, 0, 2.0), None: (3, 2, 2, 1, 3.0)}
    none = M.dataset_metrics_merged(M.metric_state(rows.limit(0))).collect()
    assert [r["n_reviews"] for r in none] in ([], [None])


def test_dictionary_of_any_ids(spark):
    rows = spark.createDataFrame([(f"user-{i % 500}", "A" if i % 2 else "B") for i in range(2000)] + [(None, "A")], "user string, publisher string").repartition(7)
    codes = M.dense_codes(rows, "user")
    assert sorted(r["code"] for r in codes.collect()) == list(range(500))
    state = M.distinct_state(rows.join(codes, "user", "left"), "publisher", ["code"])
    assert {r["publisher"]: r["n"] for r in M.distinct_counts(state, "publisher", {"code": "n"}, ["code"]).collect()} == {"A": 250, "B": 250, None: 500}


def test_sketches_merge(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("publisher"), (F.col("id") % 15_000).alias("user"))
    parts = [M.sketch_state(rows.where(f"id % 4 = {i}"), "publisher", ["user"]) for i in range(4)]
    by = {r["publisher"]: r["user"] for r in M.sketch_counts(M.merge_sketches("publisher", *parts)).collect()}
    assert all(abs(n - 7500) < 0.03 * 7500 for n in by.values()) and len(by) == 2
    assert abs(M.sketch_counts(M.merge_sketches(None, *parts)).first()["user"] - 15_000) < 0.03 * 15_000
