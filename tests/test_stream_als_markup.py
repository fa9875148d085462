"""Stream without loss, ALS ids of any type, blended weights and real review markup."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from critiq.operators import predict as P
from critiq.session import stage_path
from critiq.streaming.ingest import ingest


@pytest.mark.parametrize("files", [1, 8, 24])
@pytest.mark.parametrize("backwards", [False, True])
def test_stream_equals_batch_for_any_layout(spark, files, backwards):
    run = stage_path(spark, f"stream-{uuid.uuid4().hex}")
    rows = spark.range(600).select("id", (F.col("id") * 86_400).alias("review_ts"))
    runs = [rows.where("id < 400"), rows.where("id >= 200")]  # overlapping; newest first if backwards
    for part in reversed(runs) if backwards else runs:
        part.repartition(files).write.mode("append").parquet(f"{run}/landing")
        got = ingest(spark, f"{run}/landing", rows.schema, ["id"], f"{run}/out", f"{run}/_checkpoint", files_per_trigger=4)
    assert got.count() == 600 and got.distinct().count() == 600


def test_unseen_ids_take_the_mean_factors(spark):
    rng = np.random.default_rng(1)
    rows = [(s, u, i, float(rng.integers(1, 6))) for s in ("A", "B") for u in range(8) for i in range(6) if (u + i) % 3]
    train = spark.createDataFrame(rows, "scope string, user long, item long, rating double")
    predict = P.fit_als_residuals(train, *P.fit_biases(train, 0.05, 2), rank=3, lam=0.05, max_iter=5)
    asked = spark.createDataFrame([(s, u, i, 0.0) for s in ("A", "B") for u in [*range(8), 99] for i in [*range(6), 99]],
                                  "scope string, user long, item long, rating double")
    term = {(r["scope"], r["user"], r["item"]): r["lfm"] - r["model"] for r in predict(asked).collect()}
    for s in ("A", "B"):  # the dot product with a mean vector is the mean of the dot products
        for u in range(8):
            assert term[s, u, 99] == pytest.approx(np.mean([term[s, u, i] for i in range(6)]), abs=1e-9)
        for i in range(6):
            assert term[s, 99, i] == pytest.approx(np.mean([term[s, u, i] for u in range(8)]), abs=1e-9)
    assert any(abs(term[s, u, 99]) > 1e-6 for s in ("A", "B") for u in range(8))


def test_grid_has_a_row_per_setting_scope_and_split(spark, monkeypatch):
    from critiq.plans import predict_queries as Q

    assert {lam for lam, _ in Q.GRID} == {1, 1 / 2, 1 / 3, 1 / 4, 1 / 5}
    monkeypatch.setattr(Q, "GRID", [Q.GRID[0], Q.GRID[-1]])  # two of the settings, for the time that a fit takes
    got = [(r["lam"], r["rank"], r["scope"], r["split"]) for r in Q.q_grid_search(spark, "/root/testdata/sf0.001").collect()]
    scopes = {r["scope"] for r in Q.Ratings(spark, "/root/testdata/sf0.001").rows.select("scope").distinct().collect()}
    assert len(scopes) == 3 and sorted(got) == sorted((*g, s, x) for g in Q.GRID for s in scopes for x in P.SPLITS)


def test_als_takes_string_ids(spark):
    rows = [("A", f"u{u}", f"i{i}", float(1 + (u * i) % 5)) for u in range(12) for i in range(8)]
    train = spark.createDataFrame(rows, "scope string, user string, item string, rating double")
    alpha, ub, ib = P.fit_biases(train)
    predict = P.fit_als_residuals(train, alpha, ub, ib, rank=4, max_iter=3)
    assert predict(train).where("lfm is null or isnan(lfm)").count() == 0
    codes = P._int_codes(train, "user", "uid").select("uid").collect()
    assert sorted(r[0] for r in codes) == list(range(12))


def test_blend_columns(spark):
    row = spark.createDataFrame([(5.0, 3.0)], "m double, b double").select(P.blend(F.col("m"), F.col("b")).alias("x")).first()
    assert row["x"] == pytest.approx(3.6)
