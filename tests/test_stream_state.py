"""The ingest stream's keyed state: many small files, cost of a batch, runs that go on, null keys."""

import os
import uuid

from pyspark.sql import functions as F

from critiq.session import stage_path
from critiq.streaming.ingest import ROCKSDB, ingest, stream_session


def test_two_hundred_files_and_flat_cost(spark):
    run = stage_path(spark, f"state-{uuid.uuid4().hex}")
    rows = spark.range(4000).select("id", (F.col("id") % 7).alias("v"))
    both = rows.unionByName(rows.where("id % 2 = 0"))  # half of the keys twice
    both.repartition(200).write.parquet(f"{run}/landing")
    progress = []
    got = ingest(spark, f"{run}/landing", rows.schema, ["id"], f"{run}/out", f"{run}/_checkpoint", files_per_trigger=20, state_partitions=2,
                 progress=progress)
    assert got.exceptAll(rows).isEmpty() and got.count() == 4000
    batches = [p for p in progress if p["numInputRows"]]
    assert len(batches) == 10 and sum(p["numInputRows"] for p in batches) == 6000
    ops = [p["stateOperators"][0] for p in batches]
    assert ops[-1]["numRowsTotal"] == 4000 and any("rocksdb" in k.lower() for k in ops[0]["customMetrics"])
    # A batch touches its own keys: reads from the state follow its rows, not the 4,000 that are held.
    gets = [o["customMetrics"]["rocksdbGetCount"] for o in ops]
    assert all(g <= 4 * p["numInputRows"] + 8 for g, p in zip(gets, batches))
    puts = [o["numRowsUpdated"] for o in ops]
    assert sum(puts) == 4000


def test_goes_on_where_it_stopped_and_repeats_nothing(spark):
    run = stage_path(spark, f"state-{uuid.uuid4().hex}")
    schema = "a long, b string, v int"
    first = spark.createDataFrame([(1, "x", 1), (1, None, 2), (None, None, 3), (None, None, 4)], schema)
    second = spark.createDataFrame([(1, "x", 9), (2, "y", 5), (1, None, 9)], schema)
    first.coalesce(1).write.mode("append").parquet(f"{run}/landing")
    ask = (spark, f"{run}/landing", first.schema, ["a", "b"], f"{run}/out", f"{run}/_checkpoint")
    assert ingest(*ask).count() == 3
    second.coalesce(1).write.mode("append").parquet(f"{run}/landing")
    for _ in range(2):  # the second time nothing is new
        got = {(r["a"], r["b"]): r["v"] for r in ingest(*ask).collect()}
        assert len(got) == 4 and got[1, "x"] == 1 and got[1, None] == 2 and got[2, "y"] == 5 and got[None, None] in (3, 4)


def test_rows_of_a_batch_that_died_are_not_read(spark):
    run = stage_path(spark, f"state-{uuid.uuid4().hex}")
    rows = spark.range(50)
    rows.coalesce(2).write.parquet(f"{run}/landing")
    ask = (spark, f"{run}/landing", rows.schema, ["id"], f"{run}/out", f"{run}/_checkpoint")
    ingest(*ask)
    spark.range(7).coalesce(1).write.parquet(f"{run}/stray")  # a file that no commit of the table names
    out = f"{run}/out".removeprefix("file:")
    stray = next(f for f in os.listdir(f"{run}/stray".removeprefix("file:")) if f.endswith(".parquet"))
    with open(f"{run}/stray/{stray}".removeprefix("file:"), "rb") as a, open(f"{out}/part-stray.parquet", "wb") as b:
        b.write(a.read())
    assert ingest(*ask).count() == 50


def test_settings_of_the_caller_stay(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    own = stream_session(spark, 3)
    assert own.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB != before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before and own.conf.get("spark.sql.shuffle.partitions") == "3"
