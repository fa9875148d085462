"""Registered streaming query and its DuckDB oracle.

Collection runs that overlap are landed from the whole review table: each year is
a run that holds that year and the year before, so every review arrives twice. After
the idempotent merge the final table must equal the review table exactly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.plans.oracle_views import with_views
from critiq.session import stage_path, table_bytes
from critiq.sources import tables
from critiq.streaming.ingest import ingest

# A review is identified by these columns (unique at every scale, FIXTURES.md §2).
REVIEW_KEY = ["l_orderkey", "l_linenumber", "review_item", "l_suppkey", "l_extendedprice"]
FILES_PER_TRIGGER = 8
# Input bytes behind a task that lands runs: it writes a file per run, and a micro-batch costs as much for a small file.
INPUT_PER_LANDING_TASK = 64 << 20
# Files that a landing task holds open, each filled as rows come; rows of more runs than that are sorted first.
OPEN_RUNS = 16
# State partitions for each task that can run: a micro-batch opens and commits the store of every one.
STATE_PER_CORE = 4


def land_overlapping_runs(reviews: DataFrame, landing: str, ts_col: str = "review_ts", tasks: int | None = None) -> None:
    """Write all runs in one job: a folder per run, each review in its year's run and the next.

    At most ``tasks`` files are written for a run.
    """
    year = F.year(F.timestamp_seconds(ts_col))
    rows = reviews.withColumn("run", F.explode(F.array(year, year + 1)))
    conf, name = reviews.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(OPEN_RUNS))
    try:
        (rows.coalesce(tasks) if tasks else rows).write.partitionBy("run").parquet(landing)
    finally:
        conf.set(name, before)


def q_incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    reviews = tables.reviews(spark, sf)
    run = stage_path(spark, f"ingest-{uuid.uuid4().hex}")
    cores = spark.sparkContext.defaultParallelism
    size = table_bytes(spark, *(f"{sf.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders")))
    land_overlapping_runs(reviews, f"{run}/landing", tasks=max(cores, -(-size // INPUT_PER_LANDING_TASK)))
    return ingest(spark, f"{run}/landing/run=*", reviews.schema, REVIEW_KEY, f"{run}/reviews", f"{run}/_checkpoint",
                  files_per_trigger=FILES_PER_TRIGGER, state_partitions=STATE_PER_CORE * cores, count_keys=False)


QUERIES = {"incremental_ingest": q_incremental_ingest}

ORACLE = {"incremental_ingest": with_views(["reviews"], "SELECT * FROM reviews")}
