"""Spark session settings shared by the library, the tests and the benchmark.

The library never creates its own temporary storage on a cluster: the checkpoint
folder is taken from ``spark.checkpoint.dir``. Only when that setting is absent
(local tests, the benchmark) is a scratch folder under /tmp used.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC for epoch arithmetic, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast conversion
# from measured sizes).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Runtime broadcast only for sides AQE has measured below 32 MB.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Shuffle files go when the execution that wrote them ends: loops store what they read again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "critiq") -> SparkSession:
    """Create (or reuse) a session with the library's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("CRITIQ_DRIVER_MEM", "16g"))
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only if none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
    store); it is used as is. A machine-local folder is chosen only when the
    setting is missing, which happens in local tests and benchmarks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share; "
                         "a machine-local folder is chosen on a local master only")
    if current:
        return current
    if not configured:
        configured = tempfile.mkdtemp(prefix="critiq-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Bytes of a shuffled partition and of a split of a file, about: what a task makes of them takes many times as much.
PARTITION_BYTES = 16 << 20
#: Input bytes for each partition that a shuffle starts with; adaptive planning joins those that turn out small.
INPUT_PER_PARTITION = 4 << 20


def table_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below ``paths``."""
    places = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in places)


def size_partitions(spark: SparkSession, sf_dir: str) -> None:
    """Let the number of partitions follow the input, so that a task's memory does not."""
    size = table_bytes(spark, sf_dir)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, -(-size // INPUT_PER_PARTITION))))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(PARTITION_BYTES))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(PARTITION_BYTES))


def stage_path(spark: SparkSession, name: str) -> str:
    """Folder for a materialised intermediate table, inside the checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/stages/{name}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the checkpoint folder and read back (fresh lineage); ``drop`` deletes it."""
    path = stage_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_path = path
    return out


def drop(*kept: DataFrame) -> None:
    """Delete tables that ``keep`` wrote and no later step reads; other tables stay."""
    for df in kept:
        if path := getattr(df, "_kept_path", None):
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
