"""Incremental review ingestion with Structured Streaming (S8, J3, J5, J7 as a stream; Q40).

Collection runs drop review files into a landing folder; runs overlap, so a review can
arrive several times. The stream reads the folder (new files only), keeps the first
arrival of every key and appends it to the review table.

Which keys have arrived is keyed state in RocksDB: a micro-batch looks up its own keys
and nothing else, so its cost follows the batch, not the table or the number of batches
before it; the table is only appended to. State and progress lie in the stream's
checkpoint folder, the table's commits in its own log, so a batch that runs again after
a failure adds nothing twice.

There is no watermark: event times say when a review was written, not when it arrived,
so a watermark would discard reviews of older files. ``trigger(availableNow=True)``
processes everything present and stops; a later run goes on from there.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None, count_keys: bool = True) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB; the caller's settings stay as they are.

    The number of state partitions is fixed by a stream's first run. Without ``count_keys`` a
    new key is not looked up a second time to keep the number of keys that progress reports.
    """
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Each batch uploads the changes of its keys, not the whole state.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", str(count_keys).lower())
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def ingest(spark: SparkSession, landing: str, schema: StructType, key: Sequence[str], target: str,
           checkpoint: str, files_per_trigger: int | None = None, state_partitions: int | None = None,
           progress: list[dict] | None = None, count_keys: bool = True) -> DataFrame:
    """Run the ingest stream over everything in ``landing`` and return the review table.

    ``files_per_trigger`` bounds a micro-batch; it does not change the result. ``progress``
    takes what each micro-batch reported; ``count_keys`` keeps the number of keys in it.
    """
    own = stream_session(spark, state_partitions, count_keys)
    reader = own.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(landing).dropDuplicates(list(key))
    q = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if progress is not None:
        progress += [json.loads(p.json) for p in q.recentProgress]
    return spark.read.schema(schema).parquet(target)
