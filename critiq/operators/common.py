"""Small planning helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row count of a table that is broadcast after an explicit check.
MAX_BROADCAST_ROWS = 100_000

# Bytes of text in a partition, about: words and phrases take many times the size of their text.
TEXT_PARTITION = 4 << 20


def dealt_by_size(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` hash-partitioned by ``key`` into as many partitions as the bytes of its texts call for, which one pass counts.

    A number that is given is not reduced by adaptive planning, which goes by the size of
    the texts and not by that of what is made of them.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TEXT_PARTITION)), key)


def row_count_at_most(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> bool:
    """Size check: does ``df`` have at most ``limit`` rows? Reads at most limit + 1 rows."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking its row count; otherwise leave the join
    strategy to the planner (shuffle join, or AQE's measured runtime broadcast).
    Use on materialised (checkpointed) tables, where the check reads stored rows."""
    return F.broadcast(df) if row_count_at_most(df, limit) else df

