"""Connected components of an edge table by star contraction.

Large-star and small-star steps move every edge towards the smallest id around it
until all edges are (id, smallest id of its component), which one grouped count of
each id's roles tells, so edges that are such stars already take no round. Each step
is one grouped minimum and one join, both on ids; the minimum is taken in every task
first and the join is an equi-join that adaptive execution may split, so a centre with
very many neighbours does not meet in one task. Every round is written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import Stages


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b); the result has a > b."""
    if large:
        ends = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = ends.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether edges (a, b), a > b, are stars: every a has one b, and no b is an a."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    roles = ends.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return roles.where("leaf > 1 or leaf = 1 and centre = 1").count() == 0


def components(edges: DataFrame, stages: Stages, max_rounds: int = 60) -> DataFrame:
    """id, component (smallest id that can be reached) of every id in ``edges`` (a, b)."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stages.save(now, "edges")
    for _ in range(max_rounds):
        if _settled(now):
            break
        after = stages.save(_star(_star(now, True), False), "star")
        stages.drop(now)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
