"""Connected components of an edge table, by alternating large and small stars.

Each round hangs the larger neighbours of a node on its smallest one (large
star), then the smaller ones (small star). Minima are partial aggregates and
the joins back are splittable, so a node with very many edges is no single
task's work. Edges shrink to a star on each component's smallest node; the
loop ends when a round changes nothing. Every round is a written stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import stage


def _hang(pairs: DataFrame) -> DataFrame:
    """For directed (u, v): v and the smallest of u and all its v, with u's own row kept."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(spark: SparkSession, edges: DataFrame, root: str, name: str = "cc") -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (u, v); component = smallest node."""
    e = stage(spark, edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                  F.least("u", "v").alias("v")).distinct(),
              root, f"{name}0")
    state, k = None, 0
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state, k = now, k + 1
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_hang(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        small = _hang(large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = stage(spark, small, root, f"{name}{k}")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
