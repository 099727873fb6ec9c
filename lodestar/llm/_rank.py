"""Positions of rows in an order within each tree (group), as distributed prefix sums.

Rows are range-sorted by group and order, so a hot group spreads over many
partitions; a count of each (partition, group) and a running sum over those
counts give every partition its offset. The only window runs over one row a
(partition, group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm._common import shuffle_partitions, small, stage

#: (partition, group) counts up to this many rows are broadcast to the rows.
MAX_BROADCAST_RUNS = 200_000


def ranked(spark: SparkSession, rows: DataFrame, group: str, order: Sequence, root: str, name: str) -> DataFrame:
    """The columns of ``rows`` and ``pos`` (long, from 0 in each ``group``, not null) and ``group_rows``.

    ``order`` are columns or sort expressions such as ``F.asc_nulls_first("turn")``;
    they should tell different rows apart, since equal ones are numbered in any order.
    """
    keys = [F.col(group), *order]
    runs = stage(spark, rows.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
                 .withColumn("rank_part", F.spark_partition_id())
                 .withColumn("rank_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
                 root, f"{name}-runs")
    counts = runs.groupBy(group, "rank_part").agg(F.count("*").alias("rank_n"), F.min("rank_at").alias("rank_0"))
    before = Window.partitionBy(group).orderBy("rank_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(spark, counts.withColumn("rank_before", F.coalesce(F.sum("rank_n").over(before), F.lit(0)))
                    .withColumn("group_rows", F.sum("rank_n").over(Window.partitionBy(group)))
                    .drop("rank_n"), root, f"{name}-offsets")
    return (runs.join(small(offsets, MAX_BROADCAST_RUNS), [group, "rank_part"])
            .withColumn("pos", F.col("rank_at") - F.col("rank_0") + F.col("rank_before"))
            .select(*rows.columns, "pos", "group_rows"))
