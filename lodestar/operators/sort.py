"""Ordering (G1, G2).

A global sort range-partitions on the sort key. If one key value holds a
large share of the rows, every row with that value lands in one range
partition and one task. ``sort_rows`` therefore appends the remaining
columns as tie-breakers: the requested order is unchanged (ties had no
defined order anyway), and the range partitioner can cut a hot key across
several tasks because the rows behind it differ. Nulls sort first, as in the
jobs this re-expresses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_rows(df: DataFrame, keys: Sequence[str], tie_break: bool = True) -> DataFrame:
    order = list(keys)
    if tie_break:
        order += [c for c in df.columns if c not in order]
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order])


def sort_within_partitions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Local order only: no shuffle, for outputs that need sorted files, not a total order."""
    return df.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in keys])
