"""Distinct, grouped counts and HAVING filters.

All of these are hash aggregations with a partial (map-side) step, so a key
that holds a large share of the rows is collapsed inside each map task before
the shuffle; no group is ever gathered whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct; nulls compare equal (F1)."""
    return df.distinct()


def group_count(df: DataFrame, keys: Sequence[str], count_of: str,
                alias: str = "count") -> DataFrame:
    """Group by ``keys`` and count the non-null values of ``count_of`` (F2).

    A group whose ``count_of`` values are all null counts 0.
    """
    return df.groupBy(*keys).agg(F.count(F.col(count_of)).alias(alias))


def having_more_than(df: DataFrame, column: str = "count", threshold: int = 1) -> DataFrame:
    """Keep groups whose count exceeds ``threshold`` (D3)."""
    return df.where(F.col(column) > F.lit(threshold))


def is_empty(df: DataFrame) -> bool:
    """Emptiness test (F5); reads at most one row."""
    return df.isEmpty()
