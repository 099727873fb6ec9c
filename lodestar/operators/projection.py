"""Projection and schema operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.patterns import ANSWER_PATTERN, matching_columns


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Projection by list (C1); raises on a missing name."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*columns)


def select_by_pattern(df: DataFrame, pattern: str = ANSWER_PATTERN,
                      leading: Sequence[str] = ()) -> DataFrame:
    """``leading`` columns, then every column the pattern matches at its start."""
    picked = [c for c in matching_columns(df.columns, pattern) if c not in leading]
    return select_columns(df, [*leading, *picked])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename in place, keeping column order (C4)."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.withColumnsRenamed(dict(mapping))


def cast_keys(df: DataFrame, columns: Iterable[str], to: str = "int") -> DataFrame:
    """Strict cast of key columns.

    With ANSI mode (the Spark 4 default) a value that does not fit raises
    instead of turning into null.
    """
    cols = list(columns)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.withColumns({c: F.col(c).cast(to) for c in cols})
