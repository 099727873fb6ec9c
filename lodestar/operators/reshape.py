"""Wide-to-long unpivot (H1) with missing-value removal.

``DataFrame.unpivot`` runs as an ``Expand`` inside the scan stage: every input
row becomes one output row per value column, with no shuffle. The value
columns must share a type; they are aligned first: all numeric columns widen
to their common numeric type, anything else makes every value a string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
)

_INTEGRAL_RANK = {ByteType: 0, ShortType: 1, IntegerType: 2, LongType: 3}


def common_value_type(types: Sequence[DataType]) -> DataType:
    """The type every value column is cast to before unpivoting."""
    if not types:
        return StringType()
    if not all(isinstance(t, NumericType) for t in types):
        return StringType()
    if any(isinstance(t, (DoubleType, FloatType, DecimalType)) for t in types):
        return DoubleType()
    return max(types, key=lambda t: _INTEGRAL_RANK[type(t)])


def unpivot_values(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                   variable: str, value: str, value_type: DataType | str | None = None,
                   drop_missing: bool = True) -> DataFrame:
    """Long form ``(*ids, variable, value)``; missing values (null, NaN) dropped.

    With no value column the result is the empty long table with that schema.
    """
    ids, values = list(ids), list(values)
    if value_type is None:
        value_type = common_value_type([df.schema[c].dataType for c in values])
    if not values:
        return df.select(*ids, F.lit(None).cast("string").alias(variable),
                         F.lit(None).cast(value_type).alias(value)).where(F.lit(False))
    aligned = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in values])
    long = aligned.unpivot(ids, values, variable, value)
    if drop_missing:
        long = long.na.drop(subset=[value])
    return long
