from lodestar.operators.aggregate import distinct_rows, group_count, having_more_than, is_empty
from lodestar.operators.joins import (
    ColumnCollisionError,
    JoinStep,
    chain_output_columns,
    join_chain,
    left_join,
    small_enough,
)
from lodestar.operators.projection import (
    cast_keys,
    rename_columns,
    select_by_pattern,
    select_columns,
)
from lodestar.operators.reshape import common_value_type, unpivot_values
from lodestar.operators.sort import sort_rows, sort_within_partitions

__all__ = [
    "ColumnCollisionError",
    "JoinStep",
    "cast_keys",
    "chain_output_columns",
    "common_value_type",
    "distinct_rows",
    "group_count",
    "having_more_than",
    "is_empty",
    "join_chain",
    "left_join",
    "rename_columns",
    "select_by_pattern",
    "select_columns",
    "sort_rows",
    "small_enough",
    "sort_within_partitions",
    "unpivot_values",
]
