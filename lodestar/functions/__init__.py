from lodestar.functions.ids import (
    IdCollisionError,
    assert_unique,
    assign_hash_ids,
    assign_ids,
    id_stats,
    with_row_index,
)
from lodestar.functions.patterns import ANSWER_PATTERN, matching_columns

__all__ = [
    "ANSWER_PATTERN",
    "IdCollisionError",
    "assert_unique",
    "assign_hash_ids",
    "assign_ids",
    "id_stats",
    "matching_columns",
    "with_row_index",
]
