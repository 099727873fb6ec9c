"""Ranges of equal row counts for database reads (A1, J1): the rendered SQL and conditions; no database is read."""

import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.plans.warehouse import FACT_SPLITS, WAREHOUSE_SOURCES
from lodestar.sources.jdbc import range_predicates, tiles_sql
from lodestar.sources.specs import TableSpec, cols


def test_tiles_query():
    spec = {s.name: s for s in WAREHOUSE_SOURCES}["inmapp"]
    column = FACT_SPLITS["inmapp"]
    assert tiles_sql(spec, column, 8) == (
        f"SELECT MIN(v) AS lo FROM (SELECT {column} AS v, NTILE(8) OVER (ORDER BY {column}) AS tile "
        f"FROM ({spec.to_sql()}) AS inmapp_all WHERE {column} IS NOT NULL) AS inmapp_tiles GROUP BY tile")
    with pytest.raises(ValueError):
        tiles_sql(spec, "nowhere", 8)


def test_predicates():
    assert range_predicates("k", []) == range_predicates("k", [5]) == ["1 = 1"]
    assert range_predicates("k", [7, 1, 4]) == ["k < 4 OR k IS NULL", "k >= 4 AND k < 7", "k >= 7"]
    assert range_predicates("k", [1, 4, 4, 4, 9]) == ["k < 4 OR k IS NULL", "k >= 4 AND k <= 4", "k > 4 AND k < 9", "k >= 9"]
    assert range_predicates("k", [1, 1]) == ["k < 1 OR k IS NULL", "k >= 1 AND k <= 1", "k > 1"]
    assert range_predicates("k", ["a", "o'b"]) == ["k < 'o''b' OR k IS NULL", "k >= 'o''b'"]


def holds(predicate, k):
    """A condition of the forms above in plain Python."""
    def one(part):
        name, op, value = part.split(" ", 2)
        if value == "NULL":
            return k is None
        return k is not None and {"<": k < int(value), "<=": k <= int(value), ">": k > int(value), ">=": k >= int(value)}[op]
    return predicate == "1 = 1" or any(all(one(p) for p in part.split(" AND ")) for part in predicate.split(" OR "))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-9, 9), max_size=9), st.one_of(st.none(), st.integers(-12, 12)))
def test_every_row_is_in_exactly_one_range(firsts, k):
    assert sum(holds(p, k) for p in range_predicates("k", firsts)) == 1


def test_ranges_of_a_skewed_column_are_even(spark):
    """Half the keys are one value, the rest are unevenly spread: no range but the hot value's is large."""
    rng = random.Random(1)
    keys = [100] * 5000 + [int(rng.paretovariate(0.4)) % 10**9 + 200 for _ in range(5000)] + [None] * 30
    spec = TableSpec("t", "source", cols("k"))
    con = duckdb.connect()
    con.execute("CREATE TABLE source AS SELECT unnest(?::BIGINT[]) AS k", [keys])
    firsts = [r[0] for r in con.execute(tiles_sql(spec, "k", 16)).fetchall()]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    sizes = df.agg(*[F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(range_predicates("k", firsts))]).first()
    assert sum(sizes) == len(keys)
    assert sorted(sizes)[-1] == 5000 and sorted(sizes)[-2] <= 2 * len(keys) / 16
