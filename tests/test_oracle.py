"""Every registered query against its DuckDB oracle on the smallest data folder."""

import pytest

from lodestar.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle_and_is_registered():
    from __spark_entry__ import oracle_sql, queries
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    n, _, problems = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert not problems, problems


def test_entry_flagship(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns[:3] == ["orgid", "programid", "orgprogramid"]
    assert df.count() == 55
