"""Projection, name-pattern selection, rename and strict casts."""

import pytest

from lodestar.functions.patterns import matching_columns
from lodestar.operators.projection import (
    cast_keys,
    rename_columns,
    select_by_pattern,
    select_columns,
)
from lodestar.sources.specs import Col, TableSpec, cols


def test_pattern_matches_at_start_case_sensitive():
    names = ["FACILITY", "pca_1", "pca_12abc", "pca_1_total", "pca_total", "xpca_3", "PCA_1",
             "pca_10", "pca_"]
    assert matching_columns(names) == ["pca_1", "pca_12abc", "pca_1_total", "pca_10"]


def test_select_by_pattern_keeps_frame_order(spark):
    df = spark.createDataFrame([(1, 2, 3, "a", 4)], "pca_10 int, pca_2 int, pca_1 int, FACILITY string, xpca_3 int")
    out = select_by_pattern(df, leading=("FACILITY",))
    assert out.columns == ["FACILITY", "pca_10", "pca_2", "pca_1"]


def test_select_columns_missing_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        select_columns(df, ["a", "b"])


def test_rename_keeps_order(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, FACILITY string, b int")
    assert rename_columns(df, {"FACILITY": "facility_name"}).columns == ["a", "facility_name", "b"]
    with pytest.raises(KeyError):
        rename_columns(df, {"nope": "x"})


def test_cast_keys_strict_under_ansi(spark):
    df = spark.createDataFrame([("1", 5), ("2", 6)], "k string, j long")
    out = cast_keys(df, ["k", "j"])
    assert [f.dataType.typeName() for f in out.schema.fields] == ["integer", "integer"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 5), (2, 6)]
    bad = spark.createDataFrame([("x1",)], "k string")
    with pytest.raises(Exception):
        cast_keys(bad, ["k"]).collect()
    too_big = spark.createDataFrame([(1 << 40,)], "k long")
    with pytest.raises(Exception):
        cast_keys(too_big, ["k"]).collect()


def test_table_spec_apply_and_sql(spark):
    spec = TableSpec("inmapp", "r_ab.tblinmateapp",
                     cols("applicationid", "caregiverid", cast="INTEGER"), where="statusid = 1")
    assert spec.to_sql() == ("SELECT CAST(applicationid AS INTEGER) AS applicationid, "
                             "CAST(caregiverid AS INTEGER) AS caregiverid "
                             "FROM r_ab.tblinmateapp WHERE statusid = 1")
    src = spark.createDataFrame([(1, 10, 1, "z"), (2, 20, 0, "z")],
                                "applicationid long, caregiverid long, statusid int, other string")
    out = spec.apply(src)
    assert out.columns == ["applicationid", "caregiverid"]
    assert [tuple(r) for r in out.collect()] == [(1, 10)]
    alias = TableSpec("prg", "p", (Col("programyear", "program_year", "INTEGER"),))
    assert alias.output_columns == ["program_year"]


def test_spec_filter_and_projection_reach_the_scan(spark, workdir):
    path = f"{workdir}/t"
    spark.createDataFrame([(1, 1, "a", "b"), (2, 0, "c", "d")],
                          "id long, status int, x string, y string").write.parquet(path)
    spec = TableSpec("t", "t", (Col("id", cast="int"), Col("x")), where="status = 1")
    plan = spec.apply(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,1)]" in plan
    assert "ReadSchema: struct<id:bigint,status:int,x:string>" in plan
