"""Unpivot with type alignment and missing-value drop."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from lodestar.operators.reshape import common_value_type, unpivot_values
from lodestar.operators.sort import sort_rows
from lodestar.plans import survey as S


def test_common_value_type():
    assert common_value_type([IntegerType(), LongType()]) == LongType()
    assert common_value_type([IntegerType(), DoubleType()]) == DoubleType()
    assert common_value_type([IntegerType(), StringType()]) == StringType()
    assert common_value_type([]) == StringType()


def test_unpivot_mixed_numeric_types_and_nan(spark):
    df = spark.createDataFrame([("p1", 7, 1, float("nan")), ("p2", 7, None, 2.5)],
                               "participant_id string, survey_id int, pca_1 int, pca_2 double")
    out = unpivot_values(df, ["participant_id", "survey_id"], ["pca_1", "pca_2"],
                         "item_id", "response")
    assert out.schema["response"].dataType == DoubleType()
    assert sorted(tuple(r) for r in out.collect()) == [("p1", 7, "pca_1", 1.0),
                                                       ("p2", 7, "pca_2", 2.5)]


def test_unpivot_with_string_column_becomes_text(spark):
    df = spark.createDataFrame([("p1", 1, "x")], "id string, a int, b string")
    out = unpivot_values(df, ["id"], ["a", "b"], "item_id", "response")
    assert out.schema["response"].dataType == StringType()
    assert sorted(tuple(r) for r in out.collect()) == [("p1", "a", "1"), ("p1", "b", "x")]


def test_unpivot_without_value_columns_is_empty(spark):
    df = spark.createDataFrame([("p1", 1)], "participant_id string, survey_id int")
    out = unpivot_values(df, ["participant_id", "survey_id"], [], "item_id", "response")
    assert out.columns == ["participant_id", "survey_id", "item_id", "response"]
    assert out.count() == 0


def test_melt_sorts_item_ids_as_text(spark):
    df = spark.createDataFrame([("b", 1, 3, 4), ("a", 1, None, 2)],
                               "participant_id string, survey_id int, pca_2 int, pca_10 int")
    out = S.melt(df)
    assert [tuple(r) for r in out.collect()] == [("a", 1, "pca_10", 2), ("b", 1, "pca_10", 4),
                                                 ("b", 1, "pca_2", 3)]


def test_sort_rows_nulls_first_with_tie_breaks(spark):
    df = spark.createDataFrame([(2, "b"), (None, "z"), (1, "c"), (1, "a")], "k int, v string")
    assert [tuple(r) for r in sort_rows(df, ["k"]).collect()] == [
        (None, "z"), (1, "a"), (1, "c"), (2, "b")]


answers = st.one_of(st.none(), st.integers(1, 5))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(answers, answers, answers), max_size=15))
def test_property_long_rows_equal_wide_cells_minus_nulls(spark, data):
    wide = [(f"p{i}", 1, *r) for i, r in enumerate(data)]
    df = spark.createDataFrame(wide, "participant_id string, survey_id int, pca_1 int, pca_2 int, pca_3 int")
    out = S.melt(df, sort=False)
    assert out.count() == sum(v is not None for r in data for v in r)


def test_melt_is_totally_ordered_across_partitions(spark):
    wide = spark.range(3000).selectExpr(
        "cast(id * 7919 % 3001 as string) as participant_id", "cast(id % 5 as int) as survey_id",
        "cast(id % 4 as int) as pca_1", "if(id % 3 = 0, null, cast(id % 6 as int)) as pca_10",
        "cast(id % 2 as int) as pca_2").repartition(13)
    got = [tuple(r) for r in S.melt(wide).collect()]
    assert got == sorted(got, key=lambda r: (r[0], r[2], r[1], r[3]))
    assert len(got) == 3000 * 3 - 1000
