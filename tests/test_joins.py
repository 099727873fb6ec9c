"""Join chain semantics (E1-E6, F1) on literal frames."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.operators.joins import (
    ColumnCollisionError,
    JoinStep,
    chain_output_columns,
    join_chain,
    small_enough,
    left_join,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_null_left_key_survives_left_join_with_null_columns(spark):
    left = frame(spark, [(1, 10), (2, None), (3, None)], "app int, caregiverid int")
    right = frame(spark, [(10, "ann"), (11, "bob")], "caregiverid int, name string")
    out = left_join(left, right, ["caregiverid"])
    assert out.columns == ["app", "caregiverid", "name"]
    assert rows(out) == rows(frame(spark, [(1, 10, "ann"), (2, None, None), (3, None, None)],
                                   "app int, caregiverid int, name string"))


def test_null_keys_never_match_even_if_right_has_null_key(spark):
    left = frame(spark, [(1, None)], "a int, k int")
    right = frame(spark, [(None, "x")], "k int, v string")
    assert rows(left_join(left, right, ["k"])) == [(1, None, None)]
    assert join_chain({"l": left, "r": right}, "l", [JoinStep("r", ("k",))]).count() == 0


def test_left_join_to_prefiltered_right_keeps_inactive_child(spark):
    # The child dimension is filtered (status = 1) before the left join.
    chain = frame(spark, [(1, 100), (2, 200)], "applicationid int, childid int")
    chd_src = frame(spark, [(100, "amy", 1), (200, "ben", 0)], "childid int, name string, status int")
    chd = chd_src.where("status = 1").select("childid", "name")
    out = join_chain({"c": chain, "chd": chd}, "c", [JoinStep("chd", ("childid",), "left")])
    assert rows(out) == [(1, 100, "amy"), (2, 200, None)]


def test_existence_join_with_repeated_keys_does_not_multiply(spark):
    left = frame(spark, [(1, 5), (2, 6)], "orgid int, programid int")
    key_only = frame(spark, [(5,), (5,), (5,), (7,)], "programid int")
    out = join_chain({"l": left, "k": key_only}, "l", [JoinStep("k", ("programid",))])
    assert rows(out) == [(1, 5)]
    # Without set semantics the bag repeats the row once per key copy.
    bag = join_chain({"l": left, "k": key_only}, "l", [JoinStep("k", ("programid",))], dedup=False)
    assert bag.count() == 3


def test_composite_key_and_column_order(spark):
    a = frame(spark, [(1, 10, 100)], "orgprogramid int, applicationid int, childid int")
    b = frame(spark, [(10, 100, "hi", "pa")],
              "applicationid int, childid int, message string, nick string")
    out = join_chain({"a": a, "b": b}, "a", [JoinStep("b", ("childid", "applicationid"))])
    assert out.columns == ["orgprogramid", "applicationid", "childid", "message", "nick"]
    assert rows(out) == [(1, 10, 100, "hi", "pa")]


def test_non_key_collision_raises(spark):
    a = frame(spark, [(1, "x")], "k int, name string")
    b = frame(spark, [(1, "y")], "k int, name string")
    with pytest.raises(ColumnCollisionError):
        join_chain({"a": a, "b": b}, "a", [JoinStep("b", ("k",))])


def test_missing_key_raises(spark):
    a = frame(spark, [(1,)], "k int")
    b = frame(spark, [(1,)], "j int")
    with pytest.raises(KeyError):
        join_chain({"a": a, "b": b}, "a", [JoinStep("b", ("k",))])


def test_step_validation():
    with pytest.raises(ValueError):
        JoinStep("t", ("k",), "outer")
    with pytest.raises(ValueError):
        JoinStep("t", ("k",), "left", broadcast="left")
    with pytest.raises(ValueError):
        JoinStep("t", ("k",), "left", branch=(JoinStep("u", ("j",), "inner"),))
    assert JoinStep("t", "k").on == ("k",)


def test_branch_equals_flat_left_chain(spark):
    chain = frame(spark, [(1, 10), (2, 11), (3, None), (4, 10)], "app int, caregiverid int")
    crg = frame(spark, [(10, 5, 7, "ann"), (11, None, 8, "bob")],
                "caregiverid int, addressid int, contactid int, name string")
    adr = frame(spark, [(5, "main st")], "addressid int, street string")
    cnt = frame(spark, [(7, "a@x"), (8, "b@x")], "contactid int, email string")
    tables = {"c": chain, "crg": crg, "adr": adr, "cnt": cnt}
    flat = [JoinStep("crg", ("caregiverid",), "left"), JoinStep("adr", ("addressid",), "left"),
            JoinStep("cnt", ("contactid",), "left")]
    branched = [JoinStep("crg", ("caregiverid",), "left", broadcast="right", branch=(
        JoinStep("adr", ("addressid",), "left"), JoinStep("cnt", ("contactid",), "left")))]
    a = join_chain(tables, "c", flat)
    b = join_chain(tables, "c", branched)
    assert a.columns == b.columns
    assert rows(a) == rows(b)
    cols = {n: t.columns for n, t in tables.items()}
    assert chain_output_columns(cols, "c", branched) == b.columns


def test_branch_key_shadowed_by_chain_raises(spark):
    chain = frame(spark, [(1, 10, 5)], "app int, caregiverid int, addressid int")
    crg = frame(spark, [(10, "ann")], "caregiverid int, name string")
    adr = frame(spark, [(5, "x")], "addressid int, street string")
    steps = [JoinStep("crg", ("caregiverid",), "left",
                      branch=(JoinStep("adr", ("addressid",), "left"),))]
    with pytest.raises(ColumnCollisionError):
        join_chain({"c": chain, "crg": crg, "adr": adr}, "c", steps)


def test_small_enough_checks_rows_and_bytes(spark):
    df = spark.range(100).selectExpr("cast(id as int) as k", "repeat('x', 10) as s")
    assert small_enough([df], max_rows=100, max_bytes=10_000) == [True]
    assert small_enough([df], max_rows=99) == [False]
    assert small_enough([df], max_rows=1000, max_bytes=100 * 14 - 1) == [False]


def test_broadcast_left_prefix_plan(spark):
    dims = frame(spark, [(1, 100)], "orgid int, orgprogramid int")
    fact = spark.range(1000).selectExpr("cast(100 + id % 3 as int) as orgprogramid",
                                        "cast(id as int) as applicationid")
    out = join_chain({"d": dims, "f": fact}, "d",
                     [JoinStep("f", ("orgprogramid",), broadcast="left")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" in plan
    assert out.count() == 334


keys = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(keys, keys), max_size=12),
       st.lists(st.tuples(keys, st.integers(0, 2)), max_size=8),
       st.lists(st.tuples(keys,), max_size=6))
def test_property_stepwise_distinct_equals_final_distinct(spark, base, right, key_only):
    b = frame(spark, base, "k int, j int")
    r = frame(spark, right, "k int, v int")
    ko = frame(spark, key_only, "j int")
    tables = {"b": b, "r": r, "ko": ko}
    steps = [JoinStep("r", ("k",), "left"), JoinStep("ko", ("j",), "inner")]
    final = join_chain(tables, "b", steps)
    stepwise = join_chain(tables, "b", steps, distinct_after={"r", "ko"}, semi_for_key_only=False)
    assert rows(final) == rows(stepwise)
    # inner + distinct == semi + distinct
    inner = join_chain(tables, "b", steps, semi_for_key_only=False)
    assert rows(inner) == rows(final)


def test_oversized_marked_side_falls_back_to_shuffle_join(spark):
    dims = frame(spark, [(1, 100), (2, 101)], "orgid int, orgprogramid int")
    fact = spark.range(3000).selectExpr("cast(100 + id % 3 as int) as orgprogramid",
                                        "cast(id as int) as applicationid")
    tables = {"d": dims, "f": fact}
    steps = [JoinStep("f", ("orgprogramid",), broadcast="left")]
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = join_chain(tables, "d", steps, max_broadcast_rows=1)
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "BuildLeft" not in plan and "SortMergeJoin" in plan
        small = join_chain(tables, "d", steps)
        assert "BuildLeft" in small._jdf.queryExecution().executedPlan().toString()
        assert rows(big) == rows(small) and len(rows(big)) == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_hot_left_join_key_is_split_by_aqe(spark):
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.enabled": "true",
             "spark.sql.adaptive.skewJoin.enabled": "true",
             "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
             "spark.sql.shuffle.partitions": "16"}
    prev = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        # One child id holds 40% of the rows.
        left = spark.range(400_000).selectExpr(
            "cast(id as int) as applicationid",
            "cast(if(id % 5 < 2, 7, id % 20000) as int) as childid")
        right = spark.range(20000).selectExpr("cast(id as int) as childid", "concat('c', id) as name")
        out = join_chain({"l": left, "r": right}, "l", [JoinStep("r", ("childid",), "left")])
        qe = out._jdf.queryExecution()
        assert qe.executedPlan().execute().count() == 400_000
        assert "SortMergeJoin(skew=true)" in qe.executedPlan().toString()
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_unique_from_equals_stepwise_distinct_with_repeated_rows(spark):
    """Repeated fact and dimension rows: a set after the named step, and deduplicated tables after it."""
    facts = frame(spark, [(1, 5), (1, 5), (2, 6), (3, None), (3, None)], "k int, d int")
    child = frame(spark, [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, "e")], "k int, t string")
    dim = frame(spark, [(5, "x"), (5, "x"), (5, "y"), (6, "z")], "d int, n string")
    steps = [JoinStep("child", ("k",)), JoinStep("dim", ("d",), "left")]
    tables = {"facts": facts, "child": child, "dim": dim}
    want = join_chain(tables, "facts", steps, distinct_after=("child", "dim"))
    got = join_chain(tables, "facts", steps, unique_from="child")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    with pytest.raises(KeyError):
        join_chain(tables, "facts", steps, unique_from="nowhere")
