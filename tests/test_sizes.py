"""Sizes from parquet footers and the broadcast decisions made from them."""

import pytest
from pyspark.sql import functions as F

from lodestar.operators import joins as J
from lodestar.operators.joins import JoinStep, join_chain
from lodestar.plans import survey as S
from lodestar.plans import warehouse as W
from lodestar.plans.fixtures import FIXTURE_WAREHOUSE, Fixtures
from lodestar.sources import sizes as Z
from lodestar.sources.files import write_parquet
from lodestar.sources.published import publish
from lodestar.sources.specs import Col, TableSpec

SF = "/root/testdata/sf0.001"


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def counted(df):
    r = df.agg(F.count(F.lit(1)), F.sum(J._value_bytes(df))).first()
    return Z.TableSize(r[0], r[1])


def test_footers_give_rows_and_value_bytes(spark, workdir):
    df = spark.range(1000).selectExpr("id", "cast(id as int) k", "concat('é', id % 7) repeated", "if(id % 3 = 0, null, uuid()) t")
    path = write_parquet(df.repartition(3), f"{workdir}/t")
    back = spark.read.schema(df.schema).parquet(path)
    before = jobs(spark)
    size = Z.folder_size(spark, path, back.schema)
    assert jobs(spark) == before
    assert size == counted(back)
    assert size.fits(1000, size.bytes) and not size.fits(999, size.bytes) and not size.fits(1000, size.bytes - 1)


def test_every_benchmark_spec_is_bounded(spark):
    fx = Fixtures(spark, SF)
    sizes = fx.sizes()
    for spec in FIXTURE_WAREHOUSE:
        size = sizes(spec.name)
        if spec.name == "orgprgchdj":  # a join of tables
            assert size is None
            continue
        real = counted(fx.table(spec.name))
        assert size.rows >= real.rows and size.bytes >= real.bytes, spec.name


def test_unknown_sizes(spark, workdir, monkeypatch):
    path = write_parquet(spark.range(10).selectExpr("cast(id as string) s"), f"{workdir}/t")
    schema = spark.read.parquet(path).schema
    assert Z.folder_size(spark, f"{workdir}/none", schema) is None
    spec = TableSpec("t", "t", (Col("concat(s, s)", "s"),))
    assert Z.size_of(Z.parquet_stats(spark, path), schema, spec) is None  # text that is computed
    assert Z.size_of(Z.ParquetStats(5, {"s": None}), schema) is None  # files of an older writer
    monkeypatch.setattr(Z, "MAX_FILES", 0)
    assert Z.folder_size(spark, path, schema) is None


def test_joins_are_bounded_by_products(spark):
    a = spark.createDataFrame([(1, "xx"), (1, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "zzz"), (1, ""), (2, "q")], "k int, b string")
    sa, sb = counted(a), counted(b)
    for how in ("inner", "left"):
        real = counted(a.join(b, "k", how))
        bound = sa.joined(sb, how)
        assert bound.rows >= real.rows and bound.bytes >= real.bytes
    assert sa.joined(Z.TableSize(0, 0), "left") == sa and sa.joined(sb, "semi") == sa


def published_tables(spark, root):
    fx = Fixtures(spark, SF)
    made = {s.name: publish(fx.table(s.name), f"{root}/{s.name}") for s in FIXTURE_WAREHOUSE}
    return {n: v.read(spark) for n, v in made.items()}, W.version_sizes(spark, made)


def test_chain_is_built_without_a_job(spark, workdir):
    tables, sizes = published_tables(spark, workdir)
    before = jobs(spark)
    df = W.denormalize(tables, sizes=sizes)
    assert jobs(spark) == before
    want = W.denormalize(tables)  # counts the marked sides
    assert jobs(spark) > before
    assert df.columns == want.columns == W.chain_columns()
    assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect()))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = W.denormalize(tables, sizes=sizes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    # the prefix, the inmates, the caregivers with address and contact each for itself, and the children
    assert plan.count("BroadcastHashJoin") >= 6 and "BuildLeft" in plan


def test_survey_is_built_without_a_job_and_is_a_set(spark, workdir):
    answers = spark.createDataFrame([("a", "S", 1), ("a", "S", 1), ("a", "S", 2), ("b", None, 3)],
                                    "participant_id string, facility_name string, pca_1 int")
    made = {"correction_sites": publish(spark.createDataFrame([("S", 1), ("S", 1)], "facility_name string, facility_id int"),
                                        f"{workdir}/sites"),
            "survey": publish(spark.createDataFrame([(1, 7), (1, 7), (1, 8)], "facility_id int, survey_id int"), f"{workdir}/survey")}
    tables = {"pca": answers, **{n: v.read(spark) for n, v in made.items()}}
    before = jobs(spark)
    out = S.melt_of_tables(tables, sizes=W.version_sizes(spark, made))
    assert jobs(spark) == before
    assert sorted(map(tuple, out.collect())) == [("a", 7, "pca_1", 1), ("a", 7, "pca_1", 2), ("a", 8, "pca_1", 1), ("a", 8, "pca_1", 2)]
    assert sorted(map(tuple, S.melt(S.survey_join(tables, base_unique=False)).collect())) == sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("known", [True, False])
def test_sizes_decide_as_counting_does(spark, known):
    dims = spark.createDataFrame([(1, 100), (2, 101)], "orgid int, orgprogramid int")
    fact = spark.range(3000).selectExpr("cast(100 + id % 3 as int) orgprogramid", "cast(id as int) applicationid")
    steps = [JoinStep("f", ("orgprogramid",), broadcast="left")]
    sizes = Z.sizes_of({"d": lambda: counted(dims)}) if known else Z.no_sizes
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(**kw):
            return join_chain({"d": dims, "f": fact}, "d", steps, sizes=sizes, **kw)._jdf.queryExecution().executedPlan().toString()
        assert "BuildLeft" in plan() and "BuildLeft" not in plan(max_broadcast_rows=1)
        assert "BuildLeft" not in plan(max_broadcast_bytes=15) and "BuildLeft" in plan(max_broadcast_bytes=16)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_arm_of_small_and_unknown_tables(spark):
    """An arm is joined table by table if all its tables are small, else at its own size: the same rows."""
    chain = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 12), (4, 12)], "app int, caregiverid int")
    crg = spark.createDataFrame([(10, 5, "ann"), (11, None, "bob"), (11, None, "bob"), (12, 6, "eve")], "caregiverid int, addressid int, n string")
    adr = spark.createDataFrame([(5, "x"), (5, "y"), (None, "z")], "addressid int, street string")
    tables = {"c": chain, "crg": crg, "adr": adr}
    steps = [JoinStep("crg", ("caregiverid",), "left", broadcast="right", branch=(JoinStep("adr", ("addressid",), "left"),))]
    some = {n: (lambda n=n: counted(tables[n])) for n in tables}
    want = sorted(map(repr, join_chain(tables, "c", steps).collect()))
    for names in ((), ("crg",), ("crg", "adr")):
        got = join_chain(tables, "c", steps, sizes=Z.sizes_of({n: some[n] for n in names}))
        assert got.columns == ["app", "caregiverid", "addressid", "n", "street"]
        assert sorted(map(repr, got.collect())) == want
