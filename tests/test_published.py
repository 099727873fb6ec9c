"""Datasets replaced in one step and pipelines that go on where they stopped."""

import os
import time

import pytest
from pyspark.sql import functions as F

from lodestar.plans import survey as S
from lodestar.plans import warehouse as W
from lodestar.sources import published as P
from lodestar.sources.files import write_parquet
from tests.test_jobs import empty_tables


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_publish_replaces_and_keeps_columns(spark, workdir):
    path = f"{workdir}/t"
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, path)
    one = P.publish(spark.createDataFrame([(1, 2023, "a")], "k int, program_year int, v string"), path, ("program_year",))
    old = P.read_published(spark, path)
    P.publish(spark.createDataFrame([(2, 2022, "b")], "k int, program_year int, v string"), path, ("program_year",))
    assert P.read_published(spark, path).columns == ["k", "program_year", "v"]
    assert [tuple(r) for r in P.read_published(spark, path).collect()] == [(2, 2022, "b")]
    assert [tuple(r) for r in old.collect()] == [(1, 2023, "a")]  # a reader of the old version can finish
    assert P.current(spark, path).number == one.number + 1


def test_failed_write_leaves_the_old_rows(spark, workdir):
    path = f"{workdir}/t"
    P.publish(spark.range(5), path)
    half = spark.range(0, 100, 1, 4).select(F.when(F.col("id") > 90, F.raise_error(F.lit("half way")).cast("long"))
                                            .otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half way"):
        P.publish(half, path)
    assert sorted(r[0] for r in P.read_published(spark, path).collect()) == [0, 1, 2, 3, 4]

    def refuse(rows):
        raise ValueError(f"{rows.count()} rows refused")
    with pytest.raises(ValueError, match="7 rows refused"):
        P.publish(spark.range(7), path, check=refuse)
    assert P.read_published(spark, path).count() == 5
    P.publish(spark.range(3), path)
    assert P.read_published(spark, path).count() == 3
    assert len(P.versions(spark, path)) == 4


def test_prune_keeps_current_versions(spark, workdir):
    path = f"{workdir}/t"
    for n in range(4):
        P.publish(spark.range(n), path)
    names = P.versions(spark, path)
    assert P.prune(spark, path) == names[:2]
    assert P.versions(spark, path) == names[2:] and P.read_published(spark, path).count() == 3
    assert P.prune(spark, f"{workdir}/nothing") == []


def test_fingerprints_follow_the_files(spark, workdir):
    path = write_parquet(spark.range(10), f"{workdir}/in")
    one = P.files_fingerprint(spark, [path])
    assert one == P.files_fingerprint(spark, [f"{workdir}/i*"]) and one != P.fingerprint("x")
    time.sleep(1.1)
    write_parquet(spark.range(10), path)
    assert P.files_fingerprint(spark, [path]) != one
    assert P.files_fingerprint(spark, [f"{workdir}/none"]) is None and P.fingerprint("a", None) is None


class Warehouse:
    """The source tables as parquet files, read with a stated schema, so that reading starts no job."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.tables = empty_tables(spark)
        rows = {"org": [(1,)], "orgprg": [(1, 2, 3)], "prg": [(2, 2023)], "prsprg": [(2,)],
                "orgprgchdj": [(3, 10, 20), (3, 10, 21)], "inmapp": [(10, 5, 6)],
                "inmappchdj": [(10, 20, "m", "n"), (10, 21, "m", "n")], "inm": [(6, 7, "f", "l")], "prs": [(7,)],
                "crg": [(5, None, None, "c", "d")], "chd": [(20, "x", "y")]}
        for name, df in self.tables.items():
            self.write(name, rows.get(name, []))

    def write(self, name, rows):
        write_parquet(self.spark.createDataFrame(rows, self.tables[name].schema), f"{self.root}/{name}")

    def read(self, spec):
        return self.spark.read.schema(self.tables[spec.name].schema).parquet(f"{self.root}/{spec.name}")

    def source(self, spec):
        return P.files_fingerprint(self.spark, [f"{self.root}/{spec.name}"])


def test_warehouse_goes_on_where_it_stopped(spark, workdir, monkeypatch):
    db, root = Warehouse(spark, f"{workdir}/db"), f"{workdir}/out"

    def run():
        return W.run_pipeline(spark, db.read, root, resume=True, sources=db.source)
    right = W.normalize

    def broken(joined, entity, year):
        if entity == "inmate":
            raise RuntimeError("lost")
        return right(joined, entity, year)
    monkeypatch.setattr(W, "normalize", broken)
    with pytest.raises(RuntimeError, match="lost"):
        run()
    monkeypatch.setattr(W, "normalize", right)
    made = {n: P.current(spark, f"{root}/{n}") for n in (W.JOIN_TABLE, "extract/chd", W.FLAT_TABLE)}
    assert P.current(spark, f"{root}/{W.NORMALIZED_TABLE.format('inmate')}") is None
    paths = run()  # the rest
    for name, version in made.items():
        assert P.current(spark, f"{root}/{name}").name == version.name
    children = P.read_published(spark, f"{root}/{W.NORMALIZED_TABLE.format('children')}")
    assert sorted(map(tuple, children.collect()), key=repr) == [(20, "x", "y", 2023), (21, None, None, 2023)]

    before = jobs(spark)
    assert run() == paths
    assert jobs(spark) == before  # all is finished: no job

    time.sleep(1.1)
    db.write("chd", [(20, "x2", "y"), (21, "z", "z")])
    again = run()
    assert again["orgprg"] == paths["orgprg"] and again["chd"] != paths["chd"]
    assert again[W.JOIN_TABLE] != paths[W.JOIN_TABLE]
    children = P.read_published(spark, f"{root}/{W.NORMALIZED_TABLE.format('children')}")
    assert sorted(map(tuple, children.collect())) == [(20, "x2", "y", 2023), (21, "z", "z", 2023)]


def test_unknown_sources_are_read_every_time(spark, workdir):
    db, root = Warehouse(spark, f"{workdir}/db"), f"{workdir}/out"
    one = W.run_pipeline(spark, db.read, root, resume=True)
    two = W.run_pipeline(spark, db.read, root, resume=True)
    assert all(one[n] != two[n] for n in one)


def test_survey_goes_on_where_it_stopped(spark, workdir, monkeypatch):
    os.makedirs(f"{workdir}/up")

    def upload(name, text):
        with open(f"{workdir}/up/{name}", "w") as fh:
            fh.write(text)
    upload("a.csv", "FACILITY,pca_1,pca_2\nS,1,2\nT,3,\n")
    dims = {"correction_sites": spark.createDataFrame([("S", 1), ("T", 2)], "facility_name string, facility_id int"),
            "survey": spark.createDataFrame([(1, 7), (2, 8)], "facility_id int, survey_id int")}

    def run():
        return S.run_pipeline(spark, f"{workdir}/up", lambda s: dims[s.name], f"{workdir}/out", resume=True, split=True,
                              sources=lambda s: f"snapshot of {s.name}")
    right = S.melt
    monkeypatch.setattr(S, "melt", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.setattr(S, "melt", right)
    ids = {r[0] for r in P.read_published(spark, f"{workdir}/out/{S.INPUT_TABLE}").select(S.ID_COL).collect()}
    paths = run()
    long = P.read_published(spark, f"{workdir}/out/{S.FINAL_TABLE}").collect()
    assert sorted((r["survey_id"], r["item_id"], r["response"]) for r in long) == [(7, "pca_1", 1), (7, "pca_2", 2), (8, "pca_1", 3)]
    assert {r[S.ID_COL] for r in long} == ids  # the random ids of the first run
    before = jobs(spark)
    assert run() == paths and jobs(spark) == before
    upload("b.csv", "pca_2,FACILITY\n5,T\n")
    run()
    assert P.read_published(spark, f"{workdir}/out/{S.FINAL_TABLE}").count() == 4


def test_bucketed_facts_are_joined_without_a_shuffle(spark, workdir):
    """Automatic broadcasts refused: no exchange under the two joins of the fact tables; the same rows."""
    from lodestar.plans.fixtures import FIXTURE_WAREHOUSE, Fixtures
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    ledger = P.Ledger(spark, workdir)
    buckets = {t: P.Buckets(c, 8) for t, c in W.FACT_SPLITS.items()}
    made = W.extract_stages(ledger, FIXTURE_WAREHOUSE, fx.read_spec, buckets=buckets)
    assert P.current(spark, f"{workdir}/extract/inmapp").buckets == P.Buckets("applicationid", 8)
    assert len(P.list_files(spark, [made["inmapp"].folder])) <= 8
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
             "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = W.denormalize({n: v.read(spark) for n, v in made.items()}, sizes=W.version_sizes(spark, made))
        plan = df._jdf.queryExecution().executedPlan().toString()
        facts = [line for line in plan.splitlines() if "SortMergeJoin" in line and "applicationid" in line]
        assert len(facts) == 2 and plan.count("Bucketed: true") == 3
        moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(applicationid" in line or "Exchange hashpartitioning(childid" in line and "applicationid" in line]
        assert not moved, moved
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = W.denormalize(fx.tables())
    assert df.columns == want.columns and sorted(map(repr, df.collect())) == sorted(map(repr, want.collect()))


def test_bucketed_pipeline_is_replaced_and_resumed(spark, workdir):
    db, root = Warehouse(spark, f"{workdir}/db"), f"{workdir}/out"
    paths = W.run_pipeline(spark, db.read, root, resume=True, sources=db.source, fact_buckets=4)
    children = P.read_published(spark, f"{root}/{W.NORMALIZED_TABLE.format('children')}")
    assert sorted(map(tuple, children.collect()), key=repr) == [(20, "x", "y", 2023), (21, None, None, 2023)]
    before = jobs(spark)
    assert W.run_pipeline(spark, db.read, root, resume=True, sources=db.source, fact_buckets=4) == paths
    assert jobs(spark) == before
    assert W.run_pipeline(spark, db.read, root, resume=True, sources=db.source)["inmapp"] != paths["inmapp"]
