"""Row ids (C7, I1) and the uniqueness check."""

import pytest

from lodestar.functions.ids import ID_PATTERN, IdCollisionError, assert_unique, assign_ids
from lodestar.sources.files import materialize


def test_ids_are_v4_unique_and_stable_after_write(spark, workdir):
    df = spark.range(5000).selectExpr("cast(id as string) as FACILITY")
    with_ids = materialize(spark, assign_ids(df.repartition(7)), f"{workdir}/ids")
    assert assert_unique(with_ids) == 5000
    bad = with_ids.where(~with_ids.participant_id.rlike(ID_PATTERN)).count()
    assert bad == 0
    first = sorted(r[0] for r in with_ids.select("participant_id").collect())
    again = sorted(r[0] for r in spark.read.parquet(f"{workdir}/ids").select("participant_id").collect())
    assert first == again and len(first[0]) == 36


def test_collision_raises(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "participant_id string")
    with pytest.raises(IdCollisionError):
        assert_unique(df)


def test_null_id_counts_as_collision(spark):
    df = spark.createDataFrame([("a",), (None,)], "participant_id string")
    with pytest.raises(IdCollisionError):
        assert_unique(df)


def test_existing_id_column_rejected(spark):
    df = spark.createDataFrame([("a",)], "participant_id string")
    with pytest.raises(ValueError):
        assign_ids(df)


def test_with_row_index_is_global_and_dense(spark, workdir):
    from lodestar.functions.ids import with_row_index
    src = spark.range(1000).selectExpr("cast(id as int) as v").repartition(7)
    src.write.parquet(f"{workdir}/src")
    df = spark.read.parquet(f"{workdir}/src")
    out = with_row_index(df)
    assert out.columns == ["index", "v"]
    got = [tuple(r) for r in out.collect()]
    assert [i for i, _ in got] == list(range(1000))
    assert sorted(v for _, v in got) == list(range(1000))


def test_csv_export_with_row_index(spark, workdir):
    from lodestar.sources.files import read_csv, write_csv
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    path = write_csv(df, f"{workdir}/csv", row_index="index")
    back = read_csv(spark, path, schema="index long, x string")
    assert sorted(tuple(r) for r in back.collect()) == [(0, "a"), (1, "b"), (2, "c")]


def test_hash_ids_are_unique_and_reproducible(spark, workdir):
    from lodestar.functions.ids import assign_hash_ids
    rows = [("North", "1"), ("North", "1"), ("North", "1"), ("South", None), ("South", None), ("East", "2")]
    spark.createDataFrame(rows * 50, "FACILITY string, pca_1 string").repartition(5) \
        .write.parquet(f"{workdir}/a")
    spark.createDataFrame(list(reversed(rows * 50)), "FACILITY string, pca_1 string").coalesce(1) \
        .write.parquet(f"{workdir}/b")
    a = assign_hash_ids(spark.read.parquet(f"{workdir}/a"))
    b = assign_hash_ids(spark.read.parquet(f"{workdir}/b"))
    assert a.columns == ["FACILITY", "pca_1", "participant_id"]
    assert assert_unique(a) == 300
    got_a = sorted(tuple(r) for r in a.collect())
    assert got_a == sorted(tuple(r) for r in b.collect())       # other partitioning, same ids
    assert got_a == sorted(tuple(r) for r in assign_hash_ids(spark.read.parquet(f"{workdir}/a")).collect())
    assert all(len(r[2]) == 36 for r in got_a)


def test_id_mode_validation(spark):
    df = spark.createDataFrame([("a",)], "FACILITY string")
    with pytest.raises(ValueError):
        assign_ids(df, mode="sequential")


def test_unique_counts_are_exact_also_when_hashes_collide(spark):
    from pyspark.sql import functions as F

    from lodestar.functions.ids import id_stats, unique_counts
    ids = [f"id-{i}" for i in range(500)] + ["id-3", "id-3", "id-77"] + [None, None]
    df = spark.createDataFrame([(i,) for i in ids], "participant_id string").repartition(5)
    want = tuple(id_stats(df).first())
    assert want == (505, 500)
    assert unique_counts(df) == want
    for few in (F.length, lambda c: F.pmod(F.xxhash64(c), F.lit(40))):  # nearly every id is a suspect
        assert unique_counts(df, hash_of=few) == want
    assert unique_counts(df.where("participant_id IS NULL")) == (2, 0)
    assert unique_counts(df.limit(0)) == (0, 0)


def test_unique_ids_are_not_shuffled(spark):
    """Without a repeated hash the second pass does not run."""
    from pyspark.sql import functions as F

    from lodestar.functions.ids import unique_counts
    df = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("participant_id"))
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    assert unique_counts(df) == (2000, 2000)
    few = len(tracker.getJobIdsForGroup(None)) - before
    assert unique_counts(df.union(df.limit(1))) == (2001, 2000)
    assert len(tracker.getJobIdsForGroup(None)) - before - few > few
