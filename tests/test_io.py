"""CSV and parquet sources and sinks."""

import pytest

from lodestar.sources.files import materialize, read_csv, write_csv, write_parquet
from lodestar.sources.jdbc import JdbcConnection, JdbcPartitioning, jdbc_read_options
from lodestar.sources.specs import TableSpec, cols

TRICKY = [
    ("plain", "x"),
    ('has "quotes"', "y"),
    ("comma, inside", "z"),
    ("line\nbreak", None),
    ("", "w"),
]


def test_csv_roundtrip_quotes_commas_line_breaks(spark, workdir):
    df = spark.createDataFrame(TRICKY, "a string, b string")
    path = write_csv(df.coalesce(1), f"{workdir}/out")
    back = read_csv(spark, path, schema=df.schema, multi_line=True)
    got = sorted((tuple(r) for r in back.collect()), key=repr)
    # An empty string and a null both come back as null.
    want = sorted(((a or None, b) for a, b in TRICKY), key=repr)
    assert got == want
    text = open(next(p for p in __import__("glob").glob(f"{path}/*.csv"))).read()
    assert '"has ""quotes"""' in text


def _file(path, text):
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path


def test_csv_quoted_line_breaks_in_an_ignored_column(spark, workdir):
    path = _file(f"{workdir}/in.csv", 'FACILITY,comment,pca_1,pca_2\nSouth,"line one\nline two",3,4\n')
    rows = read_csv(spark, path).select("FACILITY", "pca_1", "pca_2").collect()
    assert [tuple(r) for r in rows] == [("South", "3", "4")]
    with pytest.raises(Exception):  # without multi_line the broken rows are noticed, not shifted
        read_csv(spark, path, multi_line=False).select("FACILITY", "pca_1").collect()


def test_csv_columns_by_header_name(spark, workdir):
    path = _file(f"{workdir}/in.csv", "pca_2,FACILITY,pca_1\n20,A,10\n")
    df = read_csv(spark, path, schema="FACILITY string, pca_1 int, pca_2 int")
    assert [tuple(r) for r in df.collect()] == [("A", 10, 20)]
    with pytest.raises(KeyError):
        read_csv(spark, path, schema="FACILITY string, pca_9 int")


def test_csv_folder_with_another_header_fails(spark, workdir):
    _file(f"{workdir}/a.csv", "FACILITY,pca_1,pca_2\nA,1,2\n")
    _file(f"{workdir}/b.csv", "FACILITY,pca_2,pca_1\nB,2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, workdir).collect()


def test_csv_keeps_blanks(spark, workdir):
    df = spark.createDataFrame([("  Ann ", " q,"), ("\tx", "y ")], "a string, b string")
    back = read_csv(spark, write_csv(df, f"{workdir}/out"), schema=df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_without_schema_reads_strings(spark, workdir):
    path = f"{workdir}/in.csv"
    with open(path, "w") as fh:
        fh.write("FACILITY,pca_1,pca_2\nA,1,\nB,,3\n")
    df = read_csv(spark, path)
    assert df.columns == ["FACILITY", "pca_1", "pca_2"]
    assert sorted(tuple(r) for r in df.collect()) == [("A", "1", None), ("B", None, "3")]


def test_parquet_materialize_keeps_order_and_partitions(spark, workdir):
    df = spark.createDataFrame([(1, 2023, "a"), (2, 2022, "b")], "k int, program_year int, v string")
    path = write_parquet(df, f"{workdir}/p", partition_by=("program_year",))
    assert sorted(spark.read.parquet(path).columns) == ["k", "program_year", "v"]
    back = materialize(spark, df, f"{workdir}/q", partition_by=("program_year",))
    assert back.columns == ["k", "program_year", "v"]
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2023, "a"), (2, 2022, "b")]


def test_jdbc_options_single_query_and_partitioned():
    spec = TableSpec("inmapp", "r_ab.tblinmateapp", cols("applicationid", "inmateid", cast="INTEGER"),
                     where="statusid = 1")
    conn = JdbcConnection.postgres("db.example", 5432, "warehouse", "reader", "secret")
    assert "secret" not in repr(conn)
    one = jdbc_read_options(conn, spec)
    assert one["url"] == "jdbc:postgresql://db.example:5432/warehouse"
    assert one["query"] == spec.to_sql() and "dbtable" not in one
    part = jdbc_read_options(conn, spec, JdbcPartitioning("applicationid", 0, 1_000_000, 64))
    assert part["dbtable"] == f"({spec.to_sql()}) AS inmapp_src"
    assert (part["partitionColumn"], part["numPartitions"]) == ("applicationid", "64")
    assert "query" not in part


def test_jdbc_bounds_query_and_fact_splits():
    from lodestar.plans.warehouse import FACT_SPLITS, WAREHOUSE_SOURCES
    from lodestar.sources.jdbc import bounds_sql
    specs = {x.name: x for x in WAREHOUSE_SOURCES}
    for name, column in FACT_SPLITS.items():
        sql = bounds_sql(specs[name], column)
        assert sql == (f"SELECT MIN({column}) AS lo, MAX({column}) AS hi "
                       f"FROM ({specs[name].to_sql()}) AS {name}_bounds")
    with pytest.raises(ValueError):
        bounds_sql(specs["inmapp"], "nowhere")
