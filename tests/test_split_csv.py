"""CSV by byte ranges: quoted line breaks over range ends, headers united by name."""

import csv
import io
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodestar.plans import survey as S
from lodestar.sources.split_csv import _lines, csv_records, range_parities, read_split_csv


def _write(folder, name, rows, end="\n", quote=csv.QUOTE_MINIMAL):
    os.makedirs(folder, exist_ok=True)
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quote).writerows(rows)
    with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as fh:
        fh.write(out.getvalue())
    return folder


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _want(rows):
    return sorted((tuple(v or None for v in r) for r in rows), key=repr)


VALUES = ["x", "", "a,b", 'say "hi"', "two\nlines", "\n\n", 'end"\n"', "\r\nwindows", ",", "é ü", " blank ", '""', "\n" * 40]


def test_small_ranges_cut_the_same_rows(spark, workdir):
    """One file, some hundred byte ranges, values that span several of them."""
    rng = random.Random(4)
    rows = [[str(i), rng.choice(VALUES) + rng.choice(VALUES), rng.choice(VALUES), "t" * rng.randrange(30)] for i in range(1500)]
    rows[700][1] = 'long "value"\n' * 400  # over many ranges
    _write(workdir, "in.csv", [["id", "a", "b", "c"], *rows])
    df = read_split_csv(spark, f"{workdir}/in.csv", range_bytes=512)
    assert df.columns == ["id", "a", "b", "c"]
    assert _rows(df) == _want(rows)


def test_one_file_is_read_by_many_tasks(spark, workdir):
    rows = [[str(i), 'a "b",\n' * 20] for i in range(3000)]
    _write(workdir, "in.csv", [["id", "a"], *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 << 10))
        lines = _lines(spark, f"{workdir}/in.csv")
        assert lines.rdd.getNumPartitions() > 10
        odd = [r["odd"] for r in range_parities(lines).collect()]
        assert len(odd) > 10 and True in odd and False in odd
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert _rows(read_split_csv(spark, f"{workdir}/in.csv", range_bytes=32 << 10)) == _want(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(VALUES), min_size=2, max_size=2), max_size=30), st.sampled_from(["\n", "\r\n"]),
       st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), st.integers(16, 200))
def test_any_file_as_python_reads_it(spark, rows, end, quote, size):
    import tempfile
    folder = tempfile.mkdtemp(prefix="lodestar-test-", dir="/tmp")
    rows = [[f"k{i}", *r] for i, r in enumerate(rows)]
    _write(folder, "in.csv", [["k", "a", "b"], *rows], end, quote)
    assert _rows(read_split_csv(spark, folder, range_bytes=size)) == _want(rows)


def test_headers_are_united_by_name(spark, workdir):
    _write(workdir, "a.csv", [["FACILITY", "pca_1", "pca_2"], ["A", "1", "2"]])
    _write(workdir, "b.csv", [["pca_2", "note", "FACILITY", "pca_1"], ["20", "x\ny", "B", "10"]])
    _write(workdir, "c.csv", [["pca_10", "FACILITY"], ["7", "C"], ["", "D"]])
    df = read_split_csv(spark, workdir)
    assert df.columns == ["FACILITY", "pca_1", "pca_2", "note", "pca_10"]
    assert _rows(df) == _want([("A", "1", "2", "", ""), ("B", "10", "20", "x\ny", ""), ("C", "", "", "", "7"), ("D", "", "", "", "")])
    typed = read_split_csv(spark, workdir, "pca_1 int, FACILITY string")
    assert _rows(typed) == sorted([(1, "A"), (10, "B"), (None, "C"), (None, "D")], key=repr)
    with pytest.raises(KeyError):
        read_split_csv(spark, workdir, "pca_3 int")
    out = S.ingest(spark, workdir, f"{workdir}-out", split=True)
    assert out.columns[1:] == ["facility_name", "pca_1", "pca_2", "pca_10"]
    assert sorted((r["facility_name"], r["pca_10"]) for r in out.collect()) == [("A", None), ("B", None), ("C", 7), ("D", None)]


def test_blank_lines_marks_and_quoted_headers(spark, workdir):
    with open(f"{workdir}/in.csv", "w", newline="", encoding="utf-8") as fh:
        fh.write('\n﻿"a ""x""\nb",c\r\n\r\n1,2\r\n\n"3","4"')
    df = read_split_csv(spark, f"{workdir}/in.csv", range_bytes=8)
    assert df.columns[1:] == ["c"]
    assert _rows(df) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("text,why", [
    ("a,b\n1\n", "1 values"), ("a,b\n1,2,3\n", "3 values"), ('a,b\n1,"2\n', "inside a quoted value"), ("a,a\n1,2\n", "repeats")])
def test_broken_files_fail_and_are_named(spark, workdir, text, why):
    with open(f"{workdir}/broken.csv", "w") as fh:
        fh.write(text)
    with pytest.raises(Exception, match=f"(?s)(broken.csv.*{why}|{why}.*broken.csv)"):
        read_split_csv(spark, workdir).collect()


def test_empty_inputs(spark, workdir):
    open(f"{workdir}/none.csv", "w").close()
    with pytest.raises(ValueError):
        read_split_csv(spark, workdir)
    assert read_split_csv(spark, workdir, "a int").collect() == []
    _write(workdir, "head.csv", [["a", "b"]])
    assert read_split_csv(spark, workdir).collect() == []
    assert csv_records(spark, f"{workdir}/head.csv", f"{workdir}-stages").count() == 1
