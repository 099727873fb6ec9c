"""Operator 1: round trip, magic inside payloads, damaged files, defined cases."""

import base64
import hashlib

import pytest

from lodestar.llm import warc
from lodestar.llm._common import scratch
from tests.llm.common import SF
from tests.oracle import compare, duck

PAGES = "page_id long, url string, html string"
FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\n"
        "hello\r\n\r\n")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, pages, **options):
    root = scratch(spark, "test")
    path = warc.write_warc(pages, f"{root}/archives", root, **options)
    return warc.read_warc(spark, path, root).collect(), path


def rows():
    return [(1, "http://a/", "<p>one</p>"), (2, "http://b/\r\nX: y", "<p>one</p>"), (3, None, None), (4, "", ""),
            (5, "http://e/", FAKE), (6, "http://f/", "x" + FAKE + FAKE + "WARC/1.1\r\n"), (7, "u", "a\r\n\r\nb"),
            (8, "u", "é漢字" * 1000), (9, "u", "WARC/1.1\r\n" * 50), (10, "u", "y" * 300_000),
            (None, "u", "no id"), (8, "u", "é漢字" * 1000)]


def test_round_trip_with_magic_in_payloads(spark):
    pages = spark.createDataFrame(rows(), PAGES)
    got, _ = round_trip(spark, pages)
    assert len(got) == len(rows())
    by = {(r["record_id"], r["record_type"]): r for r in got}
    for i, _, html in rows():
        r = by.get((f"<urn:page:{'' if i is None else i}>", "response"))
        if r is not None:
            assert r["payload"] == (html or "") and r["stored_digest"] == digest(html)
            assert r["digest"] == "sha1:" + digest(html)
    assert {r["record_id"] for r in got if r["record_type"] == "revisit"} == {"<urn:page:2>", "<urn:page:4>"}
    assert by["<urn:page:2>", "revisit"]["refers_to"] == "<urn:page:1>"


def test_min_revisit_bytes(spark):
    got, _ = round_trip(spark, spark.createDataFrame(rows(), PAGES), min_revisit_bytes=1)
    assert {r["record_id"] for r in got if r["record_type"] == "revisit"} == {"<urn:page:2>"}


def test_small_byte_ranges(spark):
    """Records over many byte ranges: runs are chained across them."""
    pages = spark.createDataFrame([(i, "u", f"{i}" + ("z" * (i * 37 % 4000)) + (FAKE if i % 9 == 0 else ""))
                                   for i in range(400)], PAGES).coalesce(1)
    root = scratch(spark, "test")
    path = warc.write_warc(pages, f"{root}/archives", root)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = warc.read_warc(spark, path, root).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {f"<urn:page:{r['page_id']}>": r["html"] for r in pages.collect()}
    assert {r["record_id"]: r["payload"] for r in got} == want


def test_damaged_files(spark, workdir):
    good = FAKE.replace("99", "1")
    cut = "WARC/1.1\r\nWARC-Record-ID: <urn:page:2>\r\nContent-Length: 500\r\n\r\nshort\r\n\r\n"
    for name, text in (("cut", good + cut + good), ("junk", "junk" + good), ("none", "no record"), ("empty", "")):
        with open(f"{workdir}/{name}.warc", "w", newline="") as f:
            f.write(text)
    got = warc.read_warc(spark, workdir, scratch(spark, "test")).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["off"]) for r in got] == [("cut.warc", 0)]


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], PAGES)
    assert round_trip(spark, empty)[0] == []
    more = spark.createDataFrame([(1, "u", "p", "own", 7)], PAGES + ", digest string, id long")
    assert round_trip(spark, more)[0][0]["payload"] == "p"


def test_query_against_sql(spark):
    n, _, problems = compare(spark, duck_with(SF), "op1", warc.op1_warc, warc.OP1_SQL, SF)
    assert n and not problems


def duck_with(sf):
    con = duck(sf)
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("text", ["", "a", "é" * 50])
def test_base32(spark, text):
    from pyspark.sql import functions as F
    got = spark.range(1).select(warc.base32_sha1(F.lit(text)).alias("d")).first()["d"]
    assert got == digest(text)
