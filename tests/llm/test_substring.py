"""Operator 10 against SQL and brute force."""

import hashlib
from collections import Counter

import pytest

from lodestar.llm import substring
from tests.llm.common import SF, edge_docs, no_docs, numbered, rows_of, words
from tests.llm.test_warc import duck_with
from tests.oracle import compare


def brute(rows, width=35):
    ws = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in ws for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, ws):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("batch_words", [1, 500, 1 << 20])
def test_edge_documents(spark, batch_words):
    docs = edge_docs(spark, clash=False)
    got = substring.remove_repeats(docs, carry=["doc_id"], text=False, batch_words=batch_words).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows_of(docs))


def test_repeats_inside_one_document_and_across(spark):
    p = numbered(40, "p")
    rows = [(1, f"a b {p} c {p} d"), (2, numbered(34, "s")), (3, numbered(34, "s")), (4, numbered(35, "t")),
            (5, numbered(35, "t") + " end"), (6, "r " * 80), (7, "x " + p[:-3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.remove_repeats(docs, carry=["doc_id"], text=False, batch_words=60).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_clashing_columns_and_text(spark):
    docs = edge_docs(spark)
    out = substring.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[6]["text"] == "" and by[6]["n_chars"] == 0 and by[6]["kept"] == "own kept"
    assert by[11]["text"].endswith(" tail")  # nothing lost: the text stays as it is


def test_empty(spark):
    assert substring.remove_repeats(no_docs(spark)).collect() == []


def test_query_against_sql(spark):
    n, _, problems = compare(spark, duck_with(SF), "op10", substring.op10_substring, substring.OP10_SQL, SF)
    assert n and not problems


def test_query_gives_few_partitions(spark, tmp_path):
    files = 5 * spark.sparkContext.defaultParallelism
    rows = spark.createDataFrame([(i, "one two") for i in range(4 * files)], "doc_id long, text string")
    rows.repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # a file a partition
    try:
        done = substring.op10_substring(spark, str(tmp_path))
        assert spark.read.parquet(f"{tmp_path}/documents.parquet").rdd.getNumPartitions() > 4 * files // 5
        assert done.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert done.count() == 4 * files
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
