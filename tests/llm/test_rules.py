"""Operator 7: base counts by brute force, likelihood ratios by the same hashes in Python, defined cases."""

import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from lodestar.llm import rules
from tests.llm.common import SF, edge_docs, no_docs, numbered, rows_of, sf_docs, words


def base(text):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def long_hash(a, b):
    h = 42
    for v in (a, b):
        h = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed=h)
    return signed(h)


def grams(text, bits):
    w = words(text)
    n = (1 << bits) - 1
    h = [signed(xxhash.xxh64_intdigest(x.encode(), seed=42)) for x in w]
    return ([x & n for x in h] + [(long_hash(a, b) & n) + n + 1 for a, b in zip(h, h[1:])]
            + [(xxhash.xxh64_intdigest(x[-3:].encode(), seed=42) & n) + 2 * (n + 1) for x in w])


def judge(docs, trusted, **options):
    df, name = rules.quality(docs, trusted, **options)
    return df, name


@pytest.mark.parametrize("which", ["sf", "edge"])
def test_base_counts(spark, which):
    docs = sf_docs(spark) if which == "sf" else edge_docs(spark)
    df, name = judge(docs, spark.createDataFrame([(6,)], "i long"))
    assert df.columns == [*docs.columns, name]
    got = sorted((tuple(r) for r in df.select(
        "doc_id", *[f"{name}.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                            "n_repeat_words", "base_failed")]).collect()), key=str)
    assert got == sorted([(d, *base(t)) for d, t in rows_of(docs)], key=str)


def test_repeat_patterns(spark):
    texts = ["a " * 30, numbered(8) + " " + numbered(8), numbered(9) + " x " + numbered(9),
             numbered(7) + " " + numbered(7), " ".join(["a b c"] * 10), numbered(50) + " " + numbered(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df, name = judge(docs, spark.createDataFrame([], "i long"))
    got = {r[0]: r[1] for r in df.select("doc_id", f"{name}.n_repeat_words").collect()}
    assert got == {i: base(t)[4] for i, t in enumerate(texts)}


def test_scores(spark):
    docs, bits = sf_docs(spark), 8
    trusted = rules.trusted_ids(spark, SF)
    good = {r["doc_id"] for r in trusted.collect()}
    raw, fine = Counter(), Counter()
    by = {d: grams(t, bits) for d, t in rows_of(docs)}
    for d, g in by.items():
        raw.update(g)
        if d in good:
            fine.update(g)
    n = 1 << bits
    total = [sum(c for b, c in raw.items() if b // n == k) for k in range(3)]
    part = [sum(c for b, c in fine.items() if b // n == k) for k in range(3)]
    value = {b: math.log((fine[b] + 8) / (c * part[b // n] / total[b // n] + 8)) for b, c in raw.items()}
    df, name = judge(docs, trusted, bits=bits)
    for r in df.select("doc_id", f"{name}.score", f"{name}.base_failed", f"{name}.kept").collect():
        g = by[r["doc_id"]]
        want = sum(value[b] for b in g) / max(3 * ((len(g) + 1) // 3) - 1, 1)
        assert r["score"] == pytest.approx(want, abs=1e-4)
        if abs(want + 0.15) > 1e-3:
            assert r["kept"] == (not r["base_failed"] and want >= -0.15)


def test_clean_documents_stay_and_junk_goes(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = rules.accepted(docs, rules.trusted_ids(spark, "/root/testdata/sf0.01"))
    share = {r["quality"]: r["s"] for r in labels.join(kept.select("doc_id", F.lit(1).alias("k")), "doc_id", "left")
             .groupBy("quality").agg(F.avg(F.coalesce("k", F.lit(0))).alias("s")).collect()}
    assert share[1] > 0.95 and share[0] < 0.1


def test_columns_nulls_and_empty(spark):
    docs = edge_docs(spark)
    out = rules.accepted(docs, spark.createDataFrame([(None,), (6,), (6,)], "i long"))
    assert out.columns == docs.columns and out.count() < docs.count()
    assert rules.accepted(no_docs(spark), spark.createDataFrame([], "i long")).count() == 0


def test_native_plan(spark):
    df = rules.op7_quality_rules(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
