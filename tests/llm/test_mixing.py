"""Operator 3: targets by plain water filling, exact cuts, defined cases."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodestar.llm import mixing
from tests.llm.common import SF, edge_docs, no_docs, rows_of, sf_docs, words
from tests.llm.test_warc import duck_with
from tests.oracle import compare


def reshare(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > most * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            free.discard(s)
        left = float(sum(sizes.values())) - sum(target.values())
    return target


def takes(docs):
    df, name = mixing.mix_sources(docs)
    return df.select("doc_id", "source", f"{name}.*").collect()


@pytest.mark.parametrize("which", ["sf", "edge"])
def test_targets_and_taken_words(spark, which):
    docs = sf_docs(spark) if which == "sf" else edge_docs(spark)
    rows = takes(docs)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = reshare(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
    for s, t in want.items():
        assert t - 2 <= taken[s] <= t  # rows that share a key are rounded down one by one
    assert sorted(r["size"] for r in rows) == sorted(len(words(t)) for _, t in rows_of(docs))


def test_level_is_the_first_allowed_one(spark):
    """Many capped sources: a later level is smaller, even negative, and must not be chosen."""
    sizes = {f"s{i:02d}": 10 ** (i % 4) + i for i in range(12)}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df, (5.0, 2.0, 1.0), 3, 1.0).collect()}
    assert got == pytest.approx(reshare(sizes))


def test_reruns_and_partitionings_agree(spark):
    a = sorted(map(tuple, takes(sf_docs(spark))))
    b = sorted(map(tuple, takes(sf_docs(spark).repartition(7))))
    assert a == b


def test_mixed_documents(spark):
    docs = edge_docs(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    want = sum(r["taken"] for r in takes(docs))
    assert sum(len(words(r["text"])) for r in out.select("text").collect()) == want
    cut = out.join(docs.select(F.col("text").alias("whole")).distinct(), out["text"] == F.col("whole"), "left_anti")
    for r in cut.where("text IS NOT NULL").select("text", "n_chars").collect():
        assert r["n_chars"] == len(r["text"])


def test_empty(spark):
    assert takes(no_docs(spark)) == []
    assert mixing.mixed(no_docs(spark)).count() == 0


def test_query_against_sql(spark):
    from tests.llm.common import SF
    n, _, problems = compare(spark, duck_with(SF), "op3", mixing.op3_mix_sources, mixing.OP3_SQL, SF)
    assert n and not problems
