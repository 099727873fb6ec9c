"""Operator 8 against exact pairwise similarity."""

from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from lodestar.llm import minhash
from lodestar.llm.components import components
from lodestar.llm._common import scratch
from tests.llm.common import Union, edge_docs, no_docs, numbered, rows_of, sf_docs, words


def sets(rows):
    out = defaultdict(list)
    for d, t in rows:
        w = words(t, lower=True)
        out[d].append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def similar(a, b):
    both = len(a & b)
    return a and b and 100 * both >= 75 * (len(a) + len(b) - both)


def brute(rows):
    by = sets(rows)
    items = [(d, i) for d, ss in by.items() for i in range(len(ss))]
    up = Union(range(len(items)))
    for i, (d, k) in enumerate(items):
        for j in range(i):
            e, m = items[j]
            if (d is not None and d == e) or similar(by[d][k], by[e][m]):
                if by[d][k] and by[e][m]:
                    up.join(i, j)
    least = defaultdict(list)
    for i, (d, k) in enumerate(items):
        least[up.find(i)].append(d)
    result = []
    for i, (d, k) in enumerate(items):
        ids = [x for x in least[up.find(i)] if x is not None]
        c = min(ids, default=None) if by[d][k] else d
        result.append((d, len(by[d][k]), c, d == c))
    return sorted(result, key=str)


@pytest.mark.parametrize("which", ["sf", "edge"])
def test_components(spark, which):
    docs = sf_docs(spark) if which == "sf" else edge_docs(spark)
    got = minhash.near_duplicates(docs).select("id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows_of(docs))


def test_blocks_of_outsiders_are_bounded(spark, monkeypatch):
    """400 outsiders of 401 members: no pair of blocks holds them all, and every pair meets."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    here = (spark.range(401).selectExpr("7L AS bucket", "401L AS size", "400L AS n_out", "id AS node", "id AS comp",
                                        "id > 0 AS out"))
    rows = minhash._dealt(here).collect()
    groups = defaultdict(lambda: (set(), set()))
    for r in rows:
        groups[r["bl"], r["br"]][r["left"]].add(r["node"])
    assert max(len(s) for g in groups.values() for s in g) < 3 * 16
    assert {(a, b) for m, o in groups.values() for a in o for b in m} == {
        (a, b) for a in range(1, 401) for b in range(401)}


def test_template_texts_in_small_blocks(spark, monkeypatch):
    """Texts that share half of their shingles, a few of them near copies of each other."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(6)
    same = [f"t{i}" for i in range(140)]
    own = [[f"o{rng.integers(1 << 40)}" for _ in range(60)] for _ in range(100)]
    rows = [(i, " ".join(same + own[i % 90 if i >= 90 else i] + [f"e{i}"] * (i % 3))) for i in range(110)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs).select("id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_chain_of_edits_in_one_bucket(spark):
    """Many variants of one text, some linked only through others: outsiders of a bucket are not lost."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(120):
        w = list(base)
        for k in rng.choice(100, rng.integers(0, 9), replace=False):
            w[k] = f"n{rng.integers(1000)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs).select("id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_deduplicated_keeps_columns_and_clean_documents(spark):
    docs = edge_docs(spark)
    out = minhash.deduplicated(docs)
    assert out.columns == docs.columns
    ids = sorted((r["doc_id"] for r in out.collect()), key=str)
    assert ids == sorted([1, 2, 3, None, 4, 6, 9, 10, 11, 12], key=str)  # the copy with a null id goes


def test_deduplicated_drops_rows_not_ids(spark):
    x, y = numbered(50, "x"), numbered(50, "y")
    keep = lambda rows: sorted(map(tuple, minhash.deduplicated(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert keep([(5, x), (5, y), (3, y)]) == [(3, y), (5, x)]
    assert keep([(5, x), (5, x), (6, x), (1, "")]) == [(1, ""), (5, x)]


def test_empty(spark):
    assert minhash.near_duplicates(no_docs(spark)).collect() == []
    assert minhash.deduplicated(no_docs(spark)).collect() == []


def test_posterior_pruning():
    least = minhash.prune_table(128, 16, 0.75, 1e-6)
    assert (np.diff(least) > 0).all() and least[-1] < 0.75 * 128
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 32, (4000, 128), dtype=np.uint32)
    near, far = a.copy(), a.copy()
    near[rng.random(a.shape) > 0.76] += 1
    far[rng.random(a.shape) > 0.3] += 1
    assert minhash.survives(a, near, least, 16).all()
    assert not minhash.survives(a, far, least, 16).any()


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
                                   [(5, 3), (3, 5), (9, 9), (9, 8), (2, 8)]])
def test_connected_components(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["component"] for r in components(spark, df, scratch(spark, "test")).collect()}
    up = Union({x for e in edges for x in e})
    for a, b in edges:
        up.join(a, b)
    assert got == {x: up.find(x) for e in edges for x in e if e[0] != e[1] or x in got}


def test_one_row_stays_of_copies_without_ids(spark):
    rows = [(None, numbered(50)), (None, numbered(50)), (None, numbered(30, "q")), (3, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in minhash.deduplicated(docs).collect()]
    assert sorted(kept, key=str) == sorted([(None, numbered(50)), (None, numbered(30, "q")), (3, None), (None, None)], key=str)


def test_blocks_of_large_sets_are_smaller(spark):
    """512 sets of 20,000 shingles in one bucket: no pair of blocks holds much more than its share."""
    here = spark.range(1, 513).selectExpr("1L AS bucket", "512L AS size", "256L AS n_out", "id * 7919 AS node", "id AS comp",
                                          "id % 2 = 0 AS out", "20000L AS n", "256 * 20000L AS w_out", "512 * 20000L AS w_all")
    most = 1 << 20
    blocks = minhash._dealt(minhash.weighted(here, most).drop("n", "w_out", "w_all"))
    sizes = [r["count"] * 20_000 for r in blocks.groupBy("bl", "br", "left").count().collect()]
    assert sum(sizes) >= 10 * 512 * 20_000 and max(sizes) <= 1.7 * most
    met = {(r["bl"], r["br"]) for r in blocks.collect()}
    for left, right in ((a, b) for a in range(5) for b in range(10)):
        assert (left, right) in met  # every outsider meets every member
    small = minhash.weighted(here.withColumns({"w_out": F.lit(256), "w_all": F.lit(512)}), most).first()
    assert (small["n_out"], small["size"]) == (256, 512)
