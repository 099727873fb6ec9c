import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import neighbours as N

ROWS = "vec_id long, embedding array<double>, rank string, id string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "own", "own", "own") for i, v in rows], ROWS)


def exact(rows, k=20, every=20):
    """Brute force: sorted (query_id, rank, vec_id, score)."""
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (q, x) in enumerate(good):
        if q % every:
            continue
        near = sorted((-float(np.cumsum(x * y)[-1]), i) for b, (i, y) in enumerate(good) if b != a and len(y) == len(x))
        out += [(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(near[:k])]
    return sorted(out)


def got(df):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 9)) for r in df.collect())


def test_edge_cases(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(1, 50)]
    rows += [(60, None), (80, []), (100, [0.0] * 6), (120, [None] + [1.0] * 5), (140, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(160, rows[3][1]), (160, rows[3][1]), (160, rows[4][1]), (180, [1.0, 2.0]), (181, [2.0, 1.0]), (200, [1.0, 2.0, 3.0])]
    rows += [(300 + i, rows[0][1]) for i in range(40)]  # ties: more copies than asked for
    rows += [(400, [50 * x for x in rows[1][1]])]  # a long vector is near to many
    assert got(N.nearest_neighbours(table(spark, rows), F.col("id") % 20 == 0)) == exact(rows)


def test_empty(spark):
    df = N.nearest_neighbours(table(spark, []), F.col("id") % 20 == 0)
    assert df.columns == ["query_id", "rank", "id", "score"] and df.count() == 0


def test_recall_beyond_one_block(spark):
    """Random directions of different lengths, with a dense group that holds a third of the rows."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3600, 24)) * rng.uniform(0.5, 1.5, (3600, 1))
    x[:1200] = rng.standard_normal(24) + 0.01 * rng.standard_normal((1200, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(rng.permutation(x))]
    found = got(N.nearest_neighbours(table(spark, rows), F.col("id") % 20 == 0))
    want = exact(rows)
    assert len(found) == len(want)
    assert len({r[::2] for r in found} & {r[::2] for r in want}) >= 0.9 * len(want)


@pytest.mark.parametrize("rows,size", [(1, 4), (4, 4), (5, 4), (11, 4), (4097, 2048)])
def test_blocks_are_even(spark, rows, size):
    block, local = N._dealt(F.col("pos"), F.lit(rows).cast("long"), size)
    placed = spark.range(rows).withColumnRenamed("id", "pos").select(block.alias("b"), local.alias("l")).collect()
    sizes = {}
    for r in placed:
        sizes.setdefault(r["b"], []).append(r["l"])
    assert all(sorted(v) == list(range(len(v))) and len(v) <= size for v in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1


def test_queries_go_to_the_vectors_and_ask_for_each_once(spark, monkeypatch):
    """A search round joins no vectors to blocks of queries: a query asks a group of nodes once, and never for a node it has met."""
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((2600, 12)))]
    written, real = {}, N.stage

    def stage(session, df, root, name):
        written[name] = real(session, df, root, name)
        return written[name]

    monkeypatch.setattr(N, "stage", stage)
    whole = got(N.nearest_neighbours(table(spark, rows), F.col("id") % 20 == 0))
    asks = [r for name, df in written.items() if name.startswith("asks") for r in df.withColumn("step", F.lit(name)).collect()]
    assert asks and len({(r["step"], r["query"], r["area"]) for r in asks}) == len(asks)
    asked = [(r["query"], int(i)) for r in asks for i in np.frombuffer(r["ids"], np.int64)]
    assert len(set(asked)) == len(asked) and all(q != i for q, i in asked)
    assert {r["parts"] for name, df in written.items() if name.startswith("parts") for r in df.collect()} == {1}
    monkeypatch.setattr(N, "ASK_BYTES", 1 << 12)  # groups that are asked much answer in parts, to the same result
    assert got(N.nearest_neighbours(table(spark, rows), F.col("id") % 20 == 0)) == whole
    assert max(r["parts"] for name, df in written.items() if name.startswith("parts") for r in df.collect()) > 1
