"""Operator 6 against SQL and brute force, recall of the hashing, defined cases."""

import numpy as np
import pytest

from lodestar.llm import embeddings
from tests.llm.common import SF, Union
from tests.llm.test_warc import duck_with
from tests.oracle import compare

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    good = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[i] = x / np.linalg.norm(x)
    up, links = Union(range(len(rows))), [0] * len(rows)
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold:
                up.join(i, j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (d, _, _) in enumerate(rows):
        ids = [x for x in (least.get(up.find(i)), d) if x is not None]
        least[up.find(i)] = min(ids, default=None)
    return sorted(((d, links[i], least[up.find(i)], d == least[up.find(i)]) for i, (d, _, _) in enumerate(rows)), key=str)


def run(spark, rows):
    return sorted(map(tuple, embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def near(rng, v, cos):
    v = v / np.linalg.norm(v)
    w = rng.normal(size=len(v))
    w -= (w @ v) * v
    return cos * v + np.sqrt(1 - cos * cos) * w / np.linalg.norm(w)


def test_clusters_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(6):
        v = rng.normal(size=64)
        for k in range(25):
            rows.append((len(rows), near(rng, v, rng.choice([0.975, 0.985, 0.995])).astype(np.float32).tolist(), c % 3))
    rows += [(len(rows) + k, rows[3][1], 0) for k in range(4)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 64, 1), (903, [float("nan")] + [1.0] * 63, 1),
             (904, [float("inf")] + [1.0] * 63, 1), (905, [None] + [1.0] * 63, 1), (906, rows[3][1], None),
             (None, rows[3][1], 0), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1), (909, [3.0], 1), (910, [5.0], 1),
             (911, [-0.0, 1.0, 0.0], 2), (912, [0.0, 1.0, -0.0], 2), (3, rows[3][1], 0), (913, [1e38] * 64, 2),
             (914, [1e-38] * 64, 2)]
    assert run(spark, rows) == brute(rows)


def test_hot_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(6)
    v = rng.normal(size=64)
    rows = [(i, near(rng, v, 0.991).astype(np.float32).tolist(), 1) for i in range(150)]
    assert run(spark, rows) == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(7)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.stack([near(rng, v, 0.98) for v in a])
    x, y = embeddings.bucket_codes(a, 6), embeddings.bucket_codes(b, 6)
    met = ((x == y[:, :, :1]).any(2) | (y == x[:, :, :1]).any(2))
    assert met[:, 0].mean() > 0.8 and met.any(1).mean() > 0.9995


def test_hadamard_is_orthonormal():
    h = embeddings.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))


def test_empty_and_extra_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, [1.0, 2.0], 3, "x", 9)], SCHEMA + ", node string, id long")
    assert embeddings.near_vectors(df).collect()[0]["component_id"] == 1


def test_query_against_sql(spark):
    n, _, problems = compare(spark, duck_with(SF), "op6", embeddings.op6_embedding_dedup, embeddings.OP6_SQL, SF)
    assert n and not problems


@pytest.mark.parametrize("d", [1, 2, 3, 64, 100])
def test_codes_of_any_dimension(d):
    x = np.random.default_rng(1).normal(size=(5, d))
    assert embeddings.bucket_codes(x, 2).shape == (5, 2, len(embeddings.RANKS))
