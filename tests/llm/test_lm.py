"""Operator 2: exact base scores, filter levels, probabilities that add up, defined cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from lodestar.llm import lm
from lodestar.llm._hashing import U64, WORD_HASHES
from lodestar.llm._common import scratch
from tests.llm.common import edge_docs, no_docs, sf_docs, words


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def brute(rows):
    tokens = [[*words(t, lower=True), "\n"] for _, t in rows]
    c = Counter(w for (d, _), ws in zip(rows, tokens) if not out(d) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, out(d), len(ws), sum(c[w] > 0 for w in ws), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for (d, _), ws in zip(rows, tokens)]


@pytest.mark.parametrize("which,head", [("sf", 200_000), ("sf", 100), ("edge", 5)])
def test_base_scores(spark, which, head):
    docs = sf_docs(spark) if which == "sf" else edge_docs(spark)
    got = lm.scored(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0, head=head, batch_tokens=5000).collect()
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    key = lambda r: (str(r[0]), r[2], r[5])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5])
        assert g[6] < 0 or g[2] == 0


def test_held_out_text_is_likelier_than_by_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm.scored(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_filter_levels():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    q = lm.level(rng.geometric(0.3, 3000))
    size = 8 * 40_000
    bits, kept = lm.fill(keys, q, size)
    assert kept.all()
    part = np.zeros(3000, np.int64)
    found = lm.probe(bits, keys, part, size)
    assert (found >= q).all() and (found == q).mean() > 0.97
    other = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    assert (lm.probe(bits, other, part, size) == 0).mean() > 0.97


def test_full_filter_keeps_the_most_frequent():
    keys = np.arange(1, 5001, dtype=np.uint64)
    q = np.r_[np.full(4900, 1), np.full(100, 8)]
    bits, kept = lm.fill(keys, q, 8 * 1200)
    assert kept.sum() == 100 and kept[4900:].all()


def test_no_ngram_is_left_out_of_an_overfull_filter():
    """More words, pairs and shares in one bucket than its share of 28 MiB held: all have their level."""
    rng = np.random.default_rng(4)
    n = 2_200_000  # one bucket of eight held 1.94M pair, 0.97M word and 0.48M share items
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    ones = pa.table({"ones": [keys.tobytes()], "keys": [b""], "counts": [b""]})
    for kind in (0, 1):
        out = lm._add_up(8)((pa.scalar(0), pa.scalar(kind)), ones)
        bits = np.frombuffer(out.filter(pc.equal(out["kind"], kind + 10))["bits"][0].as_py(), np.uint8)
        assert (lm.probe(bits, keys, np.zeros(len(keys), np.int64), 8 * len(bits)) >= 1).all()
        assert len(bits) == max(lm.LEAST[kind] // 8, 2 * len(keys))
    some = keys[:600_000]
    out = lm._shares(8)((pa.scalar(0),), pa.table({"key": some.view(np.int64), "q": np.full(len(some), 1, np.int32)}))
    bits = np.frombuffer(out["bits"][0].as_py(), np.uint8)
    assert (lm.probe(bits, some, np.zeros(len(some), np.int64), 8 * len(bits)) >= 1).all()


@pytest.mark.parametrize("which", ["sf", "edge"])
def test_joined_filters_score_as_broadcast_ones(spark, which):
    docs = sf_docs(spark) if which == "sf" else edge_docs(spark)
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    both = [sorted(map(tuple, lm.scored(docs, held, batch_tokens=3000, max_broadcast=b).collect()), key=str)
            for b in (1 << 30, 0)]
    assert len(both[0]) == len(both[1])
    for a, b in zip(*both):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])
    assert lm.scored(no_docs(spark), held, max_broadcast=-1).collect() == []


def test_levels_stand_for_counts():
    c = np.arange(1, 5000)
    q = lm.level(c)
    assert (np.diff(q) >= 0).all() and (lm.TOPS[q] > c * (1 - 1e-9)).all()
    assert lm.MEANS[lm.level(np.array([1, 2, 3]))].tolist() == [1, 2, 3]


def test_probabilities_add_up_to_at_most_one(spark):
    texts = sf_docs(spark).select("text")
    model, vocab = lm.train(texts, scratch(spark, "test"))
    h = np.array([r["h"] for r in vocab.select("h").collect()], np.int64).view(U64)
    for context in ("the", "of", "und", "no-such-word"):
        a = U64(WORD_HASHES[context.encode()])
        t = np.empty(2 * len(h), U64)
        t[0::2], t[1::2] = a, h
        total = (10 ** model.log10(t)[0::2]).sum()
        assert 0.5 < total < 1.1


def test_empty(spark):
    assert lm.scored(no_docs(spark), F.lit(False)).collect() == []
    only = lm.scored(edge_docs(spark), F.lit(True)).collect()  # nothing to learn from
    assert {r["train_tokens"] for r in only} == {0} and {r["n_known"] for r in only} == {0}


def exact_scores(train_texts, texts):
    """The model's log10 probabilities from exact quantised counts, in plain Python, without filters."""
    import math
    from collections import Counter, defaultdict
    end = "\n"

    def stream(t):
        return [end, *words(t, lower=True), end]
    one, two = Counter(), Counter()
    for t in train_texts:
        s = stream(t)
        one.update(s[1:])
        two.update(zip(s, s[1:], strict=False))
    mean = lambda c: lm.MEANS[lm.level(np.array([c]))[0]] if c else 0.0
    top = {w: lm.BASE ** lm.level(np.array([c]))[0] for w, c in one.items()}
    mass, taken = sum(mean(c) for c in one.values()), defaultdict(float)
    for (a, _), c in two.items():
        taken[a] += mean(c) - lm.DISCOUNT
    out = []
    for t in texts:
        total, s = 0.0, stream(t)
        for a, b in zip(s, s[1:], strict=False):
            p1 = (mean(one[b]) + 0.1) / (mass + 0.1 * (len(one) + 1))
            share = min(math.ceil(lm.SHARES * taken[a] / top[a]), lm.SHARES) / lm.SHARES if a in top else 0.0
            p2 = (mean(two[a, b]) - lm.DISCOUNT) / top[a] if two[a, b] else 0.0
            if share == 1:
                p2 *= 1 - 1 / lm.SHARES
            total += math.log10(min(p2 + max(1 - share, 1 / lm.SHARES) * p1, 1.0))
        out.append(total)
    return out


@pytest.mark.parametrize("max_broadcast", [lm.MAX_BROADCAST, 0])
def test_scores_are_those_of_exact_quantised_counts(spark, max_broadcast):
    """Broadcast filters and filters asked by bucket against plain counts; filters of this size hold few false members."""
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 300)) if x < 5000) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = lm.scored(docs, F.col("doc_id") % 5 == 0, max_broadcast=max_broadcast).collect()
    got = {r["id"]: r["score"] for r in rows}
    want = exact_scores([t for i, t in enumerate(texts) if i % 5], texts)
    off = [abs(got[i] - w) for i, w in enumerate(want)]
    assert sum(x > 1e-6 for x in off) <= 4 and max(off) < 3


def test_keys_travel_as_gaps_and_are_probed_once(monkeypatch):
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 48, 5000).astype(np.uint64))
    for some, most in ((keys, 5), (keys[::1000], 6), (np.array([3, 3, (1 << 48) - 1], np.uint64), 6)):
        assert len(lm.packed(some)) <= 1 + most * len(some)
        assert (lm.unpacked(lm.packed(some)) == some).all()
    probed = []
    real = lm.probe_filter_keys
    monkeypatch.setattr(lm, "probe_filter_keys", lambda b, k, *a: probed.append(len(k)) or real(b, k, *a))
    asked = lm.pa.table({"batch": [1, 2, 3], "bucket": [0] * 3, "kind": [1] * 3, "keys": [lm.packed(keys)] * 3})
    got = lm._answer(asked, lm.pa.table({"bits": [bytes(range(256)) * 8]})).column("levels").to_pylist()
    assert probed == [len(keys)] and got[0] == got[1] == got[2] and len(got[0]) == len(keys)


def test_asked_and_answered_keys_are_in_one_order():
    """What a batch asks is what it sorts its answers by: buckets, then filter keys, one sort for both."""
    held = [lm.tokens(t) for t in (b"a b a c", None, b"b c d " * 40)]
    asked = lm._ask(7)([lm.pa.RecordBatch.from_pydict({"batch": [1] * 3, "text": ["a b a c", None, "b c d " * 40]})])
    rows = [r for rb in asked for r in rb.to_pylist()]
    grams = lm.ngrams(lm._joined(held))
    assert [len(k) for k, _ in grams[:2]] == [5, 11]
    for kind, (keys, at) in enumerate(grams):
        want = sorted((int(b), int(f)) for b, f in zip(lm.bucket_of(keys, 7), lm.filter_keys(keys)))
        assert [(r["bucket"], int(f)) for r in rows if r["kind"] == kind for f in lm.unpacked(r["keys"])] == want
    assert (grams[2][0][grams[2][1]] == grams[0][0] >> U64(32)).all()


def test_words_are_hashed_without_a_table():
    """Rare words cost one hash: nothing is kept between texts, and the values are those of the library."""
    text = " ".join(f"W{i}" for i in range(3000)).encode()
    want = [lm.xxhash.xxh3_64_intdigest(w.lower()) for w in text.split()]
    assert lm.word_hashes(text, lower=True).tolist() == want
    assert not hasattr(WORD_HASHES, "__len__")
