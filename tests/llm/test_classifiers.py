"""Operators 4 and 9: held-out accuracy, model identities, defined cases."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import kneser_ney as kn
from lodestar.llm import toxicity as tox
from lodestar.llm._common import scratch
from tests.llm.common import edge_docs, no_docs, sf_docs

SF = "/root/testdata/sf0.1"


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = (tox.op9_toxicity(spark, SF).join(labels, "doc_id").where("held_out")
            .groupBy("toxic", "predicted").count().collect())
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8  # a tenth of the toxic labels here are on texts without toxic words
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.03


def test_toxicity_misspellings_and_repetition():
    texts = [f"w{i} this {'idiot' if i % 2 else 'lovely'} person k{i % 7}" for i in range(300)]
    table, bias, slope, intercept = tox.train(texts, np.arange(300) % 2 == 1, 0.5)
    value = lambda w: tox.word_values([w], table)[0]
    assert value("idiotz") > value("lovely") and value("idi0t") > value("person")
    _, code, seg, doc = tox.segments(pa.array(["a a a b", "", "c " * 40], pa.large_string()))
    per = -(-40 // tox.SEGMENT)
    assert len(code) == 2 + per and doc.tolist() == [0, 1] + [2] * per  # a repeated word counts once a segment


def test_toxicity_defined_cases(spark):
    docs = edge_docs(spark)
    held = F.crc32(F.col("id").cast("string")) % 4 == 2
    none = spark.createDataFrame([], "i long, t int")
    rows = tox.toxicity(docs, none, held).collect()
    assert len(rows) == docs.count() and {r["score"] for r in rows} == {0.0}
    labels = spark.createDataFrame([(6, 1), (6, None), (9, 0), (None, 1), (11, 0), (12, 1), (4, 0), (7, 1), (8, 0)],
                                   "i long, t int")
    rows = tox.toxicity(docs, labels, held).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert not [r for r in rows if r["id"] is None and r["held_out"]]
    assert tox.toxicity(no_docs(spark), labels, held).collect() == []


def first_hashed(spark, n, where="true"):
    return spark.range(n).where(where).orderBy(F.xxhash64("id")).first()["id"]


def test_toxicity_sample_goes_on_after_a_long_text(spark):
    word = lambda i: "idiot" if i % 2 else "lovely"
    firsts = {first_hashed(spark, 400, f"id % 2 = {k}") for k in (0, 1)}
    rows = [(i, " ".join([f"w{i} this {word(i)} person k{i % 7}"] * (2000 if i in firsts else 1))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "i long, t int")
    got = tox.toxicity(docs, labels, F.lit(False), max_bytes=40_000).collect()
    assert len(rows[min(firsts)][1]) > 40_000
    assert np.mean([r["predicted"] == r["id"] % 2 for r in got]) > 0.95


def test_kneser_ney_sample_goes_on_after_a_long_text(spark):
    held = F.pmod(F.xxhash64(F.lit("held out"), "id"), F.lit(kn.HELD)) == 0
    first = spark.range(300).where(~held).orderBy(F.xxhash64("id")).first()["id"]
    rng = np.random.default_rng(4)
    rows = [(i, "en", " ".join(f"w{k}" for k in rng.integers(0, 40, 9000 if i == first else 60))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = kn.judged(docs, docs.select("doc_id"), max_bytes=20_000).collect()
    assert len(rows[first][2]) > 20_000
    assert all(1 < r["perplexity"] < 100 and r["threshold"] is not None for r in got)


def test_kneser_ney_adds_up(spark):
    model = kn.train(sf_docs(spark).select("text").limit(40), scratch(spark, "test"))
    words = np.unique(model.word.keys)
    for a, b in ((words[3], words[5]), (kn.END, kn.END), (words[0], np.uint64(12345))):
        # every word after the context (a, b), and an unknown one for the mass of the rest
        h = np.r_[words, a, b, np.uint64(999)]
        n = len(words)
        token = np.r_[np.arange(n), n + 2]
        w2, w3 = np.full(n + 1, n + 1), token
        left = model.pair.find(kn.join2(h[np.full(n + 1, n)], h[w2]))
        at = model.word.find(h)
        p1 = model.word.get(at, 0, 0.0) + model.floor
        p2 = model.pair.get(model.pair.find(kn.join2(h[w2], h[w3])), 0, 0.0) + model.word.get(at, 1, 1.0)[w2] * p1[w3]
        p3 = (model.triple.get(model.triple.find(kn.join2(kn.join2(h[np.full(n + 1, n)], h[w2]), h[w3])), 0, 0.0)
              + model.pair.get(left, 1, 1.0) * p2)
        assert p3.sum() == pytest.approx(1.0, abs=1e-4)


def test_kneser_ney_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = (kn.op4_kneser_ney(spark, SF).join(labels, "doc_id").groupBy("quality")
            .agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect())
    kept = {r["quality"]: r["kept"] for r in rows}
    assert kept[1] > 0.99 and kept[0] < 0.4


def test_kneser_ney_quality_of_small_input(spark):
    small = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{small}/labels.parquet")
    rows = kn.op4_kneser_ney(spark, small).join(labels, "doc_id").select("quality", "threshold", "kept").collect()
    kept = {q: np.mean([r["kept"] for r in rows if r["quality"] == q]) for q in (0, 1)}
    assert all(r["threshold"] is not None for r in rows)
    assert kept[1] > 0.98 and kept[0] < 0.4


def test_kneser_ney_defined_cases(spark):
    docs = edge_docs(spark)
    none = kn.judged(docs, spark.createDataFrame([], "i long")).collect()
    assert len(none) == docs.count() and all(r["kept"] and r["perplexity"] is None for r in none)
    some = kn.judged(docs, spark.createDataFrame([(6,), (None,), (9,), (9,), (12,)], "i long")).collect()
    assert len(some) == docs.count() and all(r["perplexity"] > 1 for r in some)
    assert kn.judged(no_docs(spark), spark.createDataFrame([(6,)], "i long")).collect() == []


def test_kneser_ney_learns_from_all_trusted_text(spark):
    # more trusted ids than any sample held, one of them long: each repeats its own words, so all are alike
    rows = [(i, "en", f"a{i} b{i} a{i} b{i}") for i in range(4200)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    held = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(kn.HELD)) == 0
    got = kn.judged(docs, docs.select("doc_id")).withColumnRenamed("id", "doc_id").withColumn("held", held).collect()
    seen = [r["perplexity"] for r in got if not r["held"]]
    assert len(seen) > 3000 and max(seen) == pytest.approx(min(seen), rel=1e-6)
    assert min(r["perplexity"] for r in got if r["held"]) > 2 * max(seen)


def test_kneser_ney_learns_from_the_end_of_a_long_text(spark):
    held = F.pmod(F.xxhash64(F.lit("held out"), "id"), F.lit(kn.HELD)) == 0
    first, other = [r["id"] for r in spark.range(50).where(~held).orderBy("id").limit(2).collect()]
    docs = spark.createDataFrame([(first, "en", "x " * 20_000 + "the end of it"), (other, "en", "q r"),
                                  (100, "en", "the end of it"), (101, "en", "not a word there")],
                                 "doc_id long, lang string, text string")
    got = {r["id"]: r["perplexity"] for r in kn.judged(docs, docs.where("doc_id < 50").select("doc_id")).collect()}
    assert got[100] < got[101] / 2


@pytest.mark.parametrize("portion", [1 << 25, 1 << 17])
def test_kneser_ney_counts_joined_by_bucket(spark, monkeypatch, portion):
    monkeypatch.setattr(kn, "PORTION", portion)
    monkeypatch.setattr(kn, "BATCH_TEXT", 1 << 16)
    docs = edge_docs(spark, False).select("doc_id", "lang", "text").union(sf_docs(spark).selectExpr("doc_id + 100", "lang", "text"))
    trusted = docs.where("doc_id % 3 != 0").select("doc_id")
    rows = [sorted(((r["id"] or -1, r["n_tokens"], r["perplexity"], r["kept"])
                    for r in kn.judged(docs, trusted, max_bytes=n).collect())) for n in (kn.MAX_BROADCAST, 0)]
    assert len(rows[0]) == len(rows[1]) == docs.count()
    for a, b in zip(*rows):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-5) and a[3] == b[3]


def test_kneser_ney_words_of_a_line():
    texts = ["ab c", "", "x  y ", "a", "b", " \t\n\v\f\r", "é\tab c", "ab", "q" * 9000 + " ab " + "r" * 40_000 + "\nab", "ab"]
    h, bounds = kn.word_stream(pa.array(texts, pa.large_string()))
    words = [w for t in texts for w in t.encode().split()]
    assert bounds.tolist() == np.cumsum([0] + [len(t.encode().split()) for t in texts]).tolist()
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))


def test_kneser_ney_large_counts_are_not_written(spark, monkeypatch, tmp_path):
    # a frequent word has several buckets, texts of one id are fitted once; written counts of trigrams are what took too much disk
    monkeypatch.setattr(kn, "scratch", lambda spark, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    monkeypatch.setattr(kn, "PORTION", 1 << 12)
    monkeypatch.setattr(kn, "BUCKET_TEXT", 1 << 12)
    deals = []
    find = kn.deal_for
    monkeypatch.setattr(kn, "deal_for", lambda *a: deals.append(find(*a)) or deals[-1])
    rng = np.random.default_rng(7)
    rows = [(i % 190, "en", " ".join("the" if k < 30 else f"w{k}" for k in rng.integers(0, 90, 60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trusted = docs.where("doc_id % 3 != 0").select("doc_id")
    few, many = [sorted((r["id"], r["n_tokens"], r["perplexity"]) for r in kn.judged(docs, trusted, max_bytes=n).collect())
                 for n in (kn.MAX_BROADCAST, 0)]
    assert [r[:2] for r in few] == [r[:2] for r in many] and len(few) == len(rows)
    assert [r[2] for r in many] == pytest.approx([r[2] for r in few], rel=1e-5)
    assert deals[0].split.max() > 1
    assert not list(tmp_path.glob("*-1/triples")) and list(tmp_path.glob("*-1/sums5"))
