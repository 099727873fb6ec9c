"""The pipeline against a plain-Python version of its five stages."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lodestar.llm import rules
from lodestar.llm._common import scratch, stage
from tests.llm.common import SF, edge_docs, no_docs, words
from tests.llm.test_minhash import brute as brute_components
from tests.llm.test_mixing import reshare
from tests.llm.test_packing import ids_of
from tests.llm.test_rules import base, grams

BITS = 14


def accepted(docs, good):
    raw, fine = Counter(), Counter()
    by = {d: grams(r["text"], BITS) for d, r in docs.items()}
    for d, g in by.items():
        raw.update(g)
        if d in good:
            fine.update(g)
    n = 1 << BITS
    total = [sum(c for b, c in raw.items() if b // n == k) for k in range(3)]
    part = [sum(c for b, c in fine.items() if b // n == k) for k in range(3)]
    value = {b: math.log((fine[b] + 8) / (c * part[b // n] / total[b // n] + 8)) for b, c in raw.items()}
    score = {d: sum(value[b] for b in g) / max(3 * ((len(g) + 1) // 3) - 1, 1) for d, g in by.items()}
    assert all(abs(s + 0.15) > 1e-6 for s in score.values())
    return {d: r for d, r in docs.items() if not base(r["text"])[5] and score[d] >= -0.15}


def near_dedup(docs):
    kept = {d for d, _, _, k in brute_components([(d, r["text"]) for d, r in docs.items()]) if k}
    return {d: r for d, r in docs.items() if d in kept}


def without_repeats(docs, width=35):
    ws = {d: words(r["text"]) for d, r in docs.items()}
    seen = Counter(tuple(w[i:i + width]) for w in ws.values() for i in range(len(w) - width + 1))
    out = {}
    for d, r in docs.items():
        w, gone = ws[d], set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r["text"]
        out[d] = {**r, "text": text, "n_chars": len(text) if gone else r["n_chars"]}
    return out


def mixed(docs):
    size = {d: len(words(r["text"])) for d, r in docs.items()}
    total = defaultdict(int)
    for d, r in docs.items():
        total[r["source"]] += size[d]
    out = []
    for source, target in reshare(total).items():
        ids = [d for d, r in docs.items() if r["source"] == source]
        ids.sort(key=lambda d: hashlib.md5(f"mix:{d}".encode()).hexdigest())
        epochs = int(target // total[source]) if total[source] else 0
        left = target - epochs * total[source]
        for d in ids:
            out += [(d, docs[d]["text"])] * epochs
            if size[d] <= left:
                out.append((d, docs[d]["text"]))
            elif left >= 1:
                out.append((d, " ".join(words(docs[d]["text"])[:int(left)])))
            left = max(left - size[d], 0)
    return out


def test_stages_against_plain_python(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    docs = {r["doc_id"]: r.asDict() for r in rows}
    good = {r["doc_id"] for r in rules.trusted_ids(spark, SF).collect()}
    steps = [lambda d: accepted(d, good), near_dedup, without_repeats]
    df, root = spark.read.parquet(f"{SF}/documents.parquet"), scratch(spark, "test")
    for (name, f), plain in zip(corpus_pipeline.STAGES, steps):
        columns = df.columns
        df = stage(spark, f(spark, df, SF), root, name)
        docs = plain(docs)
        assert df.columns == columns
        assert {r["doc_id"]: r.asDict() for r in df.collect()} == docs, name
    df = stage(spark, corpus_pipeline.STAGES[3][1](spark, df, SF), root, "mix")
    # a document of no words may stand at either side of a cut without changing the mix
    want = Counter(x for x in mixed(docs) if words(x[1]))
    assert Counter((r["doc_id"], r["text"]) for r in df.collect() if words(r["text"])) == want

    pieces, sequences = Counter(), defaultdict(list)
    for r in corpus_pipeline.STAGES[4][1](spark, df, SF).collect():
        pieces[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = Counter()
    for r in df.collect():
        ids = np.array(ids_of(r["text"]), "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            expected[r["doc_id"], k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())] += 1
    assert pieces == expected
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset", "ids"} <= set(out.columns) and out.count() > 0


def test_stages_on_odd_and_empty_tables(spark):
    for docs in (edge_docs(spark), no_docs(spark)):
        root = scratch(spark, "test")
        docs = stage(spark, docs, root, "docs")
        for name, f in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, f(spark, docs, SF), root, name)
            assert name == "pack" or docs.columns == columns
        docs.agg(F.count("*")).collect()
