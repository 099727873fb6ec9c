"""Toxicity: subword-bag embeddings averaged into a linear softmax (operator 9).

A word's vector is the mean of the embeddings of its character n-grams (3 to 5
characters of ``<word>``, hashed to ``2**BITS`` rows), so an unseen misspelling
shares most of its vectors with the word it hides. A segment of ``SEGMENT``
words is the mean over that many places, with a repeated word once and nothing
in the other places (so neither a mild word said often nor a short last segment
weighs more), and a linear softmax over two classes gives its score; a text scores as its most toxic segment, so a long text does not dilute
a short insult. Embeddings and softmax are trained jointly, in numpy, by
Adagrad: first on all segments of the sample, then on each toxic text's most
toxic segments against the others' most toxic ones. Last, a logistic curve is fitted to
the texts' scores, weighted to the labels' true shares.

The model is fitted on a bounded sample of labelled texts, at most ``most``
(toxic, other) texts and ``max_bytes`` of text, split between the classes as
``most`` is, in the order of a hash of the id. Texts above 1/64 of their class's
bytes (64 KiB of toxic ones) come after the others, the shortest first, and none
gives more than its first 1/16 in characters, so no long text ends the sample.
As both layers are linear, a text needs one number per n-gram row, which is all
that is broadcast (1 MiB). Every text is scored whole.

Defined cases: null and empty texts have one segment without words, whose logit
is the bias; rows that repeat score alike; rows with a null id are not held out
and never have labels; of repeated labels the largest counts and null labels
are ignored; without labels of both classes all scores are 0; very long texts
are scored on their own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm._common import hash_sample, scratch, stage
from lodestar.llm._hashing import U64, mix
from lodestar.llm.packing import text_slices, word_codes

BITS = 17
DIM = 8
SEGMENT = 8
SIZES = (3, 4, 5)


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, row) of every character n-gram of the words."""
    size = np.array([len(w) for w in words], np.int64) + 2
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(U64)
    ends = np.repeat(np.cumsum(size), size)
    word = np.repeat(np.arange(len(words), dtype=np.int32), size)
    of, row = [], []
    for n in SIZES:
        k = len(chars) - n + 1
        if k <= 0:
            continue
        h = np.full(k, n, U64)
        for j in range(n):
            h = h * U64(0x100000001B3) + chars[j:j + k]
        inside = np.arange(k) + n <= ends[:k]
        of.append(word[:k][inside])
        row.append((mix(h[inside]) >> U64(64 - BITS)).astype(np.int32))
    return (np.concatenate(of), np.concatenate(row)) if of else (np.empty(0, np.int32),) * 2


def word_values(words: list[str], table: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
    """Mean over each word's n-grams of ``table``, some words at a time."""
    out = [np.empty(0)]
    for at in range(0, len(words), chunk):
        some = words[at:at + chunk]
        of, row = ngrams(some)
        n = np.maximum(np.bincount(of, minlength=len(some)), 1)
        out.append(np.bincount(of, weights=table[row], minlength=len(some)) / n)
    return np.concatenate(out)


def segments(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, and for each word of each segment its number and the segment's; text of each segment).

    Every text has at least one segment.
    """
    words, code, bounds = word_codes(pc.utf8_lower(texts))
    n = np.diff(bounds)
    per = np.maximum(-(-n // SEGMENT), 1)
    first = np.cumsum(per) - per
    place = np.arange(len(code)) - np.repeat(bounds[:-1], n)
    both = np.unique((np.repeat(first, n) + place // SEGMENT) * len(words) + code)
    return words, both % max(len(words), 1), both // max(len(words), 1), np.repeat(np.arange(len(texts)), per)


def segment_means(value: np.ndarray, code: np.ndarray, seg: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(seg, weights=value[code], minlength=count) / SEGMENT


def train(texts: list[str], toxic: np.ndarray, share: float, epochs: int = 10, rate: float = 0.2,
          seed: int = 9) -> tuple[np.ndarray, float, float, float]:
    """(value of each n-gram row, bias, slope, intercept); ``share`` is the labels' share of toxic texts."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM))
    out = np.zeros((DIM, 2))
    bias = np.zeros(2)
    g_emb, g_out, g_bias = np.full(1 << BITS, 1e-8), np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
    words, code, seg, doc = segments(pa.array(texts, pa.large_string()))
    of, row = ngrams(words)
    order = np.argsort(of, kind="stable")
    of, row = of[order], row[order]
    start = np.searchsorted(of, np.arange(len(words) + 1))
    at = np.searchsorted(seg, np.arange(len(doc) + 1))
    label = toxic[doc].astype(np.int64)

    even = label.mean() / max(1 - label.mean(), 1e-9)  # as many clean segments as toxic texts have

    def logits() -> np.ndarray:
        value = word_mean(emb @ (out[:, 1] - out[:, 0]))
        return segment_means(value, code, seg, len(doc)) + bias[1] - bias[0]

    def word_mean(table: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=table[row], minlength=len(words)) / np.maximum(np.diff(start), 1)

    def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        n = hi - lo
        return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())

    for epoch in range(epochs):
        chosen = np.flatnonzero(rng.random(len(doc)) < np.where(label == 1, 1.0, even))
        if epoch >= 2:  # the most toxic segments of each text: two where it is toxic, four where not
            z = logits()
            order = np.lexsort((-z, doc))
            rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
            chosen = order[rank < np.where(toxic[doc[order]], 2, 4)]
        for batch in np.array_split(rng.permutation(chosen), max(1, len(chosen) // 512)):
            places = ranges(at[batch], at[batch + 1])
            who = np.repeat(np.arange(len(batch)), at[batch + 1] - at[batch])
            w = code[places]
            grams = ranges(start[w], start[w + 1])
            per_word = start[w + 1] - start[w]
            weight = np.repeat(1 / (per_word * SEGMENT), per_word)
            owner, rows = np.repeat(who, per_word), row[grams]
            x = np.stack([np.bincount(owner, weights=emb[rows, d] * weight, minlength=len(batch))
                          for d in range(DIM)], 1)
            z = x @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), label[batch]] -= 1
            go, gb, gx = x.T @ p / len(batch), p.mean(0), p @ out.T
            used, inv = np.unique(rows, return_inverse=True)
            ge = np.stack([np.bincount(inv, weights=gx[owner, d] * weight, minlength=len(used))
                           for d in range(DIM)], 1)
            g_emb[used] += (ge ** 2).mean(1)
            g_out += go ** 2
            g_bias += gb ** 2
            emb[used] -= rate * ge / np.sqrt(g_emb[used])[:, None]
            out -= rate * go / np.sqrt(g_out)
            bias -= rate * gb / np.sqrt(g_bias)

    z = np.full(len(texts), -np.inf)
    np.maximum.at(z, doc, logits())
    weight = np.where(toxic, share / max(toxic.mean(), 1e-9), (1 - share) / max(1 - toxic.mean(), 1e-9))
    slope, intercept = 1.0, 0.0
    for _ in range(50):  # Newton steps of a weighted logistic fit, slightly regularised
        p = 1 / (1 + np.exp(-np.clip(slope * z + intercept, -40, 40)))
        d, h = weight * (p - toxic), weight * p * (1 - p) + 1e-9
        g = np.array([(d * z).sum() + 0.1 * (slope - 1), d.sum()])
        m = np.array([[(h * z * z).sum() + 0.1, (h * z).sum()], [(h * z).sum(), h.sum() + 0.1]])
        step = np.clip(np.linalg.solve(m, g), -2, 2)
        slope, intercept = max(slope - step[0], 0.05), intercept - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return emb @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]), float(slope), float(intercept)


def _score(model):
    def f(batches):
        for rb in batches:
            out = [np.empty(0)]
            for b, e, texts in text_slices(rb.column("text"), 1 << 21):
                if model.value is None:
                    out.append(np.zeros(e - b))
                    continue
                table, bias, slope, intercept = model.value
                words, code, seg, doc = segments(texts)
                z = np.full(e - b, -np.inf)
                np.maximum.at(z, doc, segment_means(word_values(words, table), code, seg, len(doc)) + bias)
                out.append(1 / (1 + np.exp(-np.clip(slope * z + intercept, -40, 40))))
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), rb.column("held_out"), pa.array(np.concatenate(out))],
                ["id", "held_out", "score"])
    return f


def sample(docs: DataFrame, labels: DataFrame, root: str, id_col: str, text_col: str,
           most: tuple[int, int], max_bytes: int) -> tuple[list[str], np.ndarray, float]:
    """Texts and classes of the sample, and the share of toxic ones among all usable labels."""
    spark = docs.sparkSession
    known = (labels.toDF("id", "toxic").where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id")
             .agg((F.max("toxic") > 0).alias("toxic")))
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not share or share == 1:
        return [], np.empty(0, bool), 0.0
    ids = [hash_sample(known.where(F.col("toxic") == t), n) for t, n in zip((True, False), most)]
    ids = stage(spark, ids[0].union(ids[1]), root, "ids")
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    room = F.when(F.col("toxic"), max_bytes * most[0] // sum(most)).otherwise(max_bytes * most[1] // sum(most))
    begin = F.left("text", F.greatest((room / 16).cast("int"), F.lit(1)))
    found = stage(spark, text.join(F.broadcast(ids), "id").where("text IS NOT NULL")
                  .withColumn("text", begin).groupBy("id", "toxic").agg(F.max("text").alias("text")), root, "texts")
    sizes = found.select("id", "toxic", F.octet_length("text").alias("bytes"))
    long = F.when(F.col("bytes") > room / 64, F.col("bytes")).otherwise(0)
    so_far = Window.partitionBy("toxic").orderBy(long, F.xxhash64("id"), "id")
    fit = stage(spark, sizes.withColumn("sum", F.sum("bytes").over(so_far)).where(F.col("sum") <= room)
                .select("id"), root, "fit")
    rows = found.join(F.broadcast(fit), "id", "left_semi")
    rows = sorted(rows.collect(), key=lambda r: r["id"])  # at most max_bytes of text
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], bool), float(share)


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id",
             text_col: str = "text", most: tuple[int, int] = (1500, 4500), max_bytes: int = 16 << 20,
             threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted), a row per row of ``docs``.

    ``labels`` has the columns id and label; ``held_out`` is a boolean column
    over ``id``, and labels of such rows are not used.
    """
    spark = docs.sparkSession
    own = labels.toDF("id", "toxic").where(~F.coalesce(held_out, F.lit(False)))
    texts, toxic, share = sample(docs, own, scratch(spark, "toxicity"), id_col, text_col, most, max_bytes)
    model = train(texts, toxic, share) if toxic.any() and not toxic.all() else None
    sent = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(_score(sent), f"id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.crc32(F.col("id").cast("string")) % 4 == 2
    return toxicity(docs, labels, held_out).withColumnRenamed("id", "doc_id")
