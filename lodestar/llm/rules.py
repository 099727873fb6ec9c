"""Quality rules: base counts and a hashed n-gram log-likelihood ratio (operator 7).

DataFrame functions only. N-grams of a text are its words, its pairs of
neighbouring words and the last three characters of its words, each kind
hashed to ``2**bits`` buckets. Two multinomials over the buckets, one from the
trusted documents and one from all documents, come from one aggregation whose
groups are the buckets, so what is shuffled and kept is bounded by them
whatever the corpus. A text's score is the mean over its n-grams of
``log(p_trusted / p_raw)``; every text is kept or not by one fixed threshold.

Trusted documents are at most ``max_trusted`` ids (chosen by hash), 8 bytes each, which bounds the broadcast; the raw side is every
document. Both counts of a bucket are raised by ``prior`` occurrences at the
raw rate, so n-grams that are too rare to tell count about 0, and without
trusted documents all scores are 0.

Defined cases: null and empty texts have no words, all counts 0, score 0, and
fail the base rules; equal words in a window are compared by 64-bit hashes;
rows that repeat are judged alike; null ids are never trusted; an empty table
gives an empty result; other columns are passed through untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import fresh, hash_sample, scratch, stage, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _pairwise(hashes: Column, apart: int) -> Column:
    """Hashes of the elements that stand ``apart`` places from each other."""
    n = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + apart), n),
                      lambda a, b: F.xxhash64(a, b))


def _with_hashes(docs: DataFrame, text_col: str) -> tuple[DataFrame, str, str, str]:
    """``docs`` plus the words of the text, their hashes, and the hashes of neighbouring pairs; the names."""
    ws, h, h2 = fresh(docs, "words"), fresh(docs, "hashes"), fresh(docs, "pairs")
    df = docs.withColumn(ws, words(F.col(text_col).cast("string")))
    df = df.withColumn(h, F.transform(F.col(ws), lambda w: F.xxhash64(w)))
    return df.withColumn(h2, _pairwise(F.col(h), 1)), ws, h, h2


def _buckets(bits: int, ws: Column, h: Column, h2: Column):
    """(array, bucket of an element) for each kind of n-gram; kinds have their own ranges."""
    n = 1 << bits
    low = lambda kind, x: (x.bitwiseAND(F.lit(n - 1)) + kind * n).cast("int")
    return [(h, lambda x: low(0, x)), (h2, lambda x: low(1, x)),
            (ws, lambda w: low(2, F.xxhash64(F.right(w, F.lit(3)))))]


def ratios(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, bits: int,
           max_trusted: int, prior: float) -> list[float]:
    """log(p_trusted / p_raw) of each of the 3 * 2**bits buckets; ``trusted`` has one column of ids."""
    ids = trusted.toDF("id").where("id IS NOT NULL").distinct()
    ids = hash_sample(ids, max_trusted)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows, *names = _with_hashes(rows.join(F.broadcast(ids.withColumn("t", F.lit(1))), "id", "left"), "text")
    grams = F.concat(*[F.transform(a, f) for a, f in _buckets(bits, *map(F.col, names))])
    counts = (rows.select(F.coalesce("t", F.lit(0)).alias("t"), F.explode(grams).alias("bucket"))
              .groupBy("bucket")
              .agg(F.count("*").alias("raw"), F.sum("t").alias("good")))
    counts = stage(docs.sparkSession, counts, scratch(docs.sparkSession, "rules"), "counts")
    n = 1 << bits
    table = [0.0] * (3 * n)
    found = counts.collect()  # at most 3 * 2**bits rows
    for kind in range(3):
        mine = [r for r in found if r["bucket"] // n == kind]
        raw, good = sum(r["raw"] for r in mine), sum(r["good"] for r in mine)
        for r in mine if good else ():
            table[r["bucket"]] = math.log((r["good"] + prior) / (r["raw"] * good / raw + prior))
    return table


def base_counts(ws: Column, text: Column) -> dict[str, Column]:
    """The counts that need no windows, of a text and its words."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: F.length(F.translate(x, " \t\n\u000b\f\r", "")) > 0)
    return {"n_words": F.size(ws).cast("long"),
            "word_chars": F.length(F.array_join(ws, "")).cast("long"),
            "n_symbols": F.coalesce(F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
                                    F.lit(0)).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")}


def _repeated(df: DataFrame, h2: str, out: str) -> DataFrame:
    """``df`` plus ``out``: words in windows of WINDOW (8) words that are found twice or more.

    Hashes of pairs give those of four and of eight words. They are sorted with
    their places; equal neighbours are repeats, and the sorted places of those
    tell the covered words. Texts without repeats (most) stop after one distinct.
    """
    h4, win, srt, at = (fresh(df, c) for c in ("h4", "win", "srt", "at"))
    col = F.col
    df = df.withColumn(h4, _pairwise(col(h2), 2)).withColumn(win, _pairwise(col(h4), 4))
    df = df.withColumn(srt, F.when(F.size(F.array_distinct(col(win))) < F.size(win), F.sort_array(
        F.transform(col(win), lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    n = F.size(srt)
    twice = F.filter(col(srt), lambda e, i: (
        F.get(col(srt), i - 1)["x"].eqNullSafe(e["x"]) | F.get(col(srt), i + 1)["x"].eqNullSafe(e["x"])))
    df = df.withColumn(at, F.when(n > 0, F.sort_array(F.transform(twice, lambda e: e["i"]))))
    gaps = F.zip_with(col(at), F.slice(col(at), F.lit(2), F.size(at) - 1),
                      lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(gaps, F.lit(0), lambda s, g: s + g)
    return df.withColumn(out, F.coalesce(total, F.lit(0)).cast("long")).drop(h4, win, srt, at)


def quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            bits: int = 14, max_trusted: int = 50_000, prior: float = 8.0, threshold: float = -0.15,
            min_words: int = 20, max_repeat_percent: int = 30, out: str = "rules") -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of the counts, score, base_failed and kept; and its name."""
    table = ratios(docs, trusted, id_col, text_col, bits, max_trusted, prior)
    model = F.split(F.lit(",".join(f"{x:.5g}" for x in table)), ",").cast("array<double>")
    df, ws, h, h2 = _with_hashes(docs, text_col)
    rep, score = fresh(df, "rep"), fresh(df, "score")
    df = _repeated(df, h2, rep)
    adding = lambda f: lambda s, x: s + F.get(model, f(x))
    total = sum((F.aggregate(a, F.lit(0.0), adding(f))
                 for a, f in _buckets(bits, F.col(ws), F.col(h), F.col(h2))), F.lit(0.0))
    n = F.greatest(3 * F.size(ws) - 1, F.lit(1))
    df = df.withColumn(score, F.round(total / n, 9))
    counts = base_counts(F.col(ws), F.col(text_col).cast("string"))
    failed = (counts["n_words"] < min_words) | (100 * F.col(rep) > max_repeat_percent * counts["n_words"])
    name = fresh(docs, out)
    verdict = F.struct(*[c.alias(k) for k, c in counts.items()], F.col(rep).alias("n_repeat_words"),
                       F.col(score).alias("score"), failed.alias("base_failed"),
                       (~failed & (F.col(score) >= threshold)).alias("kept"))
    # The explode of one element keeps a filter on the verdict above these expressions; pushed below,
    # it would hold each of them many times over.
    return df.select(*[df[c] for c in docs.columns], F.explode(F.array(verdict)).alias(name)), name


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose label says good quality."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")


def accepted(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The documents that pass, columns as in ``docs``."""
    judged, name = quality(docs, trusted, **options)
    return judged.where(F.col(f"{name}.kept")).select(*[judged[c] for c in docs.columns])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged, name = quality(docs, trusted_ids(spark, sf_dir))
    return judged.select("doc_id", *[F.col(f"{name}.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")])
