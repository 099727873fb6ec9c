"""Small inputs and plain-Python reference versions for the operator tests."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, lower=False):
    found = WORD.findall(text or "")
    return [w.translate(LOWER) for w in found] if lower else found


def numbered(n, word="w"):
    return " ".join(f"{word}{i}" for i in range(n))


def edge_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, copies."""
    long = " ".join(f"x{i * i % 9973}" for i in range(60_000))
    base = numbered(120)
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4),
        (None, "one two three", None, "b", None), (None, base, "en", "b", None),
        (4, "one", "en", "b", 3), (5, "One", "en", "b", 3), (6, base, "en", "a", 1), (7, base, "en", "a", 1),
        (7, base, "en", "a", 1), (8, base + " extra", "en", None, 1), (9, numbered(90, "q"), "fr", "c", 1),
        (10, long, "en", "c", 1), (11, numbered(40, "é") + "   tail", "de", "d", 1),
        (12, numbered(60, "z") + "\n" + numbered(40), "fr", "e", 1),
    ]


#: Names that the operators use inside or give out, as further columns of the input.
CLASHING = ("id", "words", "size", "kept", "node", "bucket", "score", "mix", "rules", "n_words", "spans",
            "k1", "K2", "target", "title", "component_id", "kept_text", "n_removed", "mix_copy", "rep", "h")


def edge_docs(spark, clash=True):
    df = spark.createDataFrame(edge_rows(), DOCS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}) if clash else df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, a):
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
