"""Substring deduplication: repeated fixed-length word windows (operator 10).

1. Tasks hash every window of ``width`` consecutive words of every text with
   two independent Rabin-Karp values: one deals the window to a bucket, the
   other is its 64-bit key there. Windows that repeat inside a task's batch are
   found there, and only one of them is sent on, so a passage that many
   documents share costs a row a batch, not a row a copy.
2. Each bucket counts its keys; a key sent by two batches is a repeated window,
   and its places go back to the batches they came from.
3. A batch turns its flagged places into maximal removal intervals a document.
4. The documents take their intervals and drop the words in them.

What travels is packed: 8 bytes of key and 2 to 4 of place a window, the texts
at most once. Two different windows are taken for equal with probability
2**-(64 + log2 buckets): under 1e-3 for any pair at all in 30 GB of text.

A batch is named by its task's partition and its number there, so the input
should be a table or written stage, which reads the same way each time.

Defined cases: null and empty texts have no words; texts of fewer than
``width`` words lose none; a very long text is a batch of its own (about 60
bytes a word); rows that repeat a document repeat all its windows, so all of
them go; ids may be null or repeat; an empty table gives an empty result;
other columns are passed through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import few_files, fresh, scratch, shuffle_partitions, stage
from lodestar.llm._hashing import BASE, BASE2, U64, mix, rolling, slices, word_hashes

#: Bytes of the table of intervals up to which it is broadcast to the documents.
MAX_BROADCAST_BYTES = 16 << 20
SENT = "bucket int, batch long, kind int, keys binary, places binary"


def _packed(places: np.ndarray) -> bytes:
    """Ascending places as gaps of two bytes, or as they are (four bytes) if a gap is larger."""
    gaps = np.diff(places, prepend=np.uint32(0))
    return b"\0" + gaps.astype(np.uint16).tobytes() if gaps.max() < 1 << 16 else b"\1" + places.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    if blob[0]:
        return np.frombuffer(blob, np.uint32, offset=1)
    return np.cumsum(np.frombuffer(blob, np.uint16, offset=1), dtype=np.uint32)


def _send(width: int, buckets: int, batch_words: int):
    """Tasks: documents (k1, k2, text) to packed rows; kinds: 0 windows, 1 map of the batch, 2 found here."""
    def flush(name, docs, hashes):
        h = np.concatenate(hashes)
        sizes = np.array([len(x) for x in hashes])
        ends = np.cumsum(sizes)
        key = rolling(h, width, BASE)
        place = np.flatnonzero(np.arange(len(key)) + width <= np.repeat(ends, sizes)[:len(key)])
        key = mix(key[place])
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.r_[True, k[1:] != k[:-1]] if len(k) else np.empty(0, bool)
        twice = ~new | np.r_[~new[1:], False] if len(k) else new
        rows = [(name % buckets, name, 1, np.array(docs, np.int64).tobytes(), (ends - sizes).tobytes())]
        if twice.any():
            here = np.sort(place[order[twice]]).astype(np.uint32)
            rows.append((name % buckets, name, 2, b"", _packed(here)))
        once = np.sort(order[new])
        key, place = key[once], place[once].astype(np.uint32)
        deal = (mix(rolling(mix(h), width, BASE2))[place] % U64(buckets)).astype(np.int64)
        order = np.argsort(deal, kind="stable")
        key, place, deal = key[order], place[order], deal[order]
        cuts = np.flatnonzero(np.r_[True, deal[1:] != deal[:-1]]) if len(deal) else []
        for i, j in zip(cuts, np.r_[cuts[1:], len(deal)].astype(int) if len(cuts) else []):
            rows.append((int(deal[i]), name, 0, key[i:j].tobytes(), _packed(place[i:j])))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
             pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())],
            ["bucket", "batch", "kind", "keys", "places"])

    def f(batches):
        name, docs, hashes, held = TaskContext.get().partitionId() << 32, [], [], 0
        for rb in batches:
            k1, k2, text = (rb.column(c) for c in ("k1", "k2", "text"))
            for i in range(rb.num_rows):
                t = text[i].as_buffer()
                h = word_hashes(t.to_pybytes() if t is not None else None)
                if len(h) < width:
                    continue
                docs.append((k1[i].as_py(), k2[i].as_py()))
                hashes.append(h)
                held += len(h)
                if held >= batch_words:
                    yield flush(name, docs, hashes)
                    name, docs, hashes, held = name + 1, [], [], 0
        if docs:
            yield flush(name, docs, hashes)
    return f


def _count(table: pa.Table) -> pa.Table:
    """One bucket: the places of keys that more than one batch sent; maps and local finds pass through."""
    kind = table.column("kind").to_numpy()
    batch = table.column("batch").to_numpy()
    rows = np.flatnonzero(kind == 0)
    keys, places = table.column("keys"), table.column("places")
    blobs = [np.frombuffer(keys[int(i)].as_buffer(), U64) for i in rows]
    out = []
    if len(rows) > 1:
        key = np.concatenate(blobs)
        sizes = np.array([len(b) for b in blobs])
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order] = np.r_[same, False] | np.r_[False, same]
        for i, b, e in zip(rows, np.cumsum(sizes) - sizes, np.cumsum(sizes)):
            if (hit := twice[b:e]).any():
                at = _unpacked(places[int(i)].as_py())[hit]
                out.append((batch[i], 2, b"", _packed(at)))
    passed = table.filter(pa.array(kind != 0)).select(["batch", "kind", "keys", "places"])
    cols = list(zip(*out)) if out else [(), (), (), ()]
    found = pa.table({"batch": pa.array(cols[0], pa.int64()), "kind": pa.array(cols[1], pa.int32()),
                      "keys": pa.array(cols[2], pa.binary()), "places": pa.array(cols[3], pa.binary())})
    return pa.concat_tables([passed.cast(found.schema), found])


def _intervals(width: int):
    """One batch: its flagged places as intervals (begin, end) of word numbers, merged, a row a document."""
    def f(table: pa.Table) -> pa.Table:
        docs, out = None, []
        flagged = []
        for kind, keys, places in zip(*(table.column(c).to_pylist() for c in ("kind", "keys", "places"))):
            if kind == 1:
                docs, begins = np.frombuffer(keys, np.int64).reshape(-1, 2), np.frombuffer(places, np.int64)
            else:
                flagged.append(_unpacked(places))
        if flagged:
            at = np.unique(np.concatenate(flagged)).astype(np.int64)
            doc = np.searchsorted(begins, at, side="right") - 1
            new = np.r_[True, (at[1:] > at[:-1] + width) | (doc[1:] != doc[:-1])]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(at)] - 1
            begin, end, of = at[first] - begins[doc[first]], at[last] + width - begins[doc[first]], doc[first]
            spans = np.stack([begin, end], 1)
            cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            for i, j in zip(cut, np.r_[cut[1:], len(of)]):
                out.append((*docs[of[i]], spans[i:j].tobytes()))
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.table({"k1": pa.array(cols[0], pa.int64()), "k2": pa.array(cols[1], pa.int64()),
                         "spans": pa.array(cols[2], pa.binary())})
    return f


def repeated_spans(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 35, batch_words: int = 1 << 20) -> DataFrame:
    """(k1, k2, spans): for documents with repeated windows, the maximal intervals those cover.

    ``k1`` and ``k2`` are hashes of the id and the text; ``spans`` is a sequence
    of int64 pairs (first word, word after the last).
    """
    spark = docs.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    sent = keyed(docs, id_col, text_col).mapInArrow(_send(width, buckets, batch_words), SENT)
    counted = sent.groupBy("bucket").applyInArrow(
        _count, "batch long, kind int, keys binary, places binary")
    spans = counted.groupBy("batch").applyInArrow(_intervals(width), "k1 long, k2 long, spans binary")
    return stage(spark, spans.groupBy("k1", "k2").agg(F.first("spans").alias("spans")), root, "spans")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs[text_col].cast("string")
    return docs.select(F.xxhash64(docs[id_col].cast("string")).alias("k1"),
                       F.xxhash64(text).alias("k2"), text.alias("text"))


def _kept(batches):
    """(text, spans) to the number of words, of removed words, and the text that stays."""
    for rb in slices(batches):
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(rb.column("text").cast(pa.large_binary()), rb.column("spans")):
            text, spans = text.as_py() or b"", spans.as_py()
            ws = text.split()
            n_words.append(len(ws))
            out, at, gone = [], 0, 0
            for b, e in np.frombuffer(spans, np.int64).reshape(-1, 2).tolist() if spans else ():
                out += ws[at:b]
                at, gone = e, gone + e - b
            kept.append(b" ".join(out + ws[at:] if gone else ws))
            n_removed.append(gone)
        yield pa.RecordBatch.from_arrays(
            [*(rb.column(i) for i in range(rb.num_columns - 2)), pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64()),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.large_binary())],
            [*rb.schema.names[:-2], "w", "r", "s", "t"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35,
                   carry: list[str] | None = None, text: bool = True,
                   batch_words: int = 1 << 20) -> DataFrame:
    """``carry`` columns (all by default) of each row plus n_words, n_removed, kept_sha256 and kept_text.

    ``kept_text`` (left out with ``text=False``) is the kept words joined by one space. A name that
    ``carry`` has already gets underscores in front.
    """
    spark = docs.sparkSession
    root = scratch(spark, "substring")
    spans = repeated_spans(docs, root, id_col, text_col, width, batch_words)
    size = spans.agg(F.sum(F.octet_length("spans") + 24)).first()[0] or 0
    if size <= MAX_BROADCAST_BYTES:
        spans = F.broadcast(spans)
    carry = docs.columns if carry is None else carry
    doc, k1, k2, body = (fresh(docs, c) for c in ("doc", "k1", "k2", "body"))
    rows = docs.select(F.struct(*[docs[c] for c in carry]).alias(doc),
                       F.xxhash64(docs[id_col].cast("string")).alias(k1),
                       F.xxhash64(docs[text_col].cast("string")).alias(k2),
                       docs[text_col].cast("string").alias(body))
    joined = rows.join(spans, (rows[k1] == spans["k1"]) & (rows[k2] == spans["k2"]), "left")
    joined = joined.select(F.col(doc).alias("doc"), F.col(body).alias("text"), "spans")
    kind = joined.schema["doc"].dataType.simpleString()
    done = joined.mapInArrow(_trimmed if not text else _kept,
                             f"doc {kind}, w long, r long, s string" + ", t binary" * text)
    own = docs.select(*carry)
    out = [F.col(c).alias(fresh(own, name)) for c, name in
           (("w", "n_words"), ("r", "n_removed"), ("s", "kept_sha256"))]
    return done.select("doc.*", *out, *[F.col("t").cast("string").alias(fresh(own, "kept_text"))] * text)


def _trimmed(batches):
    for rb in _kept(batches):
        yield rb.select(rb.schema.names[:-1])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    chars_col: str | None = "n_chars", **options) -> DataFrame:
    """The documents with repeated passages removed, columns as in ``docs``.

    A text that loses nothing stays as it is; ``chars_col``, if there, is counted anew where words went.
    """
    new, gone = fresh(docs, "kept_text"), fresh(docs, "n_removed")
    done = remove_repeats(docs, id_col, text_col, **options)
    lost = F.col(gone) > 0
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.when(lost, F.col(new)).otherwise(F.col(c)).alias(c))
        elif c == chars_col:
            cols.append(F.when(lost, F.length(new)).otherwise(F.col(c))
                        .cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return done.select(*cols)


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return few_files(remove_repeats(docs, carry=["doc_id"], text=False))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w
  FROM documents),
x AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS p, w FROM d WHERE len(w) >= 35),
k AS (SELECT doc_id, p, md5(list_aggregate(w[p:p + 34], 'string_agg', ' ')) AS k FROM x),
r AS (SELECT doc_id, p FROM k QUALIFY count(*) OVER (PARTITION BY k) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM r),
a AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
f AS (
  SELECT d.doc_id, d.w, coalesce(a.gone, []::BIGINT[]) AS gone FROM d LEFT JOIN a USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
       sha256(coalesce(list_aggregate(CASE WHEN len(gone) = 0 THEN w ELSE
         list_filter(w, lambda v, i: NOT list_contains(gone, i)) END, 'string_agg', ' '), ''))
         AS kept_sha256
FROM f
"""
