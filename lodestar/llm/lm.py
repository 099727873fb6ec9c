"""Language-model scoring from a log-frequency Bloom filter (operator 2).

Training, on the documents that are not held out:

1. Tasks count words and pairs of neighbouring tokens in batches (64-bit
   hashes; every text is its words and one end token, which also stands before
   the first word) and send the pre-aggregated counts, packed, to buckets.
2. Buckets add up the counts. A count c is quantised to the level
   ``1 + floor(log(c) / log(1.5))`` and its n-gram is put into the bucket's part
   of a Bloom filter once for each level up to its own, so repeated membership
   probes, until the first miss, give the level back.
3. A bucket's part has ``ITEM`` bits for each counted item (and a least size),
   so no n-gram is left out and the filters grow with the corpus. Up to
   ``MAX_BROADCAST`` bytes in all they are broadcast. Beyond, the parts stay rows
   on the shared folder: texts are dealt to batches, a batch's distinct n-grams
   go to their buckets (five or six bytes each), and the levels found there come back to the batch in the
   order asked (a byte each). Both ways probe the same filters and give the same scores.

The model interpolates: ``P(w | h) = (c(h,w) - 0.75) / c(h) + (1 - r(h)) P1(w)``,
where counts are quantised ones from the filter, r(h) is the share that the
pairs in the filter take of h (a third filter, in sixteenths, rounded up) and
``P1(w) = (c(w) + 0.1) / (sum of c + 0.1 (V + 1))``.

The base score needs exact counts: those of at most ``head`` words, the most frequent ones,
are broadcast (16 bytes each), the other words' are joined by hash, and what
travels for them is a row for each such word of a document.

Defined cases: null and empty texts are one end token; a row with a null id is
not held out; rows that repeat are scored each on its own and count as often
as they stand there; very long texts are hashed in parts; without training
documents all counts are 0; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodestar.llm._common import scratch, shuffle_partitions, stage
from lodestar.llm._hashing import U64, bucket_of, distinct, mix, placed, slices, word_hashes

END = U64(xxhash.xxh3_64_intdigest(b"\n"))
BASE = 1.5
DISCOUNT = 0.75
SHARES = 16
PROBES = 6
#: Odd multiplier that tells the levels of a key apart.
LEVELS = 0x9E3779B97F4A7C15
#: Bits of a filter for each item.
ITEM = 16
#: Least bytes of the filters of words, pairs and shares.
LEAST = (1 << 23, 1 << 24, 1 << 22)
#: Bytes up to which the filters are broadcast.
MAX_BROADCAST = sum(LEAST)
SENT = "bucket int, kind int, ones binary, keys binary, counts binary"


def level(c: np.ndarray) -> np.ndarray:
    return (1 + np.floor(np.log(np.maximum(c, 1)) / math.log(BASE) + 1e-9)).astype(np.int64)


def counts_of_levels(most: int = 110) -> np.ndarray:
    """The count a level stands for, the mean of its integers; 0 for level 0."""
    out = [0.0]
    for q in range(1, most):
        lo, hi = math.ceil(BASE ** (q - 1) - 1e-9), math.ceil(BASE ** q - 1e-9) - 1
        out.append((lo + hi) / 2 if hi >= lo else BASE ** (q - 0.5))
    return np.array(out)


MEANS = counts_of_levels()
#: Highest level of words, pairs and shares.
MOST = (109, 109, SHARES)
TOPS = BASE ** np.arange(110.0)


def tokens(text: bytes | None) -> np.ndarray:
    return np.r_[END, word_hashes(text, lower=True), END].astype(U64)


def pairs(t: np.ndarray) -> np.ndarray:
    """Keys of neighbouring tokens: 32 bits of each, the first one's on top."""
    return (t[:-1] >> U64(32) << U64(32)) | (t[1:] >> U64(32))


def _joined(held: list[np.ndarray]) -> np.ndarray:
    """Token sequences joined at their ends: the end of a text is the token before the next one's first word."""
    return np.concatenate([held[0], *(t[1:] for t in held[1:])])


def ngrams(t: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of a token sequence: its distinct words, pairs and contexts in order, and the place of each token, pair and word there."""
    words, w = placed(t)
    contexts = words >> U64(32)
    new = np.r_[True, contexts[1:] != contexts[:-1]]
    return [(words, w), placed(pairs(t)), (contexts[new], np.cumsum(new) - 1)]


# ------------------------------------------------------------ Bloom filters


def filter_keys(key: np.ndarray) -> np.ndarray:
    """48 bits of each key, by which a bucket's part knows it; its bucket comes from all 64."""
    return mix(key) >> U64(16)


def packed(key: np.ndarray) -> bytes:
    """Ascending filter keys as gaps of five bytes, or of six if a gap is larger; the first byte says which."""
    gaps = np.diff(key, prepend=U64(0))
    size = 5 if gaps.max(initial=0) < 1 << 40 else 6
    return bytes([size]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The filter keys of packed ones."""
    size = data[0]
    gaps = np.frombuffer(data, np.uint8, offset=1).reshape(-1, size)
    out = np.zeros((len(gaps), 8), np.uint8)
    out[:, :size] = gaps
    return np.cumsum(out.view("<u8").ravel(), dtype=U64)


def _bits(key: np.ndarray, q: int, size: int):
    """The PROBES bit numbers (below ``size``) of (key, level), one array after the other."""
    h = mix(key + U64(LEVELS * q & (1 << 64) - 1))
    step = mix(h) | U64(1)
    for i in range(PROBES):
        yield ((h + U64(i) * step) % U64(size)).astype(np.int64)


def bits_for(q: np.ndarray, kind: int, buckets: int) -> int:
    """Bits (whole bytes) of a bucket's part that holds levels 1..q of every key."""
    return 8 * max(LEAST[kind] // buckets, 8, -(-ITEM * int(q.sum()) // 8))


def fill(key: np.ndarray, q: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A filter of ``size`` bits with (key, 1..q), and which keys are in it (the most frequent that fit)."""
    room = int(size * math.log(2) / PROBES)
    items = np.bincount(q, weights=q, minlength=2)[::-1].cumsum()[::-1]  # items of this level and above
    least = int(np.argmax(items <= room)) if (items <= room).any() else len(items)
    kept = q >= max(least, 1)
    bits = np.zeros(size, bool)
    k, q = filter_keys(key[kept]), q[kept]
    for j in range(1, int(q.max(initial=0)) + 1):
        for at in _bits(k[q >= j], j, size):
            bits[at] = True
    return np.packbits(bits, bitorder="little"), kept


def probe(bitmap: np.ndarray, key: np.ndarray, part: np.ndarray, size: int | np.ndarray,
          most: int = 109) -> np.ndarray:
    """The level of each key in its part: probes j = 1, 2, ... until the first miss.

    All parts have ``size`` bits, or part i has ``size[i]``.
    """
    return probe_filter_keys(bitmap, filter_keys(key), part, size, most)


def probe_filter_keys(bitmap: np.ndarray, key: np.ndarray, part: np.ndarray, size: int | np.ndarray,
                      most: int = 109) -> np.ndarray:
    """``probe`` for filter keys."""
    out = np.zeros(len(key), np.int64)
    alive = np.arange(len(key))
    part = part.astype(np.int64)
    if np.ndim(size):
        base, size = (np.cumsum(size) - size)[part], size[part].astype(U64)
    else:
        base, size = part * size, np.full(len(key), size, U64)
    for j in range(1, most + 1):
        hit = alive
        # bit after bit: most misses show at the first ones
        h = mix(key[hit] + U64(LEVELS * j & (1 << 64) - 1))
        step = mix(h) | U64(1)
        for i in range(PROBES):
            at = base[hit] + ((h + U64(i) * step) % size[hit]).astype(np.int64)
            ok = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            hit, h, step = hit[ok], h[ok], step[ok]
        out[hit] = j
        alive = hit
        if not len(alive):
            break
    return out


# ----------------------------------------------------------------- counting


def _deal(kind: int, keys: np.ndarray, counts: np.ndarray, buckets: int):
    """Packed rows (bucket, kind, keys counted once, other keys, their counts)."""
    b = bucket_of(keys, buckets)
    order = np.argsort(counts > 1, kind="stable")
    order = order[np.argsort(b[order], kind="stable")]
    b, keys, counts = b[order], keys[order], counts[order]
    cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else []
    for i, j in zip(cuts, np.r_[cuts[1:], len(b)].astype(int) if len(cuts) else []):
        one = i + int((counts[i:j] == 1).sum())
        yield (int(b[i]), kind, keys[i:one].tobytes(), keys[one:j].tobytes(),
               counts[one:j].astype(np.uint32).tobytes())


def _count(buckets: int, batch_tokens: int):
    def flush(held):
        rows = []
        t = _joined(held)
        for kind, keys in ((0, t[1:]), (1, pairs(t))):
            rows += _deal(kind, *np.unique(keys, return_counts=True), buckets)
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
             *(pa.array(c, pa.binary()) for c in cols[2:])], ["bucket", "kind", "ones", "keys", "counts"])

    def f(batches):
        held, n = [], 0
        for rb in slices(batches):
            for t in rb.column("text").cast(pa.large_binary()):
                held.append(tokens(t.as_py()))
                n += len(held[-1])
                if n >= batch_tokens:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)
    return f


def _total(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys of packed rows and their summed counts."""
    ones = np.frombuffer(b"".join(table.column("ones").to_pylist()), U64)
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), U64)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32)
    keys = np.r_[ones, keys]
    counts = np.r_[np.ones(len(ones), np.int64), counts.astype(np.int64)]
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


ADDED = "kind int, bucket int, key long, value double, bits binary"


def _added(kind, bucket, keys, values, bits) -> pa.Table:
    """Rows (key, value) of one kind, and one row with the bucket's filter part."""
    n = len(keys)
    last = np.arange(n + 1) == n
    return pa.table({"kind": pa.array(np.where(last, kind + 10, kind), pa.int32()),
                     "bucket": pa.array(np.full(n + 1, bucket), pa.int32()),
                     "key": pa.array(np.append(keys.view(np.int64), 0), mask=last),
                     "value": pa.array(np.append(values, 0.0), mask=last),
                     "bits": pa.array([None] * n + [bits.tobytes()], pa.binary())})


def _add_up(buckets: int):
    """One bucket and kind: words and their counts, or contexts and what their pairs take."""
    def f(key: tuple, table: pa.Table) -> pa.Table:
        bucket, kind = key[0].as_py(), key[1].as_py()
        keys, counts = _total(table)
        q = level(counts)
        bits, _ = fill(keys, q, bits_for(q, kind, buckets))
        if kind == 0:
            return _added(0, bucket, keys, counts.astype(float), bits)
        first, taken = keys >> U64(32), MEANS[q] - DISCOUNT
        at = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else np.empty(0, np.int64)
        return _added(1, bucket, first[at], np.add.reduceat(taken, at) if len(at) else taken, bits)
    return f


def _shares(buckets: int):
    def f(key: tuple, table: pa.Table) -> pa.Table:
        keys, q = table.column("key").to_numpy().astype(U64), table.column("q").to_numpy().astype(np.int64)
        bits, _ = fill(keys, q, bits_for(q, 2, buckets))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([bits.tobytes()], pa.binary())})
    return f


class Model:
    """What scoring needs; the filters only if they are broadcast (``parts``: kind, then bucket, to bytes)."""

    def __init__(self, buckets: int, n: int, v: int, mass: float, head: tuple[bytes, bytes],
                 parts: dict[int, dict[int, bytes]] | None):
        self.buckets, self.n, self.v, self.mass, self.head = buckets, n, v, mass, head
        self.filters = {}
        for kind, own in (parts or {}).items():
            each = [own.get(b, bytes(8)) for b in range(buckets)]
            self.filters[kind] = b"".join(each), 8 * np.array([len(x) for x in each], np.int64)

    def level(self, kind: int, key: np.ndarray) -> np.ndarray:
        bitmap, size = self.filters[kind]
        return probe(np.frombuffer(bitmap, np.uint8), key, mix(key) % U64(self.buckets), size, MOST[kind])

    def head_counts(self, words: np.ndarray) -> np.ndarray:
        """Exact counts of the words in the head, -1 for others."""
        keys, counts = np.frombuffer(self.head[0], U64), np.frombuffer(self.head[1], np.int64)
        at = np.minimum(np.searchsorted(keys, words), max(len(keys) - 1, 0))
        return np.where(keys[at] == words, counts[at], -1) if len(keys) else np.full(len(words), -1)

    def log10(self, t: np.ndarray) -> np.ndarray:
        """log10 P of each token after the first of a token sequence (texts joined at their ends)."""
        grams = ngrams(t)
        return self.log10_of(grams, [self.level(kind, keys) for kind, (keys, _) in enumerate(grams)])

    def log10_of(self, grams: list[tuple[np.ndarray, np.ndarray]], levels: list[np.ndarray]) -> np.ndarray:
        """``log10`` of a sequence's ``ngrams`` and the levels of its distinct words, pairs and contexts."""
        (_, w), (_, inverse), (_, context) = grams
        q = levels[0]
        p1 = (MEANS[q] + 0.1) / (self.mass + 0.1 * (self.v + 1))
        r = levels[2][context] / SHARES
        c = MEANS[levels[1]][inverse]
        a, b = w[:-1], w[1:]
        seen = (q[a] > 0) & (c > 0)
        p2 = np.where(seen, (c - DISCOUNT) / TOPS[q[a]], 0.0)
        taken = np.where(q[a] > 0, r[a], 0.0)
        # a context that its pairs fill leaves one part in SHARES to other words
        p2 = np.where(taken == 1, p2 * (1 - 1 / SHARES), p2)
        return np.log10(np.minimum(p2 + np.maximum(1 - taken, 1 / SHARES) * p1[b], 1.0))


def train(texts: DataFrame, root: str, head: int = 200_000, batch_tokens: int = 1 << 20) -> tuple[Model, DataFrame]:
    """The model of the ``text`` column with its filters, and the exact vocabulary (h, c)."""
    return _train(texts, root, head, batch_tokens, None)[:2]


def _train(texts: DataFrame, root: str, head: int, batch_tokens: int,
           max_broadcast: int | None) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the exact vocabulary (h, c), and the filters' parts (kind, bucket, bits).

    Beyond ``max_broadcast`` bytes of parts the model has no filters.
    """
    spark = texts.sparkSession
    buckets = min(4 * shuffle_partitions(spark), 1 << 16)  # a bucket's number has 16 bits beside a key
    sent = texts.select("text").mapInArrow(_count(buckets, batch_tokens), SENT)
    added = stage(spark, sent.groupBy("bucket", "kind").applyInArrow(_add_up(buckets), ADDED), root, "added")
    vocab = added.where("kind = 0").select(F.col("key").alias("h"), F.col("value").cast("long").alias("c"))
    n, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    inside = added.where("kind = 0")
    q = F.floor(F.log(F.col("value")) / math.log(BASE) + 1e-9).cast("int") + 1
    mean = F.element_at(F.array(*[F.lit(float(x)) for x in MEANS[1:90]]), q)
    mass = inside.agg(F.coalesce(F.sum(mean), F.lit(0.0))).first()[0]
    contexts = (inside.select(F.shiftrightunsigned("key", 32).alias("key"), "value").groupBy("key")
                .agg(F.max("value").alias("value"))
                .select("key", F.pow(F.lit(BASE), q.cast("double")).alias("top")))
    taken = added.where("kind = 1").groupBy("key").agg(F.sum("value").alias("taken"))
    share = F.least(F.ceil(SHARES * F.col("taken") / F.col("top")), F.lit(SHARES))
    shares = (contexts.join(taken, "key").select("key", share.cast("int").alias("q")))
    dealt = shares.mapInArrow(_bucket_of(buckets), "bucket int, key long, q int")
    shares = stage(spark, dealt.groupBy("bucket").applyInArrow(_shares(buckets), "bucket int, bits binary"),
                   root, "shares")

    filters = (added.where("kind >= 10").select((F.col("kind") - 10).alias("kind"), "bucket", "bits")
               .union(shares.select(F.lit(2).alias("kind"), "bucket", "bits")))
    size = filters.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
    parts: dict[int, dict[int, bytes]] | None = None
    if max_broadcast is None or size <= max_broadcast:
        parts = {0: {}, 1: {}, 2: {}}
        for r in filters.toLocalIterator():
            parts[r["kind"]][r["bucket"]] = bytes(r["bits"])
    # the counts from the top on that together belong to at most ``head`` words: one row a count
    often = vocab.groupBy("c").agg(F.count("*").alias("n"))
    cut = (often.withColumn("above", F.sum("n").over(Window.orderBy(F.desc("c")))).where(F.col("above") <= head)
           .agg(F.min("c")).first()[0])
    top = vocab.where(F.col("c") >= (cut if cut is not None else n + 1)).toArrow()
    keys = top.column("h").to_numpy().view(U64)
    order = np.argsort(keys)
    counts = top.column("c").to_numpy()[order]
    model = Model(buckets, int(n), int(v), float(mass), (keys[order].tobytes(), counts.tobytes()), parts)
    return model, vocab, filters


def _bucket_of(buckets: int):
    def f(batches):
        for rb in batches:
            key = rb.column("key").to_numpy().astype(U64)
            b = (mix(key) % U64(buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(b), rb.column("key"), rb.column("q")],
                                             ["bucket", "key", "q"])
    return f


NAMES = ["rid", "n_tokens", "n_head", "base_head", "score", "words", "times"]


def _score_texts(m: Model, rids: list, held: list, levels=None) -> pa.RecordBatch:
    """Scores, the base score of head words, and the other words with their numbers, of token sequences.

    ``levels`` gives the levels of their ``ngrams``; by default they are probed in the broadcast filters.
    """
    n = np.array([len(t) - 1 for t in held])
    starts = np.cumsum(n) - n
    grams = ngrams(_joined(held))
    found = [*levels(grams)] if levels else [m.level(kind, keys) for kind, (keys, _) in enumerate(grams)]
    score = np.add.reduceat(m.log10_of(grams, found), starts)
    doc = np.repeat(np.arange(len(held)), n)
    words, inverse = grams[0][0], grams[0][1][1:]
    c = m.head_counts(words)
    log = np.where(c >= 0, np.log10((np.maximum(c, 0) + 0.1) / (m.n + 0.1 * (m.v + 1))), 0.0)
    base = np.add.reduceat(log[inverse], starts)
    known = np.add.reduceat((c[inverse] > 0).astype(np.int64), starts)
    rest = np.flatnonzero(c[inverse] < 0)
    out_w: list = [[] for _ in held]
    out_n: list = [[] for _ in held]
    if len(rest):
        both, times = np.unique(doc[rest] * len(words) + inverse[rest], return_counts=True)
        d = both // len(words)
        w = words[both % len(words)].view(np.int64)
        cut = np.searchsorted(d, np.arange(len(held) + 1))
        for i in range(len(held)):
            out_w[i], out_n[i] = w[cut[i]:cut[i + 1]], times[cut[i]:cut[i + 1]].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(rids, pa.int64()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base),
         pa.array(score), pa.array(out_w, pa.list_(pa.int64())), pa.array(out_n, pa.list_(pa.int32()))],
        NAMES)


def _score(model, batch_tokens: int):
    """Rows (rid, text) to the columns of ``_score_texts``, with the broadcast filters."""
    def f(batches):
        m, rids, held, n = model.value, [], [], 0
        for rb in slices(batches):
            for rid, t in zip(rb.column("rid").to_pylist(), rb.column("text").cast(pa.large_binary())):
                rids.append(rid)
                held.append(tokens(t.as_py()))
                n += len(held[-1])
                if n >= batch_tokens:
                    yield _score_texts(m, rids, held)
                    rids, held, n = [], [], 0
        if held:
            yield _score_texts(m, rids, held)
    return f


def _number(batch_bytes: int):
    """Rows with ``batch``, the number of their batch's first row; a batch ends at ``batch_bytes`` of text."""
    def f(batches):
        first, n = None, 0
        for rb in slices(batches):
            sizes = pc.fill_null(pc.binary_length(rb.column("text")), 0).to_pylist()
            own = []
            for rid, size in zip(rb.column("rid").to_pylist(), sizes):
                first, n = (rid, 0) if first is None or n >= batch_bytes else (first, n)
                own.append(first)
                n += size + 8
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(own, pa.int64())], [*rb.schema.names, "batch"])
    return f


def _dealt(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets (16 bits) above filter keys (48 bits): in this order keys are asked, so one sort gives both."""
    return bucket_of(keys, buckets).astype(U64) << U64(48) | filter_keys(keys)


def _ask(buckets: int):
    """The distinct n-grams of batches, packed: rows (batch, bucket, kind, keys), one a bucket and kind."""
    def flush(batch, held):
        rows = []
        t = _joined(held)
        words = distinct(t)
        for kind, keys in enumerate((words, distinct(pairs(t)), distinct(words >> U64(32)))):
            keys = np.sort(_dealt(keys, buckets))
            b, own = keys >> U64(48), keys & U64((1 << 48) - 1)
            cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
            rows += [(batch, int(b[i]), kind, packed(own[i:j])) for i, j in zip(cuts, np.r_[cuts[1:], len(b)])]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
            ["batch", "bucket", "kind", "keys"])

    def f(batches):
        batch, held = None, []
        for rb in slices(batches):
            for own, t in zip(rb.column("batch").to_pylist(), rb.column("text").cast(pa.large_binary())):
                if held and own != batch:
                    yield flush(batch, held)
                    held = []
                batch = own
                held.append(tokens(t.as_py()))
        if held:
            yield flush(batch, held)
    return f


def _answer(asked: pa.Table, part: pa.Table) -> pa.Table:
    """The levels of the keys asked of one bucket and kind, in the order asked, a byte each.

    The keys of many batches are probed at once, each once: a bucket is asked a little by each batch.
    """
    levels = []
    bits = part.column("bits")[0].as_py() if part.num_rows else bytes(8)
    bitmap = np.frombuffer(bits, np.uint8)
    most = MOST[asked.column("kind")[0].as_py()] if asked.num_rows else 0  # a bucket may be asked nothing
    held, n = [], 0

    def flush():
        key, which = placed(np.concatenate(held))
        q = probe_filter_keys(bitmap, key, np.zeros(len(key), np.int64), 8 * len(bitmap), most).astype(np.uint8)
        levels.extend(x.tobytes() for x in np.split(q[which], np.cumsum([len(k) for k in held])[:-1]))

    for keys in asked.column("keys"):
        held.append(unpacked(keys.as_py()))
        n += len(held[-1])
        if n >= 1 << 20:
            flush()
            held, n = [], 0
    if held:
        flush()
    return pa.table([asked.column("batch"), asked.column("kind"), asked.column("bucket"), pa.array(levels, pa.binary())],
                    ["batch", "kind", "bucket", "levels"])


def _score_batch(model):
    """A batch's texts and the levels of its n-grams to the columns of ``_score_texts``, id and held_out."""
    def f(rows: pa.Table, answers: pa.Table) -> pa.Table:
        held = [tokens(t.as_py()) for t in rows.column("text").cast(pa.large_binary())]
        given = {(k, b): q for k, b, q in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "levels")))}

        def levels(grams):
            for kind, (keys, _) in enumerate(grams):
                dealt = _dealt(keys, model.value.buckets)
                order = np.argsort(dealt)
                own = distinct(dealt[order] >> U64(48)).tolist()
                out = np.empty(len(keys), np.int64)
                out[order] = np.frombuffer(b"".join(given[kind, b] for b in own), np.uint8)
                yield out

        out = pa.Table.from_batches([_score_texts(model.value, rows.column("rid").to_pylist(), held, levels)])
        return out.append_column("id", rows.column("id")).append_column("held_out", rows.column("held_out"))
    return f


def scored(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
           head: int = 200_000, batch_tokens: int = 1 << 20, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row of ``docs``.

    ``held_out`` is a boolean column of ``docs``; the other rows are learnt from.
    """
    spark = docs.sparkSession
    root = scratch(spark, "lm")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    model, vocab, filters = _train(rows.where(~F.col("held_out")), root, head, batch_tokens, max_broadcast)
    sent = spark.sparkContext.broadcast(model)
    keyed = rows.withColumn("rid", F.monotonically_increasing_id())
    # ids are kept beside the number of the row by the same pass
    kind = rows.schema["id"].dataType.simpleString()
    inner = _score(sent, batch_tokens)

    def with_ids(batches):
        kept: dict = {}

        def remember():
            for rb in batches:
                for r, i, h in zip(*(rb.column(c).to_pylist() for c in ("rid", "id", "held_out"))):
                    kept[r] = (i, h)
                yield rb
        for out in inner(remember()):
            own = [kept.pop(r) for r in out.column("rid").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array([o[0] for o in own], ids), pa.array([o[1] for o in own], pa.bool_())],
                [*out.schema.names, "id", "held_out"])

    ids = to_arrow_type(rows.schema["id"].dataType)
    schema = ("rid long, n_tokens long, n_head long, base_head double, score double, words array<long>, "
              f"times array<int>, id {kind}, held_out boolean")
    if model.filters:
        base = keyed.mapInArrow(with_ids, schema)
    else:
        dealt = stage(spark, keyed.select("rid", "id", "held_out", "text").mapInArrow(
            _number(4 * batch_tokens), f"rid long, id {kind}, held_out boolean, text string, batch long"),
            root, "batches")
        asked = dealt.select("batch", "text").mapInArrow(
            _ask(model.buckets), "batch long, bucket int, kind int, keys binary")
        answers = stage(spark, asked.groupBy("bucket", "kind").cogroup(filters.groupBy("bucket", "kind")).applyInArrow(
            _answer, "batch long, kind int, bucket int, levels binary"), root, "levels")
        base = (dealt.groupBy("batch").cogroup(answers.groupBy("batch"))
                .applyInArrow(_score_batch(sent), schema))
    base = stage(spark, base, root, "scores")
    total = model.n + 0.1 * (model.v + 1)
    tail = (base.select("rid", F.explode(F.arrays_zip("words", "times")).alias("w"))
            .select("rid", F.col("w.words").alias("h"), F.col("w.times").alias("times")))
    found = tail.join(vocab, "h", "left").select(
        "rid", F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / total)).alias("part"))
    rest = found.groupBy("rid").agg(F.sum("known").alias("known"), F.sum("part").alias("part"))
    return base.join(rest, "rid", "left").select(
        "id", "held_out", "n_tokens",
        (F.col("n_head") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base_head") + F.coalesce("part", F.lit(0.0))).alias("base_score"), "score")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return scored(docs, held_out).withColumnRenamed("id", "doc_id")
