"""Quality classifier: perplexity under a Kneser-Ney model of trusted text (operator 4).

An interpolated modified Kneser-Ney trigram model of the whole texts of all trusted
documents but those held out for the thresholds (one in ``HELD`` trusted ids, by a hash).

1. Counts that come to at most ``MAX_BROADCAST`` bytes (estimated from the text): tasks count the trigrams of batches of
   text and send them, packed, to buckets by the hash of the context; a bucket adds them up. Pairs are counted by their
   distinct trigrams, dealt by their first words, and words by their distinct pairs. The three discounts of each
   order come from the counts of counts. The weights are made in the driver and broadcast; each task looks its
   documents' n-grams up.
2. Larger counts stay in buckets. Trigrams go to the bucket of their middle word, where their counts, those of their contexts
   and the pairs of their last two words meet; a frequent middle word has several buckets, dealt by the word before,
   and the counts of its pairs are summed apart. A first pass over the trusted text gives the discounts, the counts of
   words and those pairs. A second one sends the trigrams of all texts, trusted ones marked, at most
   ``PORTIONS`` portions of the buckets after each other, so that no trigram's count is written and
   only a portion is on disk; a bucket asks for the counts of its words and frequent words' pairs and returns
   each text's sum of log10 probabilities. Both ways give the same probabilities.
3. A document's mean negative log10 probability, drawn towards the median of its
   language as if by ``prior_tokens`` more tokens, is compared with its language's
   threshold: the ``quantile`` of the trusted documents held out, plus
   ``margin``. A language with fewer than ``least`` of them takes the threshold of
   all together, and without any (a handful of trusted ids) everything is kept.

A task holds a batch (about ``BATCH_TEXT`` bytes of text), or a bucket (the trigrams of about ``BUCKET_TEXT`` bytes of
text); all pairs that begin with one frequent word are counted in one bucket, at most one for each word of the vocabulary,
and all trigrams with the same first two words are in one bucket.
Rows are numbered, so for counts in buckets the input should be a table or written stage, which reads the same way each time.

Defined cases: null and empty texts are one end token; null languages are a
language; null ids are never trusted; rows that repeat are judged alike, and
an id's largest text is fitted; very long texts are a batch of their own; without trusted text all perplexities are
null and all rows kept; an empty table gives an empty result; other columns
are ignored by ``judged``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import return_freed, scratch, shuffle_partitions, small, stage
from lodestar.llm._hashing import BASE, U64, _powers, bucket_of, distinct, mix, placed
from lodestar.llm.packing import text_slices, word_codes

#: Words are known by the upper 48 bits of their hash.
KNOWN = U64((1 << 64) - (1 << 16))
END = U64(xxhash.xxh3_64_intdigest(b"\n")) & KNOWN
SHARD_BITS = 16
#: One in so many trusted ids is kept out of the fit, for the thresholds.
HELD = 5
#: Most trusted ids that are broadcast.
MAX_IDS = 2_000_000
#: Bytes of counts up to which the weights are broadcast.
MAX_BROADCAST = 24 << 20
#: Bytes of counts that a byte of text makes at most, nearly.
COUNTS_A_BYTE = 2.5
#: Bytes of text of a batch whose trigrams are sent together, and of a portion, of which there are at most PORTIONS.
BATCH_TEXT = 8 << 20
PORTION = 32 << 20
PORTIONS = 6
#: Bytes of text whose trigrams a bucket holds, whose words one holds, and of text that is looked at for frequent words.
BUCKET_TEXT = 8 << 20
WORDS_TEXT = 32 << 20
SEEN = 16 << 20
_COUNTED = "bucket int, keys binary, counts binary"
_PART = "bucket int, kind int, keys binary, counts binary"


def join2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from those of its beginning and its last word."""
    return mix(a * U64(0x9E3779B97F4A7C15) + b)


def token_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct word, its number at each token, number of the token before, text of the token).

    A text is its words and the end; the end also stands before the first word.
    """
    words, code, bounds = word_codes(texts)
    hashes = np.r_[np.array([xxhash.xxh3_64_intdigest(w) for w in words], U64) & KNOWN, END]
    n = np.diff(bounds) + 1
    doc = np.repeat(np.arange(len(n)), n)
    token = np.full(n.sum(), len(words), np.int64)
    token[np.arange(len(code)) + np.repeat(np.arange(len(n)), n - 1)] = code
    return hashes, token, np.r_[len(words), token[:-1]], doc


def _grams(h: np.ndarray, token: np.ndarray, before: np.ndarray, doc: np.ndarray):
    """(first token of a text, the three words) of each token of ``token_stream``."""
    first = np.r_[True, doc[1:] != doc[:-1]]
    w3, w2 = h[token], h[before]
    return first, np.where(first, END, np.r_[END, w2[:-1]]), w2, w3


# ----------------------------------------------------------------- counting


def _six(x: np.ndarray) -> np.ndarray:
    """The upper 48 bits of each value, as rows of six bytes."""
    return (x >> U64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _from_six(data: bytes) -> np.ndarray:
    """Values of six bytes each, their lower bits 0."""
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, 2:] = six
    return out.view("<u8").ravel()


def _packed(w: np.ndarray) -> bytes:
    """N-grams (a row each) as the number of their words, the words, and their places there, first words first."""
    words, at = placed(w.T.ravel())
    narrow = np.uint16 if len(words) <= 1 << 16 else np.uint32
    return np.uint32(len(words)).tobytes() + _six(words).tobytes() + at.astype(narrow).tobytes()


def _unpacked(blobs: list, width: int) -> np.ndarray:
    """The n-grams of packed ones."""
    out = [np.empty((0, width), U64)]
    for blob in blobs:
        n = int(np.frombuffer(blob, np.uint32, 1)[0])
        at = np.frombuffer(blob, np.uint16 if n <= 1 << 16 else np.uint32, offset=4 + 6 * n)
        out.append(_from_six(blob[4:4 + 6 * n])[at].reshape(width, -1).T)
    return np.concatenate(out)


def _context(w: np.ndarray) -> np.ndarray:
    """What the n-grams ``w`` (a row each) are counted under: all words but the last."""
    return join2(w[:, 0], w[:, 1]) if w.shape[1] == 3 else w[:, 0] if w.shape[1] == 2 else np.zeros(len(w), U64)


def _key(w: np.ndarray) -> np.ndarray:
    return w[:, 0] if w.shape[1] == 1 else join2(_context(w), w[:, -1])


def _begins(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.empty(0, np.int64)


def _added(w: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of ``w`` and their summed counts."""
    key = _key(w)
    order = np.argsort(key)
    at = _begins(key[order])
    return w[order[at]], np.add.reduceat(counts[order], at) if len(at) else counts


def _runs(bucket: np.ndarray):
    """(order by bucket, [(bucket, begin, end)] in it)."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    at = _begins(b)
    return order, [(int(b[i]), int(i), int(j)) for i, j in zip(at, np.r_[at[1:], len(b)].astype(int))]


def _batch(rows: list, names: list[str], types: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _counts_by(w: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Packed n-grams with counts, dealt by what they are counted under (words: by the word)."""
    order, runs = _runs(bucket_of(_context(w) if w.shape[1] > 1 else w[:, 0], buckets))
    w, counts = w[order], counts[order].astype(np.uint32)
    return _batch([(b, _packed(w[i:j]), counts[i:j].tobytes()) for b, i, j in runs],
                  ["bucket", "keys", "counts"], [pa.int32(), pa.binary(), pa.binary()])


def _trigrams(buckets: int):
    def f(batches):
        for rb in batches:
            for b, e, texts in text_slices(rb.column("text")):
                w = np.stack(_grams(*token_stream(texts))[1:], 1)
                yield _counts_by(*_added(w, np.ones(len(w), np.int64)), buckets)
    return f


def _shorter(width: int, buckets: int):
    """Counted n-grams to theirs without the first word, each counted once."""
    def f(batches):
        for rb in batches:
            for keys in rb.column("keys"):
                w = _unpacked([keys.as_py()], width)[:, 1:]
                yield _counts_by(*_added(w, np.ones(len(w), np.int64)), buckets)
    return f


def _add_up(width: int):
    """One bucket's packed counts, added up, in the order of what they are counted under."""
    def f(table: pa.Table) -> pa.Table:
        w, c = _added(_unpacked(table.column("keys").to_pylist(), width),
                      np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32).astype(np.int64))
        order = np.argsort(_context(w), kind="stable")
        w, c = w[order], c[order]
        n = [int((c == i).sum()) for i in (1, 2, 3, 4)]
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "keys": [_packed(w)],
                         "counts": [c.astype(np.uint32).tobytes()], **{f"n{i}": [v] for i, v in enumerate(n, 1)},
                         "grams": [len(c)], "total": [int(c.sum())]})
    return f


def _counted(sent: DataFrame, width: int, root: str, name: str) -> DataFrame:
    longs = "".join(f", {c} long" for c in ("n1", "n2", "n3", "n4", "grams", "total"))
    return stage(sent.sparkSession, sent.groupBy("bucket").applyInArrow(_add_up(width), _COUNTED + longs), root, name)


def _discounts(counted: DataFrame) -> list[float]:
    n1, n2, n3, n4 = counted.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in (1, 2, 3, 4)]).first()
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    return [min(max(v, 0.0), i) for i, v in enumerate((
        1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0,
        3 - 4 * y * n4 / n3 if n3 else 1.5), 1)]


def _off(c: np.ndarray, d: list[float]) -> np.ndarray:
    """The discount of each count."""
    return np.r_[0.0, d][np.minimum(c, 3)]


def _totals(context: np.ndarray, c: np.ndarray):
    """Of ordered contexts: (where each begins, sum of counts, number of ones, of twos, of n-grams)."""
    at = _begins(context)
    n = [c, c == 1, c == 2, np.ones(len(c), np.int64)]
    return at, [np.add.reduceat(x.astype(np.int64), at) if len(at) else np.empty(0, np.int64) for x in n]


def _gamma(total, n1, n2, n, d: list[float]) -> np.ndarray:
    """The mass that a context leaves to the lower order; 1 where it was not seen."""
    return np.where(total > 0, (d[0] * n1 + d[1] * n2 + d[2] * (n - n1 - n2)) / np.maximum(total, 1), 1.0)


class Counts:
    """The counted trigrams, pairs (by distinct words before them) and words (by distinct pairs), and their discounts."""

    def __init__(self, texts: DataFrame, root: str):
        spark = texts.sparkSession
        self.buckets = 4 * shuffle_partitions(spark)
        sent = texts.select("text").mapInArrow(_trigrams(self.buckets), _COUNTED)
        self.triples = _counted(sent, 3, root, "triples")
        self.pairs = _counted(self.triples.select("keys").mapInArrow(_shorter(3, self.buckets), _COUNTED), 2, root, "pairs")
        self.words = _counted(self.pairs.select("keys").mapInArrow(_shorter(2, self.buckets), _COUNTED), 1, root, "words")
        self.d1, self.d2, self.d3 = map(_discounts, (self.words, self.pairs, self.triples))
        self.total, self.n, n1, n2 = self.words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "grams", "n1", "n2")]).first()
        self.floor = float(_gamma(self.total, n1, n2, self.n, self.d1)) / (self.n + 1)


# --------------------------------------------------- weights in one place


class Shards:
    """Keys with values, sharded by the leading bits of the key."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        keys = keys.astype(np.int64).view(U64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = [np.asarray(v, np.float32)[order] for v in values]
        self.begin = np.searchsorted(self.keys >> U64(64 - SHARD_BITS), np.arange((1 << SHARD_BITS) + 1))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, or -1."""
        shard = (keys >> U64(64 - SHARD_BITS)).astype(np.int64)
        at, end = self.begin[shard], self.begin[shard + 1]
        out = np.full(len(keys), -1, np.int64)
        left = np.flatnonzero(at < end)
        at = at[left]
        while len(left):
            hit = self.keys[at] == keys[left]
            out[left[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at < end[left])
            left, at = left[go], at[go]
        return out

    def get(self, at: np.ndarray, value: int, missing: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(at), missing)
        return np.where(at >= 0, self.values[value][np.maximum(at, 0)], missing)


class Model:
    """word: (alpha1, gamma2); pair: (alpha2, gamma3); triple: (alpha3)."""

    def __init__(self, word: Shards, pair: Shards, triple: Shards, floor: float):
        self.word, self.pair, self.triple, self.floor = word, pair, triple, floor

    def log10(self, h: np.ndarray, token: np.ndarray, before: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """log10 P of each token of ``token_stream``."""
        at = self.word.find(h)
        p1 = self.word.get(at, 0, 0.0) + self.floor
        g2 = self.word.get(at, 1, 1.0)
        w2, w3 = h[before], h[token]
        first = np.r_[True, doc[1:] != doc[:-1]]
        w1 = np.where(first, END, np.r_[END, w2[:-1]])
        right = self.pair.find(join2(w2, w3))
        p2 = self.pair.get(right, 0, 0.0) + g2[before] * p1[token]
        left = np.where(first, self.pair.find(join2(np.full(1, END), np.full(1, END)))[0], np.r_[-1, right[:-1]])
        p3 = self.pair.get(left, 1, 1.0) * p2
        seen = np.flatnonzero(left >= 0)
        p3[seen] += self.triple.get(self.triple.find(join2(join2(w1[seen], w2[seen]), w3[seen])), 0, 0.0)
        return np.log10(np.minimum(p3, 1.0))


def train(texts: DataFrame, root: str) -> Model | None:
    """The model of the ``text`` column (few texts), or None if there is none."""
    return _model(Counts(texts, root))


def _model(counts: Counts) -> Model | None:
    """The weights of counts that one place can hold."""
    def weights(counted: DataFrame, width: int, d: list[float]):
        """(key, alpha) of the n-grams and (key, gamma) of what they are counted under."""
        rows = counted.select("keys", "counts").toArrow()
        w = _unpacked(rows.column("keys").to_pylist(), width)
        c = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.uint32).astype(np.int64)
        context = _context(w)
        order = np.argsort(context, kind="stable")
        w, c, context = w[order], c[order], context[order]
        at, totals = _totals(context, c)
        total = np.repeat(totals[0], np.diff(np.r_[at, len(c)]))
        return _key(w), (c - _off(c, d)) / total, context[at], _gamma(*totals, d)

    def both(keys, alpha, contexts, gamma) -> Shards:
        every = np.sort(np.r_[keys, contexts])
        every = every[_begins(every)]
        values = np.zeros(len(every)), np.ones(len(every))
        values[0][np.searchsorted(every, keys)] = alpha
        values[1][np.searchsorted(every, contexts)] = gamma
        return Shards(every, *values)

    if not counts.n:
        return None
    key1, alpha1, _, _ = weights(counts.words, 1, counts.d1)
    key2, alpha2, context2, gamma2 = weights(counts.pairs, 2, counts.d2)
    key3, alpha3, context3, gamma3 = weights(counts.triples, 3, counts.d3)
    return Model(both(key1, alpha1, context2, gamma2), both(key2, alpha2, context3, gamma3), Shards(key3, alpha3),
                 counts.floor)


def _score(model):
    def f(batches):
        m = model.value
        for rb in batches:
            n, total = [np.empty(0, np.int64)], [np.empty(0)]
            for b, e, texts in text_slices(rb.column("text")):
                h, token, before, doc = token_stream(texts)
                n.append(np.bincount(doc, minlength=e - b))
                total.append(-np.bincount(doc, weights=m.log10(h, token, before, doc), minlength=e - b)
                             if m else np.zeros(e - b))
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), rb.column("lang"), pa.array(np.concatenate(n)),
                 pa.array(np.concatenate(total), mask=np.full(rb.num_rows, m is None))],
                ["id", "lang", "n_tokens", "neg_log10"])
    return f


# ------------------------------------------------ larger models, bucket by bucket


_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: A random value of each byte, for hashing.
_BYTE = np.array([xxhash.xxh3_64_intdigest(bytes([i]), 4) for i in range(256)], U64)
#: Longer words are hashed one by one; the others in pieces of about so many bytes.
_LONG, _PIECE = 1 << 12, 1 << 15
#: Tokens whose buckets are found at once, and bytes of text whose words are: arrays of a few hundred KB.
_STEP, _SLICE = 1 << 15, 1 << 18
_DEALT = "bucket int, first long, keys binary, tokens binary, fit binary"


def word_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the word at each place, first place of each text) of large strings without nulls, by array work alone."""
    if not len(texts):
        return np.empty(0, U64), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.empty(0, np.uint8)
    at = at - at[0]
    inside = np.r_[False, ~_SPACE[data], False]
    apart = inside[1:] != inside[:-1]  # between a byte and the one before, beginning and end included
    edge = at[1:-1][at[1:-1] > at[:-2]]  # once where texts between are empty
    edge = edge[inside[edge] & inside[edge + 1]]  # a word up to the end of a text and another from the beginning of the next
    ends = np.flatnonzero(apart)
    ends = np.sort(np.r_[ends, edge, edge]) if len(edge) else ends
    begin, end = ends[::2], ends[1::2]
    out = np.empty(len(begin), U64)
    up, down = _powers(BASE, 2 * (_PIECE + _LONG))
    long = np.flatnonzero(end - begin > _LONG)
    for i in long:
        out[i] = xxhash.xxh3_64_intdigest(data[begin[i]:end[i]].tobytes())
    for i, j in zip(np.r_[0, long + 1], np.r_[long, len(begin)]):  # words between long ones
        while i < j:
            to = max(min(int(np.searchsorted(end, begin[i] + _PIECE, "right")), j), i + 1)
            x, y = begin[i:to] - begin[i], end[i:to] - begin[i]
            sums = np.zeros(y[-1] + 1, U64)
            np.cumsum(_BYTE[data[begin[i]:end[to - 1]]] * up[:y[-1]], out=sums[1:])
            out[i:to] = mix((sums[y] - sums[x]) * down[x])
            i = to
    return out & KNOWN, np.searchsorted(begin, at)


def _line(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(END, END, then the hash of each token of all texts; where each text's tokens begin, and where the last ones end)."""
    h, bounds = word_stream(texts)
    n = np.diff(bounds)
    line = np.full(len(h) + len(n) + 2, END, U64)
    line[np.arange(2, len(h) + 2) + np.repeat(np.arange(len(n)), n)] = h
    return line, bounds + np.arange(len(bounds))


def _grams_at(line: np.ndarray, begins: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The n-grams, a row each, that end at the tokens ``own`` (ascending); the end stands before the first word."""
    w = np.stack([line[own], line[own + 1], line[own + 2]], 1)
    at = np.searchsorted(own, begins)  # the first of them at or after the beginning of each text
    there = at < len(own)
    at, begins = at[there], begins[there]
    w[at[own[at] == begins], 0] = END
    return w


class Deal:
    """Where trigrams go: to the bucket of their middle word; a frequent one has several, dealt by the word before."""

    def __init__(self, buckets: int, frequent: dict[int, int]):
        self.buckets = buckets
        words = sorted(frequent)
        self.words = np.array(words, U64)
        self.split = np.array([frequent[x] for x in words], np.int64)

    def place(self, w2: np.ndarray) -> np.ndarray:
        """The place of each word among the frequent ones, or -1."""
        if not len(self.words):
            return np.full(len(w2), -1)
        at = np.minimum(np.searchsorted(self.words, w2), len(self.words) - 1)
        return np.where(self.words[at] == w2, at, -1)

    def bucket(self, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        """The bucket of each trigram."""
        b = bucket_of(w2, self.buckets).astype(np.int64)
        at = self.place(w2)
        own = np.flatnonzero(at >= 0)
        more = (mix(w1[own] * U64(BASE)) % self.split[at[own]].astype(U64)).astype(np.int64)
        b[own] = (b[own] + more) % self.buckets
        return b

    def chosen(self, line: np.ndarray, begins: np.ndarray, portion: int, portions: int) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of a portion of the buckets, and their buckets; by steps that fit a processor's cache."""
        own, buckets = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in range(0, len(line) - 2, _STEP):
            j = min(i + _STEP, len(line) - 2)
            w1 = line[i:j].copy()
            w1[begins[np.searchsorted(begins, i):np.searchsorted(begins, j)] - i] = END
            b = self.bucket(w1, line[i + 1:j + 1])
            at = np.flatnonzero(b % portions == portion) if portions > 1 else np.arange(j - i)
            own.append(at + i)
            buckets.append(b[at])
        narrow = np.uint16 if self.buckets <= 1 << 16 else np.int64
        return np.concatenate(own), np.concatenate(buckets).astype(narrow)


def _frequent(batches):
    """Words of at least one in 20,000 tokens of a batch: (word, count, tokens of the batch with the first of them)."""
    for rb in batches:
        for _, _, texts in text_slices(rb.column("text")):
            w2 = np.sort(_line(texts)[0][1:-1])
            at = _begins(w2)
            n = np.diff(np.r_[at, len(w2)])
            some = n * 20_000 >= len(w2)
            tokens = np.zeros(some.sum(), np.int64)
            tokens[:1] = len(w2)
            yield pa.RecordBatch.from_arrays([pa.array(w2[at[some]].view(np.int64)), pa.array(n[some]), pa.array(tokens)],
                                             ["word", "n", "tokens"])


def deal_for(rows: DataFrame, size: int, buckets: int) -> Deal:
    """The deal over ``buckets``, with frequent words found in about ``SEEN`` bytes of the rows (it moves no result)."""
    some = rows.where(F.col("rid") % max(1, size // SEEN) == 0).select("text")
    found = some.mapInArrow(_frequent, "word long, n long, tokens long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("tokens").alias("tokens")).toArrow()
    word, n = (np.asarray(found.column(c)).astype(np.int64) for c in ("word", "n"))
    load = n / max(int(np.asarray(found.column("tokens")).sum()), 1) * buckets
    own = load > 0.5
    split = np.minimum(np.ceil(2 * load[own]), buckets).astype(int)
    return Deal(buckets, dict(zip(word[own].view(U64).tolist(), split.tolist())))


def _sent(deal: Deal, portion: int, portions: int):
    """Rows (rid, text, fit) to the trigrams of batches in the buckets of a portion: rows of ``_DEALT``."""
    def f(batches):
        for first, held in _batched(batches, BATCH_TEXT):
            fit = np.packbits(np.concatenate([np.asarray(rb.column("fit"), bool) for rb in held])).tobytes()
            parts, n = [], 0
            for b, e, texts in text_slices(pa.concat_arrays([rb.column("text") for rb in held]), _SLICE):
                line, bounds = _line(texts)
                at, bucket = deal.chosen(line, bounds[:-1], portion, portions)
                parts.append((_grams_at(line, bounds[:-1], at), np.searchsorted(bounds, at, "right") - 1 + b, bucket))
                n = e
            w, doc, bucket = (np.concatenate(x) for x in zip(*parts))
            order, runs = _runs(bucket)
            w, doc = w[order], doc[order]
            yield _batch([(b, first, _packed(w[i:j]), np.bincount(doc[i:j], minlength=n).astype(np.uint32).tobytes(),
                           fit) for b, i, j in runs], ["bucket", "first", "keys", "tokens", "fit"],
                         [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])
    return f


def _four(c: np.ndarray) -> list[int]:
    return [int((c == i).sum()) for i in (1, 2, 3, 4)]


def _tallied(deal: Deal, buckets: int):
    """One bucket's trigrams to counts of counts (kinds 3 and 20), partial counts of words (1) and of pairs begun by frequent words (2)."""
    def f(table: pa.Table) -> pa.Table:
        w = _unpacked(table.column("keys").to_pylist(), 3)
        w, c = _added(w, np.ones(len(w), np.int64))
        pair, c2 = _added(w[:, 1:], np.ones(len(w), np.int64))
        few = deal.place(pair[:, 0]) < 0
        word, c1 = _added(pair[few][:, 1:], np.ones(few.sum(), np.int64))
        rows = [(3, 0, b"", b"", *_four(c)), (20, 0, b"", b"", *_four(c2[few]))]
        for kind, x, n in ((1, word, c1), (2, pair[~few], c2[~few])):
            order, runs = _runs(bucket_of(_key(x), buckets))
            x, n = x[order], n[order].astype(np.uint32)
            rows += [(kind, b, _packed(x[i:j]), n[i:j].tobytes(), 0, 0, 0, 0) for b, i, j in runs]
        cols = list(zip(*rows))
        return pa.table([pa.array(v, t) for v, t in zip(cols, [pa.int32(), pa.int32(), pa.binary(), pa.binary()] + [pa.int64()] * 4)],
                        ["kind", "bucket", "keys", "counts", "n1", "n2", "n3", "n4"])
    return f


def _under(batches):
    """Counted pairs to (word, sum of counts, ones, twos, n-grams) of their first words."""
    for rb in batches:
        for keys, counts in zip(rb.column("keys").to_pylist(), rb.column("counts").to_pylist()):
            w, c = _unpacked([keys], 2), np.frombuffer(counts, np.uint32).astype(np.int64)
            order = np.argsort(w[:, 0])
            first, c = w[order, 0], c[order]
            at, totals = _totals(first, c)
            yield pa.RecordBatch.from_arrays([pa.array(first[at].view(np.int64)), *map(pa.array, totals)],
                                             ["word", "total", "n1", "n2", "n"])


class Totals:
    """Discounts, counted words and counted pairs of frequent words of the fitted trigrams; the trigrams are not kept."""

    def __init__(self, texts: DataFrame, deal: Deal, portions: int, n: int, root: str):
        spark = texts.sparkSession
        tally = None
        for k in range(portions):
            sent = texts.mapInArrow(_sent(deal, k, portions), _DEALT).select("bucket", "keys")
            part = stage(spark, sent.groupBy("bucket").applyInArrow(
                _tallied(deal, n), "kind int, bucket int, keys binary, counts binary, n1 long, n2 long, n3 long, n4 long"),
                root, f"tally{k}")
            tally = part if tally is None else tally.union(part)
        pick = ["bucket", "keys", "counts"]
        self.pairs = _counted(tally.where("kind = 2").select(pick), 2, root, "pairs")
        self.words = _counted(tally.where("kind = 1").select(pick).union(
            self.pairs.select("keys").mapInArrow(_shorter(2, n), _COUNTED)), 1, root, "words")
        fours = ["n1", "n2", "n3", "n4"]
        self.d1, self.d2, self.d3 = map(_discounts, (
            self.words, tally.where("kind = 20").select(fours).union(self.pairs.select(fours)), tally.where("kind = 3")))
        self.total, self.n, n1, n2 = self.words.agg(
            *[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "grams", "n1", "n2")]).first()
        self.floor = float(_gamma(self.total, n1, n2, self.n, self.d1)) / (self.n + 1)
        under = {r["word"]: r for r in self.pairs.mapInArrow(
            _under, "word long, total long, n1 long, n2 long, n long").groupBy("word").agg(
            *[F.sum(c).alias(c) for c in ("total", "n1", "n2", "n")]).collect()}  # a row a frequent word
        self.under = np.array([[under[x][c] if x in under else 0 for c in ("total", "n1", "n2", "n")]
                               for x in deal.words.view(np.int64).tolist()], np.int64).reshape(-1, 4).T


def _facts(kind: int, buckets: int):
    """Counted pairs (kind 2) or words (1) to what is looked up: rows (bucket, kind, keys of six bytes, counts)."""
    def f(batches):
        for rb in batches:
            for keys, counts in zip(rb.column("keys").to_pylist(), rb.column("counts").to_pylist()):
                key, c = _key(_unpacked([keys], kind)) & KNOWN, np.frombuffer(counts, np.uint32)
                order, runs = _runs(bucket_of(key, buckets))
                key, c = _six(key[order]), c[order]
                yield _batch([(b, kind, key[i:j].tobytes(), c[i:j].tobytes()) for b, i, j in runs],
                             ["bucket", "kind", "keys", "counts"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])
    return f


def _wanted(deal: Deal, buckets: int):
    """The words and the pairs begun by frequent words whose counts a bucket of trigrams needs."""
    def f(table: pa.Table) -> pa.Table:
        w = _unpacked(table.column("keys").to_pylist(), 3)
        rows, to = [], table.column("bucket")[0].as_py()
        for kind, key in ((1, w[:, 2]), (2, join2(w[:, 1], w[:, 2])[deal.place(w[:, 1]) >= 0] & KNOWN)):
            key = distinct(key)
            order, runs = _runs(bucket_of(key, buckets))
            six = _six(key[order])
            rows += [(b, to, kind, six[i:j].tobytes()) for b, i, j in runs]
        return pa.Table.from_batches([_batch(rows, ["bucket", "to", "kind", "keys"],
                                             [pa.int32(), pa.int32(), pa.int32(), pa.binary()])])
    return f


def _given(wanted: pa.Table, facts: pa.Table) -> pa.Table:
    """The counts that are wanted of one bucket of counts: those above 0."""
    known, rows = {}, []
    kinds = np.asarray(facts.column("kind"))
    for kind in (1, 2):
        own = facts.filter(pa.array(kinds == kind))
        key = _from_six(b"".join(own.column("keys").to_pylist()))
        order = np.argsort(key)
        known[kind] = key[order], np.frombuffer(b"".join(own.column("counts").to_pylist()), np.uint32)[order]
    for to, kind, keys in zip(*(wanted.column(c).to_pylist() for c in ("to", "kind", "keys"))):
        key, count = known[kind]
        if len(key):
            keys = _from_six(keys)
            at = np.minimum(np.searchsorted(key, keys), len(key) - 1)
            hit = key[at] == keys
            rows.append((to, kind, _six(keys[hit]).tobytes(), count[at[hit]].tobytes()))
    return pa.Table.from_batches([_batch(rows, ["bucket", "kind", "keys", "counts"],
                                         [pa.int32(), pa.int32(), pa.binary(), pa.binary()])])


def _summed(deal: Deal, d1, d2, d3, total1: int, floor: float, under: np.ndarray):
    """One bucket's trigrams and the counts given to it to each batch's sums: rows (first, tokens, neg_log10), a value a text."""
    def look(given: pa.Table, kind: int, keys: np.ndarray) -> np.ndarray:
        own = given.filter(pa.array(np.asarray(given.column("kind")) == kind))
        key = _from_six(b"".join(own.column("keys").to_pylist()))
        count = np.frombuffer(b"".join(own.column("counts").to_pylist()), np.uint32).astype(np.int64)
        if not len(key):
            return np.zeros(len(keys), np.int64)
        order = np.argsort(key)
        key, count = key[order], count[order]
        at = np.minimum(np.searchsorted(key, keys), len(key) - 1)
        return np.where(key[at] == keys, count[at], 0)

    def totals(of: np.ndarray, c: np.ndarray, size: int) -> list[np.ndarray]:
        """As ``_totals``, of the contexts ``of``."""
        seen = np.flatnonzero(c)
        of, c = of[seen], c[seen]
        return [np.bincount(of, weights=c, minlength=size).astype(np.int64)] + [
            np.bincount(x, minlength=size) for x in (of[c == 1], of[c == 2], of)]

    def f(table: pa.Table, given: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(x, np.uint32) for x in table.column("tokens").to_pylist()]
        fit = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(t)).astype(bool)
               for x, t in zip(table.column("fit").to_pylist(), tokens)]
        texts = np.cumsum([0] + [len(t) for t in tokens])
        n = np.concatenate(tokens)
        w = _unpacked(table.column("keys").to_pylist(), 3)
        triple, which = placed(_key(w))
        one = np.empty(len(triple), np.int64)
        one[which] = np.arange(len(w))
        w = w[one]  # a row a distinct trigram
        c3 = np.bincount(which[np.repeat(np.concatenate(fit), n)], minlength=len(w))
        seen = c3 > 0
        context, of3 = placed(_context(w))
        under3 = totals(of3, c3, len(context))
        pair, of2 = placed(join2(w[:, 1], w[:, 2]))
        one = np.empty(len(pair), np.int64)
        one[of2] = np.arange(len(w))
        second, last = w[one, 1], w[one, 2]
        c2 = np.bincount(of2[seen], minlength=len(pair))
        word, of1 = placed(second)
        under2 = totals(of1, c2, len(word))
        place = deal.place(word)
        many = place >= 0
        if many.any():
            c2 = np.where(many[of1], look(given, 2, pair & KNOWN), c2)
            for x, y in zip(under2, under):
                x[many] = y[place[many]]
        c1 = look(given, 1, last)
        p1 = (c1 - _off(c1, d1)) / max(total1, 1) + floor
        p2 = (c2 - _off(c2, d2)) / np.maximum(under2[0], 1)[of1] + _gamma(*under2, d2)[of1] * p1
        p3 = (c3 - _off(c3, d3)) / np.maximum(under3[0], 1)[of3] + _gamma(*under3, d3)[of3] * p2[of2]
        log = np.log10(np.minimum(p3, 1.0))[which]
        sums = -np.bincount(np.repeat(np.arange(len(n)), n), weights=log, minlength=len(n))
        rows = [(first, n[i:j].tobytes(), sums[i:j].tobytes())
                for first, i, j in zip(table.column("first").to_pylist(), texts, texts[1:]) if first >= 0]
        return pa.Table.from_batches([_batch(rows, ["first", "tokens", "neg_log10"], [pa.int64(), pa.binary(), pa.binary()])])
    return f


def _gathered(table: pa.Table) -> pa.Table:
    """A batch's sums of all buckets of a portion, added up: rows (rid, n_tokens, neg_log10)."""
    n = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in table.column("tokens").to_pylist())
    total = sum(np.frombuffer(x, np.float64) for x in table.column("neg_log10").to_pylist())
    return pa.table([pa.array(table.column("first")[0].as_py() + np.arange(len(n))), pa.array(n), pa.array(total)],
                    ["rid", "n_tokens", "neg_log10"])


def _batched(batches, batch_bytes: int):
    """Each batch of rows (of about ``batch_bytes`` of text) with the number of its first one."""
    held, n = [], 0
    for rb in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(rb.column("text")), 0)).astype(np.int64) + 8
        begin = 0
        while begin < rb.num_rows:
            end = min(begin + int(np.searchsorted(np.cumsum(size[begin:]), batch_bytes - n)) + 1, rb.num_rows)
            held.append(rb.slice(begin, end - begin))
            n += int(size[begin:end].sum())
            begin = end
            if n >= batch_bytes:
                yield held[0].column("rid")[0].as_py(), held
                held, n = [], 0
    if held:
        yield held[0].column("rid")[0].as_py(), held
    return_freed()


def _scored_by_bucket(rows: DataFrame, trained: DataFrame, once: DataFrame, size: int, root: str) -> DataFrame:
    """The scores of all rows (``size`` bytes of text) under the model of the texts of the ids ``trained`` and of ``once``.

    Trigrams are counted twice, first for the discounts and the counts of words, then with those of all rows,
    in portions of the buckets, so that no count of a trigram is ever written and the trigrams of few buckets are on
    disk at a time.
    """
    spark = rows.sparkSession
    portions = max(1, min(PORTIONS, -(-size // PORTION)))
    parts, n = shuffle_partitions(spark), max(1, -(-size // WORDS_TEXT))
    keyed = rows.withColumn("rid", F.monotonically_increasing_id())
    texts = keyed.join(small(trained.withColumn("fit", F.lit(True)), MAX_IDS), "id", "left").select(
        "rid", "text", F.coalesce("fit", F.lit(False)).alias("fit"))
    once = once.select(F.lit(-1).cast("long").alias("rid"), "text", F.lit(True).alias("fit"))
    deal = deal_for(keyed, size, portions * max(parts, -(-size // (portions * BUCKET_TEXT))))
    counts = Totals(texts.where("fit").union(once), deal, min(portions, 2), n, root)
    facts = stage(spark, counts.words.select("keys", "counts").mapInArrow(_facts(1, n), _PART).union(
                      counts.pairs.select("keys", "counts").mapInArrow(_facts(2, n), _PART)), root, "facts")
    out = None
    for k in range(portions):
        sent = texts.union(once).mapInArrow(_sent(deal, k, portions), _DEALT).repartition(parts, "bucket")
        wanted = sent.groupBy("bucket").applyInArrow(_wanted(deal, n), "bucket int, to int, kind int, keys binary")
        given = wanted.groupBy("bucket").cogroup(facts.groupBy("bucket")).applyInArrow(_given, _PART)
        sums = sent.groupBy("bucket").cogroup(given.groupBy("bucket")).applyInArrow(
            _summed(deal, counts.d1, counts.d2, counts.d3, counts.total, counts.floor, counts.under),
            "first long, tokens binary, neg_log10 binary")
        done = stage(spark, sums.groupBy("first").applyInArrow(_gathered, "rid long, n_tokens long, neg_log10 double"),
                     root, f"sums{k}")
        out = done if out is None else out.union(done)
    out = out.groupBy("rid").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("neg_log10").alias("neg_log10"))
    return stage(spark, keyed.select("rid", "id", "lang").join(out, "rid").select("id", "lang", "n_tokens", "neg_log10"),
                 root, "scores")


def judged(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", max_bytes: int = MAX_BROADCAST, quantile: float = 0.99,
           margin: float = 0.3, least: int = 50, prior_tokens: int = 20) -> DataFrame:
    """(id, n_tokens, perplexity, threshold, kept), a row per row of ``docs``; ``trusted`` has one column of ids.

    ``threshold`` and ``margin`` are on log10 of the perplexity as compared; counts of more than about
    ``max_bytes`` stay in buckets.
    """
    spark = docs.sparkSession
    root = scratch(spark, "kneser-ney")
    held = F.pmod(F.xxhash64(F.lit("held out"), "id"), F.lit(HELD)) == 0
    ids = stage(spark, trusted.toDF("id").where("id IS NOT NULL").distinct().withColumn("held", held), root, "ids")
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    fit = rows.join(small(ids.where(~F.col("held")), MAX_IDS), "id", "left_semi").select("id", "text")
    again = stage(spark, fit.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), root, "again")
    again = small(again, MAX_IDS)
    largest = fit.join(again, "id", "left_semi").groupBy("id").agg(F.max("text").alias("text"))
    texts = fit.join(again, "id", "left_anti").select("text").union(largest.select("text"))
    size, read, n = rows.join(small(ids.where(~F.col("held")), MAX_IDS), "id", "left").agg(
        *[F.coalesce(F.sum(F.octet_length("text") * x), F.lit(0)) for x in (F.lit(1), F.col("held").isNotNull().cast("long"))],
        F.count("held")).first()

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, lang string, n_tokens long, neg_log10 double"
    if read * COUNTS_A_BYTE <= max_bytes or not n:
        sent = spark.sparkContext.broadcast(_model(Counts(texts, root)))
        scores = stage(spark, rows.mapInArrow(_score(sent), schema), root, "scores")
    else:
        trained = stage(spark, ids.where(~F.col("held")).select("id").join(again, "id", "left_anti"), root, "trained")
        scores = _scored_by_bucket(rows, trained, largest.select("text"), size, root)
    mean = F.col("neg_log10") / F.col("n_tokens")
    middle = scores.groupBy("lang").agg(F.percentile_approx(mean, 0.5, 10_000).alias("middle"))
    middle = small(stage(spark, middle, root, "middle"), 10_000)
    drawn = (scores.alias("s").join(middle.alias("m"), F.col("s.lang").eqNullSafe(F.col("m.lang")))
             .select("s.*", ((F.col("neg_log10") + prior_tokens * F.col("middle"))
                             / (F.col("n_tokens") + prior_tokens)).alias("drawn")))
    good = drawn.join(small(ids.where("held"), MAX_IDS), "id", "left_semi")
    cut = F.percentile_approx("drawn", quantile, 10_000) + margin
    everywhere = good.agg(cut.alias("cut")).first()["cut"]
    own = good.groupBy("lang").agg(cut.alias("cut"), F.count("*").alias("n")).where(F.col("n") >= least)
    own = small(stage(spark, own, root, "cuts"), 10_000)
    out = drawn.alias("d").join(own.alias("o"), F.col("d.lang").eqNullSafe(F.col("o.lang")), "left")
    threshold = F.coalesce("cut", F.lit(everywhere).cast("double"))
    return out.select("id", "n_tokens", F.pow(F.lit(10.0), mean).alias("perplexity"),
                      threshold.alias("threshold"),
                      F.coalesce(F.col("drawn") <= threshold, F.lit(True)).alias("kept"), "drawn")


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return judged(docs, trusted).withColumnRenamed("id", "doc_id")
