"""Best-fit packing of tokenised documents into sequences by bin completion (operator 5).

Tokenising: texts are cut at white space and every distinct word is encoded
once (the tokenizer's pre-tokens never span white space, so the ids of a text
are those of its words in order), then joined, ended by one id, and cut into
pieces of ``capacity`` only if longer.

Packing: only (key, length) rows travel. They are dealt by hash into groups of
about ``group_size`` pieces and each group is packed on its own:

* a best-fit-decreasing packing is the first incumbent;
* branch and bound over bins: the next bin takes the largest piece left, and
  its fillings are the undominated ones around it (no filling that leaves room
  for a piece still there, fullest first, with one or two or more pieces); a
  branch ends when its waste exceeds what an improvement on the incumbent
  allows; the search has a node budget, and the incumbent stands if it runs out.

Sequences of the first round that are not nearly full are opened again and
their pieces packed once more in new groups, so a group's badly filled last
sequences do not add up over the groups.

Defined cases: null and empty texts are the end id alone; pieces of equal
length are interchangeable; rows that repeat are packed each on its own; null
ids are allowed; a very long text is encoded on its own; an empty table gives an
empty result; other columns are ignored. The tokenizer file's path is a
parameter; it is read on the executors.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import return_freed, scratch, stage

CAPACITY = 2048
#: A sequence of the first round stays closed if it is at least this full.
CLOSED = 0.998
#: Sentence marks that are encoded apart from the word before them.
MARKS = ".,;:!?"
#: Lower-case Latin letters, and a test for words of such letters in either case.
LOWER = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


# ---------------------------------------------------------------- tokenising


class WordIds:
    """Encodes each distinct word once: words map to their ids as uint32 bytes.

    Two generations of at most ``limit`` words each bound the memory (about
    200 bytes a word): when the young one is full it becomes the old one, and a
    word found in the old one moves back, so frequent words stay.

    A word of Latin letters only is one pre-token, so its ids come from the
    tokenizer's model alone; whether that holds for this tokenizer is tried out
    on all the letters when it is loaded.
    """

    def __init__(self, path: str, limit: int = 250_000):
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.letters = str.maketrans({c: self._mapped(c) for c in LOWER})
        trial = [LOWER, LOWER.upper().replace("SS", ""), "straße", "El", "Ça"]
        self.plain = all(self._model_ids(w) == self._ids([w])[0] for w in trial)

    def _mapped(self, letter: str) -> str:
        """How the tokenizer's model sees a letter."""
        pre = self.tokenizer.pre_tokenizer
        found = pre.pre_tokenize_str(letter) if pre else [(letter, None)]
        return "".join(p for p, _ in found)

    def _model_ids(self, word: str) -> bytes:
        found = self.model.tokenize(word.lower().translate(self.letters))
        return array("I", [t.id for t in found]).tobytes()

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        missing = [w for w, v in zip(words, found) if v is None]
        if missing:
            self._learn(missing)
            found = list(map(self.young.__getitem__, words))
        return found

    def _learn(self, words: list[str]) -> None:
        """Take words from the old generation, or encode them.

        The tokenizer never joins a letter or digit and the sentence marks
        after it, so a word that ends in marks is put together from two parts.
        """
        young, old, new, joined = self.young, self.old, {"": None}, []
        for w in words:
            v = old.get(w)
            if v is not None:
                young[w] = v
            elif w and w[-1] in MARKS and (stem := w.rstrip(MARKS))[-1:].isalnum() and stem[-1].isascii():
                marks = w[len(stem):]
                joined.append((w, stem, marks))
                for p in (stem, marks):
                    if p not in young:
                        if (v := old.get(p)) is None:
                            new[p] = None
                        else:
                            young[p] = v
            else:
                new[w] = None
        rest = []
        for p in new:
            if self.plain and LATIN(p):
                young[p] = self._model_ids(p)
            else:
                rest.append(p)
        young.update(zip(rest, self._ids(rest)))
        for w, stem, marks in joined:
            young[w] = young[stem] + young[marks]


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def word_codes(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, the word at each place, first place of each text) of large strings without nulls."""
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    if "" in words:  # white space at either end of a text leaves an empty word
        empty = code == words.index("")
        gone = np.r_[0, np.cumsum(empty)]
        return words, code[~empty], (bounds - bounds[0]) - gone[bounds - bounds[0]]
    return words, code, bounds - bounds[0]


def token_ids(texts: pa.Array, path: str, end_id: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (large strings without nulls), each ended by the end id, and where each begins.

    White space, distinct words and the gathering of ids are array work; only
    a distinct word is a Python object.
    """
    plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<")))
    words, code, bounds = word_codes(pc.if_else(plain, pc.ascii_lower(texts), texts))
    blobs = _word_ids(path).encode(words)
    size = np.array([len(b) for b in blobs], np.int64) // 4
    values = np.frombuffer(b"".join(blobs), np.uint32)
    n = size[code]
    before = np.r_[0, np.cumsum(n)]
    ids = values[np.repeat((np.cumsum(size) - size)[code] - before[:-1], n) + np.arange(before[-1])]
    begin = before[bounds]  # without the end ids
    out = np.full(len(ids) + len(texts), end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(begin))] = ids
    return out, begin + np.arange(len(begin))


def text_slices(texts: pa.Array, most: int = 1 << 22):
    """(first row, row after the last, texts) of about ``most`` bytes of text; nulls are empty texts.

    Each is a copy of its own: some string kernels misread arrays that are cut out of others.
    """
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64).cumsum()
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(size, (size[begin - 1] if begin else 0) + most)) + 1
        end = min(end, len(texts))
        own = texts.take(pa.array(np.arange(begin, end))).cast(pa.large_string())
        yield begin, end, pc.fill_null(own, "")
        begin = end


def _tokenise(path: str, end_id: int, capacity: int, keep_ids: bool):
    def f(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for rb in batches:
            for b, e, texts in text_slices(rb.column("text")):
                ids, begin = token_ids(texts, path, end_id)
                per = -(-np.diff(begin) // capacity)
                of = np.repeat(np.arange(e - b), per)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per)
                at = begin[of] + piece * capacity
                to = np.minimum(at + capacity, begin[of + 1])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(at.tolist(), to.tolist())]
                cols = [rb.column("id").take(pa.array(of + b)), pa.array(piece.astype(np.int32)),
                        pa.array(piece * capacity), pa.array(to - at), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(np.r_[at, len(ids)].astype(np.int32),
                                                         pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
        return_freed()
    return f


def tokenised(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 0, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the documents' pieces."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_tokenise(tokenizer_path, end_id, capacity, keep_ids),
                           f"id {kind}, piece int, start long, length long, ids_crc32 long"
                           + ", ids array<int>" * keep_ids)


# ------------------------------------------------------------------- packing


class Left:
    """The pieces still to pack, by length: counts, and the sorted distinct lengths."""

    def __init__(self, lengths):
        self.count: dict[int, int] = {}
        for x in lengths:
            self.count[x] = self.count.get(x, 0) + 1
        self.sizes = sorted(self.count)
        self.total = sum(lengths)

    def take(self, x: int) -> None:
        self.count[x] -= 1
        self.total -= x
        if not self.count[x]:
            del self.count[x]
            del self.sizes[bisect.bisect_left(self.sizes, x)]

    def put(self, x: int) -> None:
        if x not in self.count:
            bisect.insort(self.sizes, x)
            self.count[x] = 0
        self.count[x] += 1
        self.total += x

    def fits(self, room: int) -> int:
        """The largest length of at most ``room``, or 0."""
        i = bisect.bisect_right(self.sizes, room)
        return self.sizes[i - 1] if i else 0


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit decreasing: each piece goes to the fullest bin that has room for it."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, (x, -1))
        if i == len(rooms):
            bins.append([x])
            if capacity > x:
                bisect.insort(rooms, (capacity - x, len(bins) - 1))
        else:
            room, b = rooms.pop(i)
            bins[b].append(x)
            if room > x:
                bisect.insort(rooms, (room - x, b))
    return bins


def fillings(left: Left, room: int, tries: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, fullest first, at most ``tries`` per first piece looked at.

    A filling is dominated if a piece that is left would still fit, or if a
    larger piece could stand for one of its own; only fillings in which every
    piece is the largest that fits, or one that ends in an exact fit, are made.
    """
    found: set[tuple[int, ...]] = set()

    def grow(picked: tuple[int, ...], room: int, most: int, width: int) -> None:
        x = left.fits(min(room, most))
        seen = 0
        while x and seen < width:
            if left.count[x] > sum(1 for p in picked if p == x):
                seen += 1
                if room == x:
                    found.add(picked + (x,))
                    return
                rest = room - x
                # an exact pair is worth a look at once
                if rest in left.count and rest <= x and left.count[rest] > sum(
                        1 for p in picked + (x,) if p == rest):
                    found.add(picked + (x, rest))
                elif not left.fits(rest):
                    found.add(picked + (x,))
                else:
                    grow(picked + (x,), rest, x, max(1, width // 2))
            x = left.fits(x - 1)
        if not seen and picked:
            found.add(picked)

    grow((), room, room, tries)
    return sorted(found, key=lambda f: (-sum(f), len(f), [-x for x in f])) or [()]


def bin_completion(lengths: list[int], capacity: int = CAPACITY, nodes: int = 4000,
                   tries: int = 8) -> list[list[int]]:
    """Bins of at most ``capacity`` for ``lengths``: branch and bound with best-fit incumbents."""
    total = sum(lengths)
    bound = -(-total // capacity)
    incumbent = best_fit(lengths, capacity)
    left = Left(lengths)
    budget = nodes
    # Each level of the search is one bin: (its largest piece, fillings not tried yet, the one in use).
    path: list[list] = []
    waste = 0

    def allowed() -> int:
        """Waste that a packing with one bin fewer than the incumbent may have."""
        return (len(incumbent) - 1) * capacity - total

    def open_bin() -> None:
        big = left.sizes[-1]
        left.take(big)
        path.append([big, iter(fillings(left, capacity - big, tries)), None])

    if len(incumbent) > bound:
        open_bin()
    while path and len(incumbent) > bound and budget > 0:
        level = path[-1]
        if level[2] is not None:  # undo the filling in use
            waste -= capacity - level[0] - sum(level[2])
            for x in level[2]:
                left.put(x)
            level[2] = None
        filling = next(level[1], None)
        if filling is None or (lost := capacity - level[0] - sum(filling)) + waste > allowed():
            left.put(level[0])
            path.pop()
            continue
        budget -= 1
        for x in filling:
            left.take(x)
        level[2], waste = filling, waste + lost
        if not left.sizes:
            if len(path) < len(incumbent):
                incumbent = [[p[0], *p[2]] for p in path]
            continue
        if len(path) + -(-left.total // capacity) >= len(incumbent):
            continue
        open_bin()
    return incumbent


def _pack(capacity: int, nodes: int, final: bool):
    """One group: (key, length) to (key, sequence_id, offset); without ``final``, open bins get no sequence."""
    def f(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        keys, lengths = table.column("key").to_numpy(), table.column("length").to_numpy()
        order = np.lexsort((keys, lengths))
        by_length: dict[int, list[int]] = {}
        for i in order[::-1].tolist():
            by_length.setdefault(int(lengths[i]), []).append(i)
        seq = np.full(len(keys), -1, np.int64)
        off = np.zeros(len(keys), np.int64)
        for b, bin_ in enumerate(bin_completion(lengths.tolist(), capacity, nodes)):
            if final or sum(bin_) >= CLOSED * capacity:
                at = 0
                for x in bin_:
                    i = by_length[x].pop()
                    seq[i], off[i] = (group << 32) + b, at
                    at += x
        return pa.table({"key": pa.array(keys), "length": pa.array(lengths),
                         "sequence_id": pa.array(seq), "offset": pa.array(off)})
    return f


def pack(lengths: DataFrame, root: str, capacity: int = CAPACITY, group_size: int = 3000,
         nodes: int = 4000) -> DataFrame:
    """(key, sequence_id, offset) for (key long, length long); keys are distinct."""
    spark = lengths.sparkSession
    out = "key long, length long, sequence_id long, offset long"

    def round_(rows: DataFrame, base: int, final: bool) -> DataFrame:
        groups = max(1, -(-rows.count() // group_size))
        group = F.pmod(F.xxhash64("key", F.lit(base)), F.lit(groups)) + F.lit(base)
        return (rows.select("key", "length", group.cast("long").alias("g")).groupBy("g")
                .applyInArrow(_pack(capacity, nodes, final), out))

    whole = lengths.where(F.col("length") >= capacity)
    short = lengths.where(F.col("length") < capacity)
    first = stage(spark, round_(short, 0, False), root, "first")
    closed = first.where("sequence_id >= 0")
    open_ = stage(spark, first.where("sequence_id < 0").select("key", "length"), root, "open")
    second = stage(spark, round_(open_, 1 << 28, True), root, "second")
    alone = whole.select("key", (-F.col("key") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    cols = ["key", "sequence_id", "offset"]
    return closed.select(*cols).union(second.select(*cols)).union(alone)


def packed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           end_id: int = 0, capacity: int = CAPACITY, group_size: int = 3000, nodes: int = 4000,
           keep_ids: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset), a row per piece."""
    spark = docs.sparkSession
    root = scratch(spark, "packing")
    cut = tokenised(docs, tokenizer_path, id_col, text_col, end_id, capacity, keep_ids)
    cut = stage(spark, cut.withColumn("key", F.monotonically_increasing_id()), root, "pieces")
    places = pack(cut.select("key", "length"), root, capacity, group_size, nodes)
    return cut.join(places, "key").drop("key")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed(docs, default_tokenizer(), keep_ids=False).withColumnRenamed("id", "doc_id")
