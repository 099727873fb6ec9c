"""Word and window hashes in numpy, for use inside tasks.

A word is hashed to 64 random bits. A window of ``width`` words has the Rabin-Karp value
``sum(h[i + j] * B**(width - 1 - j)) mod 2**64``; with B odd, powers of B have
inverses, so all windows of a text come from one running sum.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow.compute as pc
import xxhash

from lodestar.llm._common import return_freed

U64 = np.uint64
_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
BASE2 = 0xC2B2AE3D27D4EB4F | 1


class WordHashes:
    """Word to 64-bit hash. Nothing is kept: in text with many rare words a look-up costs more than hashing again."""

    __getitem__ = staticmethod(xxhash.xxh3_64_intdigest)


WORD_HASHES = WordHashes()


def slices(batches, column: str = "text", most: int = 1 << 22):
    """The rows of Arrow record batches in batches of about ``most`` bytes of text: bounds what a task copies."""
    for rb in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(rb.column(column)), 0)).astype(np.int64).cumsum()
        begin = 0
        while begin < rb.num_rows:
            end = int(np.searchsorted(size, (size[begin - 1] if begin else 0) + most)) + 1
            yield rb.slice(begin, end - begin)
            begin = end
    return_freed()


def pieces(text: bytes, most: int = 1 << 22):
    """``text`` cut at white space into parts of about ``most`` bytes: bounds the word list of a long text."""
    begin, n = 0, len(text)
    while n - begin > most:
        cut = max(text.rfind(c, begin, begin + most) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if cut <= begin:  # one word longer than a part: go on to its end
            ends = [e for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")
                    if (e := text.find(c, begin + most)) >= 0]
            cut = min(ends, default=n)
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


def word_hashes(text: bytes | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words of a text, in order; empty for null."""
    if not text:
        return np.empty(0, U64)
    parts = []
    for part in pieces(text):
        ws = (part.lower() if lower else part).split()
        parts.append(np.fromiter(map(WORD_HASHES.__getitem__, ws), U64, len(ws)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order, by a sort (numpy's ``unique`` alone uses a slower hash table)."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def placed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place there of each value."""
    order = np.argsort(x)
    ordered = x[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(x) else np.empty(0, bool)
    which = np.empty(len(x), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], which


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, in a type that numpy sorts by radix if it is narrow."""
    return (mix(key) % U64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)


@functools.lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(size, base, U64), np.full(size, inverse, U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def rolling(h: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Rabin-Karp values of all windows of ``width`` hashes; empty if there are fewer."""
    n = len(h)
    if n < width:
        return np.empty(0, U64)
    size = 1 << max(10, (n + width).bit_length())
    up, down = _powers(base, size)
    sums = np.empty(n + 1, U64)
    sums[0] = 0
    np.cumsum(h * down[:n], dtype=U64, out=sums[1:])
    k = n - width + 1
    return (sums[width:] - sums[:k]) * up[width - 1:width - 1 + k]
