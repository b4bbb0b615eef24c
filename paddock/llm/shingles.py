"""Hashes of words and word n-grams of many texts at once, in numpy.

Words are maximal runs without blank or \\t \\n \\v \\f \\r. A word's hash is a polynomial
over its UTF-8 bytes modulo 2**64 with random byte values, mixed; a shingle's is a
random linear form over its words' hashes, mixed. Equal hashes are taken for equal
shingles (64 bits; about 1e-13 for the two sets of a pair of long texts).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

CHUNK_BYTES = 500_000
_RANDOM = np.random.default_rng(20_240_229)
_BYTE = _RANDOM.integers(1, 2**64, 256, np.uint64)
_PLACE = _RANDOM.integers(1, 2**64, 64, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C4B            # = 3 modulo 8
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(16)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, b, np.uint64))))
                 for b in (_BASE, inverse))


def words(texts: list[bytes], between: np.ndarray = _BLANK
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of every word of all texts in order, places counted
    from the word's text, and the first word's number of every text (and the end).
    ``between`` tells the byte values between words; a line feed must be one of them."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    blank = between[data]
    before = np.concatenate(([True], blank[:-1]))
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(blank & ~before)
    n = len(data)
    power, inverse = _powers(1 << max(12, (n - 1).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts])
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    first = np.searchsorted(starts, at)
    offset = np.repeat(at[:-1], np.diff(first))
    return hashes, starts - offset, ends - offset, first


def shingle_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text, repeats included; of a shorter text
    the whole sequence is the one shingle; none without words."""
    n = len(word_hashes)
    if not n:
        return np.empty(0, np.uint64)
    use = min(n, k)
    out = np.full(n - use + 1, np.uint64(k - use))
    for j in range(use):
        out = out + word_hashes[j:n - use + 1 + j] * _PLACE[j]
    return mix(out)


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z as lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together."""
    lo = held = 0
    for i, t in enumerate(texts):
        if i > lo and held + len(t) > size:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if texts:
        yield lo, len(texts)
