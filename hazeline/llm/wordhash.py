"""64-bit hashes of the words of whole batches, and of runs of words.

A word's hash is a polynomial of its bytes modulo 2^64, taken from prefix sums
over the whole batch, multiplied back to position 0 and mixed. Equal words have
equal hashes wherever they stand; different ones collide with a probability of
about 2^-64 a pair.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from hazeline.llm.common import mix64

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Word bytes: all but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes: ASCII letters and digits, and all of a character beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: A-Z to lower case, and bytes kept off zero.
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += np.uint64(0x20)
_LOWER += np.uint64(1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse."""
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_powers`, for n rounded up so that few lengths are made."""
    return _powers(1 << max(20, int(n).bit_length()))


def words(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z in lower case) of texts that lie end to end, and
    the number of words of each text. kind: which bytes belong to words."""
    n, docs = len(raw), len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(docs, np.int64)
    inside = kind[raw]
    fresh = np.zeros(n + 1, bool)  # a text starts here
    fresh[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | fresh[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | fresh[1:n]
    start, stop = np.flatnonzero(starts), np.flatnonzero(last) + 1
    power, inverse = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[raw] * power[:n], out=sums[1:])
    hashes = mix64((sums[stop] - sums[start]) * inverse[start])
    return hashes, np.diff(np.searchsorted(start, offsets))


def runs(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of k words inside a text, and the index of its first
    word. Runs of different lengths are told apart by k."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(doc[:m] == doc[k - 1:])
    factor, total = 0x8CB92BA72F3D8DD7, np.full(len(at), k, np.uint64)
    for i in range(k):
        total = total * np.uint64(factor) + hashes[at + i]
    return mix64(total), at
