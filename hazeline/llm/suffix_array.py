"""Suffix array by prefix doubling, as numpy passes.

Suffixes are first ordered by as many of their symbols as fit into 62 bits. What
stands alone is done; suffixes that agree so far are a group, known by the place
where it begins, and are ordered by the group of the suffix that follows what is
known to agree. Each pass doubles that length and sorts only what is still in a
group.
"""

from __future__ import annotations

import numpy as np


def _packed(values: np.ndarray) -> tuple[np.ndarray, int]:
    """The first symbols of every suffix as one number, and how many they are."""
    symbols = values.astype(np.int64)
    low, high = int(symbols.min()), int(symbols.max())
    if high - low >= 1 << 31:
        symbols = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
        low, high = 0, int(symbols.max())
    symbols = symbols - low
    bits = max(1, (high - low).bit_length())
    packed, width = np.zeros(len(symbols), np.int64), min(62 // bits, len(symbols))
    for k in range(width):
        packed <<= bits
        packed[:len(symbols) - k] |= symbols[k:]
    return packed, width


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Order of all suffixes of an integer array whose last value is smaller
    than all others."""
    n = len(values)
    if n < 2:
        return np.arange(n)
    key, width = _packed(values)
    order = np.argsort(key)
    group = np.zeros(n, np.int64)
    places, key = np.arange(n), key[order]  # of the suffixes that aren't done, in order
    while True:
        first = np.append(True, key[1:] != key[:-1])
        group[order[places]] = np.maximum.accumulate(np.where(first, places, 0))
        shared = ~(first & np.append(first[1:], True))
        if not shared.any():
            return order
        places = places[shared]
        own = order[places]
        # A suffix in a group has more symbols than agree: the last value is alone.
        key = group[own] * n + group[own + width]
        sort = np.argsort(key)
        order[places], key = own[sort], key[sort]
        width *= 2
