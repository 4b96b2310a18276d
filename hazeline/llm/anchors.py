"""Anchors of byte windows: for every window of a text one place inside it that
depends on nothing but the window's bytes, so equal windows have equal anchors.

A window's anchor is its gram (a run of bytes) of least hash, the leftmost on a
tie of the hash's upper bits. Neighbouring windows mostly share their anchor;
the windows of a text fall into stretches of one anchor each, about one for
every (window - gram) / 2 bytes.
"""

from __future__ import annotations

import numpy as np

from hazeline.llm.common import mix64
from hazeline.llm.wordhash import powers

#: Bits of a packed hash that hold a place: grams of a piece.
_PLACE_BITS = 24


def _anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """Place of the least of every ``span`` neighbouring hashes, in pieces that
    overlap by span - 1 hashes and whose places fit the packed bits."""
    out, most = [], 1 << _PLACE_BITS
    for begin in range(0, len(grams) - span + 1, most - span + 1):
        piece = grams[begin:begin + most]
        low = (piece >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(piece), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:-(span - width)], low[span - width:])
        out.append((low & np.uint64(most - 1)).astype(np.int64) + begin)
    return np.concatenate(out)


def stretches(raw: np.ndarray, offsets: np.ndarray, window: int,
              gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie end to end (n + 1 offsets): for each stretch of windows
    the index of its text, its first window's start (in the whole), the number
    of its windows, the distance from that start to the anchor, the hash of the
    anchor's gram, and a hash of all bytes of the stretch's windows."""
    n = len(raw)
    none, no_hash = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n < window:
        return none, none, none, none, no_hash, no_hash
    power, inverse = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    m = n - gram + 1
    grams = mix64((sums[gram:] - sums[:m]) * inverse[:m])
    anchor = _anchors(grams, window - gram + 1)
    starts = np.arange(len(anchor))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(anchor)]
    inside = starts + window <= offsets[1:][text]
    starts, text, anchor = starts[inside], text[inside], anchor[inside]
    if not len(starts):
        return none, none, none, none, no_hash, no_hash
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    begin, count, at = starts[first], np.diff(np.append(first, len(starts))), anchor[first]
    whole = mix64((sums[begin + count + window - 1] - sums[begin]) * inverse[begin] + count.astype(np.uint64))
    return text[first], begin, count, at - begin, grams[at], whole
