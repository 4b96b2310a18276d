"""Byte-level BPE vocabulary files and the pre-tokenizer that goes with them."""

from __future__ import annotations

import gc
import json
import re
from functools import lru_cache

import numpy as np
import regex

#: The published split pattern of byte-level BPE.
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: The same split for texts of these characters alone: white space, ASCII and Latin letters.
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼½¾"
_OTHERS = re.compile("[^\t-\r\x20-ʯ]")
_LATIN = re.compile(
    rf"""'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+""")
#: Entries that a worker's cache of pre-tokens may hold before it starts anew:
#: it saves work and bounds memory, and has no influence on results.
CACHE_ENTRIES = 400_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a vocabulary file:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def split(text: str) -> list[str]:
    """Pre-tokens of a text without special strings."""
    return (PATTERN if _OTHERS.search(text) else _LATIN).findall(text)


class Vocabulary:
    """Arrays of one vocabulary: ids of the bytes, merge keys (left * size +
    right, sorted) with their rank and product, the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = byte_characters()
        back = {c: b for b, c in enumerate(chars)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.byte_ids = np.array([vocab[c] for c in chars], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(left * self.size + right, kind="stable")
        self.keys, self.ranks = (left * self.size + right)[order], order
        self.left, self.right, self.made = left, right, made
        self.none = len(merges)
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.splitter = regex.compile("|".join(map(regex.escape, longest_first))) if self.special else None

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``none`` where the pair never merges."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def symbols(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Byte symbols of all pieces end to end, and their n + 1 offsets."""
        raw = [p.encode() for p in pieces]
        offsets = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(r) for r in raw], out=offsets[1:])
        return self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)], offsets

    def pieces(self, text: str) -> list[str | int]:
        """Pre-tokens of a text in order; a special string is its id."""
        if self.splitter is None or not (found := list(self.splitter.finditer(text))):
            return split(text)
        out, at = [], 0
        for m in found:
            out += split(text[at:m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + split(text[at:])


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """One vocabulary per worker process. Its tables and the caches of pre-tokens
    are millions of small objects without cycles, so the collector that would
    walk them again and again is off in that worker."""
    gc.disable()
    return Vocabulary(path)
