"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct new pre-tokens of a batch are laid end to end as one linked list of
symbols. An index maps every mergeable pair (by its rank) to all its positions
in the batch; active ranks are taken from a heap in ascending order, all
positions of a pair merge together, and the lists of the pairs that a merge
creates are extended. Positions made stale by an earlier merge are found by
comparing the symbols when their rank comes up. Each pre-token's symbols stay
between its own ends, so the result is the same as encoding it alone.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from hazeline.llm.common import prepare, slices, texts
from hazeline.llm.vocab import CACHE_ENTRIES, Vocabulary, load


class PairIndex:
    """Merges of a batch of pre-tokens (see the module's text)."""

    def __init__(self, vocab: Vocabulary, pieces: list[str]):
        self.vocab = vocab
        self.sym, self.offsets = vocab.symbols(pieces)
        n = len(self.sym)
        # -1 and n stand outside; a piece's last symbol has no successor.
        self.next = np.arange(1, n + 1, dtype=np.int64)
        self.prev = np.arange(-1, n - 1, dtype=np.int64)
        ends = self.offsets[1:]
        filled = np.diff(self.offsets) > 0
        self.next[ends[filled] - 1] = -1
        self.prev[self.offsets[:-1][filled]] = -1
        self.lists: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []
        left = np.flatnonzero(self.next >= 0)
        self.add(left, vocab.rank_of(self.sym[left], self.sym[left + 1]))

    def add(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        """Puts positions on the list of their pair's rank."""
        keep = ranks < self.vocab.none
        positions, ranks = positions[keep], ranks[keep]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        firsts = ranks[np.concatenate(([0], cuts))].tolist()
        for rank, part in zip(firsts, np.split(positions, cuts), strict=True):
            if rank in self.lists:
                self.lists[rank].append(part)
            else:
                self.lists[rank] = [part]
                heapq.heappush(self.heap, rank)

    def merge(self, rank: int, positions: np.ndarray) -> None:
        """Merges all live positions of one pair, left to right."""
        v, sym, nxt = self.vocab, self.sym, self.next
        a, b, made = v.left[rank], v.right[rank], v.made[rank]
        p = positions[(sym[positions] == a) & (nxt[positions] >= 0)]
        p = p[sym[nxt[p]] == b]
        if a == b and len(p) > 1:
            # In a run of overlapping places every second one merges.
            starts = np.concatenate(([True], nxt[p[:-1]] != p[1:]))
            at = np.arange(len(p))
            p = p[(at - np.maximum.accumulate(np.where(starts, at, 0))) % 2 == 0]
        if not len(p):
            return
        q = nxt[p]
        sym[p] = made
        sym[q] = -1
        after = nxt[q]
        nxt[p] = after
        has_next = after >= 0
        self.prev[after[has_next]] = p[has_next]
        before = self.prev[p]
        has_prev = before >= 0
        lefts = np.concatenate((before[has_prev], p[has_next]))
        if len(lefts):
            self.add(lefts, v.rank_of(sym[lefts], sym[nxt[lefts]]))

    def run(self) -> list[tuple[int, ...]]:
        """Ids of each piece after all merges."""
        while self.heap:
            rank = heapq.heappop(self.heap)
            parts = self.lists.pop(rank)
            self.merge(rank, np.unique(np.concatenate(parts)))
        live = self.sym >= 0
        kept = np.concatenate(([0], np.cumsum(live)))[self.offsets].tolist()
        ids = self.sym[live].tolist()
        return [tuple(ids[s:e]) for s, e in zip(kept[:-1], kept[1:], strict=True)]


class Codec:
    """Encoder and decoder of one worker, with its cache of pre-tokens."""

    def __init__(self, path: str):
        self.vocab = load(path)
        self.known: dict[str | int, tuple[int, ...]] = {}

    def encode(self, batch: list[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        split = [self.vocab.pieces(t) for t in batch]
        new = list(set(chain.from_iterable(split)) - self.known.keys())
        if new:
            if len(self.known) + len(new) > CACHE_ENTRIES:
                self.known.clear()
                new = list(set(chain.from_iterable(split)))
            plain = [p for p in new if isinstance(p, str)]
            self.known.update((p, (p,)) for p in new if not isinstance(p, str))
            self.known.update(zip(plain, PairIndex(self.vocab, plain).run(), strict=True))
        for words in split:
            yield list(chain.from_iterable(map(self.known.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.vocab.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a vocabulary file, kept from task to task."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of a text column as array<int>. A null text is empty
    and has no ids; other columns, ties and repeated rows pass through. A column
    that is already called like ``ids`` is replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop(ids) if ids in docs.columns else docs
    out = StructType([*docs.schema.fields, StructField(ids, ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in slices(batch, text):
                found = pa.array(own.encode(texts(part.column(text))), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, ids])

    return docs.mapInArrow(run, out)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of an array<int> column; null ids give an empty text."""
    prepare(docs.sparkSession)
    docs = docs.drop(text) if text in docs.columns else docs
    out = StructType([*docs.schema.fields, StructField(text, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            found = pa.array([own.decode(x or []) for x in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, text])

    return docs.mapInArrow(run, out)


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
               with_text: bool = False) -> DataFrame:
    """Encodes and decodes every text in one pass over the tokens: doc_id,
    n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256
    and, if asked for, the decoded text. A null text is an empty one. Only the
    two named columns are read."""
    prepare(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", decoded string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        names = [str(i) for i in range(own.vocab.size)]
        for batch in batches:
            for part in slices(batch):
                counts, hashes, back, decoded = [], [], [], []
                for ids in own.encode(texts(part.column("text"))):
                    counts.append(len(ids))
                    hashes.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                    plain = own.decode(ids)
                    back.append(hashlib.sha256(plain.encode()).hexdigest())
                    if with_text:
                        decoded.append(plain)
                columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(back)]
                head = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_text:
                    columns, head = [*columns, pa.array(decoded, pa.string())], [*head, "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=head)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, out)
