"""Token counts by rank-synchronous merging of ragged arrays.

The distinct new pre-tokens of a batch are one ragged array of symbols. In each
round every sequence takes its own lowest-ranked pair (one segmented minimum)
and merges all its places at once, left to right; sequences without a
mergeable pair leave the array with their count of symbols. The number of rounds is
that of the longest merge history, not of the vocabulary's ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import prepare, slices, texts
from hazeline.llm.vocab import CACHE_ENTRIES, Vocabulary, load


def count_pieces(vocab: Vocabulary, pieces: list[str]) -> np.ndarray:
    """Number of tokens of each pre-token."""
    sym, offsets = vocab.symbols(pieces)
    out = np.diff(offsets)
    seq = np.repeat(np.arange(len(pieces)), out)
    # rank[i]: of the pair (i, i + 1); none at the end of a sequence.
    rank = np.full(len(sym), vocab.none, np.int64)
    if len(sym) > 1:
        rank[:-1] = np.where(seq[:-1] == seq[1:], vocab.rank_of(sym[:-1], sym[1:]), vocab.none)
    while len(sym):
        starts = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
        lengths = np.diff(np.append(starts, len(sym)))
        lowest = np.minimum.reduceat(rank, starts)
        live = lowest < vocab.none
        out[seq[starts[~live]]] = lengths[~live]
        keep = np.repeat(live, lengths)
        sym, seq, rank = sym[keep], seq[keep], rank[keep]
        if not len(sym):
            break
        target = np.repeat(lowest[live], lengths[live])
        at = np.flatnonzero(rank == target)
        # A place that follows a merging one directly overlaps it: of such a run
        # (pairs of equal symbols) every second place merges.
        index = np.arange(len(at))
        fresh = np.concatenate(([True], at[1:] != at[:-1] + 1))
        at = at[(index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0]
        sym[at] = vocab.made[rank[at]]
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        place = np.cumsum(stay) - 1
        sym, seq = sym[stay], seq[stay]
        rank = rank[stay]
        now = place[at]
        changed = np.unique(np.concatenate((now, now[now > 0] - 1)))
        inside = changed[changed < len(sym) - 1]
        rank[changed] = vocab.none
        rank[inside] = np.where(seq[inside] == seq[inside + 1],
                                vocab.rank_of(sym[inside], sym[inside + 1]), vocab.none)
    return out


class Counter:
    """A worker's counter with its cache of pre-tokens."""

    def __init__(self, path: str):
        self.vocab = load(path)
        self.known: dict[str | int, int] = {}

    def count(self, batch: list[str]) -> list[int]:
        """Number of tokens of each text."""
        split = [self.vocab.pieces(t) for t in batch]
        every = set().union(*split)
        new = list(every - self.known.keys())
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known.clear()
            new = list(every)
        plain = [p for p in new if isinstance(p, str)]
        self.known.update((p, 1) for p in new if not isinstance(p, str))
        self.known.update(zip(plain, count_pieces(self.vocab, plain).tolist(), strict=True))
        return [sum(map(self.known.__getitem__, words)) for words in split]


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter of a vocabulary file, kept from task to task."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = 1024,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every
    text. A null text is empty: no bytes, no tokens. Repeated rows give repeated
    rows; other columns aren't read."""
    prepare(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"),
                     pa.array(own.count(texts(part.column("text"))), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])

    out = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                      F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"))
    out = out.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
