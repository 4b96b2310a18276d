"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits without regard to case, so punctuation and
layout don't hide a passage. Runs of ``min_match`` words of the benchmark are
seeds. A bitmap of fixed size, made from all seeds, tells a task which documents
can share one; only these are written, as word hashes with their candidate
seeds, and joined with the benchmark. Pairs whose shared seeds can't reach the
threshold go. For each remaining pair the longest common unmarked runs are
found with Karp-Rabin hashes of falling length, marked as tiles that don't
overlap in either text, and the share of the item's words under tiles is its
coverage: a passage whose parts were reordered keeps its coverage.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm import bitmap as bitmaps
from hazeline.llm.common import byte_view, materialize, mix64, prepare, slices
from hazeline.llm.wordhash import ALPHANUMERIC, runs, words

#: Bits of the seed bitmap: its size never depends on the data.
BITMAP_BITS = 1 << 23


def _item_words(benchmark: DataFrame, k: int) -> DataFrame:
    """item_id, words (hashes), seeds (hash of the run that starts at each word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=1 << 20):
                hashes, counts = words(*byte_view(part.column("text")), ALPHANUMERIC)
                seeds, at = runs(hashes, counts, k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id"), _lists(hashes, np.cumsum(counts)),
                     _lists(seeds, np.searchsorted(at, np.cumsum(counts)))], names=["item_id", "words", "seeds"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").distinct().mapInArrow(
        run, f"item_id {kind}, words array<long>, seeds array<long>")


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two arrays of word hashes: (item start, document
    start, length) of tiles, the longest first, none shorter than min_match.
    Ties go to the first place in the item, then in the document."""
    used_item, used_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    found = []
    length = min(len(item), len(doc))
    while length >= min_match:
        matches = _matches(item, doc, used_item, used_doc, length)
        if matches and (longest := max(m[2] for m in matches)) > 2 * length:
            length = longest  # skip ahead: long tiles are marked first
            continue
        queue = [(-n, i, j) for i, j, n in matches]
        heapify(queue)
        while queue:
            n, i, j = heappop(queue)
            n = -n
            used = used_item[i:i + n] | used_doc[j:j + n]
            if not used.any():
                used_item[i:i + n] = used_doc[j:j + n] = True
                found.append((i, j, n))
                continue
            # What a tile has left of a match waits its turn.
            edges = np.flatnonzero(np.diff(np.concatenate(([True], used, [True])).astype(np.int8))).tolist()
            for s, e in zip(edges[::2], edges[1::2], strict=True):
                if e - s >= length:
                    heappush(queue, (s - e, i + s, j + s))
        length = min_match if min_match < length < 2 * min_match else length // 2
    return found


def _windows(values: np.ndarray, used: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hash of every window of n unmarked words, and its start."""
    m = len(values) - n + 1
    marks = np.concatenate(([0], np.cumsum(used)))
    free = np.flatnonzero(marks[n:] == marks[:m]) if m > 0 else np.zeros(0, np.int64)
    if not len(free):
        return np.zeros(0, np.uint64), free
    base = 0x9E3779B97F4A7C15
    power = np.cumprod(np.full(len(values), base, np.uint64))
    inverse = np.cumprod(np.full(len(values), pow(base, -1, 1 << 64), np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * power)))
    return mix64((sums[free + n] - sums[free]) * inverse[free]), free


def _matches(item, doc, used_item, used_doc, n) -> list[tuple[int, int, int]]:
    """Maximal common unmarked runs of at least n words; only those that can't
    be extended to the left, so that each is given once."""
    of_item, at_item = _windows(item, used_item, n)
    of_doc, at_doc = _windows(doc, used_doc, n)
    hit = np.isin(of_doc, of_item)
    places: dict[int, list[int]] = {}
    for h, i in zip(of_item.tolist(), at_item.tolist(), strict=True):
        places.setdefault(h, []).append(i)
    out = []
    for h, j in zip(of_doc[hit].tolist(), at_doc[hit].tolist(), strict=True):
        for i in places[h]:
            if i and j and not used_item[i - 1] and not used_doc[j - 1] and item[i - 1] == doc[j - 1]:
                continue
            m = min(len(item) - i, len(doc) - j)
            same = (item[i:i + m] == doc[j:j + m]) & ~used_item[i:i + m] & ~used_doc[j:j + m]
            length = m if same.all() else int(same.argmin())
            if length >= n:
                out.append((i, j, length))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 4,
                 threshold: float = 0.5) -> DataFrame:
    """doc_id, item_id, coverage, n_words, n_tiles of every pair of a document
    and a benchmark item of which at least ``threshold`` of the item's words lie
    under tiles. Null and empty texts and items of fewer than min_match words
    match nothing; repeated rows of either table give one row; other columns
    aren't read; no match, no row."""
    spark = docs.sparkSession
    prepare(spark)
    items = materialize(_item_words(benchmark, min_match), "items")
    seeds = items.select("item_id", F.size("words").alias("n_words"),
                         F.posexplode("seeds").alias("pos", "seed"))
    bitmap = spark.sparkContext.broadcast(bitmaps.build(seeds, "seed", BITMAP_BITS))  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bitmap.value
        for batch in batches:
            for part in slices(batch, max_bytes=1 << 20):
                hashes, counts = words(*byte_view(part.column("text")), ALPHANUMERIC)
                grams, at = runs(hashes, counts, min_match)
                hit = bitmaps.has(own, grams)
                grams, at = grams[hit], at[hit]
                ends = np.cumsum(counts)
                owner = np.searchsorted(ends, at, side="right")
                keep = np.unique(owner)
                if not len(keep):
                    continue
                rows = [hashes[ends[i] - counts[i]:ends[i]] for i in keep]
                own_seeds = [np.unique(grams[owner == i]) for i in keep]
                row = part.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [row.column("doc_key"), row.column("doc_id"),
                     _lists(np.concatenate(rows), np.cumsum([len(x) for x in rows])),
                     _lists(np.concatenate(own_seeds), np.cumsum([len(x) for x in own_seeds]))],
                    names=["doc_key", "doc_id", "words", "seeds"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_key"), "doc_id", "text")
    hits = materialize(keyed.mapInArrow(run, f"doc_key long, doc_id {kind}, words array<long>, seeds array<long>")
                       .dropDuplicates(["doc_key"]), "seeded")
    # min_match words a shared seed at most: what falls short even so can't reach the threshold.
    shared = (hits.select("doc_key", F.explode("seeds").alias("seed")).join(seeds, "seed")
              .groupBy("doc_key", "item_id").agg(F.count_distinct("pos").alias("n"), F.max("n_words").alias("n_words"))
              .where(F.col("n") * min_match >= F.col("n_words") * threshold).select("doc_key", "item_id"))
    pairs = (shared.join(items.select("item_id", F.col("words").alias("item")), "item_id")
             .join(hits.select("doc_key", "doc_id", "words"), "doc_key"))
    item_kind = benchmark.schema["item_id"].dataType.simpleString()

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, doc in zip(batch.column("item"), batch.column("words"), strict=True):
                a = item.values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = doc.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found = tiles(a, b, min_match)
                out.append((sum(n for _, _, n in found) / len(a), len(a), len(found)))
            share, size, n = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), pa.array(share, pa.float64()),
                 pa.array(size, pa.int32()), pa.array(n, pa.int32())],
                names=["doc_id", "item_id", "coverage", "n_words", "n_tiles"])

    schema = f"doc_id {kind}, item_id {item_kind}, coverage double, n_words int, n_tiles int"
    return pairs.mapInArrow(tile, schema).where(F.col("coverage") >= threshold)
