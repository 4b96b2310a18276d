"""Near-duplicate documents by MinHash: word shingles, minima under many
universal hash functions, banding, signature verification, an exact check on
full shingle sets, and connected components.

Documents of equal shingle sets are one class and only its least id goes on.
Documents that share a band key form a bucket. Instead of all pairs of a bucket,
each is compared with one hub; documents that end up in one component need no
more comparisons. What is left in a bucket are members of different components.
Of these a similar pair must share one of its rarest shingles (a prefix filter,
which is exact), so candidates are pairs with such a shingle in common whose sizes
and places allow enough common shingles; all of them are checked, and no link that
joins components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm import bitmap
from hazeline.llm.common import byte_view, discard, materialize, mix64, prepare, slices
from hazeline.llm.components import components
from hazeline.llm.hubs import hub_pairs, unresolved
from hazeline.llm.wordhash import NOT_SPACE, runs, words

SHINGLE = 5
#: With these, a pair of similarity 0.85 shares no band with a probability of 1.2e-5.
BANDS, ROWS = 24, 6
#: That probability, to which bands and rows are made at any threshold, and the
#: minima that they may take.
MISSED, MINIMA = 1.2e-5, 150
#: Signature check: a pair goes if its share of equal minima is this far below
#: the threshold (five standard deviations of the estimate at 0.85), or further
#: where five standard deviations are more.
SLACK = 0.16
#: Members of a shingle's group that one block of the last, pairwise round takes.
BLOCK_MEMBERS = 256
#: Bits of the bitmap that tells whose sets are wanted (2 MB). A full one only
#: means that sets are written which no pair reads.
WANTED_BITS = 1 << 24


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a text of fewer than
    ``size`` words has its whole sequence as one, one without words has none."""
    hashes, counts = words(*byte_view(column), NOT_SPACE)
    grams, at = runs(hashes, counts, size)
    ends = np.cumsum(counts)
    cut = np.searchsorted(at, ends)
    out, before = [], 0
    for end, n, stop in zip(ends.tolist(), counts.tolist(), cut.tolist(), strict=True):
        if n >= size:
            own = np.sort(grams[before:stop])
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            out.append(own[keep])
        elif n:
            out.append(runs(hashes[end - n:end], np.array([n]), n)[0])
        else:
            out.append(np.zeros(0, np.uint64))
        before = stop
    return out


def universal(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of n multiply-shift hash functions."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, np.uint64))


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows at a threshold: the most rows, up to ROWS, with which a
    pair of that similarity shares no band with a probability of MISSED at most
    and that take MINIMA minima at most. (24, 6) at 85, (29, 5) at 80."""
    similarity = min(max(percent, 1), 99) / 100
    for rows in range(ROWS, 0, -1):
        bands = math.ceil(math.log(MISSED) / math.log1p(-similarity ** rows))
        if bands * rows <= MINIMA:
            break
    return bands, rows


def signatures(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Minima of every non-empty set under bands * rows universal functions, one
    row a set (uint32)."""
    a, b = universal(bands * rows)
    out = np.empty((len(sets), bands * rows), np.uint32)
    if not len(sets):
        return out
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    work = np.empty_like(values)
    for i in range(bands * rows):
        np.multiply(values, a[i], out=work)
        work += b[i]
        out[:, i] = np.minimum.reduceat(work, starts) >> np.uint64(32)
    return out


def band_keys(minima: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of each signature; the band is part of it."""
    parts = minima.reshape(len(minima), bands, minima.shape[1] // bands).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(parts.shape[2]):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r] + np.uint64(1))
    return key


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (128 bits that stand for the set), bands
    (array<long>), signature (one byte of each minimum); the last two are null
    for empty sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=1 << 20):
                sets = shingle_sets(part.column("text"))
                filled = np.array([len(s) > 0 for s in sets], bool)
                minima = signatures([s for s in sets if len(s)], bands, rows)
                keys = band_keys(minima, bands).view(np.int64)
                low = (minima & np.uint32(255)).astype(np.uint8)
                place = np.cumsum(filled) - 1
                own = [keys[p] if ok else None for p, ok in zip(place, filled, strict=True)]
                short = [low[p].tobytes() if ok else None for p, ok in zip(place, filled, strict=True)]
                one, two = zip(*map(_digests, sets), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()),
                     pa.array(two, pa.int64()), pa.array(own, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"])

    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _digests(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return (int(mix64(values).sum(dtype=np.uint64).view(np.int64)),
            int(mix64(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))


def sets_of(docs: DataFrame, wanted=None) -> DataFrame:
    """doc_id, set (one half of what stands for it), shingles: the sorted hashes
    as bytes. With ``wanted``, a broadcast bitmap, only of ids whose bit is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if wanted is not None:
                batch = batch.filter(pa.array(bitmap.has(wanted.value, _ids(batch))))
            for part in slices(batch, max_bytes=1 << 20):
                sets = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([_digests(s)[0] for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "set", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return rows.mapInArrow(run, "doc_id long, set long, shingles binary")


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _kept_pairs(pairs: DataFrame, decide, columns: tuple[str, str]) -> DataFrame:
    """Pairs u, v for which decide(bytes of u, bytes of v) holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [decide(x.as_buffer(), y.as_buffer()) for x, y in
                  zip(batch.column(columns[0]), batch.column(columns[1]), strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("u", "v", *columns).mapInArrow(run, "u long, v long")


def _similar(percent: int):
    def decide(x, y) -> bool:
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.sort(np.concatenate((a, b)))
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= percent * (len(a) + len(b) - common)
    return decide


def _near(percent: int):
    similarity, minima = percent / 100, math.prod(banding(percent))
    least = similarity - max(SLACK, 5 * math.sqrt(similarity * (1 - similarity) / minima))

    def decide(x, y) -> bool:
        a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
        return (a == b).mean() >= least
    return decide


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of candidate pairs u, v those whose full sets are similar: first by what
    their sizes allow, then by signature, then exactly. A document of several
    texts is compared by each of its sets."""
    side = lambda name: nodes.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"n_{name}"),
                                     F.col("signature").alias(f"s_{name}"))
    near = (pairs.join(side("u"), "u").join(side("v"), "v")
            .where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")))
    near = materialize(_kept_pairs(near, _near(percent), ("s_u", "s_v")).distinct(), "near")
    sets = sets.select("doc_id", "shingles")
    full = near.join(sets.toDF("u", "x_u"), "u").join(sets.toDF("v", "x_v"), "v")
    found = materialize(_kept_pairs(full, _similar(percent), ("x_u", "x_v")).distinct(), "verified")
    discard(near)
    return found


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``. Two
    documents are linked when 100 * |A & B| >= percent * |A | B| of their sets
    of 5-word shingles; component_id is the least doc_id that can be reached.

    A null or empty text, or one of white space alone, has no shingle and is
    linked with nothing. Rows of one doc_id are one document that may have
    several texts; a null doc_id is never linked, has a null component and is
    kept. No row in, no row out; other columns aren't read.
    """
    spark = docs.sparkSession
    prepare(spark)
    every = materialize(signed(docs, *banding(percent)), "signed")
    # One node for each distinct set: its least id. The minimum is combined before the shuffle.
    same = every.where("n_shingles > 0 and doc_id is not null")
    classes = materialize(same.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    chosen = same.join(classes, ["set_a", "set_b", "n_shingles"])
    # The classes of a document with several texts belong together.
    set_ = F.struct("set_a", "set_b")
    several = same.groupBy("doc_id").agg(F.min(set_).alias("a"), F.max(set_).alias("b")).where("a <> b").select("doc_id")
    own = (same.select("doc_id", "set_a", "set_b", "n_shingles").join(several, "doc_id")
           .join(classes, ["set_a", "set_b", "n_shingles"]).select(F.col("rep").alias("u"), F.col("doc_id").alias("v")).distinct())
    nodes = (chosen.where("doc_id = rep").select("doc_id", F.col("set_a").alias("set"), "n_shingles", "bands", "signature")
             .dropDuplicates(["doc_id", "set", "n_shingles"]))
    buckets = nodes.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    full = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialize(buckets.join(full, "key").withColumn("component", F.col("node")), "buckets")
    wanted = buckets.select(F.col("node").alias("doc_id")).distinct()
    nodes = materialize(nodes.join(wanted, "doc_id", "left_semi").drop("bands"), "nodes")
    # Texts stay where they are: only the sets of nodes with company are dealt.
    bits = spark.sparkContext.broadcast(bitmap.build(wanted, "doc_id", WANTED_BITS))
    sets = materialize(sets_of(docs, bits).join(nodes.select("doc_id", "set"), ["doc_id", "set"], "left_semi")
                       .dropDuplicates(["doc_id", "set"]), "sets")
    # First every member against its bucket's hub, the one with most company in
    # all its buckets: of copies with changes of their own, that is the original.
    company = buckets.groupBy("node").agg(F.sum("n").alias("company"))
    first = hub_pairs(buckets.join(company, "node"), -F.col("company"))
    found = materialize(components(_verified(first, nodes, sets, percent).union(own)), "components")
    left = unresolved(buckets, found)
    if not left.isEmpty():
        more = _verified(_rest(left, sets, percent), nodes, sets, percent)
        if not more.isEmpty():
            found = materialize(components(found.toDF("u", "v").union(more)), "components")
    discard(buckets, nodes, sets, left)
    # Equal sets are tied together by their class, whose own component is the representative's.
    ties = every.where("doc_id is not null").join(classes, ["set_a", "set_b", "n_shingles"], "left")
    root = F.coalesce("component", "rep", "doc_id")
    out = (ties.join(found, F.col("rep") == F.col("node"), "left")
           .select("doc_id", "n_shingles", root.alias("component_id")))
    alone = every.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    out = out.union(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _unpacked(sets: DataFrame) -> DataFrame:
    """node, set, size and shingle of every member of every set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, own, raw in zip(batch.column("doc_id").to_pylist(), batch.column("set").to_pylist(),
                                      batch.column("shingles"), strict=True):
                values = np.frombuffer(raw.as_buffer(), np.int64)
                n = len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, node)), pa.array(np.full(n, own)), pa.array(np.full(n, n)), pa.array(values)],
                    names=["node", "set", "size", "shingle"])

    return sets.select("doc_id", "set", "shingles").mapInArrow(run, "node long, set long, size long, shingle long")


def _rest(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of open buckets from different components that can be
    similar.

    Shingles are ordered by the number of open sets that have them, the rarest
    first. A set of n shares at least percent % of n with a similar one, so it
    has one of the pair's common shingles among its first n less that, plus one.
    The first common shingle at places i and j of sets of n and m leaves at most
    1 + min(n - i, m - j) common ones. A shingle of one set alone takes a place
    but makes no pair.
    """
    open_ = buckets.select(F.col("node").alias("doc_id"), "component").distinct()
    tokens = _unpacked(sets.join(open_, "doc_id", "left_semi"))
    often = tokens.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    of_set = Window.partitionBy("node", "set")
    placed = (tokens.join(often, "shingle")
              .withColumn("place", F.col("size") - F.count("*").over(of_set)
                          + F.row_number().over(of_set.orderBy("n", "shingle")))
              .where(f"place <= size - (({percent} * size + 99) div 100) + 1")
              .join(open_.withColumnRenamed("doc_id", "node"), "node")
              .select("shingle", "node", "component", "size", (F.col("size") - F.col("place") + 1).alias("rest")))
    placed = materialize(placed, "prefixes")
    mixed = (placed.groupBy("shingle").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n"))
             .where("a <> b").select("shingle", F.ceil(F.col("n") / BLOCK_MEMBERS).cast("long").alias("blocks")))
    able = placed.join(mixed, "shingle")
    left = able.select("shingle", F.col("node").alias("u"), F.col("component").alias("cu"), F.col("size").alias("nu"),
                       F.col("rest").alias("ru"), F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    right = able.select("shingle", F.col("node").alias("v"), F.col("component").alias("cv"), F.col("size").alias("nv"),
                        F.col("rest").alias("rv"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    fits = f"u < v and cu <> cv and 100 * least(ru, rv) >= {percent} * (nu + nv - least(ru, rv))"
    same = (left["shingle"] == right["shingle"]) & (left["block"] == right["block"])
    return left.join(right, same & F.expr(fits)).select("u", "v").distinct()
