"""Fuzzy line deduplication by MinHash.

Equal lines are one node, known by a 64-bit hash. A line's bands are 15 keys of
4 minima each of its set of 5-character shingles, the set that the check
compares: equal sets share all bands at any length. Lines that share a band are
candidates; two lines whose sets have a Jaccard similarity of 0.8 share none with
a probability of 3.7e-4. A pair is a link if the similarity of the full sets is
high enough. Every member of a bucket is compared with the bucket's hub, then
with all members of other components that its size allows. Components come
from a distributed union-find, and the first line of each stays.

The hashing of lines and the comparison of sets run as numpy over Arrow batches;
grouping, joins, union-find and the cutting of texts are DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm import bitmap
from hazeline.llm.common import byte_view, materialize, mix64, prepare, slices
from hazeline.llm.hubs import hub_pairs, unresolved
from hazeline.llm.minhash import band_keys, universal
from hazeline.llm.union_find import union_find
from hazeline.llm.wordhash import NOT_SPACE, powers

#: With these, a pair of similarity 0.8 shares no band with a probability of 3.7e-4.
BANDS, ROWS = 15, 4
CHARS = 5
#: Members of a bucket, and shingles of them, that one block of the pairwise
#: round holds.
BLOCK, BLOCK_SHINGLES = 1000, 1 << 20
#: Bits of the bitmap that tells which lines are wanted.
BITMAP_BITS = 1 << 24


def line_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie end to end: text, number, start and end of every line
    that isn't blank, without the white space at its ends."""
    breaks = np.flatnonzero(raw == 10)
    start = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    # A break at the very end of a text begins a line at the next one's offset.
    text = np.searchsorted(offsets[:-1], start, side="right") - 1
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    per_text = np.bincount(owner, minlength=len(offsets) - 1) + 1
    text = np.repeat(np.arange(len(offsets) - 1), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    first = number == 0
    start = np.empty(len(text), np.int64)
    start[first], start[~first] = offsets[:-1], breaks + 1
    end = np.empty(len(text), np.int64)
    last = np.append(first[1:], True)
    end[last], end[~last] = offsets[1:], breaks
    solid = np.flatnonzero(NOT_SPACE[raw])
    left, right = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = right > left
    return text[some], number[some], solid[left[some]], solid[right[some] - 1] + 1


def _sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the polynomial of all bytes, and the inverse powers."""
    power, inverse = powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], out=sums[1:])
    return sums, inverse


def signatures(raw: np.ndarray, sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bands of lines, a row of keys for each: minima of the line's 5-character
    runs under universal functions. A shorter line is its only run."""
    if not len(start):
        return np.zeros((0, BANDS), np.uint64)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)  # first bytes of characters
    place = np.append(lead, len(raw))
    first, last = np.searchsorted(lead, start), np.searchsorted(lead, end)
    n = np.maximum(last - first - CHARS + 1, 1)
    begin = np.cumsum(n) - n
    at = np.arange(n.sum()) + np.repeat(first - begin, n)
    stop = place[np.minimum(at + CHARS, np.repeat(last, n))]
    at = place[at]
    h = mix64((sums[stop] - sums[at]) * inverse[at])
    a, b = universal(BANDS * ROWS)
    minima, work = np.empty((len(start), BANDS * ROWS), np.uint32), np.empty_like(h)
    for i in range(BANDS * ROWS):
        np.multiply(h, a[i], out=work)
        work += b[i]
        minima[:, i] = np.minimum.reduceat(work, begin) >> np.uint64(32)
    return band_keys(minima, BANDS)


def _lines(keyed: DataFrame, bands: bool = False, wanted=None, texts: bool = False) -> DataFrame:
    """doc_id, doc_key, pos, node of every line that isn't blank; with its bands
    or its text and number of shingles if asked for, and only lines whose bit is
    set in ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=1 << 20):
                raw, offsets = byte_view(part.column("text"))
                text, pos, start, end = line_bounds(raw, offsets)
                sums, inverse = _sums(raw)
                node = mix64((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
                if wanted is not None:
                    keep = bitmap.has(wanted.value, node)
                    text, pos, start, end, node = (x[keep] for x in (text, pos, start, end, node))
                columns = [part.column("doc_id").take(pa.array(text)), part.column("doc_key").take(pa.array(text)),
                           pa.array(pos.astype(np.int32)), pa.array(node.view(np.int64))]
                names = ["doc_id", "doc_key", "pos", "node"]
                if bands:
                    keys = signatures(raw, sums, inverse, start, end)
                    ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS)
                    columns, names = [*columns, pa.ListArray.from_arrays(ends, pa.array(keys.ravel().view(np.int64)))], [*names, "bands"]
                if texts:
                    cut = [raw[s:e].tobytes().decode() for s, e in zip(start.tolist(), end.tolist(), strict=True)]
                    sizes = pa.array([len(x) for x in shingle_sets(cut)], pa.int32())
                    columns, names = [*columns, pa.array(cut, pa.string()), sizes], [*names, "line", "size"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, doc_key long, pos int, node long" + ", bands array<long>" * bands + ", line string, size int" * texts
    return keyed.select("doc_id", F.col("_key").alias("doc_key"), "text").mapInArrow(run, schema)


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """Sorted distinct 5-character runs of each line, as 64-bit hashes of their
    code points; a shorter line is its only run."""
    filled = [x if len(x) >= CHARS else x + "\0" * (CHARS - len(x)) for x in lines]
    points = np.frombuffer("".join(filled).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    m, total = max(0, len(points) - CHARS + 1), np.zeros(1, np.uint64)
    for i in range(CHARS):
        total = total * np.uint64(0x9E3779B97F4A7C15) + points[i:i + m]
    total = mix64(total)
    ends = np.cumsum([len(x) for x in filled]).tolist()
    out, start = [], 0
    for end in ends:
        own = np.sort(total[start:end - CHARS + 1])
        keep = np.ones(len(own), bool)
        keep[1:] = own[1:] != own[:-1]
        out.append(own[keep])
        start = end
    return out


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar. A batch's sets are made once
    for each line in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "line_u"):
                both = pa.concat_arrays([part.column("line_u"), part.column("line_v")]).dictionary_encode()
                sets, at = shingle_sets(both.dictionary.to_pylist()), both.indices.to_numpy()
                ok = []
                for u, v in zip(at[:part.num_rows].tolist(), at[part.num_rows:].tolist(), strict=True):
                    a, b = sets[u], sets[v]
                    joint = np.sort(np.concatenate((a, b)))
                    common = int((joint[1:] == joint[:-1]).sum())
                    ok.append(100 * common >= percent * (len(a) + len(b) - common))
                yield part.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(texts.toDF("u", "line_u", "size_u"), "u").join(texts.toDF("v", "line_v", "size_v"), "v")
    both = both.where(_sizes_fit("size_u", "size_v", percent))
    return both.select("u", "v", "line_u", "line_v").mapInArrow(run, "u long, v long")


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_key", F.xxhash64("doc_id", "text"))


def cross_links(sets: list[np.ndarray], comps: np.ndarray, held: int, percent: int, within: bool) -> list[tuple[int, int]]:
    """Links between the first ``held`` sets and later ones (``within``: among
    the held ones too) of other components. Components that a link joins become
    one in ``comps``, and pairs inside it aren't compared any more."""
    out = []
    if len(sets) < 2 or (comps == comps[0]).all():
        return out
    size = np.array([len(x) for x in sets])
    begin = np.cumsum(size) - size
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(values), bool)
    for i in range(held):
        later = i + 1 if within else held
        fits = 100 * np.minimum(size[later:], size[i]) >= percent * np.maximum(size[later:], size[i])
        other = later + np.flatnonzero(fits & (comps[later:] != comps[i]))
        if not len(other):
            continue
        own = ids[begin[i]:begin[i] + size[i]]
        mark[own] = True
        n = size[other]
        starts = np.cumsum(n) - n
        hits = mark[ids[np.arange(n.sum()) + np.repeat(begin[other] - starts, n)]]
        mark[own] = False
        common = np.add.reduceat(hits, starts, dtype=np.int64)
        for j in other[100 * common >= percent * (n + size[i] - common)].tolist():
            if comps[j] != comps[i]:
                out.append((i, j))
                comps[comps == comps[j]] = comps[i]
    return out


def _rest(buckets: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that are in different components;
    all pairs that sizes allow are compared. A bucket is dealt in blocks: each
    member is held in its own and goes past those before it, with its text, so
    texts are moved once a block and not once a pair."""
    members = buckets.select("key", "node", "component").join(texts, "node")
    sizes = members.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("blocks"))
    dealt = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), "own")))
    dealt = (dealt.select("key", "block", (F.col("block") < F.col("own")).alias("passing"), "node", "component", "line")
             .repartition("key", "block").sortWithinPartitions("key", "block", "passing"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[int] = []
        comps, sets, held, n, group = [], [], 0, 0, None

        def done(within: bool) -> pa.RecordBatch:
            """Compares what is held with what has come, and keeps the former."""
            nonlocal n
            now = np.array(comps, np.int64)
            found = cross_links(sets, now, held, percent, within)
            links = [(nodes[i], nodes[j]) for i, j in found]
            comps[:] = now[:held].tolist()
            del nodes[held:], sets[held:]
            n = 0
            u, v = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            for part in slices(batch, "line", max_bytes=1 << 20):
                own = shingle_sets(part.column("line").to_pylist())
                for key, block, passing, node, comp, x in zip(*(part.column(c).to_pylist() for c in (
                        "key", "block", "passing", "node", "component")), own, strict=True):
                    if (key, block) != group:
                        if group is not None:
                            yield done(within=not any_passing)
                        group, held, n, any_passing = (key, block), 0, 0, False
                        nodes.clear(), comps.clear(), sets.clear()
                    if passing and not any_passing:
                        yield done(within=True)
                        any_passing = True
                    if n > BLOCK_SHINGLES and passing:
                        yield done(within=False)
                    nodes.append(node)
                    comps.append(comp)
                    sets.append(x)
                    n += len(x)
                    held += not passing
        if group is not None:
            yield done(within=not any_passing)

    return dealt.mapInArrow(run, "u long, v long")


def line_groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Lines to drop: doc_key (hash of doc_id and text), pos (from 0). The first
    line of each group, by doc_id (null first), then place, stays."""
    prepare(docs.sparkSession)
    broadcast = docs.sparkSession.sparkContext.broadcast
    keyed = _keyed(docs)
    where = F.struct("doc_id", "doc_key", "pos")
    nodes = materialize(_lines(keyed, bands=True).groupBy("node").agg(
        F.min(where).alias("first"), F.count("*").alias("n"), F.first("bands").alias("bands")), "lines")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    full = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialize(keys.join(full, "key").withColumn("component", F.col("node")), "buckets")
    wanted = buckets.select("node").distinct()
    bits = broadcast(bitmap.build(wanted, "node", BITMAP_BITS))  # of a fixed size
    texts = _lines(keyed, wanted=bits, texts=True).groupBy("node").agg(F.first("line").alias("line"), F.first("size").alias("size"))
    texts = materialize(texts.join(wanted, "node", "left_semi"), "texts")
    # First every member against its bucket's hub, the one with most company in
    # all its buckets; then pairs of different components.
    company = buckets.groupBy("node").agg(F.sum("n").alias("company"))
    first = hub_pairs(buckets.join(company, "node"), -F.col("company"))
    links = materialize(_verified(first, texts, percent), "links")
    found = union_find(links)
    left = unresolved(buckets, found)
    if not left.isEmpty():
        more = materialize(_rest(left, texts, percent), "links")
        if not more.isEmpty():
            found = union_find(links.union(more))
    placed = (nodes.select("node", "first", "n").join(found, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    groups = placed.groupBy("component").agg(F.min("first").alias("keep"), F.sum("n").alias("total")).where("total > 1")
    kept = placed.join(groups.select("component", "keep"), "component").select("node", "keep")
    kept = materialize(kept, "kept")
    bits = broadcast(bitmap.build(kept, "node", BITMAP_BITS))
    return (_lines(keyed, wanted=bits).select("node", "doc_key", "pos").join(kept, "node")
            .where((F.col("doc_key") != F.col("keep.doc_key")) | (F.col("pos") != F.col("keep.pos")))
            .select("doc_key", "pos"))


def drop_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """All rows of ``docs`` with text without its dropped lines, and n_lines and
    n_removed. Blank lines are never dropped. A null text stays null with no
    lines; an empty one is one blank line. Repeated rows (equal doc_id and text)
    are one document and keep the same lines. Of text columns only ``text`` is
    read; others pass through, n_lines and n_removed are replaced."""
    docs = docs.drop("n_lines", "n_removed")
    gone = line_groups(docs, percent).groupBy("doc_key").agg(F.collect_set("pos").alias("gone"))
    joined = _keyed(docs).join(gone, F.col("_key") == F.col("doc_key"), "left").withColumn("_lines", F.split("text", "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "gone")
    kept = F.array_join(F.transform(places, lambda i: F.get("_lines", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text")
    lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("_lines")).alias("n_lines")
    return joined.select(*(text if c == "text" else c for c in docs.columns), lines,
                         F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).alias("n_removed"))
