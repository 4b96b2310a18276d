"""Exact removal of repeated byte strings with suffix arrays.

Every window of ``window`` bytes has an anchor inside it (:mod:`anchors`), so
equal windows lie in stretches with equal anchors. Only anchors that occur more
than once matter. Stretches with equal bytes are one class: all but the first
are repeats as a whole. Classes that share an anchor are put together, their
bytes sorted by a suffix array built by prefix doubling, and neighbours in that
order that agree in the first ``window`` bytes are the same string: all but the
earliest are repeats. Groups of classes that are too large for one array are
split by longer and longer parts of the windows around the anchor, so a line
that is common but shorter than a window doesn't gather in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm import bitmap
from hazeline.llm.anchors import stretches
from hazeline.llm.common import byte_view, materialize, prepare, slices
from hazeline.llm.suffix_array import suffix_array

GRAM = 32
#: Bits of the bitmaps that tell which anchors repeat and which bytes are wanted.
BITMAP_BITS = 1 << 27
#: Classes that one suffix array takes for an anchor; larger groups are split.
GROUP_CLASSES = 16
#: Bytes of a suffix array's text, beyond which a task begins another array.
ARRAY_BYTES = 100_000


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_key stands for the row: repeated rows are one document."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("doc_key"))


def _scan(docs: DataFrame, window: int, schema: str, rows) -> DataFrame:
    """Runs rows(part, raw, offsets, stretches of it) over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=1 << 20):
                raw, offsets = byte_view(part.column("text"))
                yield from rows(part, raw, offsets, stretches(raw, offsets, window, GRAM))

    return docs.mapInArrow(run, schema)


def _repeated_anchors(docs: DataFrame, window: int) -> np.ndarray:
    """Bitmap of the anchors that occur more than once."""
    def rows(part, raw, offsets, found):
        values, counts = np.unique(found[4], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["anchor", "n"])

    every = _scan(docs, window, "anchor long, n long", rows)
    return bitmap.build(every.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"), "anchor", BITMAP_BITS)


def _stretches(docs: DataFrame, window: int, repeated, wanted=None) -> DataFrame:
    """Stretches whose anchor may repeat; with their bytes and only those whose
    place is in ``wanted``, if that is given."""
    def rows(part, raw, offsets, found):
        text, start, n, lead, anchor, whole = found
        keep = bitmap.has(repeated.value, anchor)
        text, start, n, lead, anchor, whole = (x[keep] for x in (text, start, n, lead, anchor, whole))
        keys = part.column("doc_key").to_numpy(zero_copy_only=False)
        at = start - offsets[text]
        if wanted is not None:
            keep = bitmap.has(wanted.value, _place(keys[text], at))
            text, start, n, lead, anchor, whole, at = (x[keep] for x in (text, start, n, lead, anchor, whole, at))
        columns = [pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)),
                   part.column("doc_id").take(pa.array(text)), pa.array(keys[text]),
                   pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(lead.astype(np.int32))]
        names = ["key", "whole", "doc_id", "doc_key", "start", "n", "lead"]
        if wanted is not None:
            spans = [raw[s:s + k + window - 1].tobytes() for s, k in zip(start.tolist(), n.tolist(), strict=True)]
            columns, names = [*columns, pa.array(spans, pa.binary())], [*names, "bytes"]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"key long, whole long, doc_id {kind}, doc_key long, start int, n int, lead int"
    return _scan(docs, window, schema + ", bytes binary" * (wanted is not None), rows)


def _place(doc_key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """What stands for a stretch's place in the bitmap; doc_key is a hash."""
    return doc_key.astype(np.int64).view(np.uint64) ^ start.astype(np.uint64)


def _repeats(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Stretches that aren't the first of their class: repeats as a whole."""
    many = classes.where("k > 1").select("key", "whole", "first")
    return (rows.join(many, ["key", "whole"])
            .where((F.col("doc_key") != F.col("first.doc_key")) | (F.col("start") != F.col("first.start")))
            .select("doc_key", "start", "n"))


def _classes(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct("doc_id", "doc_key", "start", "n", "lead")).alias("first")
    return rows.groupBy("key", "whole").agg(first, F.count("*").alias("k"))


def _shared(classes: DataFrame) -> DataFrame:
    """First stretches of the classes that share their key with others, with the
    number of classes."""
    sizes = classes.groupBy("key").agg(F.count("*").alias("classes")).where("classes > 1")
    return classes.join(sizes, "key").select("key", "whole", "first.*", "classes")


def _halves(rows: DataFrame, window: int) -> DataFrame:
    """Splits stretches whose anchors may lie ``low`` to ``high`` bytes behind a
    window's start at the middle distance. The new key adds the bytes that all
    windows of a half share: the smaller the range, the more they are, and all
    of a window's when its ends meet."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(F.struct("low", middle.alias("high")), F.struct((middle + 1).alias("low"), "high"))
    part = rows.where("low < high").withColumn("half", F.explode(halves)).withColumns({"low": F.col("half.low"), "high": F.col("half.high")})
    part = (part.withColumn("most", F.least("lead", "high"))
            .withColumn("left", F.col("most") - F.greatest(F.col("lead") - F.col("n") + 1, F.col("low")) + 1).where("left > 0")
            .withColumn("skip", F.col("lead") - F.col("most"))
            .withColumn("bytes", F.expr(f"substring(bytes, skip + 1, left + {window - 1})")))
    core = F.expr(f"substring(bytes, most - low + 1, {window} - (high - low))")
    return part.select(F.xxhash64("key", "low", core).alias("key"), F.xxhash64("bytes", "left").alias("whole"), "doc_id", "doc_key",
                       (F.col("start") + F.col("skip")).alias("start"), F.col("left").alias("n"), F.col("most").alias("lead"),
                       "bytes", "low", "high")


def array_repeats(group: list[tuple], window: int) -> list[tuple[int, int, int]]:
    """Of stretches (doc_id, doc_key, start, n, bytes): ranges (doc_key, start,
    n) of windows that an earlier stretch holds too."""
    sizes = np.array([len(g[4]) for g in group])
    base = np.cumsum(sizes + 1) - sizes - 1
    text = np.full(int((sizes + 1).sum()) + 1, 1, np.int64)  # 1 parts stretches, 0 ends all
    text[-1] = 0
    for b, g in zip(base.tolist(), group, strict=True):
        text[b:b + len(g[4])] = np.frombuffer(g[4], np.uint8).astype(np.int64) + 2
    counts = np.array([g[3] for g in group])
    of = np.full(len(text), -1, np.int64)
    for k, (b, n) in enumerate(zip(base.tolist(), counts.tolist(), strict=True)):
        of[b:b + n] = k
    order = suffix_array(text)
    order = order[of[order] >= 0]
    owner = of[order]
    view = np.lib.stride_tricks.sliding_window_view(text.astype(np.int16), window)
    same = np.ones(len(order), bool)
    same[0] = False
    for i in range(1, len(order), 4096):
        a, b = order[i - 1:i + 4095], order[i:i + 4096]
        same[i:i + 4096] = (view[a[:len(b)]] == view[b]).all(1)
    begins = np.flatnonzero(~same)
    rank = np.empty(len(group), np.int64)
    rank[sorted(range(len(group)), key=lambda k: group[k][:3])] = np.arange(len(group))
    earliest = np.repeat(np.minimum.reduceat(rank[owner], begins), np.diff(np.append(begins, len(order))))
    repeated = np.zeros(len(text) + 1, bool)
    repeated[order[rank[owner] != earliest]] = True
    edges = np.flatnonzero(repeated[1:] != repeated[:-1]) + 1
    if repeated[0]:
        edges = np.append(0, edges)
    out = []
    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        # Windows of different stretches are never next to each other.
        k = int(of[s])
        out.append((group[k][1], group[k][2] + s - int(base[k]), e - s))
    return out


def _by_array(rows: DataFrame, window: int) -> DataFrame:
    """Repeats among stretches that share a key; each key's rows stay in one
    task, and tasks stream through their keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        bytes_held, last = 0, None

        def done() -> pa.RecordBatch:
            found = array_repeats(held, window)
            keys, starts, counts = zip(*found, strict=True) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int32()),
                                               pa.array(counts, pa.int32())], names=["doc_key", "start", "n"])

        for batch in batches:
            for key, doc_id, doc_key, start, n, raw in zip(*(batch.column(c).to_pylist() for c in (
                    "key", "doc_id", "doc_key", "start", "n", "bytes")), strict=True):
                if key != last and bytes_held > ARRAY_BYTES:
                    yield done()
                    held, bytes_held = [], 0
                held.append((-(1 << 63) if doc_id is None else doc_id, doc_key, start, n, raw))
                bytes_held, last = bytes_held + len(raw), key
        if held:
            yield done()

    # A fixed number of parts: sorting costs far more than its bytes suggest, so
    # small parts aren't to be merged.
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    ordered = rows.select("key", "doc_id", "doc_key", "start", "n", "bytes").repartition(parts, "key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "doc_key long, start int, n int")


def repeated_windows(docs: DataFrame, window: int = 100) -> DataFrame:
    """doc_key, start, n: stretches of windows that also start earlier, where
    earlier is a smaller doc_id (null first, then by doc_key) or an earlier
    place of the same document."""
    spark = docs.sparkSession
    repeated = spark.sparkContext.broadcast(_repeated_anchors(docs, window))  # of a fixed size
    rows = materialize(_stretches(docs, window, repeated), "stretches")
    classes = materialize(_classes(rows), "classes")
    out = [materialize(_repeats(rows, classes), "repeats")]
    first = materialize(_shared(classes), "shared")
    place = F.col("doc_key").bitwiseXOR(F.col("start").cast("long")).alias("place")  # as _place
    wanted = spark.sparkContext.broadcast(bitmap.build(first.select(place), "place", BITMAP_BITS))
    found = _stretches(docs, window, repeated, wanted).select("doc_key", "start", "bytes")
    found = found.dropDuplicates(["doc_key", "start"])
    full = materialize(first.join(found, ["doc_key", "start"]), "contexts")
    level = full.withColumns({"low": F.lit(0), "high": F.lit(window - GRAM)})
    arrays = []
    while True:
        arrays.append(level.where(F.col("classes") <= GROUP_CLASSES).select("key", "doc_id", "doc_key", "start", "n", "bytes"))
        large = level.where(F.col("classes") > GROUP_CLASSES)
        if large.isEmpty():
            break
        # Where the ends of a range have met, a key is one string and one class.
        halves = materialize(_halves(large, window), "halves")
        own = _classes(halves)
        out.append(materialize(_repeats(halves, own), "repeats"))
        bytes_of = halves.select("doc_key", "start", "bytes", "low", "high")
        level = materialize(_shared(own).join(bytes_of, ["doc_key", "start"]), "shared")
    found = arrays[0]
    for a in arrays[1:]:
        found = found.union(a)
    every = _by_array(found, window)
    for o in out:
        every = every.union(o)
    return every


def remove_repeats(docs: DataFrame, window: int = 100, with_text: bool = False) -> DataFrame:
    """Removes every byte that a repeated window covers: doc_id, n_bytes,
    n_removed, n_spans (maximal removed runs), kept_sha256 (of the remaining
    bytes) and, if asked for, those bytes as ``kept``.

    Texts are taken as UTF-8 bytes; null is empty; one shorter than a window
    loses nothing. Repeated rows (equal doc_id and text) are one document and
    give a row each; rows of one doc_id with different texts come in an order
    fixed by a hash. Other columns aren't read.
    """
    prepare(docs.sparkSession)
    keyed = _keyed(docs)
    spans = repeated_windows(keyed, window).groupBy("doc_key").agg(
        F.collect_list(F.struct("start", (F.col("start") + F.col("n") + window - 1).alias("stop"))).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(raw: bytes, spans: np.ndarray) -> tuple[int, int, bytes]:
        covered = np.zeros(len(raw) + 2, np.int64)
        np.add.at(covered, spans[:, 0] + 1, 1)
        np.add.at(covered, spans[:, 1] + 1, -1)
        gone = np.cumsum(covered) > 0  # place i + 1 stands for byte i
        runs = int((gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone[1:len(raw) + 1]]
        return len(raw) - len(kept), runs, kept.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = []
                for text, own in zip(part.column("text").cast(pa.binary()), part.column("spans"), strict=True):
                    raw = text.as_py()
                    if own.is_valid:
                        pairs = np.stack([own.values.field(i).to_numpy() for i in (0, 1)], 1)
                        removed, n, kept = cut(raw, pairs)
                    else:
                        removed, n, kept = 0, 0, raw
                    out.append((len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept))
                size, removed, n, digest, kept = zip(*out, strict=True)
                columns = [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (size, removed, n)), pa.array(digest)]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return keyed.join(spans, "doc_key", "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
