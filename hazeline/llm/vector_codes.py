"""Vector code compression: a code of one codebook entry per part of a vector.

Parts and entries are padded with zeros to a power of two n and go through an
integer Walsh-Hadamard transform. It is orthogonal up to the factor n, so the
squared differences of all n coefficients add up to n times the squared distance,
and any first few of them are a lower bound. In sequency order (by sign changes)
the first coefficients hold most of smooth data, and an entry is out as soon as
its sum exceeds the whole distance of one good entry. No floating point is used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import materialize, prepare
from hazeline.llm.vectors import integer_vectors, matrix

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Pairs of a part and an entry that are held at a time.
PAIRS = 1 << 18


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        halves = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x


def sequency(n: int) -> np.ndarray:
    """Places of the transform's coefficients in order of their sign changes."""
    rows = hadamard(np.eye(n, dtype=np.int64)).T
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def spectra(x: np.ndarray) -> np.ndarray:
    """Coefficients of each row, padded with zeros, in sequency order."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    padded = np.zeros((len(x), n), np.int64)
    padded[:, :x.shape[1]] = x
    return hadamard(padded)[:, sequency(n)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of spectra the nearest entry's number, the least of equally
    near ones, and its squared distance."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = x.shape[1]
    sums = (x[:, :1] - entries[:, 0]) ** 2
    good = entries[sums.argmin(axis=1)]
    bound = ((x - good) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for k in range(1, n):
        sums += (x[row, k] - entries[entry, k]) ** 2
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
    # The good entry itself is left in every row, so no row is without one.
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(sums, starts)
    best = sums == least[row]
    _, first = np.unique(row[best], return_index=True)
    return entry[best][first], least // n


def _assigned(vectors: np.ndarray, codebooks: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
    """(part, rows, entry numbers, distances) for blocks of rows."""
    parts, entries, width = codebooks.shape
    block = max(1, PAIRS // entries)
    for p in range(parts):
        known = spectra(codebooks[p])
        for at in range(0, len(vectors), block):
            rows = slice(at, at + block)
            yield p, rows, *nearest(spectra(vectors[rows, p * width:(p + 1) * width]), known)


def _sums(codebooks: np.ndarray):
    """Each task's component sums and counts by part and entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = codebooks.shape
        total = np.zeros((parts, entries, width), np.int64)
        n = np.zeros((parts, entries), np.int64)
        for batch in batches:
            vectors = matrix(batch.column("v")) if batch.num_rows else np.zeros((0, parts * width), np.int64)
            for p, rows, entry, _ in _assigned(vectors, codebooks):
                np.add.at(total[p], entry, vectors[rows, p * width:(p + 1) * width])
                n[p] += np.bincount(entry, minlength=entries)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_pydict({
            "part": np.repeat(part, width), "entry": np.repeat(entry, width),
            "place": np.tile(np.arange(width), len(part)), "total": total[part, entry].ravel(),
            "n": np.repeat(n[part, entry], width)})
    return run


def start(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks of the parts of the vectors with the least ids; None without any.
    At most ``entries`` rows reach the driver."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    return np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).swapaxes(0, 1).copy()


def refined(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks whose used entries are the floors of their parts' means. Tasks
    send sums, Spark adds them, and a row per component reaches the driver."""
    sums = vectors.select("v").mapInArrow(_sums(codebooks), "part long, entry long, place long, total long, n long")
    out = codebooks.copy()
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    return out


def _codes(codebooks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("v"))
            code = np.zeros((len(vectors), len(codebooks)), np.uint8)
            error = np.zeros(len(vectors), np.int64)
            for p, rows, entry, distance in _assigned(vectors, codebooks):
                code[rows, p] = entry
                error[rows] += distance
            texts = pa.array([row.tobytes().hex() for row in code])
            kept = [batch.column(c) for c in batch.schema.names if c != "v"]
            yield pa.RecordBatch.from_arrays([*kept, texts, pa.array(error)],
                                             names=[*(c for c in batch.schema.names if c != "v"), "code", "error"])
    return run


def digest(codebooks: np.ndarray) -> str:
    """Of all components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray | None]:
    """Codes of the vectors of df (vec_id, embedding, label; others are not looked
    at), and the codebooks (parts, entries, width; at most 256 entries).

    vec_id, label, code, error, label_error: two hex digits for each part, the
    squared distances to the entries summed over the parts, and that error summed
    over all vectors of an equal label, null labels together.

    Rows with a null vector, or one with a null or non-finite component, are
    left out, and so are vectors that can't be cut like the first one: those of
    another length, or of a length that isn't a multiple of ``parts``. Repeated
    rows count and return as often as they occur; a null vec_id comes after all
    others when codebooks start, and equal ids are ordered by vector. With fewer vectors than entries
    the codebooks have fewer entries. An empty table gives an empty table.
    """
    prepare(df.sparkSession)
    cut = integer_vectors(df, "embedding", scale, ["vec_id", "label"])
    cut = materialize(cut.where(F.size("v") % parts == 0), "code-vectors")
    first = cut.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("width")).first()
    kept = cut.where(F.size("v") == (first["width"] if first else 0))
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    codebooks = start(kept, parts, entries)
    if codebooks is None:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error")), None
    for _ in range(rounds):
        codebooks = refined(kept, codebooks)
    coded = materialize(kept.mapInArrow(_codes(codebooks), schema), "codes")
    # Written, so that Spark knows its size and broadcasts it only if it is small.
    by_label = materialize(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "label", "code", "error", "label_error"), codebooks
