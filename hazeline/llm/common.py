"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.session import scratch_path
from hazeline.sources import fs

#: Text bytes that a task works on at a time: what a numpy pass holds in memory
#: is a small multiple of this, whatever the size of an Arrow batch.
SLICE_BYTES = 4 << 20
#: Rows of an Arrow batch handed to Python.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Bounds Arrow batches and lets Python workers import this package when
    the driver found it by a path of its own (no effect where it is installed)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage is cut and
    the rows survive a lost executor. Shuffles of finished steps are freed when
    the driver collects the plans that own them, so that is done here rather
    than at some later time. ``compression``: of the files, the session's by default."""
    path = scratch_path(df.sparkSession, "llm", f"{label}-{uuid.uuid4().hex}")
    path = shared(df.sparkSession, path)
    df.write.parquet(path, compression=compression)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes materialized tables that no later step reads."""
    for t in tables:
        fs.remove(t.sparkSession, t.scratch_folder)


def shared(spark: SparkSession, path: str) -> str:
    """A scratch path with the scheme of the checkpoint folder kept."""
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    return "file:" + path if base.startswith("file:") and not path.startswith("file:") else path


def text_of(name: str = "text"):
    """The text column with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(batch: pa.RecordBatch, column: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each of about max_bytes of text or one row."""
    if not batch.num_rows:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated UTF-8 bytes of a string column and its n + 1 offsets
    (from 0), null as empty."""
    filled = pa.compute.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (multiply and xor-shift), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
