"""Small file-system checks through the Hadoop FileSystem of the session,
so the same code works on a local disk, HDFS or an object store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    try:
        fs, p = _fs_path(spark, path)
    except Exception:  # noqa: BLE001 - no JVM gateway (Spark Connect): ask a reader
        try:
            spark.read.text(path).schema  # noqa: B018 - resolves the path only
            return True
        except Exception:  # noqa: BLE001
            return False
    return bool(fs.exists(p))


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Total length, file and folder counts and modification time of each
    input path: one content-summary call per path (no per-file listing on
    the driver, which at millions of files would dominate a query)."""
    parts = []
    for path in paths:
        try:
            fs, p = _fs_path(spark, path)
        except Exception:  # noqa: BLE001 - no JVM gateway: local paths only
            import os
            st = os.stat(path) if os.path.exists(path) else None
            parts.append(f"{path}:{st.st_size}:{st.st_mtime_ns}" if st else f"{path}:missing")
            continue
        if not fs.exists(p):
            parts.append(f"{path}:missing")
            continue
        cs = fs.getContentSummary(p)
        st = fs.getFileStatus(p)
        parts.append(f"{path}:{cs.getLength()}:{cs.getFileCount()}:{cs.getDirectoryCount()}:"
                     f"{st.getModificationTime()}")
    return "|".join(parts)


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a path."""
    fs, p = _fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def has_data(spark: SparkSession, path: str) -> bool:
    """True if a folder holds anything but hidden files (names with _ or .)."""
    fs, p = _fs_path(spark, path)
    return fs.exists(p) and any(not x.getPath().getName().startswith(("_", ".")) for x in fs.listStatus(p))


def publish(spark: SparkSession, marker: str, text: str, replace: bool = False) -> None:
    """Writes a small marker file. Without ``replace`` an existing one stays: of
    several writers the first wins, and all read its text afterwards."""
    fs, p = _fs_path(spark, marker)
    if not replace and fs.exists(p):
        return
    try:
        out = fs.create(p, replace)
    except Exception:  # noqa: BLE001 - another writer came first
        if replace or not fs.exists(p):
            raise
        return
    out.write(bytearray(text.encode()))
    out.close()


def read_marker(spark: SparkSession, marker: str) -> str | None:
    """Text of a marker; None if there is none (or it is still being written)."""
    fs, p = _fs_path(spark, marker)
    if not fs.exists(p) or not fs.getFileStatus(p).getLen():
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder with all that it holds, if it is there."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)
