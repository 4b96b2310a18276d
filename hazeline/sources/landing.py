"""Land the readings once as Parquet in the shared scratch folder.

Bronze keeps the raw text (what a CSV scan gives); silver is the ingested,
typed table partitioned by year, so year filters prune files; gold is
silver inside the outlier band (the reference's cleaning task writes its
cleaned output once and the map and correlation tasks read it). All are
written tables: they cut lineage, so a lost executor costs a task retry and
not a recomputation of the joins. A landing is keyed by the input files
(path, length, modification time) and reused while they are unchanged; only
the layers that are asked for are landed.
"""

from __future__ import annotations

import hashlib
import math
import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from hazeline.operators.filters import outlier_band
from hazeline.plans.readings import ingest
from hazeline.schemas import MEASURES
from hazeline.session import scratch_path
from hazeline.sources import adapter, fs
from hazeline.sources.tables import table_path

LANDING_VERSION = "r2"
_READINGS = ["lineitem", "orders", "part", "supplier", "nation", "region"]
_INPUTS = [*_READINGS, "events"]


def _code_version() -> str:
    """Hash of the modules that shape landed and derived data, so a code
    change never reuses files written by older code."""
    import hazeline
    root = os.path.dirname(hazeline.__file__)
    h = hashlib.sha1(LANDING_VERSION.encode())
    for rel in _SHAPING_MODULES:
        with open(os.path.join(root, rel), "rb") as f:
            h.update(f.read())
    return h.hexdigest()[:12]


_SHAPING_MODULES = ["sources/adapter.py", "sources/files.py", "plans/readings.py",
                    "functions/safe.py", "functions/dates.py", "functions/address.py",
                    "operators/filters.py", "operators/quantiles.py", "operators/aggregates.py",
                    "streaming/snapshots.py", "streaming/events.py", "plans/q_streams.py", "pipelines.py", "schemas.py"]


def _key(spark: SparkSession, sf_dir: str, inputs: list[str]) -> str:
    fp = fs.fingerprint(spark, [table_path(sf_dir, t) for t in inputs])
    return hashlib.sha1(f"{_code_version()}|{sf_dir}|{fp}".encode()).hexdigest()[:16]


# One writer at a time per process; between processes the marker decides.
_LOCK = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, name: str, build, force: bool, inputs: list[str]) -> str:
    """Folder of a table that ``build(path)`` writes. Each writer has a folder of
    its own and publishes it by a marker when it is complete, so two drivers
    never write into one folder and a reader never meets half a table."""
    base = scratch_path(spark, "landing", _key(spark, sf_dir, inputs))
    marker = f"{base}/{name}.at"
    with _LOCK:
        at = None if force else fs.read_marker(spark, marker)
        if at is None:
            path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
            build(path)
            fs.publish(spark, marker, path, replace=force)
            at = fs.read_marker(spark, marker) or path
    return at


def land_bronze(spark: SparkSession, sf_dir: str, force: bool = False) -> str:
    """Raw text readings."""
    return _once(spark, sf_dir, "bronze", lambda p: adapter.raw_readings(spark, sf_dir).write.parquet(p), force, _READINGS)


def land_silver(spark: SparkSession, sf_dir: str, force: bool = False) -> str:
    """Typed readings by year. The rows of a year meet before the write, so a task
    doesn't write a file for every year; the hint lets Spark split a large year
    over tasks of the advisory size, so what one task reads doesn't grow with the
    input."""
    def build(path: str) -> None:
        raw = spark.read.parquet(land_bronze(spark, sf_dir))
        ingest(raw).hint("rebalance", "year").write.partitionBy("year").parquet(path)

    return _once(spark, sf_dir, "silver", build, force, _READINGS)


def land_gold(spark: SparkSession, sf_dir: str, force: bool = False) -> str:
    """Readings inside the outlier band, by year; silver's file layout stays."""
    def build(path: str) -> None:
        outlier_band(silver(spark, sf_dir), MEASURES).write.partitionBy("year").parquet(path)

    return _once(spark, sf_dir, "gold", build, force, _READINGS)


# Landed file size to aim for.
TARGET_FILE_BYTES = 1 << 30


def salts_for(output_bytes: int, partitions: int, target: int = TARGET_FILE_BYTES) -> int:
    """Files of each of ``partitions`` folders so that a file of an output of
    that size holds about ``target`` bytes."""
    return max(1, math.ceil(output_bytes / (target * max(1, partitions))))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(land_bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(land_silver(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(land_gold(spark, sf_dir))


def derived(spark: SparkSession, sf_dir: str, name: str, build, force: bool = False) -> str:
    """Path of a table or file set derived from the inputs, written once by
    ``build(path)`` and reused while the inputs are unchanged."""
    return _once(spark, sf_dir, name, build, force, _INPUTS)


def fresh(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one run of a sink (never cleared, never reused)."""
    return scratch_path(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")
