"""Snapshot documents: flatten, unnest forecasts, keep the latest revision.

The service re-sends the same hour with revised values, so the latest
document per key is chosen by its ``debug.sync`` instant with ``max_by``, never
by ``dropDuplicates`` (which keeps an arbitrary version). ``time.v`` is the
local clock read as if it were UTC; the observation instant comes from
``time.iso``, which carries its offset.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.operators.joins import sized_broadcast
from hazeline.schemas import FLAT_FIELDS, FORECAST_KEYS, IAQI_KEYS, snapshot_schema
from hazeline.session import scratch_path
from hazeline.sources import fs

_OUT = ["aqi", "dominentpol", "obs_local", "sync", *IAQI_KEYS]


def _instant(c):
    """ISO text with offset to an instant; malformed text gives NULL."""
    return F.try_to_timestamp(c)


def flatten(docs: DataFrame) -> DataFrame:
    """One flat row per document: station, observation time (instant from
    ``time.iso``, epoch seconds, and the local text), the raw ``time.v``,
    AQI, dominant pollutant, revision time and the 11 ``iaqi`` values."""
    obs = _instant(F.col("data.time.iso"))
    return docs.select(
        F.col("data.idx").alias("idx"),
        F.col("data.time.s").alias("obs_local"),
        obs.alias("obs_ts"),
        F.unix_seconds(obs).alias("obs_epoch"),
        F.col("data.time.v").alias("time_v"),
        F.col("data.aqi").alias("aqi"),
        F.col("data.dominentpol").alias("dominentpol"),
        F.col("data.debug.sync").alias("sync"),
        # Revision order by instant, not by text: offsets may differ.
        _instant(F.col("data.debug.sync")).alias("sync_ts"),
        *[F.col(f"data.iaqi.{k}.v").alias(k) for k in IAQI_KEYS])


def forecast_unnest(docs: DataFrame) -> DataFrame:
    """One row per (document, pollutant, forecast day): the four arrays are
    unpivoted with ``stack`` and exploded in a single pass."""
    pairs = ", ".join(f"'{k}', data.forecast.daily.{k}" for k in FORECAST_KEYS)
    long = docs.selectExpr("data.idx AS idx", "data.debug.sync AS sync",
                           f"stack({len(FORECAST_KEYS)}, {pairs}) AS (pollutant, days)")
    d = long.select("idx", "sync", "pollutant", F.explode("days").alias("d"))
    return d.select("idx", "sync", "pollutant", F.col("d.day").alias("day"),
                    F.col("d.avg").alias("avg"), F.col("d.min").alias("min"),
                    F.col("d.max").alias("max"))


def _revision(flat: DataFrame) -> Column:
    """Order of revisions: the sync instant, else the observation time, then the
    text and the values themselves, so that one of several always wins, the
    same one in any order of arrival. Never null."""
    sync = F.col("sync_ts") if "sync_ts" in flat.columns else _instant(F.col("sync"))
    seen = F.col("obs_ts") if "obs_ts" in flat.columns else F.try_to_timestamp(F.col("obs_local"))
    cols = [c for c in _OUT if c in flat.columns]
    return F.struct(F.coalesce(sync, seen).alias("at"), F.col("sync"), F.xxhash64(*cols).alias("tie"))


def latest(flat: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    """Latest row per key by revision: one ``max_by`` of a struct, so a key's
    revisions meet in one aggregate (partial per task, no sort)."""
    cols = cols or [c for c in _OUT if c in flat.columns]
    g = flat.groupBy(*keys).agg(F.max_by(F.struct(*cols), _revision(flat)).alias("_l"))
    return g.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in cols])


def rejects(flat: DataFrame) -> DataFrame:
    """How many flat rows have no readable observation time, and no readable
    sync time; the former have no hour and the latter no place of their own in
    the order of revisions."""
    return flat.agg(F.count("*").alias("rows"), F.count_if(F.col("obs_ts").isNull()).alias("no_time"),
                    F.count_if(F.col("sync_ts").isNull()).alias("no_sync"))


#: Names the merged dates that are being put in place, while they are.
_PENDING = "_merging"


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A merged table, its date as text; files that were written before a column
    was known have nulls in it."""
    out = spark.read.option("mergeSchema", "true").parquet(path)
    return out.withColumns({c: F.col(c).cast("string") for c, kind in out.dtypes if kind == "date"})


def _install(spark: SparkSession, path: str, staged: str, date: str) -> None:
    """Puts the staged dates in place of the table's own; may be repeated."""
    rows = spark.read.parquet(staged)
    (rows.hint("rebalance", date).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path))
    fs.publish(spark, f"{path}/{_PENDING}", "", replace=True)


def recover(spark: SparkSession, path: str, date: str = "date") -> bool:
    """Finishes a merge whose driver was lost between the first date taken away
    and the last one written: its rows are all in the staged table. True if there
    was one. Every merge begins with this."""
    staged = fs.read_marker(spark, f"{path}/{_PENDING}")
    if staged:
        _install(spark, path, staged, date)
    return bool(staged)


def _with_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of both, those that df lacks as nulls."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in like.schema.fields if f.name not in df.columns})


def merge_latest(rows: DataFrame, path: str, keys: list[str], date: str = "date") -> None:
    """Merges rows into a table of the latest revision per key, one folder per
    ``date`` (one of the keys): the dates that occur are read, merged and
    written again, others stay. A key that isn't in ``rows`` keeps its row and
    an older revision never replaces a newer one, so the result doesn't depend
    on the order or repetition of merges. A column that only the table or only the
    rows have is kept, null where it wasn't known. A table that can't be read is
    an error, never taken for an empty one.

    The merged dates are written to the shared scratch folder first, and a marker
    names them before the table is touched: if the driver is lost while dates are
    replaced, the next merge puts them in place (:func:`recover`). One merge into
    a table runs at a time."""
    spark = rows.sparkSession
    recover(spark, path, date)
    rows = latest(rows, keys)
    if fs.has_data(spark, path):
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        known = read_merged(spark, path)
        known = known.select(*(F.col(c).cast(kinds.get(c, known.schema[c].dataType)).alias(c) for c in known.columns))
        # A null date has a folder, too.
        dates = rows.select(F.col(date).alias("_date")).distinct()
        known = known.join(sized_broadcast(dates), F.col(date).eqNullSafe(F.col("_date")), "left_semi")
        rows, known = _with_columns(rows, known), _with_columns(known, rows)
        rows = latest(rows.unionByName(known), keys, [c for c in rows.columns if c not in keys])
    staged = scratch_path(spark, "merges", uuid.uuid4().hex)
    rows.write.parquet(staged)  # dealt by date when they are put in place
    fs.publish(spark, f"{path}/{_PENDING}", staged, replace=True)
    _install(spark, path, staged, date)


def write_daily_latest(flat: DataFrame, path: str) -> None:
    """The last revision per (station, local date), one folder per date, merged
    with what is there."""
    merge_latest(flat.withColumn("date", F.substring("obs_local", 1, 10)), path, ["date", "idx"])


def stream_latest(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                  window_seconds: int = 3600, max_files_per_trigger: int | None = None,
                  processing_time: str | None = None):
    """Structured Streaming job: snapshot files arrive in ``source_dir``; each
    micro-batch is reduced to its latest revision per (station, window) and
    merged into the table at ``out_dir``. The table is the state: nothing is
    dropped for being late, whatever the order of files and the size of
    batches, a retried batch changes nothing, and memory holds one batch.
    Documents without a readable observation time have no window and are left
    out (:func:`rejects` counts them). By default it runs until the files
    present now are processed; with ``processing_time`` (e.g. "1 minute") it
    keeps running and the started query is returned."""
    reader = spark.readStream.schema(snapshot_schema(FLAT_FIELDS))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    flat = flatten(reader.json(source_dir)).where(F.col("obs_ts").isNotNull())

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        start = F.col("obs_epoch") - F.pmod("obs_epoch", F.lit(window_seconds))
        rows = batch.withColumn("window_epoch", start)
        rows = rows.withColumn("date", F.date_format(F.timestamp_seconds("window_epoch"), "yyyy-MM-dd"))
        merge_latest(rows, out_dir, ["date", "idx", "window_epoch"])

    w = flat.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    w.trigger(availableNow=True).start().awaitTermination()
    return None


def read_stream_result(spark: SparkSession, out_dir: str) -> DataFrame:
    """The latest revision of every (station, window)."""
    return read_merged(spark, out_dir).select("idx", "window_epoch", *_OUT)
