"""Snapshot queries: documents derived from events
are written as JSON files (one folder per local date), then scanned,
flattened, reduced to the latest revision in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.plans.catalog import register
from hazeline.schemas import FLAT_FIELDS, FORECAST_FIELDS, IAQI_KEYS
from hazeline.sources import adapter, files, fs, landing
from hazeline.plans.q_windows import session_sql, total
from hazeline.sources.tables import table, table_path
from hazeline.streaming import events as ev
from hazeline.streaming import snapshots as snap


#: Bytes of JSON documents for a byte of the compressed events, as measured.
JSON_GROWTH = 82
#: Bytes of documents in one compressed file, which one task reads as a whole.
DOCUMENT_FILE_BYTES = 128 << 20


def snapshot_dir(spark, sf_dir, force: bool = False) -> str:
    def build(p):
        # One file per date (and salt, at scale): the shuffle spreads the
        # document building over tasks whatever the input's file layout. Events
        # are dealt and sorted by date, not the documents made of them.
        days = adapter.snapshot_documents(spark, sf_dir).select("date").distinct().count()
        salts = landing.salts_for(JSON_GROWTH * fs.size(spark, table_path(sf_dir, "events")), days, DOCUMENT_FILE_BYTES)

        def deal(e):
            salt = F.pmod(F.xxhash64("event_id", "ts"), F.lit(salts))
            return e.repartition(max(1, days * salts), F.col("date"), salt).sortWithinPartitions("date")
        (adapter.snapshot_documents(spark, sf_dir, deal).write.option("compression", "gzip")
         .partitionBy("date").json(p))
    return landing.derived(spark, sf_dir, "snapshots_json", build, force)


_K = "CAST(json_extract(props, '$.k') AS INTEGER)"
_EV = f"ev AS (SELECT *, {_K} AS k, date_trunc('hour', ts) AS hr FROM events)"
_IAQI = {"co": "value / 100.0", "no2": "CAST(k AS DOUBLE)", "pm10": "CAST(k AS DOUBLE)",
         "pm25": "value", "t": "CAST(hour(ts) AS DOUBLE)"}
_SYNC = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+09:00'"
_FLAT = ("CAST(user_id AS INTEGER) AS idx, strftime(hr, '%Y-%m-%d %H:%M:%S') AS obs_local, "
         "CAST(floor(value) AS INTEGER) AS aqi, event_type AS dominentpol, "
         f"{_SYNC} AS sync, "
         + ", ".join(f'{_IAQI.get(k, "CAST(NULL AS DOUBLE)")} AS "{k}"' for k in IAQI_KEYS))


@register("snapshot_flatten", f"""WITH {_EV}
SELECT {_FLAT}, CAST(epoch(hr) AS BIGINT) - 32400 AS obs_epoch,
  CAST(epoch(hr) AS BIGINT) AS time_v FROM ev""")
def snapshot_flatten(spark, sf_dir):
    """Nested documents to one flat row per poll."""
    flat = snap.flatten(files.snapshots(spark, snapshot_dir(spark, sf_dir), FLAT_FIELDS))
    return flat.drop("obs_ts", "sync_ts")


@register("forecast_unnest", f"""WITH {_EV},
spans(pollutant, lo, hi) AS (VALUES ('o3', -2, 5), ('pm10', -1, 6), ('pm25', -1, 6), ('uvi', -1, 4)),
d AS (SELECT user_id, ts, k, pollutant, unnest(range(lo, hi)) AS i FROM ev, spans)
SELECT CAST(user_id AS INTEGER) AS idx, {_SYNC} AS sync, pollutant,
  strftime(CAST(ts AS DATE) + CAST(i AS INTEGER), '%Y-%m-%d') AS day, CAST(k + i AS INTEGER) AS avg,
  CAST(k + i - 2 AS INTEGER) AS min, CAST(k + i + 2 AS INTEGER) AS max FROM d""")
def forecast_unnest(spark, sf_dir):
    """One row per (poll, pollutant, forecast day)."""
    return snap.forecast_unnest(files.snapshots(spark, snapshot_dir(spark, sf_dir), FORECAST_FIELDS))


_LATEST_COLS = ["aqi", "dominentpol", "obs_local", "sync", *IAQI_KEYS]


def _argmax(cols_sql: dict) -> str:
    return ", ".join(f'arg_max({v}, ts) AS "{k}"' for k, v in cols_sql.items())


_ARG = {"aqi": "CAST(floor(value) AS INTEGER)", "dominentpol": "event_type",
        "obs_local": "strftime(hr, '%Y-%m-%d %H:%M:%S')", "sync": _SYNC,
        **{k: _IAQI.get(k, "CAST(NULL AS DOUBLE)") for k in IAQI_KEYS}}


@register("snapshot_daily_latest", f"""WITH {_EV}
SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(user_id AS INTEGER) AS idx, {_argmax(_ARG)}
FROM ev GROUP BY 1, 2""")
def snapshot_daily_latest(spark, sf_dir):
    """Last poll per (station, local date) wins, written one folder per date
    with dynamic partition overwrite, and read back."""
    path = landing.fresh(spark, "daily_latest")
    flat = snap.flatten(files.snapshots(spark, snapshot_dir(spark, sf_dir), FLAT_FIELDS))
    snap.write_daily_latest(flat, path)
    back = spark.read.parquet(path)
    return back.select(F.col("date").cast("string").alias("date"), "idx", *_LATEST_COLS)


@register("stream_snapshot_latest", f"""WITH {_EV}
SELECT CAST(user_id AS INTEGER) AS idx, CAST(epoch(hr) AS BIGINT) - 32400 AS window_epoch,
  {_argmax(_ARG)} FROM ev GROUP BY 1, 2""")
def stream_snapshot_latest(spark, sf_dir):
    """The snapshot folder as a file stream: latest revision per (station,
    hour) by sync time, each micro-batch merged into a table by date."""
    run = landing.fresh(spark, "stream_latest")
    snap.stream_latest(spark, snapshot_dir(spark, sf_dir), f"{run}/out", f"{run}/checkpoint")
    return snap.read_stream_result(spark, f"{run}/out")


#: Files arrive in so many steps of time; a tenth of the rows comes a step late.
ARRIVALS = 6
#: Bytes of events in a file, and steps that a stream takes at a time.
EVENT_FILE_BYTES, STEPS_AT_A_TIME = 64 << 20, 4


def _files_a_step(spark, sf_dir) -> int:
    """Files that the events of one step of time are written to."""
    return landing.salts_for(fs.size(spark, table_path(sf_dir, "events")), ARRIVALS, EVENT_FILE_BYTES)


def _event_files(spark, sf_dir) -> tuple[str, int]:
    """Folder of event files, written in order of arrival, and how many seconds
    late a row may come. The last file closes the streams over it."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    first, last = events.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    step = ((last or 0) - (first or 0)) // ARRIVALS + 1

    def build(p):
        late = (F.col("event_id") % 10 == 0).cast("int")
        arrival = F.floor((F.unix_seconds("ts") - F.lit(first or 0)) / step) + late
        for i in range(ARRIVALS + 1):
            events.where(arrival == i).repartition(_files_a_step(spark, sf_dir)).write.mode("append").parquet(p)
        ev.closing(events, "ts", 4 * step + 86_400, by=["event_type"], keys=["user_id"]).write.mode("append").parquet(p)
    return landing.derived(spark, sf_dir, "event_files", build), 2 * step


def _event_stream(spark, sf_dir, path):
    """The event files as a stream; the number of batches doesn't grow with the
    events, as each takes the files of so many steps."""
    schema = spark.read.parquet(path).schema
    some = STEPS_AT_A_TIME * _files_a_step(spark, sf_dir)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", some).parquet(path)


@register("stream_event_sessions", session_sql("user_id", 7200))
def stream_event_sessions(spark, sf_dir):
    """The sessions of each user's events, from event files as a stream with
    late rows."""
    path, late = _event_files(spark, sf_dir)
    run = landing.fresh(spark, "stream_sessions")
    ev.stream_sessions(_event_stream(spark, sf_dir, path), ["user_id"], "ts", 7200, f"{late} seconds", f"{run}/out", f"{run}/checkpoint", total())
    out = spark.read.parquet(f"{run}/out")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@register("stream_view_purchase", """
SELECT v.event_id, v.user_id, v.ts, p.event_id AS purchase_id, p.value AS purchase_value
FROM (FROM events WHERE event_type = 'view') v LEFT JOIN (FROM events WHERE event_type = 'purchase') p
ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 6 HOUR""")
def stream_view_purchase(spark, sf_dir):
    """Views with the purchases of their user within six hours, from two streams;
    views without one come once."""
    path, late = _event_files(spark, sf_dir)
    run = landing.fresh(spark, "stream_match")
    views = _event_stream(spark, sf_dir, path).where("event_type = 'view'").select("event_id", "user_id", "ts")
    bought = _event_stream(spark, sf_dir, path).where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id", "ts", F.col("value").alias("purchase_value"))
    ev.stream_match(views, bought, ["user_id"], "ts", "ts", 6 * 3600, f"{late} seconds", ["purchase_id", "purchase_value"],
                    f"{run}/out", f"{run}/checkpoint")
    out = spark.read.parquet(f"{run}/out").where("event_id is not null")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
