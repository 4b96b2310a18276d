"""Event-time streams: sessions, and matches of two streams within a time bound.

Both keep what is still open in the state store and give each result once, when
the watermark has passed it: a session when no row can join it any more, a left
row without a match when none can come. The watermark trails the greatest time
seen by ``lateness``, which has to cover how far files are out of order; rows
within it are taken in any order (a late row may join two sessions), rows beyond
it are dropped by Spark and counted in the query's progress. So state is bounded
by the rows of ``lateness`` and the gap or time bound, not by the stream.

A stream that ends holds back what its watermark hasn't reached. Rows with a time
beyond gap, bound and lateness (see :func:`closing`) end it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def closing(events: DataFrame, time: str, after_seconds: int, by: list[str] = (), keys: list[str] = ()) -> DataFrame:
    """Rows of the schema of a batch of events that carry the watermark past
    everything: null, but for a time ``after_seconds`` behind the last one, the
    ``by`` columns, one row for each combination of these that occurs (so that
    each filtered stream gets one), and ``keys``, any value that occurs (a join
    drops null keys before its watermark). Behind lateness and bound they match
    no row but each other, and no result of theirs alone is ever due."""
    kind = events.schema[time].dataType
    last = events.agg(F.max(f"`{time}`")).first()[0]
    ends = F.lit(last).cast(kind) + F.expr(f"INTERVAL '{after_seconds}' SECOND")
    names = {c: f"_{i}" for i, c in enumerate([*by, *keys])}
    seen = events.groupBy(*(F.col(f"`{c}`").alias(names[c]) for c in by)).agg(
        F.count("*").alias("_n"), *(F.max(f"`{c}`").alias(names[c]) for c in keys))
    return seen.where(F.lit(last is not None)).select(*(
        (ends.cast(kind) if f.name == time else F.col(names[f.name]) if f.name in names
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in events.schema.fields))


def _started(df: DataFrame, out_dir: str, checkpoint_dir: str, processing_time: str | None) -> StreamingQuery:
    """Appends to Parquet files, each result exactly once; until the files present
    now are processed, or for good with a processing time."""
    w = df.writeStream.format("parquet").outputMode("append").option("path", out_dir).option("checkpointLocation", checkpoint_dir)
    q = w.trigger(processingTime=processing_time).start() if processing_time else w.trigger(availableNow=True).start()
    if not processing_time:
        q.awaitTermination()
    return q


def dropped(query: StreamingQuery) -> int:
    """Rows that came later than the watermark allows, over the progress kept."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def stream_sessions(events: DataFrame, keys: list[str], time: str, gap_seconds: int, lateness: str, out_dir: str,
                    checkpoint_dir: str, wanted: dict[str, Column] | None = None,
                    processing_time: str | None = None) -> StreamingQuery:
    """Sessions of a stream of events (a timestamp column ``time``), as
    ``operators.sessions`` makes them of a table: the keys, session_start,
    session_end, n_rows and the aggregates wanted. Rows with a null time have no
    session."""
    marked = events.where(F.col(f"`{time}`").isNotNull()).withWatermark(time, lateness)
    found = marked.groupBy(*(F.col(f"`{k}`") for k in keys), F.session_window(F.col(f"`{time}`"), f"{gap_seconds} seconds").alias("_session"))
    found = found.agg(F.count("*").alias("n_rows"), *(v.alias(n) for n, v in (wanted or {}).items()))
    out = found.select(*(F.col(f"`{k}`") for k in keys), F.col("_session.start").alias("session_start"),
                       F.col("_session.end").alias("session_end"), "n_rows", *(wanted or {}))
    return _started(out, out_dir, checkpoint_dir, processing_time)


def stream_match(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, within_seconds: int,
                 lateness: str, columns: list[str], out_dir: str, checkpoint_dir: str,
                 processing_time: str | None = None) -> StreamingQuery:
    """Each row of the left stream with ``columns`` of every right row of its keys
    from its own time to ``within_seconds`` after it; a left row without any
    comes once, with nulls, when none can come any more. Null keys match nothing.

    Both times are timestamps with a watermark, so Spark keeps a left row until
    its bound has passed and a right row until no left one can ask for it."""
    if clash := set(columns) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    a = left.withWatermark(left_time, lateness)
    names = {c: f"_r{i}" for i, c in enumerate(dict.fromkeys([*on, right_time, *columns]))}
    b = right.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())).withWatermark(names[right_time], lateness)
    t, u = F.col(f"`{left_time}`"), F.col(names[right_time])
    # A literal: Spark reads from it how long rows have to be kept.
    meets = (u >= t) & (u <= t + F.expr(f"INTERVAL '{within_seconds}' SECOND"))
    for c in on:
        meets = meets & (F.col(f"`{c}`") == F.col(names[c]))
    out = a.join(b, meets, "left_outer").select(*(F.col(f"`{c}`") for c in left.columns), *(F.col(names[c]).alias(c) for c in columns))
    return _started(out, out_dir, checkpoint_dir, processing_time)
