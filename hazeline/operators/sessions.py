"""Sessions of each key's rows: rows that follow each other within a gap.

The time of the row before comes from a scan over blocks, and so does the number
of sessions so far; a key that holds a third of all rows is never one window or
one sort. A session is then an aggregate, partial in every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.dates import ticks
from hazeline.operators.scans import deal, scan


def numbered(df: DataFrame, keys: list[str], time: str, gap_seconds: int, name: str = "session",
             blocks: int | None = None) -> DataFrame:
    """Adds each row's session among its key's, from 1 (in place of a column of
    that name). A session begins where the key's row before, if any, lies further
    back than the gap (just the gap still joins, as in ``session_window``). Null keys are a key of their own; rows with a null time have
    no session and are left out."""
    at = ticks(f"`{time}`", df.schema[time].dataType.simpleString())
    dealt = deal(df.where(F.col(f"`{time}`").isNotNull()), keys, [time], {"at": at}, blocks)
    placed = scan(dealt, {"prior": ("last", F.col("at"))}, before=True)
    begins = F.col("prior").isNull() | (F.col("at") - F.col("prior") > gap_seconds * 1_000_000)
    placed = scan(placed, {"number": ("count", F.when(begins, F.lit(1)))})
    return placed.select(*(F.col(f"row.`{c}`").alias(c) for c in df.columns if c != name), F.col("number").alias(name))


def sessions(df: DataFrame, keys: list[str], time: str, gap_seconds: int, wanted: dict[str, Column] | None = None,
             blocks: int | None = None) -> DataFrame:
    """One row per session: the keys, session_start, session_end (the last row's
    time and the gap, as ``session_window`` has it), n_rows, and the aggregates
    wanted, told as columns over df."""
    number = "session"
    while number in df.columns:
        number += "_"
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    found = numbered(df, keys, time, gap_seconds, number, blocks).groupBy(*(F.col(f"`{k}`") for k in keys), number).agg(
        F.min(f"`{time}`").alias("session_start"), (F.max(f"`{time}`") + gap).alias("session_end"),
        F.count("*").alias("n_rows"), *(v.alias(n) for n, v in (wanted or {}).items()))
    return found.drop(number)
