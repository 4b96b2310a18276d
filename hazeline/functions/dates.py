"""Date keys from reading timestamps and from date strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Input formats of the readings and of the second daily series.
MEASURED_FORMAT = "yyyy-MM-dd HH:mm"
DMY_FORMAT = "dd/MM/yyyy"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_measured(c: Column | str, fmt: str = MEASURED_FORMAT) -> Column:
    """Reading time as TIMESTAMP_NTZ; malformed text gives NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def date_part_strings(c: Column | str) -> dict[str, Column]:
    """The string slices the reference keys on: year, year-month, date,
    month (1-based ``substring``)."""
    c = _c(c)
    return {"y": F.substring(c, 1, 4), "ym": F.substring(c, 1, 7),
            "ymd": F.substring(c, 1, 10), "m": F.substring(c, 6, 2)}


def int_part(c: Column | str, pos: int, length: int) -> Column:
    """Substring cast to INT; malformed text gives NULL."""
    return F.substring(_c(c), pos, length).try_cast("int")


def dmy_to_date(c: Column | str, fmt: str = DMY_FORMAT) -> Column:
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("date")


def dmy_to_iso(c: Column | str, fmt: str = DMY_FORMAT) -> Column:
    """``dd/MM/yyyy`` text to ``yyyy-MM-dd`` text, one built-in per row."""
    return F.date_format(dmy_to_date(c, fmt), "yyyy-MM-dd")


#: Kinds of columns that :func:`ticks` takes.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def ticks(c: Column | str, kind: str) -> Column:
    """A time as a whole number that grows with it: microseconds of a timestamp,
    days of a date, the value of an integer. ``kind`` is the column's type name.
    A timestamp without a zone is taken by its own clock, so the session's zone
    and its clock changes don't matter."""
    c = _c(c)
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind in _WHOLE:
        return c.cast("long")
    raise ValueError(f"no whole number for a column of type {kind}")
