"""DuckDB SQL for the oracle check: the same adapter, ingest and band as
the Spark plans, written independently as SQL common table expressions."""

from __future__ import annotations

from hazeline.schemas import MEASURES, RAW_MEASURES


def mean(c: str) -> str:
    return f'avg("{c}")'


def rounded(expr: str, digits: int = 6) -> str:
    """As ``functions.safe.rounded``: for values of a query's result."""
    return f"round({expr} + 1e-{digits + 3}, {digits}) + 0.0"


def out_means(measures: list[str] = MEASURES, prefix: str = "") -> str:
    return ", ".join(f'{rounded(mean(m))} AS "{prefix}{m}"' for m in measures)


def dbl(c: str) -> str:
    """try_cast to DOUBLE; NaN and infinities are NULL."""
    return f'CASE WHEN isfinite(TRY_CAST("{c}" AS DOUBLE)) THEN TRY_CAST("{c}" AS DOUBLE) END'


STATIONS = """stations AS (
  SELECT s.s_suppkey, s.s_name, s.s_nationkey, s.s_acctbal, n.n_name, r.r_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

RAW = """raw AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS reading_id,
    strftime(l.l_shipdate, '%Y-%m-%d %H:%M') AS "Measurement date",
    CAST(st.s_suppkey AS VARCHAR) AS "Station code",
    CASE WHEN l.l_orderkey % 211 = 5 THEN 'short'
         ELSE concat_ws(', ', CAST(st.s_suppkey AS VARCHAR), st.s_name, st.n_name, st.r_name) END AS "Address",
    CAST(st.s_acctbal AS VARCHAR) AS "Latitude",
    CAST(CAST(st.s_nationkey AS DOUBLE) AS VARCHAR) AS "Longitude",
    CASE WHEN l.l_orderkey % 97 = 1 THEN 'bad' ELSE CAST(l.l_discount AS VARCHAR) END AS "SO2",
    CASE WHEN l.l_orderkey % 89 = 2 THEN NULL ELSE CAST(l.l_tax AS VARCHAR) END AS "NO2",
    CAST(l.l_quantity AS VARCHAR) AS "O3",
    CAST(p.p_retailprice AS VARCHAR) AS "CO",
    CASE WHEN l.l_orderkey % 83 = 3 THEN 'NaN' ELSE CAST(l.l_extendedprice AS VARCHAR) END AS "PM10",
    CAST(o.o_totalprice AS VARCHAR) AS "PM2.5"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN stations st ON l.l_suppkey = st.s_suppkey)"""

_MEASURE_SQL = ",\n    ".join(f'{dbl(r)} AS "{m}"' for r, m in zip(RAW_MEASURES, MEASURES))

SILVER = f"""silver AS (
  SELECT reading_id, ts AS measured_at,
    TRY_CAST("Station code" AS INTEGER) AS station,
    "Address" AS address,
    trim(string_split("Address", ',')[3]) AS district,
    {dbl("Latitude")} AS latitude,
    {dbl("Longitude")} AS longitude,
    {_MEASURE_SQL},
    CAST(month(ts) AS INTEGER) AS month,
    CAST(ts AS DATE) AS day,
    CAST(year(ts) AS INTEGER) AS year
  FROM (SELECT *, try_strptime("Measurement date", '%Y-%m-%d %H:%M') AS ts FROM raw))"""


def cut_cte(measures: list[str] = MEASURES, src: str = "silver", name: str = "cut",
            sigmas: float = 2.0, q: float = 0.25, lower: float = 0.5) -> str:
    parts = []
    for m in measures:
        parts.append(f'quantile_disc("{m}", {q}) * {lower} AS "lo_{m}"')
        parts.append(f'({mean(m)}) + {sigmas} * stddev_samp("{m}") AS "hi_{m}"')
    return f"{name} AS (SELECT " + ",\n  ".join(parts) + f" FROM {src})"


def clean_cte(measures: list[str] = MEASURES, src: str = "silver", cut: str = "cut",
              name: str = "clean") -> str:
    cond = " AND ".join(f'{src}."{m}" >= {cut}."lo_{m}" AND {src}."{m}" < {cut}."hi_{m}"'
                        for m in measures)
    return f"{name} AS (SELECT {src}.* FROM {src}, {cut} WHERE {cond})"


BASE = [STATIONS, RAW, SILVER]
CLEAN = BASE + [cut_cte(), clean_cte()]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def means(measures: list[str] = MEASURES, prefix: str = "") -> str:
    return ", ".join(f'{mean(m)} AS "{prefix}{m}"' for m in measures)
