"""Headline benchmark: runs the reference's data tasks re-expressed as
Spark plans, at $BENCH_SF_DIR on local[$BENCH_CPUS], and prints one JSON
line. Every query runs to completion through the ``noop`` sink, so the
whole plan executes and nothing is collected to the driver."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hazeline import pipelines  # noqa: E402
from hazeline.plans.catalog import QUERIES, load_all  # noqa: E402
from hazeline.plans.q_streams import snapshot_dir  # noqa: E402
from hazeline.session import build_session  # noqa: E402
from hazeline.sources import landing  # noqa: E402
from hazeline.sources.adapter import boundaries  # noqa: E402

# The reference's tasks and the registered queries that
# carry their data work, then further operators with real shuffles.
HEADLINE = [
    "station_year_mean", "boundary_join", "month_climatology", "corr_matrix",
    "regression_lines", "regression_residuals", "profile_summary", "district_mean",
    "daily_series_join", "row_aligned_join", "histogram_bins", "snapshot_flatten",
    "snapshot_daily_latest", "stream_snapshot_latest", "csv_sink_roundtrip",
    "year_partitioned_sink", "linear_predict",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # Stage and task times without the UI: Spark's event log, written to
        # BENCH_EVENT_LOG_DIR or a new local folder (the bench runs locally).
        import tempfile
        root = os.environ.get("BENCH_EVENT_LOG_DIR") or tempfile.mkdtemp(prefix="hazeline-events-")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": root}
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app="hazeline-bench", extra=extra)
    load_all()
    # Untimed JVM/JIT warm-up on the smallest tables (its own landing key).
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        run(QUERIES["station_year_mean"](spark, warm))
        run(QUERIES["snapshot_flatten"](spark, warm))

    times: dict[str, float] = {}

    t = time.time()
    landing.land_bronze(spark, sf_dir, force=True)
    landing.land_silver(spark, sf_dir, force=True)
    times["land_readings"] = time.time() - t

    t = time.time()
    snapshot_dir(spark, sf_dir, force=True)
    times["land_snapshots"] = time.time() - t

    # spark_clean: cut-offs over all rows, band written once (gold), then the
    # month-grain and per-year outputs from it.
    t = time.time()
    c = pipelines.clean(landing.silver(spark, sf_dir), landing.fresh(spark, "bench_clean"))
    times["spark_clean"] = time.time() - t
    landing.land_gold(spark, sf_dir)  # what the registered queries read; the same rows

    # geo_map_plot: per-station yearly means joined to boundaries, colour range.
    t = time.time()
    for table in pipelines.map_tables(boundaries(spark, sf_dir), c):
        run(table)
    times["geo_map_plot"] = time.time() - t

    # correlation_plot: month climatology, correlation matrix, three lines.
    t = time.time()
    months = landing.fresh(spark, "bench_months")
    pipelines.month_means(c).write.parquet(months)
    for table in pipelines.correlation_tables(spark.read.parquet(months)).values():
        run(table)
    times["correlation_plot"] = time.time() - t

    for name in HEADLINE:
        t = time.time()
        run(QUERIES[name](spark, sf_dir))
        times[name] = time.time() - t

    total = sum(times.values())
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
