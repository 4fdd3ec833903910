"""Headline timings: builds the archive, then runs the reports and merges over it.

Prints one JSON line. ``queries`` holds warm seconds (median of three after a first run),
``cold`` the first run of each, ``jobs`` one run of each source, job and stream, ``rows_per_sec`` the archive rows over the warm seconds for the
three queries the reference publishes timings for.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from gaugelake.session import build_session, scratch_root
from gaugelake.sinks import tables as sink
from gaugelake.suite import driver_tables as D
from gaugelake.suite.queries import QUERIES

HEADLINE = [
    "kpi_overview", "obs_per_day_60d", "coverage", "coverage_timeline", "freshness_by_source", "station_summary",
    "station_map", "recent_runs", "network_audit_status", "network_totals", "approval_by_station", "network_year",
    "station_year_heatmap", "gw_wells", "latest_per_series", "daily_means", "longest_records", "series_gaps",
    "reshape_long", "export_normalise", "upsert_wsc", "upsert_bc", "insert_ignore", "audit_gaps", "audit_compare",
    "dq_duplicate_keys", "dq_orphans", "canonical", "obs_with_corrections", "name_trigram_match",
]
# Sources, jobs and streams write and read files of their own; each is timed once.
JOBS = ["export_file_scan", "geojson_pages", "raw_landing", "migrate_export_columns", "backfill_daily", "daily_job",
        "provincial_job", "stream_upsert", "replace_slice", "rated_discharge", "nearest_station"]
PUBLISHED = {"kpi_overview", "obs_per_day_60d", "coverage"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    def build(make) -> float:
        started = time.perf_counter()
        make(spark, sf_dir)
        return round(time.perf_counter() - started, 3)

    cold = {"archive_build": build(D.archive)}
    warm = {"archive_build": build(D.build)}
    rows = D.archive(spark, sf_dir)["observation"].count()
    for name in HEADLINE:
        cold[name] = round(run(name), 3)
        warm[name] = round(statistics.median(run(name) for _ in range(3)), 3)
    jobs = {name: round(run(name), 3) for name in JOBS}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "jobs": jobs, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "observations": rows, "cpus": int(cpus), "driver_memory": "16g", "shuffle_partitions": int(cpus),
        "rows_per_sec": {name: round(rows / warm[name]) for name in PUBLISHED},
    }))
    sink.delete(spark, scratch_root(spark))
    spark.stop()


if __name__ == "__main__":
    main()
