"""Scheduled jobs: daily, weekly, provincial, gw; and one-off ones: backfill, firstcut, migrate.

    spark-submit run.py --mode daily --archive PATH --landing PATH [--as-of TS]

Fetching is not part of the jobs: they read what a fetcher has put on shared storage.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import audit, merge, normalize, quarantine
from ..session import build_session
from ..sinks import tables as sink
from ..sources import files, registry
from . import downloads
from .archive import Archive

log = logging.getLogger(__name__)

# Spans of the export service and the days they stand for (None: everything).
DATE_RANGES = {"Days7": 7, "Days30": 30, "EntirePeriodOfRecord": None}


def with_ledger(archive: Archive, source: str, as_of: datetime, body: Callable[[int], int]) -> int:
    """Run ``body(run_id)`` under the archive's lock. The run is in the ledger as ``running`` from its start, which
    reserves its id, and closed as ``ok`` or ``error``; a run whose driver died stays ``running``."""
    with archive.lock(source):
        run_id = audit.next_id(archive.read("pull_run"), "run_id")
        row = {"run_id": run_id, "source": source, "started_ts": as_of}
        archive.append_row("pull_run", row | {"status": "running"})
        try:
            row |= {"rows_in": body(run_id), "status": "ok"}
        except Exception as error:
            row |= {"status": "error", "error": str(error)}
            raise
        finally:
            archive.append_row("pull_run", row | {"finished_ts": _now()})
    return run_id


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _pull_wsc(archive: Archive, landing: str, as_of: datetime, days: int, source: str,
              run_id: int, raw_root: str | None, multiline: bool) -> int:
    # As with a failed fetch, the run goes on with what could be read.
    pull = archive.stage_split(quarantine.tag_pull(files.geojson_pages(archive.spark, landing, multiline)), "readings",
                               (quarantine.PAGE, quarantine.READING), run_id, as_of)
    _report_quarantine(archive, source, run_id)
    pull = pull.filter(C.parse_wsc_time(F.col("DATETIME")) >= C.days_before(as_of, days))
    pull = _registered(archive, pull)
    if raw_root:
        pull = archive.stage(pull, "pull")
        sink.land_raw(pull.drop(*files.PULL_ORDER), raw_root, source, run_id, as_of.date())
    return _take_wsc(archive, pull, run_id, as_of)


def _registered(archive: Archive, pull: DataFrame) -> DataFrame:
    ids = registry.active_wsc_ids(archive.read("station")).withColumnRenamed("wsc_id", "STATION_NUMBER")
    return pull.join(ids, "STATION_NUMBER", "left_semi")


def _take_wsc(archive: Archive, pull: DataFrame, run_id: int, as_of: datetime) -> int:
    """Readings are parsed and told apart by quantity once, then read three times: for their series, folders and merge."""
    long = archive.stage(normalize.reshape_long(pull).filter(F.col("datetime_utc").isNotNull()), "long")
    archive.add_series(archive.stage(normalize.series_discovery(long, "instant"), "series"))
    return archive.upsert_observations(normalize.wsc_observations(long, run_id, as_of), merge.WSC_UPDATES, files.PULL_ORDER)


def _report_quarantine(archive: Archive, source: str, run_id: int) -> None:
    for r in (archive.read("quarantine").filter(F.col("run_id") == run_id).groupBy("kind", "reason").count().collect()):  # a row a reason
        _report(source, run_id, r["count"], f"{r.kind}: {r.reason}; kept in the quarantine")


def _report(source: str, run_id: int, n: int, what: str) -> None:
    if n:
        log.warning("%s run %s: %s left out, %s", source, run_id, n, what)


def daily(archive: Archive, landing: str, as_of: datetime, raw_root: str | None = None,
          days: int = 3, multiline: bool = True) -> int:
    """Upsert the last days of federal real-time readings."""
    return with_ledger(archive, "wsc-daily", as_of, lambda run_id: _pull_wsc(
        archive, landing, as_of, days, "wsc-daily", run_id, raw_root, multiline))


def weekly(archive: Archive, landing: str, as_of: datetime, raw_root: str | None = None,
           scope: str = "reference", dedupe_open: bool = False, multiline: bool = True) -> int:
    """Re-pull 35 days for late revisions, then record calendar gaps of the last 30 days."""
    def body(run_id: int) -> int:
        n = _pull_wsc(archive, landing, as_of, 35, "wsc-audit", run_id, raw_root, multiline)
        audit_id = audit.next_id(archive.read("audit_log"), "audit_id")
        gaps = audit.gap_scan(archive.read("observation"), archive.read("series"), as_of, scope=scope)
        found = audit.discrepancies(gaps, audit_id, as_of)
        if dedupe_open:
            found = audit.new_only(found, archive.read("audit_discrepancy"))
        found = archive.stage(found, "gaps")
        archive.append("audit_discrepancy", found)
        header = audit.audit_header(archive.read("station"), found).first()
        archive.append_row("audit_log", {
            "audit_id": audit_id, "run_ts": as_of, "scope": "weekly wsc coverage",
            "stations_checked": header.stations_checked, "discrepancies": header.discrepancies,
            "notes": "realtime 30d gap scan"})
        return n
    return with_ledger(archive, "wsc-audit", as_of, body)


def export_readings(archive_spark, landing: str, registry_rows: DataFrame,
                    dataset_pattern: str | None = None, dropped: Observation | None = None) -> DataFrame:
    """Readings of registered datasets with their registry columns.

    Export files are named ``<parameter>.<label>@<moe_id>``, the upstream dataset id.
    """
    options = {"dataset_pattern": dataset_pattern} if dataset_pattern else {}
    lines = files.export_lines(archive_spark, landing, **options)
    return _known(normalize.export_normalise(files.export_rows(lines), dropped), registry_rows)


def _known(readings: DataFrame, registry_rows: DataFrame) -> DataFrame:
    known = registry_rows.select(
        C.bc_source_series_id(F.col("parameter"), F.col("label"), F.col("moe_id")).alias("dataset"),
        "moe_id", "canon")
    return readings.join(known, "dataset")


def _provincial(archive: Archive, landing: str, registry_path: str, as_of: datetime, source: str,
                wells: bool, window: str, raw_root: str | None, dataset_pattern: str | None = None) -> int:
    def body(run_id: int) -> int:
        reg = files.dataset_registry(archive.spark, registry_path)
        options = {"dataset_pattern": dataset_pattern} if dataset_pattern else {}
        lines = archive.stage_split(quarantine.tag_lines(files.tagged_lines(archive.spark, landing, **options)),
                                    "lines", quarantine.LINE, run_id, as_of)
        _report_quarantine(archive, source, run_id)
        readings = files.since(_known(normalize.export_normalise(files.export_rows(lines)), reg), "datetime_utc", as_of, DATE_RANGES[window])
        readings = archive.stage(readings, "export")
        if raw_root:
            sink.land_raw(readings.drop(*files.PULL_ORDER), raw_root, "gw" if wells else "bc", run_id, as_of.date(), "dataset")
        return _take_provincial(archive, readings, reg, wells, run_id, as_of)
    return with_ledger(archive, source, as_of, body)


def _take_provincial(archive: Archive, readings: DataFrame, reg: DataFrame, wells: bool, run_id: int, as_of: datetime) -> int:
    """Sites and series appear in the archive with their first readings."""
    seen = readings.select("moe_id", "canon").distinct()
    present = archive.stage(reg.join(seen, ["moe_id", "canon"], "left_semi"), "registry")
    archive.upsert_stations(normalize.bc_stations(present, "groundwater_well" if wells else None), wells)
    archive.add_series(normalize.bc_series(present))
    return archive.upsert_observations(normalize.bc_observations(readings, run_id, as_of), merge.BC_UPDATES, files.PULL_ORDER)


def replay(archive: Archive, repairs: DataFrame, as_of: datetime, registry_path: str | None = None, wells: bool = False) -> int:
    """Take repaired quarantine rows into the archive and close them.

    ``repairs`` (pulled_from, body, fixed) gives the mended text of a row; see :func:`quarantine.repaired`. What is still
    bad after its repair is quarantined as a row of its own. A replayed reading keeps the time of its pull among readings
    of the same run, and never replaces one that a later run has brought. Export lines need the dataset registry.
    """
    def body(run_id: int) -> int:
        fixed = archive.stage(quarantine.repaired(quarantine.still_open(archive.read("quarantine")), repairs)
                              .withColumn("seen_ts", F.col("changed_ts")), "fixed")
        pages = archive.stage_split(quarantine.tag_pages(quarantine.pages_of(fixed).withColumn("_corrupt", F.col("fixed"))),
                                    "pages", quarantine.PAGE, run_id, as_of)
        pull = files.wide_pull(pages).unionByName(quarantine.readings_of(fixed).select(
            *files.CARRIED, "STATION_NUMBER", "DATETIME", "LEVEL", "DISCHARGE", "LEVEL_SYM", "DISCHARGE_SYM"))
        pull = archive.stage(_registered(archive, archive.stage_split(
            quarantine.tag_readings(pull), "readings", quarantine.READING, run_id, as_of)), "pull")
        long = archive.stage(normalize.reshape_long(pull), "long")
        archive.add_series(normalize.series_discovery(long, "instant"))
        n = _replayed(archive, normalize.wsc_observations(long, run_id, as_of), merge.WSC_UPDATES)
        if registry_path:
            reg = files.dataset_registry(archive.spark, registry_path)
            lines = fixed.filter(F.col("kind") == quarantine.LINE).withColumnRenamed("fixed", "line")
            lines = archive.stage_split(quarantine.tag_lines(lines.select("dataset", *files.CARRIED, "line", F.lit(True).alias("complete"))),
                                        "lines", quarantine.LINE, run_id, as_of)
            readings = archive.stage(_known(normalize.export_normalise(files.export_rows(lines)), reg), "export")
            present = archive.stage(reg.join(readings.select("moe_id", "canon").distinct(), ["moe_id", "canon"], "left_semi"), "registry")
            archive.upsert_stations(normalize.bc_stations(present, "groundwater_well" if wells else None), wells)
            archive.add_series(normalize.bc_series(present))
            n += _replayed(archive, normalize.bc_observations(readings, run_id, as_of), merge.BC_UPDATES)
        done = fixed if registry_path else fixed.filter(F.col("kind") != quarantine.LINE)
        archive.append("quarantine", done.withColumns({"status": F.lit("replayed"), "changed_ts": C.instant(as_of)}))
        return n
    return with_ledger(archive, "replay", as_of, body)


def _replayed(archive: Archive, observations: DataFrame, update: list[str]) -> int:
    newer = quarantine.not_older(archive.stage(observations, "replayed"), archive.read("observation"))
    return archive.upsert_observations(archive.stage(newer, "newer"), update, ["seen_ts", *files.PULL_ORDER])


def provincial(archive: Archive, landing: str, registry_path: str, as_of: datetime,
               window: str = "Days7", raw_root: str | None = None, dataset_pattern: str | None = None) -> int:
    return _provincial(archive, landing, registry_path, as_of, "bc-export", False, window, raw_root, dataset_pattern)


def groundwater(archive: Archive, landing: str, registry_path: str, as_of: datetime,
                window: str = "Days30", raw_root: str | None = None, dataset_pattern: str | None = None) -> int:
    return _provincial(archive, landing, registry_path, as_of, "gw-export", True, window, raw_root, dataset_pattern)


def groundwater_dry_run(spark, landing: str, registry_path: str) -> DataFrame:
    """Rows and range per dataset; nothing is written."""
    reg = files.dataset_registry(spark, registry_path)
    readings = export_readings(spark, landing, reg).withColumn("dataset", F.col("moe_id"))
    return normalize.dry_run_report(reg, readings)


def dry_run_lines(report: DataFrame):
    """The report as text, a dataset a line, and the total of readings and of datasets that have any."""
    total = filled = 0
    for r in report.orderBy("moe_id").toLocalIterator():
        total, filled = total + r.n_rows, filled + (r.n_rows > 0)
        yield f"{r.moe_id:<12} {r.name or '':<42} {r.n_rows:>10} {r.first_ts or '-'} {r.last_ts or '-'}"
    yield f"total {total} readings in {filled} datasets"


def backfill(archive: Archive, flows: DataFrame, levels: DataFrame, as_of: datetime,
             meta: DataFrame | None = None) -> int:
    """Replace the approved daily record of the registered federal stations with a full history extract."""
    def body(run_id: int) -> int:
        if meta is not None:
            archive.write_dimension("station", merge.enrich_stations(archive.read("station"), meta))
        ids = registry.active_wsc_ids(archive.read("station")).withColumnRenamed("wsc_id", "STATION_NUMBER")
        own = [h.join(ids, "STATION_NUMBER", "left_semi") for h in (flows, levels)]
        long = archive.stage(normalize.daily_normalise(own[0], "Q", "m3/s").unionByName(
            normalize.daily_normalise(own[1], "H", "m")), "daily")
        daily_series = F.col("series_uid").like("WSC-%-daily")
        archive.write_dimension("series", merge.replace_slice(
            archive.read("series"), daily_series,
            S.conform(normalize.series_discovery(long, "daily"), S.SERIES)))
        obs = normalize.wsc_observations(long, run_id, as_of, approval="approved")
        return archive.replace_observations((F.col("source") == "wsc") & daily_series, obs, span="daily")
    return with_ledger(archive, "wsc-hydat", as_of, body)


def firstcut(archive: Archive, registry_path: str, landing: str, as_of: datetime,
             multiline: bool = True) -> int:
    """Refresh all federal data from one pull. As in the reference this also drops the daily
    history, so :func:`backfill` comes after it."""
    def body(run_id: int) -> int:
        reg = files.station_registry(archive.spark, registry_path)
        archive.write_dimension("station", merge.replace_slice(
            archive.read("station"), F.col("operator") == "WSC", S.conform(reg, S.STATION)))
        pages = archive.stage_split(quarantine.tag_pages(files.geojson_pages(archive.spark, landing, multiline)),
                                    "pages", quarantine.PAGE, run_id, as_of)
        pull = archive.stage_split(quarantine.tag_readings(files.wide_pull(pages)), "readings", quarantine.READING, run_id, as_of)
        ids = reg.select(F.col("wsc_id").alias("STATION_NUMBER"))
        long = archive.stage(normalize.reshape_long(pull.join(ids, "STATION_NUMBER", "left_semi"))
                     .filter(F.col("datetime_utc").isNotNull()), "pull")
        _report_quarantine(archive, "wsc", run_id)
        archive.write_dimension("series", merge.replace_slice(
            archive.read("series"), F.col("station_uid").like("WSC-%"),
            S.conform(normalize.series_discovery(long, "instant"), S.SERIES)))
        obs = merge.last_of_batch(normalize.wsc_observations(long, run_id, as_of), S.OBSERVATION_KEY, files.PULL_ORDER,
                                  S.OBSERVATION.names)
        return archive.replace_observations(F.col("source") == "wsc", obs)
    return with_ledger(archive, "wsc", as_of, body)


# The columns of an export that must be there; the others are loaded where present.
REQUIRED = {"pull_run": ["run_id", "source", "started_ts"], "station": ["station_uid"],
            "series": ["series_uid", "station_uid", "parameter", "interval"],
            "observation": ["series_uid", "datetime_utc", "source", "pull_run_id"]}


def migrate(source_root: str, archive: Archive, as_of: datetime) -> None:
    """Load exported CSV tables by the names in their headers, parents first; present keys are kept, '' is NULL. Run
    ids allocated later continue after the loaded ones. An absent ``pull_run`` table is left out; an absent required
    column is an error."""
    spark = archive.spark

    def read(name: str, schema) -> DataFrame:
        """Read as text, then cast: the text form of a time is zone-free."""
        text = files.by_name(spark, f"{source_root}/{name}", REQUIRED[name])
        typed = {f.name: f.dataType.typeName() for f in schema.fields}
        return text.select(*(files.zone_free(F.col(c)).alias(c) if typed[c] == "timestamp_ntz" else C.null_if_empty(F.col(c)).alias(c)
                             for c in text.columns if c in typed))

    with archive.lock("migrate"):
        if sink.exists(spark, f"{source_root}/pull_run"):
            runs = S.conform(read("pull_run", S.PULL_RUN), S.PULL_RUN)
            archive.append("pull_run", runs.join(archive.read("pull_run").select("run_id"), "run_id", "left_anti"))
        flat = S.T.StructType([f for f in S.STATION.fields if f.name != "geom"])
        station = S.conform(read("station", flat), flat).withColumn("geom", C.point(F.col("lon"), F.col("lat")))
        archive.write_dimension("station", merge.insert_ignore(
            archive.read("station"), S.conform(station, S.STATION), ["station_uid"]))
        archive.add_series(read("series", S.SERIES))
        staged = S.conform(read("observation", S.STAGED_OBS), S.STAGED_OBS)
        archive.insert_observations(archive.stage(normalize.staged_to_observation(staged, as_of), "migrate"))


def build_station_registry(spark, network: str, out: str, prefix: str = "08NM") -> DataFrame:
    """Write the registry of a sub-basin's stations, from the network's station table, as one CSV for the other jobs."""
    sink.write_csv(registry.build_registry(files.station_network(spark, network), prefix), out, single_file=True)
    return files.station_registry(spark, out)


MODES = ("daily", "weekly", "provincial", "gw", "backfill", "firstcut", "migrate", "replay", "registry", "downloads")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--mode", choices=MODES, default="daily")
    p.add_argument("--archive", help="needed by all modes but registry")
    p.add_argument("--landing", help="landed pages or exports; for migrate the exported tables")
    p.add_argument("--registry", help="station or dataset registry CSV")
    p.add_argument("--flows", help="backfill: daily flows")
    p.add_argument("--levels", help="backfill: daily levels")
    p.add_argument("--stations", help="backfill: station metadata CSV")
    p.add_argument("--regulation", help="backfill: regulation CSV")
    p.add_argument("--network", help="registry: station table of the network")
    p.add_argument("--prefix", default="08NM", help="registry: sub-basin of the stations")
    p.add_argument("--out", help="registry and downloads: where to write")
    p.add_argument("--history-format", choices=("parquet", "csv"), default="parquet", help="backfill: format of the histories")
    p.add_argument("--repairs", help="replay: JSON lines of pulled_from, body, fixed")
    p.add_argument("--break-lock", action="store_true", help="remove the lock of a run that died")
    p.add_argument("--buckets", type=int, default=4, help="buckets of series in a month, for a new archive")
    p.add_argument("--raw-root", help="immutable raw landing; none if absent")
    p.add_argument("--window", choices=list(DATE_RANGES), help="provincial and gw")
    p.add_argument("--as-of", type=datetime.fromisoformat, default=None)
    p.add_argument("--dry-run", action="store_true", help="gw: report, write nothing")
    a = p.parse_args(argv)
    needed = {"backfill": ["flows", "levels"], "migrate": ["landing"], "replay": ["repairs"], "registry": ["network", "out"], "downloads": ["out"], "daily": ["landing"],
              "weekly": ["landing"]}.get(a.mode, ["landing", "registry"])
    needed = needed if a.mode == "registry" else ["archive", *needed]
    missing = [f"--{n}" for n in needed if getattr(a, n) is None]
    if missing:
        p.error(f"--mode {a.mode} needs {', '.join(missing)}")
    if a.dry_run and a.mode != "gw":
        p.error("--dry-run is for --mode gw")

    spark = build_session(f"gaugelake-{a.mode}")
    as_of = a.as_of or _now()
    if a.mode == "gw" and a.dry_run:
        for line in dry_run_lines(groundwater_dry_run(spark, a.landing, a.registry)):
            print(line)
        return
    if a.mode == "registry":
        build_station_registry(spark, a.network, a.out, a.prefix)
        return
    archive = Archive(spark, a.archive, buckets=a.buckets)
    if a.break_lock:
        archive.unlock()
    if a.mode == "daily":
        result = daily(archive, a.landing, as_of, a.raw_root)
    elif a.mode == "weekly":
        result = weekly(archive, a.landing, as_of, a.raw_root)
    elif a.mode == "provincial":
        result = provincial(archive, a.landing, a.registry, as_of, a.window or "Days7", a.raw_root)
    elif a.mode == "gw":
        result = groundwater(archive, a.landing, a.registry, as_of, a.window or "Days30", a.raw_root)
    elif a.mode == "backfill":
        flows, levels = (files.daily_history(spark, path, a.history_format) for path in (a.flows, a.levels))
        meta = None
        if a.stations and a.regulation:
            meta = files.station_metadata(files.station_table(spark, a.stations), files.regulation_table(spark, a.regulation))
        result = backfill(archive, flows, levels, as_of, meta)
    elif a.mode == "downloads":
        result = downloads.write(archive.tables(), a.out, f"{as_of:%Y-%m-%d %H:%M:%S}")
    elif a.mode == "replay":
        repairs = spark.read.schema("pulled_from string, body string, fixed string").json(a.repairs)
        result = replay(archive, repairs, as_of, a.registry)
    elif a.mode == "firstcut":
        result = firstcut(archive, a.registry, a.landing, as_of)
    else:
        result = migrate(a.landing, archive, as_of)
    log.info("mode=%s run_id=%s", a.mode, result)


if __name__ == "__main__":
    main()
