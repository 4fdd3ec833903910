"""One entry per report or operator, each run over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import audit, crosswalk, lineage, merge, normalize, quality, quarantine, rollup, search
from ..plans import downloads, jobs, reports
from ..plans.archive import Archive
from ..session import workspace
from ..sinks import tables as sink
from ..sources import files, registry
from ..streaming import legs
from . import driver_tables as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENTS, BC = D.EVENTS_AS_OF, D.BC_AS_OF


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _report(name: str, fn: Callable[[dict[str, DataFrame]], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(D.archive(spark, sf_dir))


def _flat(obs: DataFrame) -> DataFrame:
    """Observations with the flag array as text."""
    return obs.select("series_uid", "datetime_utc", "value", "grade_code", "approval_level",
                      F.array_join("qualifier_flags", ",").alias("qualifier"), "source", "pull_run_id",
                      "ingest_ts")


# --- reports ----------------------------------------------------------------

for _name, _fn in {
    "kpi_overview": lambda t: reports.kpi_overview(t, BC),
    "obs_per_day_60d": lambda t: reports.obs_per_day(t, EVENTS),
    "obs_per_ingest_day": lambda t: reports.obs_per_day(t, "2024-02-15 00:00:00", by="ingest_ts"),
    "coverage": reports.coverage,
    "coverage_by_parameter": reports.coverage_by_parameter,
    "coverage_timeline": reports.coverage_timeline,
    "coverage_firstcut": reports.coverage_firstcut,
    "coverage_interval": reports.coverage_interval,
    "freshness_by_source": lambda t: reports.freshness_by_source(t, EVENTS),
    "daily_record_span": reports.daily_record_span,
    "station_summary": reports.station_summary,
    "station_map": lambda t: reports.station_map(t, BC),
    "recent_runs": reports.recent_runs,
    "recent_audits": reports.recent_audits,
    "network_audit": lambda t: reports.network_audit(t, BC),
    "network_audit_status": lambda t: reports.network_audit_status(t, BC),
    "audit_status_summary": lambda t: reports.audit_status_summary(t, BC),
    "network_totals": lambda t: reports.network_totals(t, BC),
    "approval_by_station": reports.approval_by_station,
    "network_year": reports.network_year,
    "network_year_table": reports.network_year_table,
    "network_year_long": reports.network_year_long,
    "station_year_heatmap": reports.station_year_heatmap,
    "gw_wells": lambda t: reports.gw_wells(t, BC),
    "gw_totals": lambda t: reports.gw_totals(t, BC),
    "gw_map": lambda t: reports.gw_map(t, BC),
    "latest_per_series": reports.latest_per_series,
    "daily_means": reports.daily_means,
    "stations_with_series": reports.stations_with_series,
    "longest_records": reports.longest_records,
    "load_verify": reports.load_verify,
}.items():
    _report(_name, _fn)


# --- sources ----------------------------------------------------------------

def _lineitem_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a wide pull: stage and discharge side by side, one of them missing at times."""
    return D.load(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("STATION_NUMBER"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("DATETIME"),
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("LEVEL"),
        F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")).alias("DISCHARGE"),
        F.col("l_returnflag").alias("LEVEL_SYM"), F.col("l_linestatus").alias("DISCHARGE_SYM"))


@query
def geojson_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of two features each, one with the stage and one with the discharge, written and
    read back. What a feature lacks is absent from the JSON."""
    def feature(level, discharge, level_sym, discharge_sym):
        return F.struct(F.struct("STATION_NUMBER", "DATETIME", level.alias("LEVEL"), discharge.alias("DISCHARGE"),
                                 level_sym.alias("LEVEL_SYMBOL_EN"), discharge_sym.alias("DISCHARGE_SYMBOL_EN"))
                        .alias("properties"))
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    path = workspace(spark, "pages")
    _lineitem_pull(spark, sf_dir).select(F.array(
        feature(F.col("LEVEL"), none, F.col("LEVEL_SYM"), text),
        feature(none, F.col("DISCHARGE"), text, F.col("DISCHARGE_SYM"))).alias("features")).write.json(path)
    return files.wide_pull(files.geojson_pages(spark, path, multiline=False)).drop(*files.PULL_ORDER)


@query
def since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.since(D.load(spark, sf_dir, "events").select("event_id", "ts", "value"), "ts", EVENTS, 3)


def _export_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as export lines, some with an unreadable time or value."""
    supp = F.col("l_suppkey").cast("string")
    rows = D.load(spark, sf_dir, "lineitem").withColumn("canon", F.expr(D.BC_PARAMETER))
    bad_value = F.expr("CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 'bad' "
                       "WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'NaN' "
                       "WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN '' "
                       "ELSE cast(cast(l_quantity as decimal(12,2)) as string) END")
    time = F.expr("CASE WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN 'x' ELSE "
                  "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') || "
                  "CASE WHEN l_linenumber = 5 THEN '.000' ELSE '' END END")
    flag = F.expr("CASE WHEN l_returnflag = 'A' THEN '\"A, partial\"' WHEN l_returnflag = 'R' THEN 'E' ELSE '' END")
    return rows.select(
        F.concat("canon", F.lit(".Working@"), supp).alias("dataset"),
        F.expr("l_orderkey div 1000000").alias("pull"),
        F.concat_ws(",", time, bad_value, F.expr(D.GRADE), F.expr(D.APPROVAL_CODE), flag).alias("line"))


@query
def export_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.export_normalise(files.export_rows(_export_text(spark, sf_dir)))


@query
def export_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export files of each dataset and pull of a million orders with their metadata lines, written and read back.
    Each file also holds a reading whose line equals one of its metadata lines."""
    path = workspace(spark, "exports")
    _write_exports(_export_text(spark, sf_dir), path, 2)
    lines = files.export_lines(spark, path, dataset_pattern=_IN_FOLDER)
    return normalize.export_normalise(files.export_rows(lines)).drop(*files.PULL_ORDER)


_IN_FOLDER = r"dataset=([^/]+)/"
# Tasks move their many files into place themselves; by default the driver does it, one file after another.
_TASKS_COMMIT = ("mapreduce.fileoutputcommitter.algorithm.version", "2")
_LIKE_A_READING = "2000-01-01 00:00:00,1,1,1200,metadata shaped like a row"


def _write_exports(text: DataFrame, path: str, twins: int = 1) -> None:
    """One file per dataset and pull, as upstream gives them; ``twins`` 2 repeats the reading-like line as a reading."""
    body = text.select("dataset", "pull", F.lit(1).alias("part"), "line")
    preamble = [(i - 6, line) for i, line in enumerate([
        "Dataset", "Location", "Unit", _LIKE_A_READING, "Time zone UTC",
        "Timestamp,Value,Grade Code,Approval Level,Qualifiers"])] + [(1, _LIKE_A_READING)] * (twins - 1)
    extra = F.array(*[F.struct(F.lit(part).alias("part"), F.lit(line).alias("line")) for part, line in preamble])
    heads = body.select("dataset", "pull").distinct().select("dataset", "pull", F.explode(extra).alias("p"))
    _land(body.unionByName(heads.select("dataset", "pull", "p.part", "p.line"))
          .repartition("dataset", "pull").sortWithinPartitions("dataset", "pull", "part"), path)


def _land(sorted_lines: DataFrame, path: str) -> None:
    """Rows (dataset, pull, line), those of one file together in one task, to a text file each. On a mounted folder tasks write
    plain files, in the folders that ``partitionBy`` makes: there Hadoop's client starts a process for every folder and every
    file it makes, some 80 ms a file. Elsewhere Spark's writer is used."""
    lines = sorted_lines.select("dataset", "pull", "line")
    folder = sink.mounted(lines.sparkSession, path)
    if folder is None:
        lines.write.mode("append").option(*_TASKS_COMMIT).partitionBy("dataset", "pull").text(path)
        return
    names = F.to_json(F.struct("dataset", F.col("pull").cast("string").alias("pull")), {"ignoreNullFields": "false"})
    (lines.select(names.alias("names"), F.coalesce("line", F.lit("")).alias("line"))
     .mapInArrow(sink.text_file_per_run(folder), "files long").write.format("noop").mode("append").save())


@query
def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a daily-history extract in CSV, read back for the federal stations."""
    stations = registry.active_wsc_ids(D.archive(spark, sf_dir)["station"]).withColumnRenamed("wsc_id", "STATION_NUMBER")
    path = workspace(spark, "history")
    _order_history(spark, sf_dir).write.option("header", True).option("nullValue", "NA").csv(path)
    return files.daily_history(spark, path, "csv", stations)


def _order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.load(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("STATION_NUMBER"), F.to_date("o_orderdate").alias("Date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("Value"),
        F.col("o_orderstatus").alias("Symbol"))


@query
def station_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station and regulation tables written as CSV with their columns in another order, read back and joined."""
    stations, regulation = _customer_tables(spark, sf_dir)
    paths = [workspace(spark, name) for name in ("stations", "regulation")]
    for table, path in zip((stations, regulation), paths):
        table.select(*reversed(table.columns)).write.option("header", True).option("nullValue", "NA").csv(path)
    return files.station_metadata(files.station_table(spark, paths[0]), files.regulation_table(spark, paths[1]))


def _customer_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.station_metadata(*_customer_tables(spark, sf_dir))


def _customer_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = D.load(spark, sf_dir, "customer")
    number = F.col("c_custkey").cast("string").alias("STATION_NUMBER")
    key = F.col("c_custkey")
    stations = customer.select(
        number, F.col("c_acctbal").alias("DRAINAGE_AREA_GROSS"),
        F.when(key % 3 != 0, F.lit(49.0) + (key % 50) / 50.0).alias("LATITUDE"),
        F.when(key % 3 != 0, F.lit(-119.0) - (key % 50) / 50.0).alias("LONGITUDE"))
    regulation = (customer.filter("c_mktsegment <> 'HOUSEHOLD'")
                  .select(number, (F.col("c_mktsegment") == "MACHINERY").alias("REGULATED")))
    return stations, regulation


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's three datasets as registry rows."""
    parameter = F.explode(F.array(F.lit("H"), F.lit("Q"), F.lit("GW"))).alias("parameter")
    rows = D.load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", parameter)
    return rows.select(
        F.col("s_suppkey").cast("string").alias("moe_id"), F.col("s_name").alias("name"),
        (F.lit(49.0) + (F.col("s_suppkey") % 100) / 100.0).alias("lat"), F.lit(-119.5).alias("lon"), "parameter",
        F.lit("Working").alias("label"), F.lit(1).alias("unit_id"), F.col("parameter").alias("canon"),
        F.when(F.col("parameter") == "Q", "m3/s").otherwise("m").alias("units"))


def _registry_file(spark: SparkSession, sf_dir: str) -> str:
    """The registry as a CSV with its columns in another order."""
    path = workspace(spark, "registry")
    rows = _registry(spark, sf_dir)
    rows.select(*reversed(rows.columns)).write.option("header", True).option("nullValue", "NA").csv(path)
    return path


@query
def dataset_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.dataset_registry(spark, _registry_file(spark, sf_dir))


@query
def station_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built registry written as CSV by the registry job's sink and read back by name."""
    path = workspace(spark, "station-registry")
    sink.write_csv(registry_build(spark, sf_dir), path, single_file=True)
    return files.station_registry(spark, path)


@query
def staged_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations exported to CSV, read back by name and typed."""
    root = workspace(spark, "staged")
    sink.export_tables({"observation": D.archive(spark, sf_dir)["observation"].drop("ym")}, root)
    return _flat(normalize.staged_to_observation(files.staged_observations(spark, f"{root}/observation"), D.INGEST_TS))


@query
def registry_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.build_registry(_network(spark, sf_dir), prefix="MACH")


def _network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.load(spark, sf_dir, "customer").select(
        F.concat("c_mktsegment", F.lit("-"), F.col("c_custkey").cast("string")).alias("STATION_NUMBER"),
        F.col("c_name").alias("STATION_NAME"), F.lit(49.5).alias("LATITUDE"),
        F.col("c_acctbal").alias("LONGITUDE"))


@query
def active_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.active_wsc_ids(D.archive(spark, sf_dir)["station"])


@query
def dry_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers registered; those without readings report 0."""
    reg = D.load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("moe_id"), F.col("s_name").alias("name"))
    readings = D.bc_leg(spark, sf_dir).select(
        F.substring_index("source_series_id", "@", -1).alias("dataset"), "datetime_utc")
    return normalize.dry_run_report(reg, readings)


# --- projections ------------------------------------------------------------

@query
def reshape_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.reshape_long(_lineitem_pull(spark, sf_dir))


@query
def series_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.series_discovery(normalize.reshape_long(_lineitem_pull(spark, sf_dir)), "instant")


@query
def daily_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.daily_normalise(_order_history(spark, sf_dir), "Q", "m3/s")


@query
def qualifier_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = C.qualifier_array(F.col("qflag"))
    return D.wsc_leg(spark, sf_dir).select(
        F.col("pull_run_id").alias("event_id"), F.coalesce(F.size(flags), F.lit(0)).alias("n_flags"),
        flags[0].alias("flag"))


@query
def station_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.archive(spark, sf_dir)["station"].select(
        "station_uid", F.col("geom").isNotNull().alias("has_point"), F.col("geom.lon").alias("lon"),
        F.col("geom.lat").alias("lat"))


@query
def freshness_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series' age in hours and days with all bucket labels; series with no readings since
    the as-of day show a negative age, the youngest bucket."""
    latest = D.archive(spark, sf_dir)["observation"].groupBy("series_uid").agg(F.max("datetime_utc").alias("latest"))
    hours, days = C.hours_old(EVENTS, F.col("latest")), C.days_stale(EVENTS, F.col("latest"))
    return latest.select(
        "series_uid", F.round(hours, 1).alias("hours"), days.alias("days"),
        C.freshness_colour(hours).alias("colour"), C.well_colour(days).alias("well_colour"),
        C.audit_freshness(days).alias("audit_freshness"))


@query
def series_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.reading_gaps(D.archive(spark, sf_dir)["observation"])


# --- merges -----------------------------------------------------------------

@query
def archive_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(D.archive(spark, sf_dir)["observation"])


@query
def archive_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.archive(spark, sf_dir)["series"].select(
        "series_uid", "station_uid", "parameter", "units", "interval", "source_series_id")


def _wsc_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The archive before the last pull, and that pull: two days seen before, revised, and new ones."""
    rows = D.as_observations(D.wsc_leg(spark, sf_dir))
    ts = F.col("datetime_utc")
    pull = rows.filter(ts >= C.instant("2024-01-28")).withColumns({
        "value": F.col("value") + 0.5,
        "qualifier_flags": F.array(F.lit("R")),
        "pull_run_id": F.col("pull_run_id") + 1000000000,
        "ingest_ts": C.instant(EVENTS)})
    return rows.filter(ts < C.instant("2024-01-30")), pull


@query
def upsert_wsc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(merge.upsert_wsc(*_wsc_batches(spark, sf_dir)))


def _bc_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Approved readings as the archive, all others as the incoming batch with repeated keys."""
    rows = D.as_observations(D.bc_leg(spark, sf_dir), "ord_line", "ord_part", "ord_price")
    columns = [f.name for f in S.OBSERVATION.fields]
    approved = F.col("approval_level") == "approved"
    return (merge.last_of_batch(rows.filter(approved), S.OBSERVATION_KEY, D.ORDER, columns),
            rows.filter(~approved))


@query
def upsert_bc(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, incoming = _bc_batches(spark, sf_dir)
    return _flat(merge.upsert_bc(target, incoming, order_by=D.ORDER))


@query
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, incoming = _bc_batches(spark, sf_dir)
    return _flat(merge.insert_ignore(target, incoming, S.OBSERVATION_KEY, D.ORDER))


@query
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, incoming = _bc_batches(spark, sf_dir)
    return merge.merge_counts(target, incoming, S.OBSERVATION_KEY)


@query
def batch_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.batch_duplicates(D.bc_leg(spark, sf_dir), S.OBSERVATION_KEY)


@query
def station_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations renamed and moved by a registry of wells; operator, status and basin stay."""
    station = D.archive(spark, sf_dir)["station"]
    reg = D.load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("moe_id"), F.concat(F.lit("WELL "), "s_name").alias("name"),
        F.lit(50.0).alias("lat"), F.when(F.col("s_suppkey") % 2 == 0, -119.5).alias("lon"))
    out = merge.upsert_station(station, normalize.bc_stations(reg, "groundwater_well"), wells=True)
    return out.select("station_uid", "bc_aquarius_loc_id", "name", "operator", "station_type", "lat", "lon",
                      F.col("geom.lon").alias("geom_lon"), "drainage_area_km2", "basin")


@query
def station_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merge.enrich_stations(D.archive(spark, sf_dir)["station"], _customer_meta(spark, sf_dir))
    return out.select("station_uid", "drainage_area_km2", "regulation_status", "lat", "lon")


@query
def replace_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily history replaced by a new extract; rows the predicate cannot judge stay."""
    obs = D.archive(spark, sf_dir)["observation"].drop("ym")
    long = normalize.daily_normalise(_order_history(spark, sf_dir), "H", "m")
    new = normalize.wsc_observations(long, 7, EVENTS, approval="approved")
    return _flat(merge.replace_slice(
        obs, (F.col("source") == "wsc") & F.col("series_uid").like("WSC-%-daily"), new))


@query
def slice_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a grade of 151 replaced by nothing: rows without a grade stay."""
    obs = D.archive(spark, sf_dir)["observation"].drop("ym")
    return _flat(merge.replace_slice(obs, F.col("grade_code") == "151", obs.filter(F.lit(False))))


# --- audit ------------------------------------------------------------------

def _gaps(spark: SparkSession, sf_dir: str, scope: str) -> DataFrame:
    t = D.archive(spark, sf_dir)
    return audit.gap_scan(t["observation"], t["series"], EVENTS, scope=scope)


@query
def audit_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gaps(spark, sf_dir, "reference")


@query
def audit_gaps_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gaps(spark, sf_dir, "source")


@query
def audit_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_header(D.archive(spark, sf_dir)["station"], _gaps(spark, sf_dir, "reference"))


@query
def audit_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from shipped lines against those from open lines, as two archives."""
    rows = D.as_observations(D.bc_leg(spark, sf_dir), "ord_line", "ord_part", "ord_price")
    columns = [f.name for f in S.OBSERVATION.fields]
    approved = F.col("approval_level") == "approved"
    ours, theirs = (merge.last_of_batch(rows.filter(side), S.OBSERVATION_KEY, D.ORDER, columns)
                    for side in (approved, ~approved))
    return audit.compare(ours, theirs)


@query
def open_discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.open_discrepancies(D.archive(spark, sf_dir)["audit_discrepancy"])
    return found.select("audit_id", "series_uid", "datetime_utc", "kind", "ours")


# --- constraints ------------------------------------------------------------

def _with_faults(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The archive's tables with the unmerged readings as observations, so that rules break."""
    t = dict(D.archive(spark, sf_dir))
    t["observation"] = D.as_observations(D.bc_leg(spark, sf_dir))
    t["series"] = t["series"].withColumn(
        "parameter", F.when(F.col("parameter") == "OTHER", "TURB").otherwise(F.col("parameter"))).withColumn(
        "units", F.nullif("units", F.lit("n/a")))
    return t


@query
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_duplicate_keys(_with_faults(spark, sf_dir))


@query
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_orphans(D.archive(spark, sf_dir))


@query
def dq_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain_violations(_with_faults(spark, sf_dir))


@query
def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_with_faults(spark, sf_dir))


# --- sinks and jobs ---------------------------------------------------------

@query
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pull as landed, read back."""
    root = workspace(spark, "raw")
    on = datetime(2024, 1, 31).date()
    pull = _lineitem_pull(spark, sf_dir)
    if not sink.land_raw(pull, root, "wsc-daily", 1, on):
        raise OSError("raw landing failed")
    return (spark.read.schema(S.WIDE_PULL).option("header", True).option("nullValue", "NA")
            .csv(f"{root}/wsc-daily/2024/01/31/wsc-daily-run1.csv"))


@query
def csv_download(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The network audit as a CSV download, read back."""
    path = workspace(spark, "download")
    report = reports.network_audit_status(D.archive(spark, sf_dir), BC)
    sink.write_csv(report, path, single_file=True)
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query
def migrate_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables exported to CSV, loaded into a new archive, observations read back."""
    t = D.archive(spark, sf_dir)
    root = workspace(spark, "export")
    sink.export_tables({"observation": t["observation"].drop("ym"), "series": t["series"],
                        "station": t["station"], "pull_run": t["pull_run"]}, root)
    copy = Archive(spark, workspace(spark, "migrated"))
    jobs.migrate(root, copy, D.INGEST_TS)
    return _flat(copy.read("observation"))


@query
def migrate_export_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the upstream export's own columns, times with an offset and '' for NULL, loaded by name."""
    t = D.archive(spark, sf_dir)
    root = workspace(spark, "export-columns")
    station = ["station_uid", "wsc_id", "bc_aquarius_loc_id", "ona_id", "name", "operator", "status", "lat", "lon",
               "drainage_area_km2", "regulation_status", "basin", "telemetry_type", "station_type"]
    sink.write_csv(t["station"].select(station), f"{root}/station")
    sink.write_csv(t["series"].select("series_uid", "station_uid", "parameter", "units", "interval", "source_series_id"), f"{root}/series")
    sink.write_csv(t["observation"].select(
        "series_uid", F.concat(F.col("datetime_utc").cast("string"), F.lit("+00")).alias("datetime_utc"), "value",
        F.coalesce("grade_code", F.lit("")).alias("grade_code"), F.coalesce("approval_level", F.lit("")).alias("approval_level"),
        F.coalesce(F.array_join("qualifier_flags", ","), F.lit("")).alias("qualifier_flags"), "source", "pull_run_id"),
        f"{root}/observation")
    copy = Archive(spark, workspace(spark, "migrated-columns"))
    jobs.migrate(root, copy, D.INGEST_TS)
    loaded = copy.tables()
    return (_flat(loaded["observation"]).join(loaded["series"].select("series_uid", "station_uid", "parameter"), "series_uid")
            .join(loaded["station"].select("station_uid", "name", "basin", F.col("geom.lon").alias("lon")), "station_uid"))


def _store(spark: SparkSession, sf_dir: str, name: str, *tables: str) -> Archive:
    """A new archive holding copies of the given tables."""
    t = D.archive(spark, sf_dir) if "observation" in tables else D.dimensions(spark, sf_dir)
    store = Archive(spark, workspace(spark, name), buckets=2)
    for table in tables:
        if table == "observation":
            store.write_observations(t[table].drop("ym"))
        else:
            store.write_dimension(table, t[table])
    return store


@query
def backfill_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill job over an archive of instant readings, with flows and levels: coverage afterwards. Customers that
    are no stations have histories as well; theirs are not taken."""
    store = _store(spark, sf_dir, "backfill", "station", "series", "observation")
    history = _order_history(spark, sf_dir)
    # Repeated days of a station would break the key; the last status and value stand for the day.
    history = merge.last_of_batch(history, ["STATION_NUMBER", "Date"], ["Symbol"], history.columns)
    levels = history.withColumn("Value", F.when(F.col("Symbol") == "F", F.col("Value") / 2))
    jobs.backfill(store, history, levels, datetime(2024, 1, 31), _customer_meta(spark, sf_dir))
    return reports.coverage(store.tables())


_changed_stores: dict[tuple[str, str], Archive] = {}


def _changed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables of an archive that has seen every kind of write, with its stored partial counts. Readings of grade 151 give way
    to every third of them, 40 days later and approved; federal instant readings come again ten years later, twice; even
    pulls of provincial readings are revised to reviewed."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _changed_stores or not sink.exists(spark, _changed_stores[key].path("observation")):
        t = D.archive(spark, sf_dir)
        store, obs = _store(spark, sf_dir, "changed", "station", "series", "observation"), t["observation"].drop("ym")
        third = obs.filter("grade_code = '151' AND pull_run_id % 3 = 0").withColumns({
            "datetime_utc": F.expr("datetime_utc + INTERVAL 40 DAYS"), "approval_level": F.lit("approved"), "grade_code": F.lit("31")})
        # The key is one reading: where a later one is there already, or two meet, one stays.
        third = store.stage(third.join(obs.filter("grade_code IS NULL OR grade_code <> '151'"), S.OBSERVATION_KEY, "left_anti"), "third")
        store.replace_observations(F.col("grade_code") == "151", third)
        later = obs.filter("source = 'wsc' AND series_uid NOT LIKE '%-daily'").withColumn("datetime_utc", F.expr("datetime_utc + INTERVAL 10 YEARS"))
        later = store.stage(merge.last_of_batch(later, S.OBSERVATION_KEY, ["pull_run_id", "value"], S.OBSERVATION.names), "later")
        store.insert_observations(later)
        store.insert_observations(later)
        revised = store.read("observation").filter("source = 'bc' AND pull_run_id % 2 = 0").withColumn("approval_level", F.lit("reviewed"))
        store.upsert_observations(store.stage(S.conform(revised, S.OBSERVATION), "revised"), merge.BC_UPDATES)
        store.clear_scratch()
        _changed_stores[key] = store
    return {**D.archive(spark, sf_dir), **_changed_stores[key].tables(), **{
        name: D.archive(spark, sf_dir)[name] for name in ("pull_run", "audit_log", "audit_discrepancy")}}


@query
def partial_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts per series, source, approval level and month after changes of every kind; folders are not opened."""
    return _changed(spark, sf_dir)["partial"].groupBy("series_uid", "source", "approval_level", "ym").agg(
        F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


@query
def partial_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage from stored counts, after changes of every kind."""
    return reports.coverage(_changed(spark, sf_dir))


@query
def partial_approval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per provincial station and approval level, from stored counts."""
    return reports.approval_by_station(_changed(spark, sf_dir))


@query
def partial_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overview's figures, from stored counts."""
    return reports.kpi_overview(_changed(spark, sf_dir), BC)


def _event_pages(spark: SparkSession, sf_dir: str, path: str, revised: bool) -> None:
    """One reading per user, quantity and second as landed pages; a revised pull lowers the stages."""
    view = F.col("event_type") == "view"
    readings = (D.load(spark, sf_dir, "events")
                .groupBy("user_id", view.alias("view"), F.date_trunc("second", "ts").alias("t")).agg(F.max("value").alias("value")))
    value = F.col("value") - F.lit(1.0 if revised else 0.0)
    feature = F.struct(F.struct(
        F.col("user_id").cast("string").alias("STATION_NUMBER"),
        F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("DATETIME"),
        F.when(F.col("view"), value).alias("LEVEL"),
        F.when(~F.col("view"), F.col("value")).alias("DISCHARGE"),
        F.lit("E").alias("LEVEL_SYMBOL_EN"), F.lit("").alias("DISCHARGE_SYMBOL_EN")).alias("properties"))
    readings.select(F.array(feature).alias("features")).write.mode("append").json(path)


def _daily(spark: SparkSession, sf_dir: str) -> Archive:
    store = _store(spark, sf_dir, "daily", "station")
    path = workspace(spark, "pages")
    for revised in (False, True):
        _event_pages(spark, sf_dir, path, revised)
        jobs.daily(store, path, datetime(2024, 1, 31), days=35, multiline=False)
    return store


@query
def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the daily job over a landing that keeps both pulls: the later pull's readings, lower ones too."""
    return _flat(_daily(spark, sf_dir).read("observation")).drop("pull_run_id")


@query
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that ended well, that failed, and one whose driver died, over one archive."""
    store = _daily(spark, sf_dir)
    try:
        jobs.daily(store, workspace(spark, "nothing-landed"), datetime(2024, 2, 1))
    except Exception:  # noqa: BLE001 - the ledger has it
        pass
    store.append_row("pull_run", {"run_id": 4, "source": "wsc-daily", "started_ts": datetime(2024, 2, 2), "status": "running"})
    return store.read("pull_run").select("run_id", "source", "started_ts", "rows_in", "status",
                                         F.col("finished_ts").isNotNull().alias("finished"), F.col("error").isNotNull().alias("failed"))


@query
def weekly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 35-day re-pull with its audit: open findings per series."""
    store = _store(spark, sf_dir, "weekly", "station")
    path = workspace(spark, "weekly-pages")
    _event_pages(spark, sf_dir, path, False)
    jobs.weekly(store, path, datetime(2024, 1, 31), multiline=False)
    return store.read("audit_discrepancy").groupBy("series_uid", "kind").agg(F.count("*").alias("n"))


@query
def empty_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily run long after the last reading takes nothing and changes nothing."""
    store = _store(spark, sf_dir, "empty", "station", "observation")
    path = workspace(spark, "old-pages")
    _event_pages(spark, sf_dir, path, False)
    jobs.daily(store, path, datetime(2025, 1, 1), multiline=False)
    return store.read("observation").groupBy("source").agg(F.count("*").alias("n"), F.max("ingest_ts").alias("ingest_ts"))


@query
def firstcut_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All federal readings replaced by one landing; provincial ones stay."""
    store = _store(spark, sf_dir, "firstcut", "station", "series", "observation")
    path, reg = workspace(spark, "first-pages"), workspace(spark, "first-registry")
    _event_pages(spark, sf_dir, path, False)
    stations = store.read("station").filter("operator = 'WSC'")
    sink.write_csv(stations.select(*(c for c in S.STATION_REGISTRY.names)), reg)
    jobs.firstcut(store, reg, path, datetime(2024, 1, 31), multiline=False)
    return reports.coverage(store.tables())


def _provincial_text(spark: SparkSession, sf_dir: str, revised: bool) -> DataFrame:
    """One line per dataset and time: the greatest quantity, or in the later pull a quarter of it as working."""
    rows = D.load(spark, sf_dir, "lineitem").withColumn("canon", F.expr(D.BC_PARAMETER))
    readings = rows.groupBy("l_suppkey", "canon", "l_shipdate").agg(F.max("l_quantity").alias("q"))
    hour = F.expr("timestampadd(HOUR, cast(l_suppkey % 24 as int), l_shipdate)")
    value = (F.col("q") / F.lit(4 if revised else 1)).cast("decimal(12,2)").cast("string")
    return readings.select(
        F.concat("canon", F.lit(".Working@"), F.col("l_suppkey").cast("string")).alias("dataset"),
        F.lit(2 if revised else 1).alias("pull"),
        F.concat_ws(",", F.date_format(hour, "yyyy-MM-dd HH:mm:ss"), value, F.lit("31"), F.lit("800" if revised else "1200"), F.lit("")).alias("line"))


@query
def provincial_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pulls of surface and well exports kept side by side: the later pull's value, grade and approval."""
    store = Archive(spark, workspace(spark, "provincial"), buckets=2)
    reg, path = _registry_file(spark, sf_dir), workspace(spark, "provincial-exports")
    for revised in (False, True):
        _write_exports(_provincial_text(spark, sf_dir, revised), path)
        jobs.provincial(store, path, reg, datetime(2001, 11, 6), "EntirePeriodOfRecord", dataset_pattern=_IN_FOLDER)
    return _flat(store.read("observation")).select("series_uid", "datetime_utc", "value", "grade_code", "approval_level", "pull_run_id")


# --- streams ----------------------------------------------------------------

class _Landing:
    """A landing folder filled pull by pull, with a stream run after each."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path, self.out, self.checkpoint = (workspace(spark, f"{name}-{d}") for d in ("in", "out", "state"))

    def run(self, pulls: list[DataFrame], leg: Callable[[DataFrame], None]) -> None:
        for pull in pulls:
            S.conform(pull, S.OBSERVATION).write.mode("append").parquet(self.path)
            leg(legs.landed(self.spark, self.path))

    def rows(self) -> DataFrame:
        return self.spark.read.schema(S.OBSERVATION).parquet(self.path)

    def result(self, schema=S.OBSERVATION) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.out)


def _events_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.as_observations(D.wsc_leg(spark, sf_dir))


def _two_pulls(spark: SparkSession, sf_dir: str, overlap_days: int = 0) -> list[DataFrame]:
    """Readings up to the middle of the month, then from (overlapping) there on."""
    rows, cut = _events_obs(spark, sf_dir), "2024-01-16 00:00:00"
    ts = F.col("datetime_utc")
    return [rows.filter(ts < C.instant(cut)), rows.filter(ts >= C.days_before(cut, overlap_days))]


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _Landing(spark, "ingest")
    landing.run(_two_pulls(spark, sf_dir), lambda rows: legs.ingest(rows, landing.out, landing.checkpoint))
    return _flat(landing.result())


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _Landing(spark, "upsert")
    store = Archive(spark, workspace(spark, "stream-archive"))
    landing.run(list(_wsc_batches(spark, sf_dir)),
                lambda rows: legs.upsert(rows, store, merge.WSC_UPDATES, landing.checkpoint))
    return _flat(store.read("observation"))


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pulls that overlap by two days: each reading once."""
    landing = _Landing(spark, "dedupe")
    landing.run(_two_pulls(spark, sf_dir, overlap_days=2),
                lambda rows: legs.dedupe(rows, landing.out, landing.checkpoint))
    return _flat(landing.result())


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter's readings all land after the others: those older than the watermark are late."""
    landing = _Landing(spark, "late")
    rows = _events_obs(spark, sf_dir)
    other = F.col("series_uid").like("%-OTHER-instant")
    landing.run([rows.filter(~other), rows.filter(other)],
                lambda r: legs.dedupe(r, landing.out, landing.checkpoint))
    return _flat(legs.late_rows(landing.rows(), landing.result()))


@query
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _Landing(spark, "counts")
    landing.run(_two_pulls(spark, sf_dir), lambda rows: legs.daily_counts(rows, landing.out, landing.checkpoint))
    return legs.current_daily_counts(spark, landing.out)


@query
def stream_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _Landing(spark, "outages")
    landing.run(_two_pulls(spark, sf_dir), lambda rows: legs.sessions(rows, landing.out, landing.checkpoint))
    return legs.outages(landing.result("series_uid string, start_ts timestamp_ntz, last_ts timestamp_ntz, n long"))


# --- declared look-ups and lineage ------------------------------------------

@query
def name_trigram_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = D.load(spark, sf_dir, "part").select("p_partkey", "p_name")
    found = search.name_search(part, "p_name", ["small gizmo", "red widgit", "blu bolts"])
    return found.select("p_partkey", "p_name", "term", F.round("similarity", 6).alias("similarity"))


@query
def stations_in_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.in_bbox(D.archive(spark, sf_dir)["station"], 49.2, -119.7, 49.6, -119.1).select(
        "station_uid", "lat", "lon")


NEAREST_POINTS = [("outlet", 49.25, -119.5), ("north", 49.9, -119.1), ("far", 45.0, -110.0)]


@query
def nearest_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.nearest(D.archive(spark, sf_dir)["station"], NEAREST_POINTS)


@query
def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per station, parameter, interval and time from the unmerged provincial rows,
    half of them labelled as the other authority's copy."""
    rows = D.bc_leg(spark, sf_dir)
    copies = D.as_observations(rows, "station_uid", "parameter", "interval").withColumns({
        "source": F.when(F.col("pull_run_id") % 2 == 0, "ona").otherwise("bc")})
    return lineage.canonical(copies, ["station_uid", "parameter", "interval", "datetime_utc"], BC)


def _corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two corrections per provincial series: one of some months, one open-ended."""
    series = D.archive(spark, sf_dir)["series"].filter(F.col("station_uid").like("BC-%"))
    kind = F.explode(F.array(F.lit("drift"), F.lit("datum"))).alias("correction_type")
    drift = F.col("correction_type") == "drift"
    return series.select("series_uid", kind).select(
        F.concat_ws(":", "series_uid", "correction_type").alias("correction_id"), "series_uid",
        F.when(drift, C.instant("1996-02-10")).otherwise(C.instant("2000-05-05 12:00:00")).alias("applied_from"),
        F.when(drift, C.instant("1996-09-20")).alias("applied_to"), "correction_type")


@query
def obs_with_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = D.archive(spark, sf_dir)["observation"].select("series_uid", "datetime_utc", "value")
    return lineage.with_corrections(obs, _corrections(spark, sf_dir)).select(
        "series_uid", "datetime_utc", "value", "correction_id", "correction_type")


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rating versions per provincial station, changing on 1998-07-01."""
    supplier = D.load(spark, sf_dir, "supplier")
    version = F.explode(F.array(F.lit(1), F.lit(2))).alias("version")
    rows = supplier.select("s_suppkey", version)
    change = C.instant("1998-07-01")
    return rows.select(
        F.concat_ws("-", F.lit("R"), "s_suppkey", "version").alias("rating_uid"),
        C.bc_station_uid(F.col("s_suppkey").cast("string")).alias("station_uid"),
        F.when(F.col("version") == 2, change).alias("effective_from"),
        F.when(F.col("version") == 1, change).alias("effective_to"),
        F.concat(F.lit('{"a": '), (F.col("version") * 0.5 + 1).cast("string"), F.lit(', "b": 1.5}')).alias("equation_params"),
        F.lit(2.0).alias("offset"))


def _bc_stage(spark: SparkSession, sf_dir: str, value: str, *extra) -> DataFrame:
    t = D.archive(spark, sf_dir)
    stage_series = t["series"].filter("parameter = 'H' AND station_uid LIKE 'BC-%'").select("series_uid", "station_uid")
    return t["observation"].join(stage_series, "series_uid").select(
        "series_uid", "station_uid", "datetime_utc", F.col("value").alias(value), *extra)


@query
def rated_discharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = lineage.rated_discharge(_bc_stage(spark, sf_dir, "stage_h"), _ratings(spark, sf_dir))
    return rated.select("series_uid", "datetime_utc", "stage_h", "rating_uid",
                        F.round("rated_q", 4).alias("rated_q"))


@query
def rating_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = _bc_stage(spark, sf_dir, "stage_h", (F.col("value") * 10 + 1).alias("measured_q"))
    out = lineage.rating_deviation(measured, _ratings(spark, sf_dir))
    return out.select("series_uid", "datetime_utc", "measured_q", "rating_uid", "rating_deviation_pct")


@query
def qualifier_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.decode_qualifiers(D.archive(spark, sf_dir)["observation"]).select(
        "series_uid", "datetime_utc", "source", "qualifier_labels", "estimate_flag", "ice_flag")


@query
def grade_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.decode_grades(D.archive(spark, sf_dir)["observation"]).select(
        "series_uid", "datetime_utc", "source", "grade_code", "grade_label", "grade_description")


@query
def nearest_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closest station of every customer's place, many of them far from all stations."""
    return search.nearest_points(D.archive(spark, sf_dir)["station"], _customer_places(spark, sf_dir))


def _customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return D.load(spark, sf_dir, "customer").select(
        key.alias("point_id"),
        F.when(key % 9 == 0, -90.0 + key % 181).otherwise(48.5 + (key % 200) / 100.0).alias("lat"),
        F.when(key % 9 == 0, -180.0 + key % 361).otherwise(-120.5 + (key % 233) / 100.0).alias("lon"))


@query
def similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names against nations' and part names put another way: all pairs that resemble each other."""
    parts = D.load(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    turned = parts.select(F.concat_ws(" ", F.reverse(F.split("name", " "))).alias("name"))
    nations = D.load(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    found = search.similar_names(parts, turned.unionByName(nations))
    return found.select("left_name", "right_name", F.round("similarity", 6).alias("similarity"))


def _three_authorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rows a supplier, known by the ids of one authority and of the next: chains of three ids; every fifth chain runs on
    into the next supplier's."""
    key = F.col("s_suppkey").cast("string")
    row = F.explode(F.array(F.lit("BC"), F.lit("WSC"), F.lit("ONA"))).alias("operator")
    rows = D.load(spark, sf_dir, "supplier").select("s_suppkey", row)
    is_bc, is_wsc, is_ona = (F.col("operator") == name for name in ("BC", "WSC", "ONA"))
    following = (F.col("s_suppkey") + 1).cast("string")
    return S.conform(rows.select(
        F.concat_ws("-", "operator", key).alias("station_uid"), "operator",
        F.when(is_bc | is_wsc, F.concat(F.lit("b"), key)).when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("b"), following)).alias("bc_aquarius_loc_id"),
        F.when(is_wsc | is_ona, F.concat(F.lit("w"), key)).alias("wsc_id"),
        F.when(is_ona, F.concat(F.lit("o"), key)).alias("ona_id")), S.STATION)


@query
def canonical_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that three authorities share out among their own stations, reconciled per canonical station."""
    stations = crosswalk.canonical_stations(_three_authorities(spark, sf_dir))
    owner = F.element_at(F.array(F.lit("BC"), F.lit("WSC"), F.lit("ONA")), (F.col("pull_run_id") % 3 + 1).cast("int"))
    rows = D.as_observations(D.bc_leg(spark, sf_dir), "station_uid", "parameter", "interval")
    rows = rows.withColumn("source", F.lower(owner)).withColumn("station_uid", F.concat_ws("-", owner, F.substring("station_uid", 4, 20)))
    keyed = rows.withColumn("series_uid", F.concat_ws("/", "station_uid", "parameter"))
    series = keyed.select("series_uid", "station_uid", "parameter", "interval").distinct()
    return lineage.canonical(crosswalk.by_canonical_station(keyed.drop("station_uid", "parameter", "interval"), series, stations),
                             ["canonical_uid", "parameter", "interval", "datetime_utc"], BC)


@query
def rated_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ratings a station that overlap, one without bounds: one rating a reading."""
    supplier = D.load(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("version"))
    version = F.col("version")
    ratings = supplier.select(
        F.concat_ws("-", F.lit("R"), "s_suppkey", "version").alias("rating_uid"),
        C.bc_station_uid(F.col("s_suppkey").cast("string")).alias("station_uid"),
        F.when(version == 2, C.instant("1994-03-05")).when(version == 3, C.instant("1996-07-01 06:00:00")).alias("effective_from"),
        F.when(version == 2, C.instant("1998-01-15")).when(version == 3, C.instant("1997-02-01")).alias("effective_to"),
        F.concat(F.lit('{"a": '), (version * 0.5 + 1).cast("string"), F.lit(', "b": 1.5}')).alias("equation_params"), F.lit(2.0).alias("offset"))
    return lineage.rated_discharge(_bc_stage(spark, sf_dir, "stage_h"), ratings).select(
        "series_uid", "datetime_utc", "stage_h", "rating_uid", F.round("rated_q", 4).alias("rated_q"))


def _two_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The archive, and a copy in which one month of some series has other values, other grades and more readings."""
    ours = D.archive(spark, sf_dir)["observation"].filter("source = 'bc'").select("series_uid", "datetime_utc", "value", "grade_code", "ym")
    changed = (F.col("ym") == 199603) & F.col("series_uid").like("%-H-%")
    theirs = ours.withColumns({"value": F.when(changed, F.col("value") + 1).otherwise(F.col("value")),
                               "grade_code": F.when(changed & (F.dayofmonth("datetime_utc") > 20), "31").otherwise(F.col("grade_code"))})
    return ours.filter(~(changed & (F.dayofmonth("datetime_utc") == 5))), theirs


@query
def audit_compare_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the provincial archive, compared where the months' digests differ."""
    return audit.compare_by_month(*_two_snapshots(spark, sf_dir))


@query
def stream_open_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that are silent when the landing ends: those of an event type stop early."""
    landing = _Landing(spark, "open-outages")
    silent = (F.col("series_uid").like("%-COND-%")) & (F.col("datetime_utc") > F.lit("2024-01-10").cast("timestamp_ntz"))
    landing.run([pull.filter(~silent) for pull in _two_pulls(spark, sf_dir)], lambda rows: legs.last_seen(rows, landing.out, landing.checkpoint))
    return legs.open_outages(spark, landing.out)


@query
def input_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily run over pages some of which are broken or hold unreadable times: every page and reading is taken or kept."""
    store = _store(spark, sf_dir, "quarantine", "station")
    path = workspace(spark, "broken-pages")
    readings = (D.load(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("second", "ts").alias("t")).agg(F.max("value").alias("value")))
    time = F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    broken = F.dayofmonth("t") == 7
    feature = F.struct(F.struct(
        F.col("user_id").cast("string").alias("STATION_NUMBER"),
        F.when(F.hour("t") == 3, F.date_format("t", "dd.MM.yyyy HH:mm:ss")).otherwise(time).alias("DATETIME"),
        F.col("value").alias("LEVEL"), F.lit("E").alias("LEVEL_SYMBOL_EN")).alias("properties"))
    page = F.to_json(F.struct(F.array(feature).alias("features")))
    readings.select(F.when(broken, F.substring(page, 1, 40)).otherwise(page)).write.text(path)
    jobs.daily(store, path, datetime(2024, 1, 31), days=35, multiline=False)
    kept = store.read("quarantine").groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))
    taken = store.read("observation").agg(F.count(F.lit(1)).alias("n")).select(F.lit("observation").alias("kind"), F.lit("taken").alias("reason"), "n")
    return kept.unionByName(taken)


@query
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of which every third supplier's files end after two lines, without a header, and some times are unreadable:
    both are mended and replayed."""
    store, reg, path = Archive(spark, workspace(spark, "replay"), buckets=2), _registry_file(spark, sf_dir), workspace(spark, "short-exports")
    text = _provincial_text(spark, sf_dir, False)
    short = F.substring_index("dataset", "@", -1).cast("long") % 3 == 0
    torn = F.col("line").like("%-13 %")
    _write_exports(text.filter(~short).withColumn("line", F.when(torn, F.concat(F.lit("?"), "line")).otherwise(F.col("line"))), path)
    few = text.filter(short).withColumn("row", F.row_number().over(Window.partitionBy("dataset").orderBy("line"))).filter("row <= 2")
    _land(few.repartition("dataset").sortWithinPartitions("dataset", "pull"), path)
    jobs.provincial(store, path, reg, datetime(2001, 11, 6), "EntirePeriodOfRecord", dataset_pattern=_IN_FOLDER)
    held = quarantine.still_open(store.read("quarantine"))
    jobs.replay(store, held.select("pulled_from", "body", F.ltrim(F.col("body"), F.lit("?")).alias("fixed")), datetime(2001, 11, 6), reg)
    return _flat(store.read("observation")).select("series_uid", "datetime_utc", "value", "grade_code", "approval_level")


def _download(name: str) -> Query:
    """A download written as CSV and read back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = D.archive(spark, sf_dir)
        path = downloads.write(t, workspace(spark, "downloads"), BC, [name])[name]
        return spark.read.schema(downloads.report(t, name, BC).schema).option("header", True).csv(path)
    return run


QUERIES |= {f"download_{name}": _download(name) for name in downloads.DOWNLOADS}


@query
def registry_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry job over a network table in CSV with its columns in another order."""
    network, out = workspace(spark, "network"), workspace(spark, "registry-job")
    rows = _network(spark, sf_dir)
    rows.select(*reversed(rows.columns)).write.option("header", True).csv(network)
    return jobs.build_station_registry(spark, network, out, "MACH")


def _broken(rows: DataFrame, faults: dict[int, tuple[str, str | None]], by: str) -> DataFrame:
    """Every twentieth row's column set to a bad value, by the remainder of a number; remainder 19 stands twice. ``none`` keeps
    the old value behind it, so that keys stay unlike."""
    for n, (column, value) in faults.items():
        bad = F.concat(F.lit("none-"), F.col(column)) if value == "none" else F.lit(value)
        rows = rows.withColumn(column, F.when(F.col(by) % 20 == n, bad).otherwise(F.col(column)))
    return rows.unionByName(rows.filter(F.col(by) % 20 == 19))


@query
def write_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches for all declared tables in which each rule is broken, and the rows that pass."""
    t = D.dimensions(spark, sf_dir)
    committed = {"station": t["station"], "series": t["series"], "audit_log": t["audit_log"]}
    supplier = D.load(spark, sf_dir, "supplier").withColumn("station_uid", C.bc_station_uid(F.col("s_suppkey").cast("string")))
    number, at = F.col("s_suppkey"), C.instant("2000-01-01")
    lines = D.bc_leg(spark, sf_dir)
    obs = merge.last_of_batch(D.as_observations(lines, "ord_line", "ord_part", "ord_price"), S.OBSERVATION_KEY, D.ORDER, S.OBSERVATION.names)
    series_uid = F.concat("station_uid", F.when(number % 4 == 0, "-GW").otherwise("-H"), F.lit("-instant-bc"))
    orders = D.load(spark, sf_dir, "orders").withColumn("o", F.col("o_orderkey"))
    batches = {
        "observation": _broken(obs, {1: ("source", "noaa"), 2: ("ingest_ts", None), 3: ("grade_code", "999"), 4: ("series_uid", "none"), 5: ("approval_level", "final")}, "pull_run_id"),
        "station": _broken(supplier.select("s_suppkey", F.concat(F.lit("N-"), number).alias("station_uid"), F.lit("new").alias("name"), F.lit("BC").alias("operator"),
                                           F.lit("active").alias("status"), F.lit("natural").alias("regulation_status"), F.concat(F.lit("n"), number).alias("bc_aquarius_loc_id")),
                           {1: ("operator", "USGS"), 2: ("status", "lost"), 3: ("regulation_status", "dammed"), 4: ("name", None), 5: ("bc_aquarius_loc_id", "1")}, "s_suppkey"),
        "series": _broken(supplier.select("s_suppkey", F.concat(F.lit("N-"), number).alias("series_uid"), "station_uid", F.lit("Q").alias("parameter"), F.lit("m3/s").alias("units"),
                                          F.lit("daily").alias("interval"), F.concat(F.lit("x"), number).alias("source_series_id")),
                          {1: ("parameter", "SNOW"), 2: ("interval", "weekly"), 3: ("units", None), 4: ("station_uid", "none")}, "s_suppkey"),
        "pull_run": _broken(orders.select("o", (F.col("o") + 10_000_000).alias("run_id"), F.lit("wsc").alias("source"), F.lit("ok").alias("status"), at.alias("started_ts")),
                            {1: ("status", "lost"), 2: ("source", None)}, "o"),
        "audit_log": _broken(orders.select("o", (F.col("o") + 10_000_000).alias("audit_id"), at.alias("run_ts")), {1: ("run_ts", None)}, "o"),
        "audit_discrepancy": _broken(orders.select("o", F.expr(D._AUDIT_ID).alias("audit_id"), F.lit(None).cast("string").alias("series_uid"), at.alias("detected_ts")),
                                     {1: ("audit_id", "-7"), 2: ("detected_ts", None), 3: ("series_uid", "no such series")}, "o").filter("o % 20 <> 19"),
        "observation_canonical": _broken(supplier.select("s_suppkey", series_uid.alias("series_uid"), at.alias("datetime_utc"), F.lit("bc").alias("authoritative_source"),
                                                         at.alias("last_reconciled_ts"), F.lit("31").alias("grade_code"), F.lit("working").alias("approval_level")),
                                         {1: ("series_uid", "none"), 2: ("grade_code", "999"), 3: ("approval_level", "final"), 5: ("authoritative_source", None)}, "s_suppkey"),
        "correction_history": _broken(supplier.select("s_suppkey", number.alias("correction_id"), series_uid.alias("series_uid")), {1: ("series_uid", "none"), 2: ("series_uid", None)}, "s_suppkey"),
        "rating_curve": _broken(supplier.select("s_suppkey", F.concat(F.lit("R"), number).alias("rating_uid"), "station_uid"), {1: ("station_uid", "none"), 2: ("station_uid", None)}, "s_suppkey"),
        "discharge_measurement": _broken(supplier.select("s_suppkey", F.concat(F.lit("M"), number).alias("measurement_uid"), "station_uid", at.alias("datetime_utc")),
                                         {1: ("station_uid", "none"), 2: ("datetime_utc", None)}, "s_suppkey"),
        "grade_code": _broken(supplier.select("s_suppkey", F.concat(F.lit("G"), number).alias("grade_code"), F.lit("wsc").alias("authority")), {1: ("authority", None)}, "s_suppkey"),
    }
    schemas = {"observation": S.OBSERVATION, "station": S.STATION, "series": S.SERIES, "pull_run": S.PULL_RUN, "audit_log": S.AUDIT_LOG,
               "audit_discrepancy": S.AUDIT_DISCREPANCY, "observation_canonical": S.CANONICAL, "correction_history": S.CORRECTION,
               "rating_curve": S.RATING, "discharge_measurement": S.MEASUREMENT}
    store, out = _store(spark, sf_dir, "gate"), []
    for table, batch in batches.items():
        rows = S.conform(batch, schemas[table]) if table in schemas else batch.drop("s_suppkey")
        good = store.gated(rows, table, "batch", 1, D.EVENTS_AS_OF, committed)
        out.append(good.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{table} row").alias("kind"), F.lit("passed").alias("reason"), "n"))
    kept = store.read("quarantine").groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))
    return reduce(DataFrame.unionByName, [kept, *out]).filter("n > 0")
