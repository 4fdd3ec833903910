"""The monitoring reports. Each takes the archive's tables (a dict of DataFrames) and, where the
answer depends on the time of asking, an explicit ``as_of``; nothing reads the clock.

Counts and spans per series come from the archive's stored ``partial`` counts where the tables have them; then these
reports do not open the readings at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.rollup import by_series, days_with_gap_before, merged_partials
from ..sources.files import since

Tables = dict[str, DataFrame]


def _one_row(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(1)


def _count(df: DataFrame):
    return df.agg(F.count(F.lit(1))).scalar()


def _per_series(t: Tables, *keys, source: str | None = None) -> DataFrame:
    """Count, span and approval counts per series and extra keys: from the stored partials, else from the readings."""
    kept = t.get("partial")
    rows = t["observation"] if kept is None else kept
    if source:
        rows = rows.filter(F.col("source") == source)
    return by_series(rows, *keys) if kept is None else merged_partials(rows, *keys)


def _whole(t: Tables) -> DataFrame:
    """Rows with ``n`` readings and their newest time, to be added up."""
    kept = t.get("partial")
    return t["observation"].agg(F.count(F.lit(1)).alias("n"), F.max("datetime_utc").alias("last_ts")) if kept is None else kept


# --- overview ---------------------------------------------------------------

def kpi_overview(t: Tables, as_of) -> DataFrame:
    obs, series, runs = _whole(t), t["series"], t["pull_run"]
    return _one_row(series).select(
        obs.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long"))).scalar().alias("obs"),
        _count(t["station"]).alias("stations"),
        _count(series).alias("series"),
        series.agg(F.count_distinct("parameter")).scalar().alias("params"),
        obs.agg(F.max("last_ts")).scalar().alias("latest"),
        runs.filter("status = 'ok'").agg(F.max("finished_ts")).scalar().alias("last_run"),
        _count(since(runs, "started_ts", as_of, 30, strict=True)).alias("runs_30d"),
        _count(t["audit_discrepancy"].filter("action_taken IS NULL")).alias("open_discrepancies"))


def obs_per_day(t: Tables, as_of, days: int = 60, by: str = "datetime_utc") -> DataFrame:
    recent = since(t["observation"], by, as_of, days, strict=True) if by == "datetime_utc" else \
        t["observation"].filter(F.col(by) > C.days_before(as_of, days))
    return recent.groupBy(F.to_date(by).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d")


def coverage(t: Tables, keys: tuple[str, ...] = ("parameter", "interval", "source")) -> DataFrame:
    """Readings, series and span. Readings are counted per series first, so the join and the
    distinct count of series work on one row per series and source."""
    per_series = _per_series(t, *[k for k in keys if k == "source"])
    return (per_series.join(t["series"].select("series_uid", "parameter", "interval"), "series_uid")
            .groupBy(*keys)
            .agg(F.sum("n").alias("obs"), F.count(F.lit(1)).alias("series"),
                 F.to_date(F.min("first_ts")).alias("first_obs"),
                 F.to_date(F.max("last_ts")).alias("last_obs"))
            .orderBy(*keys))


def coverage_interval(t: Tables) -> DataFrame:
    return coverage(t, ("parameter", "interval"))


def coverage_firstcut(t: Tables) -> DataFrame:
    per_series = _per_series(t)
    return (per_series.join(t["series"].select("series_uid", "parameter"), "series_uid")
            .groupBy("parameter")
            .agg(F.sum("n").alias("obs"), F.count(F.lit(1)).alias("series"),
                 F.min("first_ts").alias("first_obs"), F.max("last_ts").alias("last_obs"))
            .orderBy("parameter"))


def coverage_by_parameter(t: Tables) -> DataFrame:
    return (coverage(t).groupBy("parameter").agg(F.sum("obs").alias("obs"))
            .select("parameter", C.parameter_label(F.col("parameter")).alias("label"), "obs"))


def coverage_timeline(t: Tables) -> DataFrame:
    label = F.format_string("%s · %s (%s)", F.upper("source"), C.parameter_label(F.col("parameter")),
                            F.col("interval"))
    return coverage(t).select(
        label.alias("row_label"), F.upper("source").alias("source"), "first_obs", "last_obs", "obs",
        F.date_diff("last_obs", "first_obs").alias("span_days")).orderBy("first_obs", "row_label")


def freshness_by_source(t: Tables, as_of) -> DataFrame:
    latest = _per_series(t, "source").select("series_uid", "source", F.col("last_ts").alias("latest"))
    return (latest.join(t["series"].select("series_uid", "parameter"), "series_uid")
            .groupBy(C.source_label(F.col("parameter"), F.col("source")).alias("source"))
            .agg(F.max("latest").alias("latest"))
            .withColumn("hours", F.round(C.hours_old(as_of, F.col("latest")), 1))
            .withColumn("colour", C.freshness_colour(F.col("hours")))
            .orderBy("source"))


def daily_record_span(t: Tables) -> DataFrame:
    daily = t["series"].filter("interval = 'daily'").select("series_uid")
    return (_per_series(t).join(daily, "series_uid", "left_semi")
            .agg(F.to_date(F.min("first_ts")).alias("first_obs"),
                 F.to_date(F.max("last_ts")).alias("last_obs")))


def station_summary(t: Tables) -> DataFrame:
    """All stations; those without series or readings show 0 and no latest time."""
    per_series = _per_series(t).select("series_uid", "n", "last_ts")
    per_station = (t["series"].select("series_uid", "station_uid").join(per_series, "series_uid")
                   .groupBy("station_uid").agg(F.sum("n").alias("obs"), F.max("last_ts").alias("latest")))
    return (t["station"].join(per_station, "station_uid", "left")
            .select("station_uid", "wsc_id", "name", "operator", "drainage_area_km2", "lat", "lon",
                    F.coalesce("obs", F.lit(0)).alias("obs"), "latest")
            .orderBy("name"))


def station_map(t: Tables, as_of) -> DataFrame:
    hours = C.hours_old(as_of, F.col("latest"))
    return (station_summary(t).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .select("station_uid", "name", "operator", "lat", "lon", "obs", "latest",
                    F.round(hours, 1).alias("hours_old"), C.freshness_colour(hours).alias("colour")))


def recent_runs(t: Tables, k: int = 50) -> DataFrame:
    return t["pull_run"].orderBy(F.desc("run_id")).limit(k).select(
        "run_id", "source", "status", "rows_in",
        C.round_to_second(F.col("started_ts")).alias("started"),
        C.round_to_second(F.col("finished_ts")).alias("finished"))


def recent_audits(t: Tables, k: int = 25) -> DataFrame:
    return t["audit_log"].orderBy(F.desc("audit_id")).limit(k).select(
        "audit_id", "scope", "stations_checked", "discrepancies",
        C.round_to_second(F.col("run_ts")).alias("run_ts"))


# --- provincial network -----------------------------------------------------

def _network(t: Tables, per_series: DataFrame, bc_operator_only: bool) -> DataFrame:
    """Per-series rows joined to their non-well station."""
    station = t["station"].filter(C.not_a_well(F.col("station_type")))
    if bc_operator_only:
        station = station.filter("operator = 'BC'")
    series = t["series"].select("series_uid", "station_uid", "parameter")
    return per_series.join(series, "series_uid").join(
        station.select("station_uid", "bc_aquarius_loc_id", "name"), "station_uid")


def _bc(t: Tables) -> DataFrame:
    return t["observation"].filter("source = 'bc'")


def network_audit(t: Tables, as_of) -> DataFrame:
    return (_network(t, _per_series(t, source="bc"), True)
            .groupBy(F.col("bc_aquarius_loc_id").alias("moe_id"), "name")
            .agg(F.count(F.lit(1)).alias("series"),
                 # The set is bounded by the parameter domain.
                 F.array_join(F.array_sort(F.collect_set("parameter")), ", ").alias("params"),
                 F.sum("n").alias("points"),
                 F.to_date(F.min("first_ts")).alias("first_obs"),
                 F.to_date(F.max("last_ts")).alias("last_obs"),
                 C.percent(F.sum("n_qaqc"), F.sum("n")).alias("pct_qaqc"),
                 C.days_stale(as_of, F.max("last_ts")).alias("days_stale"))
            .orderBy("name"))


def network_audit_status(t: Tables, as_of) -> DataFrame:
    return network_audit(t, as_of).select(
        "moe_id", "name", "params", "series", "points", "first_obs", "last_obs", "pct_qaqc", "days_stale",
        C.qaqc_status(F.col("pct_qaqc")).alias("qaqc_status"),
        C.audit_freshness(F.col("days_stale")).alias("freshness"))


def audit_status_summary(t: Tables, as_of) -> DataFrame:
    return network_audit_status(t, as_of).agg(
        F.count(F.lit(1)).alias("stations"), F.sum("series").alias("series"),
        F.count_if(F.col("qaqc_status") == "Provisional (working)").alias("provisional"),
        F.count_if(F.col("freshness") == "Stale").alias("stale"),
        F.min("first_obs").alias("first_obs"), F.max("last_obs").alias("last_obs"))


def network_totals(t: Tables, as_of) -> DataFrame:
    return network_audit(t, as_of).agg(
        F.count(F.lit(1)).alias("n"), F.sum("points").alias("points"),
        C.weighted_percent(F.col("points"), F.col("pct_qaqc")).alias("qaqc_weighted_pct"),
        F.max("last_obs").alias("latest"))


def approval_by_station(t: Tables) -> DataFrame:
    per_series = _per_series(t, F.coalesce("approval_level", F.lit("unspecified")).alias("approval"), source="bc")
    counts = _network(t, per_series, True).groupBy("name", "approval").agg(F.sum("n").alias("n"))
    # At most one row per approval level and name here.
    total = F.sum("n").over(Window.partitionBy("name"))
    return counts.select("name", "approval", "n", total.alias("name_total"),
                         C.approval_order(F.col("approval")).alias("approval_order"))


def network_year(t: Tables) -> DataFrame:
    """Stations, readings and visited station-days per year.

    A field visit shows as a pause of over a day in a series; several series pausing at one
    station on one day are one visit. Counts narrow step by step - series-days, station-days,
    station-years, years - so no distinct count and no second pass over the readings is needed.
    """
    days = _network(t, days_with_gap_before(_bc(t)), False)
    per_day = days.groupBy("station_uid", "day").agg(
        F.sum("n").alias("n"), F.max("after_gap").alias("visited"))
    per_station = per_day.groupBy(F.year("day").alias("yr"), "station_uid").agg(
        F.sum("n").alias("n"), F.count_if(F.col("visited")).alias("visits"))
    return (per_station.groupBy("yr")
            .agg(F.count(F.lit(1)).alias("stations"), F.sum("n").alias("points"),
                 F.sum("visits").alias("visits"))
            .orderBy("yr"))


def network_year_table(t: Tables) -> DataFrame:
    return network_year(t).select("yr", "stations", "points", "visits",
                                  F.lit("pending").alias("rating"), F.lit("Provisional").alias("qaqc"))


def network_year_long(t: Tables) -> DataFrame:
    return network_year(t).selectExpr(
        "yr", "stack(2, 'Stations reporting', stations, 'Field visits (proxy)', visits) AS (metric, n)")


def station_year_heatmap(t: Tables) -> DataFrame:
    # A partial lies in one month.
    at = "datetime_utc" if t.get("partial") is None else "first_ts"
    per_series = _per_series(t, F.year(at).alias("yr"), source="bc")
    counts = _network(t, per_series, False).groupBy("name", "yr").agg(F.sum("n").alias("points"))
    return counts.withColumn("name_total", F.sum("points").over(Window.partitionBy("name")))


# --- groundwater ------------------------------------------------------------

def gw_wells(t: Tables, as_of) -> DataFrame:
    wells = t["station"].filter("station_type = 'groundwater_well'").select(
        "station_uid", "bc_aquarius_loc_id", "name", "lat", "lon")
    return (_per_series(t)
            .join(t["series"].select("series_uid", "station_uid"), "series_uid")
            .join(wells, "station_uid")
            .groupBy(F.col("bc_aquarius_loc_id").alias("well"), "name", "lat", "lon")
            .agg(F.sum("n").alias("points"), F.to_date(F.min("first_ts")).alias("first_obs"),
                 F.to_date(F.max("last_ts")).alias("last_obs"),
                 C.percent(F.sum("n_approved"), F.sum("n")).alias("pct_approved"),
                 C.days_stale(as_of, F.max("last_ts")).alias("days_stale"))
            .orderBy("name"))


def gw_totals(t: Tables, as_of) -> DataFrame:
    return gw_wells(t, as_of).agg(
        F.count(F.lit(1)).alias("n"), F.sum("points").alias("points"),
        C.weighted_percent(F.col("points"), F.col("pct_approved")).alias("approved_weighted_pct"),
        F.year(F.min("first_obs")).alias("first_year"), F.year(F.max("last_obs")).alias("last_year"))


def gw_map(t: Tables, as_of) -> DataFrame:
    return (gw_wells(t, as_of).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .select("well", "name", "lat", "lon", "points",
                    F.coalesce("pct_approved", F.lit(0.0)).alias("pct_approved"), "days_stale",
                    C.well_colour(F.col("days_stale")).alias("colour")))


# --- downloads and checks ---------------------------------------------------

def latest_per_series(t: Tables) -> DataFrame:
    """Newest readings per series, all sources at that time: the time by a hash aggregate that combines
    before the shuffle, then the readings that have it."""
    readings = t["observation"].select("series_uid", "datetime_utc", "value", "approval_level")
    newest = readings.groupBy("series_uid").agg(F.max("datetime_utc").alias("datetime_utc"))
    latest = readings.join(newest, ["series_uid", "datetime_utc"], "left_semi")
    return (latest.join(t["series"].select("series_uid", "station_uid", "parameter", "interval", "units"),
                        "series_uid")
            .select("station_uid", "parameter", "interval", "value", "units", "datetime_utc", "approval_level")
            .orderBy("station_uid", "parameter"))


def daily_means(t: Tables) -> DataFrame:
    daily = t["series"].filter("interval = 'daily'").select("series_uid", "station_uid", "parameter", "units")
    return (t["observation"].join(daily, "series_uid")
            .select("station_uid", "parameter", F.to_date("datetime_utc").alias("date"), "value", "units",
                    "approval_level")
            .orderBy("station_uid", "parameter", "date"))


def longest_records(t: Tables, k: int = 8) -> DataFrame:
    daily = t["series"].filter("interval = 'daily'").select("series_uid")
    return (_per_series(t).join(daily, "series_uid", "left_semi")
            .select("series_uid", F.to_date("first_ts").alias("from_date"), F.to_date("last_ts").alias("to_date"))
            .orderBy("from_date", "series_uid").limit(k))


def stations_with_series(t: Tables) -> DataFrame:
    wsc = t["series"].filter(F.col("station_uid").like("WSC-%"))
    return _one_row(t["station"]).select(
        t["station"].agg(F.count_distinct("station_uid")).scalar().alias("stations_total"),
        wsc.agg(F.count_distinct("station_uid")).scalar().alias("stations_with_series"))


def load_verify(t: Tables) -> DataFrame:
    return _one_row(t["station"]).select(
        _count(t["station"]).alias("stations"), _count(t["series"]).alias("series"),
        _count(t["observation"]).alias("observations"))
