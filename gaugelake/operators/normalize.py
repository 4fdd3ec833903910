"""Upstream rows to observations and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..sources.files import CARRIED


def _order_of(rows: DataFrame) -> list[Column]:
    """The pull order, where the rows carry it."""
    return [F.col(c) for c in CARRIED if c in rows.columns]


def reshape_long(pull: DataFrame) -> DataFrame:
    """Wide pull to one row per reading, in one pass; NULL readings are dropped.

    Columns: series_uid, station_uid, parameter, units, datetime_utc, value, qflag.
    """
    station, parameter = F.col("STATION_NUMBER"), F.col("parameter")
    timed = pull.withColumn("datetime_utc", C.parse_wsc_time(F.col("DATETIME")))
    order = _order_of(pull)
    long = timed.selectExpr(
        *(c for c in CARRIED if c in pull.columns), "STATION_NUMBER", "datetime_utc",
        "stack(2, 'H', 'm', LEVEL, LEVEL_SYM, 'Q', 'm3/s', DISCHARGE, DISCHARGE_SYM)"
        " AS (parameter, units, value, qflag)")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value")).select(
        C.wsc_series_uid(station, parameter, "instant").alias("series_uid"),
        C.wsc_station_uid(station).alias("station_uid"), "parameter", "units",
        "datetime_utc", "value", "qflag", *order)


def daily_normalise(history: DataFrame, parameter: str, units: str) -> DataFrame:
    """Daily history to readings at UTC midnight."""
    station = F.col("STATION_NUMBER")
    return history.filter(F.col("Value").isNotNull() & ~F.isnan("Value")).select(
        C.wsc_series_uid(station, F.lit(parameter), "daily").alias("series_uid"),
        C.wsc_station_uid(station).alias("station_uid"),
        F.lit(parameter).alias("parameter"), F.lit(units).alias("units"),
        F.col("Date").cast("timestamp_ntz").alias("datetime_utc"),
        F.col("Value").alias("value"), F.col("Symbol").alias("qflag"))


def export_normalise(rows: DataFrame, dropped: Observation | None = None) -> DataFrame:
    """Positional export fields to typed readings; unparsable time or value drops the row.

    ``dropped`` observes how many rows have no readable time; rows without a value are no loss. ``inline`` keeps the planner
    from parsing once more in the filter.
    """
    keep = [c for c in rows.columns if c not in S.EXPORT_ROW.names]
    typed = rows.select(*keep, F.inline(F.array(F.struct(
        C.parse_export_time(F.col("ts")).alias("datetime_utc"),
        C.parse_number(F.col("value")).alias("value"),
        C.null_if_empty(F.trim("grade")).alias("grade_code"),
        C.approval_from_code(F.trim("approval")).alias("approval_level"),
        F.col("qualifier").alias("qflag")))))
    if dropped:
        typed = typed.observe(dropped, F.count_if(F.col("datetime_utc").isNull()).alias("n"))
    return typed.filter(F.col("datetime_utc").isNotNull() & F.col("value").isNotNull())


def series_discovery(long: DataFrame, interval: str) -> DataFrame:
    """Distinct series of a pull with their upstream ids."""
    found = long.select("series_uid", "station_uid", "parameter", "units").distinct()
    return found.select(
        "*", F.lit(interval).alias("interval"),
        C.wsc_source_series_id(F.col("station_uid"), F.col("parameter"), interval).alias("source_series_id"))


def wsc_observations(long: DataFrame, run_id, ingest_ts, approval: str = "working") -> DataFrame:
    return _conform(long, long.select(
        *_order_of(long), "series_uid", "datetime_utc", "value", F.lit(approval).alias("approval_level"),
        C.qualifier_array(F.col("qflag")).alias("qualifier_flags"),
        F.lit(False).alias("estimate_flag"), F.lit(False).alias("ice_flag"),
        F.lit("wsc").alias("source"), F.lit(run_id).alias("pull_run_id"),
        C.instant(ingest_ts).alias("ingest_ts")))


def _conform(source: DataFrame, rows: DataFrame) -> DataFrame:
    """Observation columns, then the pull order where there is one."""
    order = [S.T.StructField(c, source.schema[c].dataType) for c in CARRIED if c in source.columns]
    return S.conform(rows, S.T.StructType([*S.OBSERVATION.fields, *order]))


def bc_observations(readings: DataFrame, run_id, ingest_ts) -> DataFrame:
    """Readings with moe_id and canon (joined from the registry) to observations."""
    return _conform(readings, readings.select(
        *_order_of(readings), C.bc_series_uid(F.col("moe_id"), F.col("canon")).alias("series_uid"),
        "datetime_utc", "value", "grade_code", "approval_level",
        C.qualifier_array(F.col("qflag")).alias("qualifier_flags"),
        F.lit(False).alias("estimate_flag"), F.lit(False).alias("ice_flag"),
        F.lit("bc").alias("source"), F.lit(run_id).alias("pull_run_id"),
        C.instant(ingest_ts).alias("ingest_ts")))


def staged_to_observation(staged: DataFrame, ingest_ts) -> DataFrame:
    """Bulk-loaded text rows to observations: '' is NULL, the flag becomes an array."""
    return S.conform(staged.select(
        "series_uid", F.col("datetime_utc").try_cast("timestamp_ntz").alias("datetime_utc"), "value",
        C.null_if_empty(F.col("grade_code")).alias("grade_code"),
        C.null_if_empty(F.col("approval_level")).alias("approval_level"),
        C.qualifier_array(F.col("qualifier_flags")).alias("qualifier_flags"),
        F.lit(False).alias("estimate_flag"), F.lit(False).alias("ice_flag"),
        "source", "pull_run_id", C.instant(ingest_ts).alias("ingest_ts")), S.OBSERVATION)


def bc_stations(registry: DataFrame, station_type: str | None = None) -> DataFrame:
    """Registry rows to station rows (one per site)."""
    rows = registry.select(
        C.bc_station_uid(F.col("moe_id")).alias("station_uid"),
        F.col("moe_id").alias("bc_aquarius_loc_id"), "name", F.lit("BC").alias("operator"),
        F.lit("active").alias("status"), F.lit(station_type).cast("string").alias("station_type"),
        C.point(F.col("lon"), F.col("lat")).alias("geom"), "lat", "lon",
        F.lit("Okanagan").alias("basin"))
    return S.conform(rows, S.STATION)


def bc_series(registry: DataFrame) -> DataFrame:
    moe = F.col("moe_id")
    rows = registry.select(
        C.bc_series_uid(moe, F.col("canon")).alias("series_uid"),
        C.bc_station_uid(moe).alias("station_uid"), F.col("canon").alias("parameter"), "units",
        F.lit("instant").alias("interval"), F.lit("UTC").alias("time_zone"),
        C.bc_source_series_id(F.col("parameter"), F.col("label"), moe).alias("source_series_id"))
    return S.conform(rows, S.SERIES)


def dry_run_report(registry: DataFrame, readings: DataFrame) -> DataFrame:
    """Rows and time range per registered dataset; datasets without rows show 0."""
    per_dataset = readings.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("datetime_utc").alias("first_ts"),
        F.max("datetime_utc").alias("last_ts"))
    return (registry.join(per_dataset, registry.moe_id == per_dataset.dataset, "left")
            .select("moe_id", "name",
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "first_ts", "last_ts"))
