"""Parsing, labelling, bucketing and identity expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import APPROVAL_CODES, APPROVAL_DISPLAY_ORDER, PARAMETER_LABELS

# Fixed patterns of the upstream formats. Text after the pattern is ignored.
_WSC_TIME = r"^(\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2})Z"
_EXPORT_TIME = r"^\s*(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})"
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def instant(value: Column | str | date | datetime) -> Column:
    """A TIMESTAMP_NTZ column from a literal moment; columns pass through."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def days_before(as_of, days: int) -> Column:
    return instant(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _parse(c: Column, pattern: str) -> Column:
    return null_if_empty(F.regexp_extract(c, pattern, 1)).try_cast("timestamp_ntz")


def parse_wsc_time(c: Column) -> Column:
    return _parse(c, _WSC_TIME)


def parse_export_time(c: Column) -> Column:
    return _parse(c, _EXPORT_TIME)


def parse_number(c: Column) -> Column:
    """Text to double; anything that is no number, NaN included, is NULL."""
    return F.when(c.rlike(_NUMBER), F.trim(c)).try_cast("double")


def qualifier_array(c: Column) -> Column:
    """NULL or '' -> NULL; otherwise a one-element array."""
    return F.when(null_if_empty(c).isNotNull(), F.array(c))


def approval_from_code(c: Column) -> Column:
    """Export approval code to level; unknown codes and NULL are 'unspecified'."""
    mapped = F.lit("unspecified")
    for code, level in APPROVAL_CODES.items():
        mapped = F.when(c == code, level).otherwise(mapped)
    return mapped


def parameter_label(parameter: Column) -> Column:
    label = parameter
    for code, text in PARAMETER_LABELS.items():
        label = F.when(parameter == code, text).otherwise(label)
    return label


def source_label(parameter: Column, source: Column) -> Column:
    return (F.when(parameter == "GW", "BC groundwater")
            .when(source == "bc", "BC surface")
            .otherwise(F.upper(source)))


def approval_order(approval: Column) -> Column:
    return F.array_position(F.array(*[F.lit(a) for a in APPROVAL_DISPLAY_ORDER]), approval).cast("int")


def point(lon: Column, lat: Column) -> Column:
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def not_a_well(station_type: Column) -> Column:
    """Null-safe: stations of unknown type are kept."""
    return ~station_type.eqNullSafe("groundwater_well")


# --- ages and buckets -------------------------------------------------------

def seconds_between(start: Column, end: Column) -> Column:
    """Seconds with fraction. Subtraction, unlike ``timestampdiff``, stays free of time zones."""
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def elapsed(unit_seconds: int, start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(float(unit_seconds))


def hours_old(as_of, ts: Column) -> Column:
    return elapsed(3600, ts, instant(as_of))


def days_stale(as_of, ts: Column) -> Column:
    """Whole days, halves away from zero."""
    return F.round(elapsed(86400, ts, instant(as_of))).cast("int")


def freshness_colour(hours: Column) -> Column:
    return (F.when(hours.isNull(), "grey").when(hours <= 26, "green")
            .when(hours <= 48, "amber").otherwise("red"))


def well_colour(days: Column) -> Column:
    return (F.when(days.isNull(), "grey").when(days <= 14, "green")
            .when(days <= 180, "amber").otherwise("red"))


def audit_freshness(days: Column) -> Column:
    return (F.when(days <= 2, "Current").when(days <= 14, "Recent")
            .when(days.isNotNull(), "Stale"))


def qaqc_status(pct: Column) -> Column:
    return (F.when(pct.isNull() | (pct < 10), "Provisional (working)")
            .when(pct < 90, "Partially reviewed").otherwise("Approved"))


def percent(part: Column, whole: Column) -> Column:
    """round(100 * part / whole, 1); NULL when there is nothing to divide by."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1)


def weighted_percent(points: Column, pct: Column) -> Column:
    """Aggregate: mean of already rounded percentages weighted by points; NULL counts as 0."""
    return F.round(F.lit(100.0) * F.sum(points * F.coalesce(pct, F.lit(0.0)) / 100.0) / F.sum(points), 1)


def round_to_second(ts: Column) -> Column:
    """Halves go up."""
    shifted = ts + F.expr("INTERVAL '0.5' SECOND")
    fraction = F.pmod(F.date_part(F.lit("SECOND"), shifted), F.lit(1))
    return shifted - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


# --- identity ---------------------------------------------------------------

def wsc_station_uid(station: Column) -> Column:
    return F.concat(F.lit("WSC-"), station)


def wsc_series_uid(station: Column, parameter: Column, interval: str) -> Column:
    return F.concat(F.lit("WSC-"), station, F.lit("-"), parameter, F.lit(f"-{interval}"))


def wsc_source_series_id(station_uid: Column, parameter: Column, interval: str) -> Column:
    suffix = ":daily" if interval == "daily" else ""
    return F.concat(station_uid, F.lit(":"), parameter, F.lit(suffix))


def bc_station_uid(moe_id: Column) -> Column:
    return F.concat(F.lit("BC-"), moe_id)


def bc_series_uid(moe_id: Column, canon: Column) -> Column:
    return F.concat(F.lit("BC-"), moe_id, F.lit("-"), canon, F.lit("-instant-bc"))


def bc_source_series_id(parameter: Column, label: Column, moe_id: Column) -> Column:
    return F.concat(parameter, F.lit("."), label, F.lit("@"), moe_id)


def year_month(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def span_of(series_uid: Column) -> Column:
    """Span of a series by its id: daily series end in ``-daily``, all others hold instant readings."""
    return F.when(series_uid.endswith("-daily"), "daily").otherwise("instant")
