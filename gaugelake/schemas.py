"""Explicit table schemas, key columns, value domains and lookup rows.

All times are wall-clock UTC in ``TIMESTAMP_NTZ`` columns, so no result depends
on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _D, _L, _I, _B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
_DATE, _TS = T.DateType(), T.TimestampNTZType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


POINT = _struct(("lon", _D), ("lat", _D))

STATION = _struct(
    ("station_uid", _S), ("wsc_id", _S), ("bc_aquarius_loc_id", _S), ("ona_id", _S),
    ("name", _S), ("operator", _S), ("status", _S), ("station_type", _S),
    ("geom", POINT), ("lat", _D), ("lon", _D), ("elevation_m", _D),
    ("gauge_datum", _S), ("datum_notes", _S), ("drainage_area_km2", _D),
    ("regulation_status", _S), ("basin", _S), ("install_date", _DATE),
    ("discontinue_date", _DATE), ("telemetry_type", _S), ("goes_dcp_id", _S), ("notes", _S),
)

SERIES = _struct(
    ("series_uid", _S), ("station_uid", _S), ("parameter", _S), ("units", _S),
    ("interval", _S), ("method", _S), ("sensor_model", _S), ("sensor_install_date", _DATE),
    ("time_zone", _S), ("source_series_id", _S),
)

OBSERVATION = _struct(
    ("series_uid", _S), ("datetime_utc", _TS), ("value", _D), ("grade_code", _S),
    ("approval_level", _S), ("qualifier_flags", T.ArrayType(_S)), ("estimate_flag", _B),
    ("ice_flag", _B), ("source", _S), ("pull_run_id", _L), ("ingest_ts", _TS),
)

# Readings counted per series, source and approval level inside one folder of the archive.
PARTIAL = _struct(
    ("series_uid", _S), ("source", _S), ("approval_level", _S), ("span", _S), ("ym", T.IntegerType()), ("bucket", T.IntegerType()),
    ("n", _L), ("first_ts", _TS), ("last_ts", _TS),
)

PULL_RUN = _struct(
    ("run_id", _L), ("source", _S), ("started_ts", _TS), ("finished_ts", _TS),
    ("rows_in", _L), ("status", _S), ("error", _S),
)

AUDIT_LOG = _struct(
    ("audit_id", _L), ("run_ts", _TS), ("scope", _S), ("stations_checked", _L),
    ("discrepancies", _L), ("notes", _S),
)

AUDIT_DISCREPANCY = _struct(
    ("audit_id", _L), ("series_uid", _S), ("datetime_utc", _TS), ("kind", _S),
    ("ours", _D), ("theirs", _D), ("action_taken", _S), ("detected_ts", _TS),
)

CANONICAL = _struct(
    ("series_uid", _S), ("datetime_utc", _TS), ("value", _D), ("grade_code", _S), ("approval_level", _S),
    ("authoritative_source", _S), ("last_reconciled_ts", _TS),
)
CORRECTION = _struct(
    ("correction_id", _L), ("series_uid", _S), ("applied_from", _TS), ("applied_to", _TS), ("correction_type", _S),
    ("description", _S), ("applied_by", _S), ("applied_ts", _TS),
)
RATING = _struct(
    ("rating_uid", _S), ("station_uid", _S), ("rating_version", _S), ("effective_from", _TS), ("effective_to", _TS),
    ("equation_params", _S), ("offset", _D), ("notes", _S),
)
MEASUREMENT = _struct(
    ("measurement_uid", _S), ("station_uid", _S), ("datetime_utc", _TS), ("measured_q", _D), ("stage_h", _D), ("method", _S),
    ("party", _S), ("quality", _S), ("rating_deviation_pct", _D),
)

QUARANTINE = _struct(
    ("run_id", _L), ("pulled_at", _TS), ("pulled_from", _S), ("kind", _S), ("reason", _S), ("body", _S), ("nth", _L),
    ("dataset", _S), ("status", _S), ("changed_ts", _TS),
)

# Input shapes.
GEOJSON_PAGE = _struct(
    ("features", T.ArrayType(_struct(("properties", _struct(
        ("STATION_NUMBER", _S), ("DATETIME", _S), ("LEVEL", _D), ("DISCHARGE", _D),
        ("LEVEL_SYMBOL_EN", _S), ("DISCHARGE_SYMBOL_EN", _S),
    ))))),
)
WIDE_PULL = _struct(
    ("STATION_NUMBER", _S), ("DATETIME", _S), ("LEVEL", _D), ("DISCHARGE", _D),
    ("LEVEL_SYM", _S), ("DISCHARGE_SYM", _S),
)
DAILY_HISTORY = _struct(("STATION_NUMBER", _S), ("Date", _DATE), ("Value", _D), ("Symbol", _S))
STATION_META = _struct(
    ("STATION_NUMBER", _S), ("DRAINAGE_AREA_GROSS", _D), ("LATITUDE", _D), ("LONGITUDE", _D),
)
STATION_REGULATION = _struct(("STATION_NUMBER", _S), ("REGULATED", _B))
STATION_NETWORK = _struct(
    ("STATION_NUMBER", _S), ("STATION_NAME", _S), ("LATITUDE", _D), ("LONGITUDE", _D),
)
STATION_REGISTRY = _struct(
    ("station_uid", _S), ("wsc_id", _S), ("bc_aquarius_loc_id", _S), ("ona_id", _S),
    ("name", _S), ("operator", _S), ("status", _S), ("lat", _D), ("lon", _D),
    ("basin", _S), ("telemetry_type", _S), ("goes_dcp_id", _S),
)
DATASET_REGISTRY = _struct(
    ("moe_id", _S), ("name", _S), ("lat", _D), ("lon", _D), ("parameter", _S),
    ("label", _S), ("unit_id", _I), ("canon", _S), ("units", _S),
)
EXPORT_ROW = _struct(("ts", _S), ("value", _S), ("grade", _S), ("approval", _S), ("qualifier", _S))
STAGED_OBS = _struct(
    ("series_uid", _S), ("datetime_utc", _S), ("value", _D), ("grade_code", _S),
    ("approval_level", _S), ("qualifier_flags", _S), ("source", _S), ("pull_run_id", _L),
)

OBSERVATION_KEY = ["series_uid", "datetime_utc", "source"]
PRIMARY_KEYS = {
    "station": ["station_uid"],
    "series": ["series_uid"],
    "observation": OBSERVATION_KEY,
    "pull_run": ["run_id"],
    "audit_log": ["audit_id"],
}
UNIQUE_KEYS = {
    "station": [["wsc_id"], ["bc_aquarius_loc_id"]],
    "series": [["station_uid", "parameter", "interval", "source_series_id"]],
}
NOT_NULL = {
    "station": ["station_uid", "name", "operator"],
    "series": ["series_uid", "station_uid", "parameter", "units", "interval"],
    "observation": ["series_uid", "datetime_utc", "source", "ingest_ts"],
    "pull_run": ["run_id", "source", "started_ts"],
    "audit_log": ["audit_id", "run_ts"],
    "audit_discrepancy": ["detected_ts"],
}

# Rules of the declared tables that no job fills, which hold at the gate (:mod:`.operators.gate`) with those above.
DECLARED_KEYS = {
    "observation_canonical": ["series_uid", "datetime_utc"], "correction_history": ["correction_id"],
    "rating_curve": ["rating_uid"], "discharge_measurement": ["measurement_uid"],
    "grade_code": ["grade_code"], "approval_level": ["approval_level"], "qualifier_code": ["qualifier_code"],
}
DECLARED_NOT_NULL = {
    "observation_canonical": ["series_uid", "datetime_utc", "authoritative_source", "last_reconciled_ts"],
    "correction_history": ["correction_id", "series_uid"], "rating_curve": ["rating_uid", "station_uid"],
    "discharge_measurement": ["measurement_uid", "station_uid", "datetime_utc"],
    "grade_code": ["grade_code", "authority"], "approval_level": ["approval_level", "rank"], "qualifier_code": ["qualifier_code", "authority"],
}
# Column, and the table it refers to by that table's key of one column.
REFERENCES = {
    "series": {"station_uid": "station"},
    "observation": {"series_uid": "series", "grade_code": "grade_code", "approval_level": "approval_level"},
    "audit_discrepancy": {"audit_id": "audit_log", "series_uid": "series"},
    "observation_canonical": {"series_uid": "series", "grade_code": "grade_code", "approval_level": "approval_level"},
    "correction_history": {"series_uid": "series"},
    "rating_curve": {"station_uid": "station"},
    "discharge_measurement": {"station_uid": "station"},
}

# Allowed members of the constrained columns (NULL always passes).
DOMAINS = {
    "station": {
        "operator": ["ONA", "WSC", "BC", "OTHER"],
        "status": ["active", "discontinued", "seasonal", "unknown"],
        "regulation_status": ["natural", "regulated", "unknown"],
    },
    "series": {
        "parameter": ["Q", "H", "Tw", "COND", "GW", "OTHER"],
        "interval": ["instant", "hourly", "daily"],
    },
    "observation": {"source": ["wsc", "bc", "ona", "goes"]},
    "pull_run": {"status": ["running", "ok", "partial", "error"]},
}

# Approval levels with their reconciliation rank.
APPROVAL_LEVELS = [
    ("approved", 30, "QAQC complete, published as final/approved"),
    ("reviewed", 25, "QAQC reviewed (AQUARIUS 950), not yet final/approved"),
    ("in_review", 20, "Under QAQC review"),
    ("working", 10, "Raw/provisional, no QAQC"),
    ("unspecified", 0, "Source did not specify"),
]

# Export approval codes.
APPROVAL_CODES = {"1200": "approved", "950": "reviewed", "900": "in_review", "800": "working"}

# Order in which approval levels are shown.
APPROVAL_DISPLAY_ORDER = ["working", "in_review", "reviewed", "approved", "unspecified"]

# Qualifier symbols.
QUALIFIER_CODES = [
    ("E", "wsc", "estimate", "Estimated value"),
    ("A", "wsc", "partial", "Partial day"),
    ("B", "wsc", "ice", "Ice conditions / backwater"),
    ("D", "wsc", "dry", "Dry"),
    ("R", "wsc", "revised", "Revised"),
]

# Grade legend.
GRADE_CODES = [
    ("-3", "aquarius", "GAP", "Gap"),
    ("-2", "aquarius", "UNUSABLE", "Unusable"),
    ("-1", "aquarius", "UNSPECIFIED", "Unspecified"),
    ("0", "aquarius", "UNDEF", "Undefined"),
    ("1", "aquarius", "GRADE 1", "Numeric grade 1 (not in the published Aquarius legend)"),
    ("2", "aquarius", "GRADE 2", "Numeric grade 2 (not in the published Aquarius legend)"),
    ("11", "aquarius", "POOR", "Poor"),
    ("21", "aquarius", "ESTIMATED", "Estimated"),
    ("25", "aquarius", "BEST PRACTICE", "Best practice"),
    ("31", "aquarius", "GOOD", "Good"),
    ("41", "aquarius", "VERYGOOD", "Very good"),
    ("51", "aquarius", "EXCELLENT", "Excellent"),
    ("100", "aquarius", "RISC U", "RISC unknown"),
    ("121", "aquarius", "RISC E", "RISC estimated"),
    ("125", "aquarius", "RISC BP", "RISC best practice"),
    ("131", "aquarius", "RISC C", "RISC C"),
    ("141", "aquarius", "RISC B", "RISC B"),
    ("151", "aquarius", "RISC A", "RISC A"),
    ("161", "aquarius", "RISC A/RS", "RISC A rated structure"),
]

# Display names of parameters; others pass through unchanged.
PARAMETER_LABELS = {
    "Q": "Discharge", "H": "Stage", "Tw": "Water temp", "COND": "Conductivity", "GW": "Groundwater",
}


def approval_levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(APPROVAL_LEVELS, "approval_level string, rank int, description string")


def qualifier_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        QUALIFIER_CODES, "qualifier_code string, authority string, label string, description string")


def grade_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        GRADE_CODES, "grade_code string, authority string, label string, description string")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: absent columns become typed NULLs."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
