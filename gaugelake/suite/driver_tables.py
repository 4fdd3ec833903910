"""The archive's tables as expressions over the driver's parquet tables.

Suppliers stand for provincial stations with line items as their readings, event users for
federal stations with events as instant and orders as daily readings. Every row of a table takes
part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import merge
from ..plans.archive import Archive
from ..session import workspace
from ..sinks import tables as sink

EVENTS_AS_OF = "2024-01-31 00:00:00"
BC_AS_OF = "2001-11-06 00:00:00"
INGEST_TS = "2024-02-01 00:00:00"

# Later pulls win; the further columns make the order total.
ORDER = ["pull_run_id", "ord_line", "ord_part", "ord_price", "value"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(column: str, mapping: dict, default=None):
    out = F.lit(default)
    for key, value in mapping.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


BC_PARAMETER = "CASE WHEN l_suppkey % 4 = 0 THEN 'GW' WHEN l_linenumber % 2 = 1 THEN 'H' ELSE 'Q' END"
APPROVAL_CODE = ("CASE WHEN l_linestatus = 'F' THEN '1200' WHEN l_linenumber % 4 = 0 THEN '950' "
                 "WHEN l_linenumber % 4 = 1 THEN '900' WHEN l_linenumber % 4 = 2 THEN '800' ELSE '7' END")
GRADE = "CASE l_returnflag WHEN 'A' THEN '151' WHEN 'R' THEN '21' ELSE '' END"
EVENT_PARAMETER = {"view": "H", "click": "Q", "purchase": "Tw", "signup": "COND", "error": "OTHER"}
UNITS = {"Q": "m3/s", "H": "m", "GW": "m", "Tw": "degC", "COND": "uS/cm"}


def bc_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = F.col("l_suppkey").cast("string")
    rows = load(spark, sf_dir, "lineitem").withColumn("parameter", F.expr(BC_PARAMETER))
    return rows.select(
        C.bc_series_uid(supp, F.col("parameter")).alias("series_uid"),
        C.bc_station_uid(supp).alias("station_uid"), "parameter", F.lit("instant").alias("interval"),
        F.concat(F.col("parameter"), F.lit(".Working@"), supp).alias("source_series_id"),
        F.col("l_shipdate").alias("datetime_utc"), F.col("l_quantity").alias("value"),
        C.null_if_empty(F.expr(GRADE)).alias("grade_code"),
        C.approval_from_code(F.expr(APPROVAL_CODE)).alias("approval_level"),
        F.lit(None).cast("string").alias("qflag"), F.lit("bc").alias("source"),
        F.col("l_orderkey").alias("pull_run_id"), F.col("l_linenumber").alias("ord_line"),
        F.col("l_partkey").alias("ord_part"), F.col("l_extendedprice").alias("ord_price"))


def wsc_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    rows = (load(spark, sf_dir, "events")
            .withColumn("parameter", _case("event_type", EVENT_PARAMETER))
            .withColumn("k", F.get_json_object("props", "$.k").cast("int") % 6))
    return _wsc_ids(rows, user, "instant").select(
        "series_uid", "station_uid", "parameter", "interval", "source_series_id",
        F.col("ts").alias("datetime_utc"), "value", F.lit(None).cast("string").alias("grade_code"),
        F.lit("working").alias("approval_level"),
        _case("k", {1: "", 2: "E", 3: "A", 4: "B", 5: "D"}).cast("string").alias("qflag"),
        F.lit("wsc").alias("source"), F.col("event_id").alias("pull_run_id"), *_no_order())


def daily_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = load(spark, sf_dir, "events").select(F.col("user_id").alias("o_custkey")).distinct()
    rows = load(spark, sf_dir, "orders").join(users, "o_custkey", "left_semi").withColumn("parameter", F.lit("Q"))
    return _wsc_ids(rows, F.col("o_custkey").cast("string"), "daily").select(
        "series_uid", "station_uid", "parameter", "interval", "source_series_id",
        F.col("o_orderdate").alias("datetime_utc"), F.col("o_totalprice").alias("value"),
        F.lit(None).cast("string").alias("grade_code"), F.lit("approved").alias("approval_level"),
        F.lit(None).cast("string").alias("qflag"), F.lit("wsc").alias("source"),
        F.col("o_orderkey").alias("pull_run_id"), *_no_order())


def _wsc_ids(rows: DataFrame, station, interval: str) -> DataFrame:
    parameter = F.col("parameter")
    return rows.withColumns({
        "series_uid": C.wsc_series_uid(station, parameter, interval),
        "station_uid": C.wsc_station_uid(station),
        "interval": F.lit(interval),
        "source_series_id": C.wsc_source_series_id(C.wsc_station_uid(station), parameter, interval),
    })


def _no_order() -> list:
    return [F.lit(0).alias("ord_line"), F.lit(0).cast("long").alias("ord_part"),
            F.lit(0.0).alias("ord_price")]


def as_observations(leg: DataFrame, *extra: str) -> DataFrame:
    obs = leg.select(
        "series_uid", "datetime_utc", "value", "grade_code", "approval_level",
        C.qualifier_array(F.col("qflag")).alias("qualifier_flags"),
        F.lit(False).alias("estimate_flag"), F.lit(False).alias("ice_flag"), "source", "pull_run_id",
        C.instant(INGEST_TS).alias("ingest_ts"), *extra)
    return obs


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (bc_leg(spark, sf_dir).unionByName(wsc_leg(spark, sf_dir))
            .unionByName(daily_leg(spark, sf_dir)))


def station(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    key = F.col("s_suppkey")
    place = F.when(key % 10 != 0, 1)
    bc = load(spark, sf_dir, "supplier").join(nation, "s_nationkey", "left").select(
        C.bc_station_uid(key.cast("string")).alias("station_uid"),
        key.cast("string").alias("bc_aquarius_loc_id"), F.col("s_name").alias("name"),
        F.lit("BC").alias("operator"), F.lit("active").alias("status"),
        F.when(key % 4 == 0, "groundwater_well").when(key % 4 != 1, "stream").alias("station_type"),
        (place * (F.lit(49.0) + (key % 100) / 100.0)).alias("lat"),
        (place * (F.lit(-119.0) - (key % 37) / 37.0)).alias("lon"),
        F.col("s_acctbal").alias("drainage_area_km2"), F.col("n_name").alias("basin"))
    bc = bc.withColumn("geom", C.point(F.col("lon"), F.col("lat")))
    users = load(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    names = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    user = F.col("c_custkey").cast("string")
    wsc = users.join(names, "c_custkey", "left").select(
        C.wsc_station_uid(user).alias("station_uid"), user.alias("wsc_id"), F.col("c_name").alias("name"),
        F.lit("WSC").alias("operator"), F.lit("active").alias("status"))
    return S.conform(bc, S.STATION).unionByName(S.conform(wsc, S.STATION))


def series_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids that rows of :func:`staged` have, made once a series and not once a reading."""
    supp, user, cust = (F.col(c).cast("string") for c in ("l_suppkey", "user_id", "o_custkey"))
    bc = load(spark, sf_dir, "lineitem").select("l_suppkey", F.expr(BC_PARAMETER).alias("parameter")).distinct().select(
        C.bc_series_uid(supp, F.col("parameter")).alias("series_uid"), C.bc_station_uid(supp).alias("station_uid"), "parameter",
        F.lit("instant").alias("interval"), F.concat(F.col("parameter"), F.lit(".Working@"), supp).alias("source_series_id"))
    events = load(spark, sf_dir, "events").select("user_id", _case("event_type", EVENT_PARAMETER).alias("parameter")).distinct()
    users = load(spark, sf_dir, "events").select(F.col("user_id").alias("o_custkey")).distinct()
    orders = load(spark, sf_dir, "orders").select("o_custkey").distinct().join(users, "o_custkey", "left_semi").withColumn("parameter", F.lit("Q"))
    return (bc.unionByName(_wsc_ids(events, user, "instant").select(bc.columns))
            .unionByName(_wsc_ids(orders, cust, "daily").select(bc.columns)))


def series(staged_rows: DataFrame) -> DataFrame:
    found = staged_rows.select("series_uid", "station_uid", "parameter", "interval", "source_series_id").distinct()
    return S.conform(found.withColumn("units", _case("parameter", UNITS, "n/a"))
                     .withColumn("time_zone", F.lit("UTC")), S.SERIES)


def _finished():
    return F.expr("timestampadd(MICROSECOND, cast(round(o_totalprice * 1000000) as bigint), o_orderdate)")


def pull_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("source"),
        F.col("o_orderdate").alias("started_ts"),
        F.when(F.col("o_orderstatus") != "O", _finished()).alias("finished_ts"),
        F.col("o_custkey").alias("rows_in"),
        _case("o_orderstatus", {"F": "ok", "O": "running", "P": "partial"}).alias("status"),
        F.lit(None).cast("string").alias("error"))


_AUDIT_ID = "cast(floor(datediff(o_orderdate, date'1990-01-01') / 7) as bigint)"


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit per week of orders."""
    return load(spark, sf_dir, "orders").groupBy(F.expr(_AUDIT_ID).alias("audit_id")).agg(
        F.max(_finished()).alias("run_ts"), F.lit("weekly wsc coverage").alias("scope"),
        F.count_distinct("o_custkey").alias("stations_checked"),
        F.count_if(F.col("o_orderstatus") != "F").alias("discrepancies"),
        F.lit("realtime 30d gap scan").alias("notes"))


def audit_discrepancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select(
        F.expr(_AUDIT_ID).alias("audit_id"),
        C.wsc_series_uid(F.col("o_custkey").cast("string"), F.lit("Q"), "daily").alias("series_uid"),
        F.col("o_orderdate").alias("datetime_utc"),
        F.expr("CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'value_mismatch' "
               "WHEN '2' THEN 'grade_change' ELSE 'gap' END").alias("kind"),
        F.col("o_totalprice").alias("ours"),
        _case("o_orderstatus", {"F": "backfilled", "P": "flagged"}).cast("string").alias("action_taken"),
        F.col("o_orderdate").alias("detected_ts"))
    return S.conform(rows, S.AUDIT_DISCREPANCY)


_roots: dict[tuple[str, str], tuple[str, dict[str, DataFrame]]] = {}
_archives: dict[tuple[str, str], dict[str, DataFrame]] = {}


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The archive's tables but its observations, for queries that read no reading of it. Written once per application, and
    the archive, where it is asked for too, is built around them."""
    return _dimensions(spark, sf_dir)[1]


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roots or not sink.exists(spark, f"{_roots[key][0]}/station"):
        root = workspace(spark, "archive")
        _roots[key] = (root, build_dimensions(spark, sf_dir, root))
    return _roots[key]


def archive(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The archive built from ``sf_dir``: written once per application, then scanned by reports."""
    key = (spark.sparkContext.applicationId, sf_dir)
    root, tables = _dimensions(spark, sf_dir)
    if key not in _archives or not sink.exists(spark, f"{root}/observation"):
        _archives[key] = {"observation": build_observations(spark, sf_dir, root), **tables}
    return _archives[key]


def build(spark: SparkSession, sf_dir: str, root: str | None = None) -> dict[str, DataFrame]:
    root = root or workspace(spark, "archive")
    return {"observation": build_observations(spark, sf_dir, root), **build_dimensions(spark, sf_dir, root)}


def build_observations(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    store = Archive(spark, root, buckets=1)  # a month here is a few thousand rows
    columns = [f.name for f in S.OBSERVATION.fields]
    unique = merge.last_of_batch(as_observations(staged(spark, sf_dir), "ord_line", "ord_part", "ord_price"),
                                 S.OBSERVATION_KEY, ORDER, columns)
    store.write_observations(unique)
    return store.read("observation")


def build_dimensions(spark: SparkSession, sf_dir: str, root: str) -> dict[str, DataFrame]:
    store = Archive(spark, root, buckets=1)
    store.write_dimension("series", series(series_rows(spark, sf_dir)))
    store.write_dimension("station", station(spark, sf_dir))
    return {name: store.read(name) for name in ("series", "station")} | {
        "pull_run": pull_run(spark, sf_dir), "audit_log": audit_log(spark, sf_dir),
        "audit_discrepancy": audit_discrepancy(spark, sf_dir),
    }
