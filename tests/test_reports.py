from datetime import date, datetime

import pytest
from row_sets import rows

from gaugelake import schemas as S
from gaugelake.operators import rollup
from gaugelake.plans import reports


@pytest.fixture(scope="module")
def t(make, obs):
    """Three provincial stations (one of unknown type, one a well), one federal, one childless."""
    station = make(S.STATION,
                   {"station_uid": "BC-1", "bc_aquarius_loc_id": "1", "name": "one", "operator": "BC", "lat": 49.0, "lon": -119.0},
                   {"station_uid": "BC-2", "bc_aquarius_loc_id": "2", "name": "two", "operator": "BC",
                    "station_type": "groundwater_well", "lat": 49.5, "lon": -119.5},
                   {"station_uid": "BC-3", "bc_aquarius_loc_id": "3", "name": "three", "operator": "OTHER", "station_type": "stream"},
                   {"station_uid": "WSC-1", "wsc_id": "1", "name": "fed", "operator": "WSC"},
                   {"station_uid": "WSC-2", "wsc_id": "2", "name": "bare", "operator": "WSC", "lat": 50.0, "lon": -119.0})
    s = [("b1h", "BC-1", "H", "instant"), ("b1q", "BC-1", "Q", "instant"), ("b2g", "BC-2", "GW", "instant"),
         ("b3h", "BC-3", "H", "instant"), ("w1q", "WSC-1", "Q", "daily"), ("w1x", "WSC-1", "H", "instant")]
    series = make(S.SERIES, *[{"series_uid": a, "station_uid": b, "parameter": c, "interval": d, "units": "m"} for a, b, c, d in s])

    def o(series_uid, ts, approval=None, source="bc", value=1.0):
        return {"series_uid": series_uid, "datetime_utc": ts, "approval_level": approval, "source": source, "value": value}
    observation = obs(
        # Gaps of exactly one day, then of a day and a microsecond on both series of the station.
        o("b1h", "2023-12-30 00:00:00", "approved"), o("b1h", "2023-12-31 00:00:00", "reviewed"),
        o("b1h", "2024-01-01 00:00:00.000001", "working"),
        o("b1q", "2023-12-30 12:00:00"), o("b1q", "2024-01-01 12:00:00.000001"),
        o("b3h", "2024-01-05 00:00:00", "approved"),
        o("b2g", "2024-01-01 00:00:00", "approved"), o("b2g", "2024-01-02 00:00:00", "reviewed"),
        o("b2g", "2024-01-03 00:00:00", "approved", "ona"),
        o("w1q", "2024-01-01 00:00:00", "approved", "wsc"), o("w1q", "2024-01-02 00:00:00", "working", "wsc", 2.0),
        o("w1q", "2024-01-02 00:00:00", "approved", "goes", 3.0))
    runs = make(S.PULL_RUN, {"run_id": 1, "source": "x", "started_ts": "2024-01-01", "finished_ts": "2024-01-01 00:00:01.5", "status": "ok", "rows_in": 5},
                {"run_id": 2, "source": "x", "started_ts": "2023-12-05", "finished_ts": "2024-01-09", "status": "error"})
    audits = make(S.AUDIT_LOG, {"audit_id": 1, "run_ts": "2024-01-01 00:00:00.4"})
    found = make(S.AUDIT_DISCREPANCY, {"audit_id": 1, "kind": "gap"}, {"audit_id": 1, "kind": "gap", "action_taken": "flagged"})
    return {"station": station, "series": series, "observation": observation, "pull_run": runs,
            "audit_log": audits, "audit_discrepancy": found}


def test_kpi(t):
    assert rows(reports.kpi_overview(t, "2024-01-04")) == [
        (12, 5, 6, 3, datetime(2024, 1, 5), datetime(2024, 1, 1, 0, 0, 1, 500000), 1, 1)]


def test_histogram_start_is_exclusive(t):
    got = dict(rows(reports.obs_per_day(t, "2024-02-29", 60)))
    assert date(2023, 12, 31) not in got and got[date(2024, 1, 1)] == 4 and sum(got.values()) == 9
    assert rows(reports.obs_per_day(t, "2024-01-02", by="ingest_ts")) == [(date(2024, 1, 1), 12)]


def test_coverage(t):
    got = {r[:3]: r[3:] for r in rows(reports.coverage(t))}
    assert got[("GW", "instant", "bc")] == (2, 1, date(2024, 1, 1), date(2024, 1, 2))
    assert got[("H", "instant", "bc")][:2] == (4, 2)
    assert ("H", "instant", "wsc") not in got
    assert rows(reports.coverage_by_parameter(t)) == [
        ("GW", "Groundwater", 3), ("H", "Stage", 4), ("Q", "Discharge", 5)]
    assert ("GOES · Discharge (daily)", "GOES", date(2024, 1, 2), date(2024, 1, 2), 1, 0) in rows(reports.coverage_timeline(t))


def test_freshness(t):
    got = rows(reports.freshness_by_source(t, "2024-01-04 00:00:00"), "source", "hours", "colour")
    assert got == [("BC groundwater", 24.0, "green"), ("BC surface", -24.0, "green"), ("GOES", 48.0, "amber"), ("WSC", 48.0, "amber")]


def test_childless_stations_are_listed(t):
    got = {r[0]: r[1:] for r in rows(reports.station_summary(t), "station_uid", "obs", "latest")}
    assert len(got) == 5 and got["WSC-2"] == (0, None) and got["WSC-1"] == (3, datetime(2024, 1, 2))
    placed = {r[0]: r[1:] for r in rows(reports.station_map(t, "2024-01-04"), "station_uid", "hours_old", "colour")}
    assert placed == {"BC-1": (60.0, "red"), "BC-2": (24.0, "green"), "WSC-2": (None, "grey")}


def test_network_audit(t):
    # The station of unknown type counts, the well and the other operator's do not.
    assert rows(reports.network_audit_status(t, "2024-01-04 00:00:00")) == [
        ("1", "one", "H, Q", 2, 5, date(2023, 12, 30), date(2024, 1, 1), 40.0, 2, "Partially reviewed", "Current")]
    assert rows(reports.network_totals(t, "2024-01-04")) == [(1, 5, 40.0, date(2024, 1, 1))]
    assert rows(reports.audit_status_summary(t, "2024-02-04")) == [(1, 2, 0, 1, date(2023, 12, 30), date(2024, 1, 1))]


def test_weighted_percent_uses_rounded_shares(spark):
    from pyspark.sql import functions as F

    from gaugelake.functions import columns as C
    df = spark.createDataFrame([(3, 33.3), (1, None), (6, 66.7)], "points long, pct double")
    assert df.agg(C.weighted_percent(F.col("points"), F.col("pct")).alias("p")).first().p == 50.0


def test_approval_by_station(t):
    got = rows(reports.approval_by_station(t))
    assert ("one", "unspecified", 2, 5, 5) in got and ("one", "approved", 1, 5, 4) in got and len(got) == 4


def test_network_year(t):
    # One visit: both series of the station paused before 2024-01-01; exactly a day is no pause.
    # Any operator counts here.
    assert rows(reports.network_year(t)) == [(2023, 1, 3, 0), (2024, 2, 3, 1)]
    assert len(rows(reports.network_year_long(t))) == 4
    assert rows(reports.network_year_table(t))[0][-2:] == ("pending", "Provisional")
    assert rows(reports.station_year_heatmap(t)) == [("one", 2023, 3, 5), ("one", 2024, 2, 5), ("three", 2024, 1, 1)]


def test_wells(t):
    # All sources count; 'reviewed' is not approved.
    assert rows(reports.gw_wells(t, "2024-01-10"), "well", "points", "pct_approved", "days_stale") == [("2", 3, 66.7, 7)]
    assert rows(reports.gw_totals(t, "2024-01-10")) == [(1, 3, 66.7, 2024, 2024)]
    assert rows(reports.gw_map(t, "2024-02-10"), "colour") == [("amber",)]


def test_latest_keeps_ties(t):
    got = [r for r in rows(reports.latest_per_series(t), "station_uid", "parameter", "value", "approval_level") if r[0] == "WSC-1"]
    assert got == [("WSC-1", "Q", 2.0, "working"), ("WSC-1", "Q", 3.0, "approved")]


def test_small_reports(t):
    assert len(rows(reports.daily_means(t))) == 3
    assert rows(reports.daily_record_span(t)) == [(date(2024, 1, 1), date(2024, 1, 2))]
    assert rows(reports.longest_records(t)) == [("w1q", date(2024, 1, 1), date(2024, 1, 2))]
    assert rows(reports.stations_with_series(t)) == [(5, 1)]
    assert rows(reports.load_verify(t)) == [(5, 6, 12)]
    assert rows(reports.recent_runs(t, 1), "run_id") == [(2,)]
    assert (1, datetime(2024, 1, 1, 0, 0, 2)) in rows(reports.recent_runs(t), "run_id", "finished")
    assert rows(reports.recent_audits(t), "run_ts") == [(datetime(2024, 1, 1),)]
    assert rows(reports.coverage_interval(t), "parameter", "interval", "obs") == [
        ("GW", "instant", 3), ("H", "instant", 4), ("Q", "daily", 3), ("Q", "instant", 2)]
    assert rows(reports.coverage_firstcut(t), "parameter", "obs", "series") == [("GW", 3, 1), ("H", 4, 2), ("Q", 5, 2)]


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
def test_reading_gaps_equal_a_plain_lag(spark, bucket):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    # One series holds most readings; irregular steps, some buckets empty, ties across sources.
    obs = spark.range(3000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("series_uid"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id * id * 7919) % 9000000)").alias("datetime_utc"),
        F.when(F.col("id") % 2 == 0, "bc").otherwise("ona").alias("source")).distinct()
    w = Window.partitionBy("series_uid").orderBy("datetime_utc", "source")
    want = obs.select("series_uid", "datetime_utc", "source", (F.timestamp_diff(
        "MICROSECOND", F.lag("datetime_utc").over(w), F.col("datetime_utc")) / 1e6).alias("gap_seconds"))
    assert rows(rollup.reading_gaps(obs, bucket)) == rows(want)


def test_days_after_gap_equal_a_plain_lag(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    obs = spark.range(500).select(
        (F.col("id") % 3).cast("string").alias("series_uid"), F.lit(None).cast("string").alias("approval_level"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id * id * 7919) % 30000000)").alias("datetime_utc"))
    w = Window.partitionBy("series_uid").orderBy("datetime_utc")
    gap = F.col("datetime_utc") - F.lag("datetime_utc").over(w)
    want = (obs.withColumn("g", gap).filter(F.col("g") > F.expr("INTERVAL 1 DAY"))
            .select("series_uid", F.to_date("datetime_utc").alias("day")).distinct())
    got = rollup.days_with_gap_before(obs).filter("after_gap").select("series_uid", "day")
    assert rows(got) == rows(want) and len(rows(got)) > 20


def test_reading_gaps_carry_one_reading_a_month(obs):
    """Nothing moves per day: two months with readings of every day carry one reading between them."""
    days = [f"2024-{month:02}-{day:02}" for month in (1, 2) for day in range(1, 29)]
    gaps = rollup.reading_gaps(obs(*({"series_uid": "a", "datetime_utc": day} for day in days)))
    plan = gaps._jdf.queryExecution().optimizedPlan().toString()
    assert "date_trunc(month" in plan and "date_trunc(day" not in plan
    assert sorted(r.gap_seconds for r in gaps.collect() if r.gap_seconds) == [86400] * 54 + [4 * 86400]
