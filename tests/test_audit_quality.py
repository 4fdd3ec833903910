from datetime import date, timedelta

from row_sets import rows
from pyspark.sql import functions as F

from gaugelake import schemas as S
from gaugelake.operators import audit, quality

AS_OF = "2024-01-31 06:00:00"


def fixture(make, obs):
    series = make(S.SERIES, *[{"series_uid": u, "station_uid": "x", "parameter": "Q", "interval": i, "units": "m"}
                              for u, i in (("w", "instant"), ("b", "instant"), ("d", "daily"))])
    readings = obs({"series_uid": "w", "datetime_utc": "2024-01-01 05:00:00"},  # before the window opens
                   {"series_uid": "w", "datetime_utc": "2024-01-02 00:00:00"},
                   {"series_uid": "w", "datetime_utc": "2024-01-02 08:00:00"},
                   {"series_uid": "w", "datetime_utc": "2024-01-31 00:00:00"},
                   {"series_uid": "b", "datetime_utc": "2024-01-05 00:00:00", "source": "bc"})
    return series, readings


def test_gap_scan(make, obs):
    series, readings = fixture(make, obs)
    gaps = {}
    for r in audit.gap_scan(readings, series, AS_OF).collect():
        gaps.setdefault(r.series_uid, set()).add(r.day)
    calendar = {date(2024, 1, 1) + timedelta(days=i) for i in range(31)}
    assert gaps == {"w": calendar - {date(2024, 1, 2), date(2024, 1, 31)}, "b": calendar}
    own = audit.gap_scan(readings, series, AS_OF, scope="source")
    assert rows(own.select("series_uid").distinct()) == [("w",)] and own.count() == 29


def test_findings_header_and_dedupe(make, obs):
    series, readings = fixture(make, obs)
    gaps = audit.gap_scan(readings, series, AS_OF)
    found = audit.discrepancies(gaps, 4, AS_OF)
    assert found.columns == S.AUDIT_DISCREPANCY.names
    station = make(S.STATION, {"station_uid": "1", "operator": "WSC", "wsc_id": "1"}, {"station_uid": "2", "operator": "WSC"})
    assert rows(audit.audit_header(station, gaps)) == [(1, 60)]
    handled = found.withColumn("action_taken", F.when(F.col("series_uid") == "b", "flagged"))
    assert rows(audit.new_only(found, handled).select("series_uid").distinct()) == [("b",)]
    assert audit.open_discrepancies(handled).count() == 29


def test_compare(obs):
    t = "2024-01-0"
    ours = obs({"series_uid": "a", "datetime_utc": t + "1", "grade_code": "1"},
               {"series_uid": "a", "datetime_utc": t + "2", "value": None},
               {"series_uid": "a", "datetime_utc": t + "3", "value": None},
               {"series_uid": "a", "datetime_utc": t + "5"})
    theirs = obs({"series_uid": "a", "datetime_utc": t + "1", "value": 2.0, "grade_code": "2"},
                 {"series_uid": "a", "datetime_utc": t + "2", "value": 3.0},
                 {"series_uid": "a", "datetime_utc": t + "3", "value": None},
                 {"series_uid": "a", "datetime_utc": t + "4", "value": 9.0})
    got = [(r.datetime_utc.day, r.kind, r.ours, r.theirs) for r in audit.compare(ours, theirs).collect()]
    assert sorted(got, key=repr) == [(1, "grade_change", 1.0, 2.0), (1, "value_mismatch", 1.0, 2.0),
                                     (2, "value_mismatch", None, 3.0), (4, "gap", None, 9.0)]


def test_constraints(make, obs):
    tables = {
        "station": make(S.STATION, {"station_uid": "1", "wsc_id": "7", "name": "n", "operator": "WSC", "status": "gone"},
                        {"station_uid": "2", "wsc_id": "7", "name": None, "operator": "BC"},
                        {"station_uid": "3", "operator": "ONA", "name": "n"}, {"station_uid": "4", "operator": "ONA", "name": "n"}),
        "series": make(S.SERIES, {"series_uid": "a", "station_uid": "1", "parameter": "GW", "interval": "weekly", "units": "m"},
                       {"series_uid": "b", "station_uid": "9", "parameter": "X", "interval": "daily", "units": "m"}),
        "observation": obs({"series_uid": "a", "datetime_utc": "2024-01-01", "grade_code": "999"},
                           {"series_uid": "a", "datetime_utc": "2024-01-01", "approval_level": "reviewed"},
                           {"series_uid": "z", "datetime_utc": "2024-01-01", "source": "usgs", "grade_code": "2"}),
        "pull_run": make(S.PULL_RUN, {"run_id": 1, "source": "x", "started_ts": "2024-01-01", "status": None}),
        "audit_log": make(S.AUDIT_LOG, {"audit_id": 1, "run_ts": "2024-01-01"}),
        "audit_discrepancy": make(S.AUDIT_DISCREPANCY, {"audit_id": 2, "detected_ts": "2024-01-01"}),
    }
    assert rows(quality.all_duplicate_keys(tables)) == [
        ("observation", "series_uid,datetime_utc,source", "a|2024-01-01 00:00:00|wsc", 2), ("station", "wsc_id", "7", 2)]
    assert rows(quality.all_orphans(tables)) == [
        ("audit_discrepancy.audit_id", "2", 1), ("observation.grade_code", "999", 1),
        ("observation.series_uid", "z", 1), ("series.station_uid", "9", 1)]
    assert rows(quality.domain_violations(tables)) == [
        ("observation.source", "usgs", 1), ("series.interval", "weekly", 1), ("series.parameter", "X", 1),
        ("station.status", "gone", 1)]
    assert {r[0]: r[1] for r in rows(quality.null_counts(tables)) if r[1]} == {"station.name": 1}


def test_duplicate_keys_are_counted_over_more_tasks_as_rows_grow(obs, monkeypatch):
    monkeypatch.setattr(quality, "ROWS_A_TASK", 10)
    many = obs(*({"series_uid": f"s{i % 24}", "datetime_utc": "2024-01-01"} for i in range(25)), {"series_uid": None}, {"series_uid": None})
    found = quality.duplicate_keys(many.withColumn("source", F.lit("bc")), "observation", ["series_uid", "datetime_utc", "source"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and ", 3), REPARTITION_BY_NUM" in plan
    assert {r.key: r.n for r in found.collect()} == {"s0|2024-01-01 00:00:00|bc": 2, "||bc": 2}
