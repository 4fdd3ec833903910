"""Constraints as a gate before a write, and the downloads and registry jobs."""

from datetime import datetime

import pytest
from row_sets import rows

from gaugelake import schemas as S
from gaugelake.operators import gate
from gaugelake.plans import downloads, jobs
from gaugelake.plans.archive import Archive

AS_OF = datetime(2024, 1, 31, 12)


def reasons(batch, table, committed, key):
    return dict(rows(gate.tagged(batch, table, committed), key, "reason"))


def test_rules_in_order(make):
    station = make(S.STATION, {"station_uid": "A", "name": "a", "operator": "WSC", "wsc_id": "1"})
    batch = make(S.STATION, {"station_uid": "B", "name": "b", "operator": "WSC", "wsc_id": "1"},  # A's id
                 {"station_uid": "A", "name": "new", "operator": "WSC", "wsc_id": "1"},  # an update of A
                 {"station_uid": "C", "name": None, "operator": "XX"}, {"station_uid": "D", "name": "d", "operator": "XX"},
                 {"station_uid": "E", "name": "e", "operator": "BC", "bc_aquarius_loc_id": "9"},
                 {"station_uid": "F", "name": "f", "operator": "BC", "bc_aquarius_loc_id": "9"},
                 {"station_uid": "G", "name": "g", "operator": "BC"}, {"station_uid": "H", "name": "h", "operator": "BC"})
    assert reasons(batch, "station", {"station": station}, "station_uid") == {
        "A": "unique wsc_id", "B": "unique wsc_id", "C": "null name", "D": "domain operator", "E": "unique bc_aquarius_loc_id",
        "F": "unique bc_aquarius_loc_id", "G": None, "H": None}
    assert gate.tagged(batch.limit(0), "station", {"station": station}).count() == 0


def test_a_key_twice_keeps_its_first_good_row(make):
    runs = make(S.PULL_RUN, {"run_id": 1, "source": "b", "started_ts": "2024-01-01"}, {"run_id": 1, "source": "c", "started_ts": "2024-01-01"},
                {"run_id": 1, "source": "a", "started_ts": "2024-01-01", "status": "odd"}, {"run_id": 1, "source": "b", "started_ts": "2024-01-01"})
    assert rows(gate.tagged(runs, "pull_run", {}), "source", "reason") == sorted(
        [("b", None), ("b", "duplicate key"), ("c", "duplicate key"), ("a", "domain status")], key=repr)


@pytest.mark.parametrize("table,schema,row,column", [
    ("observation_canonical", S.CANONICAL, {"series_uid": "s", "datetime_utc": "2024-01-01", "authoritative_source": "bc", "last_reconciled_ts": "2024-01-01"}, "series_uid"),
    ("correction_history", S.CORRECTION, {"correction_id": 1, "series_uid": "s"}, "series_uid"),
    ("rating_curve", S.RATING, {"rating_uid": "r", "station_uid": "t"}, "station_uid"),
    ("discharge_measurement", S.MEASUREMENT, {"measurement_uid": "m", "station_uid": "t", "datetime_utc": "2024-01-01"}, "station_uid"),
    ("series", S.SERIES, {"series_uid": "s", "station_uid": "t", "parameter": "Q", "units": "m", "interval": "daily"}, "station_uid"),
    ("audit_discrepancy", S.AUDIT_DISCREPANCY, {"audit_id": 5, "series_uid": "s", "detected_ts": "2024-01-01"}, "series_uid")])
def test_references(make, table, schema, row, column):
    parents = {"series": make(S.SERIES, {"series_uid": "s"}), "station": make(S.STATION, {"station_uid": "t"}), "audit_log": make(S.AUDIT_LOG, {"audit_id": 5})}
    batch = make(schema, row)
    assert [r.reason for r in gate.tagged(batch, table, parents).collect()] == [None]
    without = {k: v.limit(0) for k, v in parents.items()}
    found = gate.tagged(batch, table, without).first().reason
    assert found == ("reference audit_id" if table == "audit_discrepancy" else f"reference {column}")
    assert gate.tagged(make(schema, {k: v for k, v in row.items() if k != column}), table, parents).first().reason in (f"null {column}", None)


def test_checked_insert_keeps_what_it_refuses(spark, obs, make, tmp_path):
    archive = Archive(spark, str(tmp_path / "archive"))
    archive.write_dimension("series", make(S.SERIES, {"series_uid": "a", "station_uid": "t"}))
    good = {"series_uid": "a", "datetime_utc": "2024-01-01", "grade_code": "31"}
    with archive.lock("load"):
        archive.insert_checked(obs(good, {**good, "datetime_utc": "2024-01-02", "grade_code": "?"}, {**good, "series_uid": "b"},
                                   {**good, "datetime_utc": "2024-01-03", "source": "x"}), "load.csv", 3, AS_OF)
    assert rows(archive.read("observation"), "series_uid", "datetime_utc") == [("a", datetime(2024, 1, 1))]
    kept = archive.read("quarantine")
    assert rows(kept, "kind", "reason", "run_id") == [("observation row", r, 3) for r in ("domain source", "reference grade_code", "reference series_uid")]
    assert '"grade_code":"?"' in kept.filter("reason = 'reference grade_code'").first().body


def test_the_rules_read_a_staged_batch(spark, obs, make, tmp_path, monkeypatch):
    archive = Archive(spark, str(tmp_path / "archive"))
    archive.write_dimension("series", make(S.SERIES, {"series_uid": "a", "station_uid": "t"}))
    batch = obs({"series_uid": "a", "datetime_utc": "2024-01-01"}, {"series_uid": "a", "datetime_utc": "2024-01-01"}, {"series_uid": "b", "datetime_utc": "2024-01-01"})
    seen, tagged = [], gate.tagged
    monkeypatch.setattr(gate, "tagged", lambda batch, *rest: (seen.append(batch), tagged(batch, *rest))[1])
    good = archive.gated(batch.dropDuplicates(), "observation", "load.csv", 1, AS_OF)
    assert rows(good, "series_uid") == [("a",)]
    assert rows(archive.read("quarantine"), "reason") == [("reference series_uid",)]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan


def test_downloads_and_registry_from_the_command_line(spark, obs, make, tmp_path, monkeypatch):
    archive = Archive(spark, str(tmp_path / "archive"))
    archive.write_dimension("series", make(S.SERIES, {"series_uid": "a", "station_uid": "t", "parameter": "Q", "units": "m3/s", "interval": "daily"}))
    archive.write_dimension("station", make(S.STATION, {"station_uid": "t", "name": "mill", "operator": "BC", "bc_aquarius_loc_id": "1"}))
    archive.insert_observations(obs({"series_uid": "a", "datetime_utc": "2024-01-01 01:02:03.000004", "approval_level": "approved"}))
    monkeypatch.setattr(jobs, "build_session", lambda name: spark)
    out = tmp_path / "out"
    jobs.main(["--mode", "downloads", "--archive", archive.root, "--out", str(out), "--as-of", "2024-01-31T00:00:00"])
    assert sorted(p.name for p in out.iterdir()) == sorted(f"{n}_2024-01-31.csv" for n in downloads.DOWNLOADS)
    latest = spark.read.option("header", True).csv(str(out / "latest_per_series_2024-01-31.csv")).first()
    assert (latest.station_uid, latest.datetime_utc) == ("t", "2024-01-01 01:02:03.000004")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        downloads.write(archive.tables(), str(out), "2024-01-31", ["coverage"])
    network = tmp_path / "network.csv"
    network.write_text("STATION_NAME,STATION_NUMBER,LATITUDE\nMill Creek,08NM1,49.5\nElsewhere,08XX1,1\n")
    jobs.main(["--mode", "registry", "--network", str(network), "--out", str(tmp_path / "registry")])
    registry = spark.read.option("header", True).csv(str(tmp_path / "registry"))
    assert rows(registry, "station_uid", "name", "lat", "lon") == [("WSC-08NM1", "Mill Creek", "49.5", None)]
    for missing in (["--mode", "downloads", "--out", "x"], ["--mode", "registry", "--out", "x"]):
        with pytest.raises(SystemExit):
            jobs.main(missing)
