import json
from datetime import datetime

import pytest
from row_sets import rows
from pyspark.sql import functions as F

from gaugelake import schemas as S
from gaugelake.operators import merge
from gaugelake.plans import jobs, reports
from gaugelake.plans.archive import Archive
from gaugelake.sinks import tables as sink
from gaugelake.sources import files

AS_OF = datetime(2024, 1, 31, 12)


@pytest.fixture
def archive(spark, make, tmp_path):
    a = Archive(spark, str(tmp_path / "archive"))
    a.write_dimension("station", make(
        S.STATION, {"station_uid": "WSC-1", "wsc_id": "1", "name": "one", "operator": "WSC", "status": "active"},
        {"station_uid": "WSC-2", "wsc_id": None, "name": "two", "operator": "WSC", "status": "active"}))
    return a


def pages(path, *features):
    path.mkdir(parents=True, exist_ok=True)
    keys = ("STATION_NUMBER", "DATETIME", "LEVEL", "DISCHARGE", "LEVEL_SYMBOL_EN")
    (path / f"{len(list(path.iterdir()))}.json").write_text(
        json.dumps({"features": [{"properties": dict(zip(keys, f))} for f in features]}))


def test_daily_is_idempotent_and_takes_revisions(archive, tmp_path):
    landing = tmp_path / "landing"
    pages(landing, ("1", "2024-01-31T00:00:00Z", 1.0, 2.0, "E"), ("1", "2024-01-28T00:00:00Z", 1.0, None, None),
          ("2", "2024-01-31T00:00:00Z", 1.0, None, None), ("1", "bad", 1.0, None, None))
    raw = str(tmp_path / "raw")
    assert jobs.daily(archive, str(landing), AS_OF, raw) == 1
    first = rows(archive.read("observation"), "series_uid", "datetime_utc", "value", "approval_level", "qualifier_flags", "pull_run_id")
    # Other stations and readings before the three days are not taken.
    assert first == [("WSC-1-H-instant", datetime(2024, 1, 31), 1.0, "working", ["E"], 1),
                     ("WSC-1-Q-instant", datetime(2024, 1, 31), 2.0, "working", None, 1)]
    assert jobs.daily(archive, str(landing), AS_OF) == 2
    assert rows(archive.read("observation"), "series_uid", "datetime_utc", "value", "approval_level", "qualifier_flags", "pull_run_id") == first
    pages(tmp_path / "next", ("1", "2024-01-31T00:00:00Z", 9.0, None, None), ("1", "2024-02-01T00:00:00Z", 3.0, None, None))
    jobs.daily(archive, str(tmp_path / "next"), datetime(2024, 2, 1))
    got = rows(archive.read("observation"), "datetime_utc", "value", "pull_run_id", "ym")
    assert got == [(datetime(2024, 1, 31), 2.0, 1, 202401), (datetime(2024, 1, 31), 9.0, 1, 202401),
                   (datetime(2024, 2, 1), 3.0, 3, 202402)]
    assert rows(archive.read("pull_run"), "run_id", "status", "rows_in") == [(1, "ok", 2), (2, "ok", 2), (3, "ok", 2)]
    assert (tmp_path / "raw/wsc-daily/2024/01/31/wsc-daily-run1.csv").is_dir()
    assert archive._scratch == []


def test_a_pull_is_parsed_once(archive, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    pages(landing, ("1", "2024-01-31T00:00:00Z", 1.0, 2.0, "E"), (None, "2024-01-31T00:00:00Z", 1.0, None, None))
    pages(landing)
    (landing / "broken.json").write_text("{")
    (landing / "null.json").write_text('{"features": [null]}')
    (landing / "none.json").write_text('{"features": null}')
    taken, staged, upsert, split = [], [], Archive.upsert_observations, Archive.stage_split
    monkeypatch.setattr(Archive, "upsert_observations", lambda self, rows, *a: (taken.append(rows), upsert(self, rows, *a))[1])
    monkeypatch.setattr(Archive, "stage_split", lambda self, rows, *a: (staged.append(rows), split(self, rows, *a))[1])
    assert jobs.daily(archive, str(landing), AS_OF) == 1
    assert rows(archive.read("observation"), "series_uid", "value") == [("WSC-1-H-instant", 1.0), ("WSC-1-Q-instant", 2.0)]
    assert rows(archive.read("quarantine"), "kind", "reason", "nth") == [
        ("page", "no features", 0), ("page", "unreadable page", 0), ("reading", "no station", 0), ("reading", "no station", 0)]
    plan = taken[0]._jdf.queryExecution().executedPlan().toString()
    assert len(staged) == 1 and "FileScan parquet" in plan and "regexp_extract" not in plan


def test_daily_and_gate_queries_leave_the_readings_of_the_archive_unbuilt(spark, tmp_path, monkeypatch):
    from gaugelake.suite import driver_tables, queries
    made = {"nation": "SELECT 1 n_nationkey, 'N' n_name", "customer": "SELECT 7 c_custkey, 'C' c_name",
            "supplier": "SELECT 3 s_suppkey, 'S' s_name, 1 s_nationkey, 1.0D s_acctbal",
            "events": "SELECT 1L event_id, 7 user_id, 'view' event_type, timestamp_ntz'2024-01-20 00:00:00' ts, 1.0D value, '{}' props",
            "orders": "SELECT 1L o_orderkey, 7 o_custkey, 'F' o_orderstatus, 1.0D o_totalprice, timestamp_ntz'2001-01-01 00:00:00' o_orderdate, '1' o_orderpriority",
            "lineitem": "SELECT 1L l_orderkey, 1L l_partkey, 3 l_suppkey, 1 l_linenumber, 2.0D l_quantity, 1.0D l_extendedprice, 'A' l_returnflag, 'F' l_linestatus, "
                        "timestamp_ntz'2001-01-01 00:00:00' l_shipdate"}
    for name, text in made.items():
        spark.sql(text).write.parquet(str(tmp_path / f"{name}.parquet"))
    build = driver_tables.build_observations
    monkeypatch.setattr(driver_tables, "build_observations", lambda *a: pytest.fail("readings built"))
    assert rows(queries.daily_job(spark, str(tmp_path)), "series_uid", "value") == [("WSC-7-H-instant", 0.0)]
    assert sorted(r.status for r in queries.run_ledger(spark, str(tmp_path)).collect()) == ["error", "ok", "ok", "running"]
    assert {r.kind for r in queries.write_gate(spark, str(tmp_path)).collect()} >= {"observation row", "pull_run row"}
    monkeypatch.setattr(driver_tables, "build_observations", build)
    assert driver_tables.archive(spark, str(tmp_path))["observation"].count() == 3


def test_empty_pull(archive, tmp_path):
    pages(tmp_path / "landing")
    jobs.daily(archive, str(tmp_path / "landing"), AS_OF)
    assert archive.read("observation").count() == 0
    assert rows(archive.read("pull_run"), "status", "rows_in") == [("ok", 0)]


def test_quarantine_and_replay(archive, tmp_path, spark):
    """Every input row is either taken or kept for repair; repaired rows come back, but not over later readings."""
    landing = tmp_path / "landing"
    pages(landing, ("1", "2024-01-31T00:00:00Z", 1.0, None, None), ("1", "31/01/2024 01:00", 2.0, None, "E"), (None, "2024-01-31T00:00:00Z", 3.0, None, None))
    (landing / "broken.json").write_text('{"features": [{"properties": {"STATION_NUMBER": "1", "DATETIME": "2024-01-31T02:00:00Z", "LEVEL": 4.0}}')
    (landing / "none.json").write_text('{"message": "busy"}')
    for _ in range(2):  # the landing keeps its broken files: they are known the second time
        jobs.daily(archive, str(landing), AS_OF)
    kept = archive.read("quarantine")
    assert rows(kept, "kind", "reason", "status") == sorted([
        ("page", "unreadable page", "open"), ("page", "no features", "open"), ("reading", "unreadable time", "open"), ("reading", "no station", "open")])
    by_reason = {r.reason: r for r in kept.collect()}
    late = tmp_path / "late"
    pages(late, ("1", "2024-01-31T02:00:00Z", 9.0, None, None))
    jobs.daily(archive, str(late), datetime(2024, 2, 1))
    page, time = by_reason["unreadable page"], by_reason["unreadable time"]
    repairs = spark.createDataFrame([
        (page.pulled_from, page.body, page.body + "]}"), (None, time.body, time.body.replace("31/01/2024 01:00", "2024-01-31T01:00:00Z")),
        (None, by_reason["no features"].body, '{"still": "bad"}'), (None, "unheard of", "x")], "pulled_from string, body string, fixed string")
    jobs.replay(archive, repairs, datetime(2024, 2, 2))
    got = rows(archive.read("observation"), "datetime_utc", "value", "qualifier_flags")
    assert got == [(datetime(2024, 1, 31), 1.0, None), (datetime(2024, 1, 31, 1), 2.0, ["E"]), (datetime(2024, 1, 31, 2), 9.0, None)]
    from gaugelake.operators import quarantine
    still = quarantine.still_open(archive.read("quarantine"))
    assert rows(still, "reason", "body") == sorted([("no station", by_reason["no station"].body), ("unreadable page", '{"still": "bad"}')], key=repr)
    jobs.daily(archive, str(landing), datetime(2024, 2, 1))  # replayed rows stay closed
    assert still.count() == 2 and quarantine.still_open(archive.read("quarantine")).count() == 2


def test_short_exports_are_kept_and_replayed(spark, archive, tmp_path):
    landing, reg = exports(tmp_path)
    name = "SGWL.Working@OW1"
    (tmp_path / "exports" / "later").mkdir()
    (tmp_path / "exports" / "later" / f"{name}.csv").write_text("Dataset\nbroken off\n")
    jobs.groundwater(archive, landing, reg, AS_OF, "EntirePeriodOfRecord")
    held = archive.read("quarantine").filter("reason = 'short file'")
    assert rows(held, "body", "dataset") == [("Dataset", name), ("broken off", name)]
    before = archive.read("observation").count()
    fixed = held.select("pulled_from", "body", F.when(F.col("body") == "Dataset", "2024-01-20 07:00:00,5.5,31,1200,").alias("fixed"))
    jobs.replay(archive, fixed.filter("fixed IS NOT NULL"), AS_OF, reg, wells=True)
    assert archive.read("observation").count() == before + 1
    assert rows(archive.read("observation").filter("value = 5.5"), "approval_level") == [("approved",)]


def test_an_old_pull_uploaded_again_does_not_win(spark, tmp_path):
    for day, level in (("2024-01-31", 2.0), ("2024-01-30", 1.0)):  # the older one is written last
        pages(tmp_path / "landing" / f"pull={day}", ("1", "2024-01-29T00:00:00Z", level, None, None))
    read = files.geojson_pages(spark, str(tmp_path / "landing" / "*"))
    assert [r[0] for r in read.orderBy("pulled_at").select("pulled_at").collect()] == [datetime(2024, 1, 30), datetime(2024, 1, 31)]
    paths = spark.createDataFrame([("file:/x/2023/05/06/a.csv",), ("file:/x/pull=2024-01-02T03%3A04%3A05/a.csv",), ("file:/x/a.csv",)], "p string")
    at = paths.select(files.pull_time(F.col("p"), F.lit(datetime(2020, 1, 1))))
    assert [r[0] for r in at.collect()] == [datetime(2023, 5, 6), datetime(2024, 1, 2, 3, 4, 5), datetime(2020, 1, 1)]


def test_unreadable_pages_do_not_stop_a_run(archive, tmp_path, caplog):
    landing = tmp_path / "landing"
    pages(landing, ("1", "2024-01-31T00:00:00Z", 1.0, None, None))
    (landing / "torn.json").write_text('{"features": [{"prop')
    jobs.daily(archive, str(landing), AS_OF)
    assert archive.read("observation").count() == 1
    assert rows(archive.read("pull_run"), "status", "rows_in") == [("ok", 1)]
    assert "1 left out, page: unreadable page" in caplog.text


def test_failed_run_is_recorded(archive):
    with pytest.raises(Exception):
        jobs.daily(archive, "/nonexistent/landing", AS_OF)
    run = archive.read("pull_run").first()
    assert run.status == "error" and run.rows_in is None and run.error


def test_weekly(archive, tmp_path):
    landing = tmp_path / "landing"
    pages(landing, ("1", "2023-12-28T00:00:00Z", 1.0, None, None), ("1", "2024-01-20T00:00:00Z", 1.0, None, None))
    jobs.weekly(archive, str(landing), AS_OF)
    assert archive.read("observation").count() == 2
    assert rows(archive.read("audit_log"), "audit_id", "stations_checked", "discrepancies") == [(1, 1, 30)]
    # As in the reference a repeated audit records its gaps again, unless asked not to.
    jobs.weekly(archive, str(landing), AS_OF)
    jobs.weekly(archive, str(landing), AS_OF, dedupe_open=True)
    assert rows(archive.read("audit_log"), "audit_id", "discrepancies") == [(1, 30), (2, 30), (3, 0)]
    assert archive.read("audit_discrepancy").count() == 60


def exports(tmp_path):
    reg = tmp_path / "reg.csv"
    reg.write_text('"moe_id","name","lat","lon","parameter","label","unit_id","canon","units"\n'
                   '"OW1","Well one",49.0,-119.0,"SGWL","Working",306,"GW","m"\n'
                   '"OW2","Well two",NA,NA,"SGWL","Working",306,"GW","m"\n')
    landing = tmp_path / "exports"
    landing.mkdir()
    head = "\n".join(["m"] * 5 + ["t,v,g,a,q"])
    (landing / "SGWL.Working@OW1.csv").write_text(
        f"{head}\n2024-01-30 00:00:00,1,31,1200,\n2024-01-30 00:00:00,2,,800,E\n2023-01-30 00:00:00,3,31,1200,\n")
    (landing / "SGWL.Working@OW2.csv").write_text(head + "\n")
    (landing / "A B+C.Working@XX.csv").write_text(f"{head}\n2024-01-30 00:00:00,1,31,1200,\n")
    (landing / "Other.Working@XX.csv").write_text(f"{head}\n2024-01-30 00:00:00,1,31,1200,\n")
    return str(landing), str(reg)


def test_groundwater(archive, spark, tmp_path):
    landing, reg = exports(tmp_path)
    report = rows(jobs.groundwater_dry_run(spark, landing, reg), "moe_id", "n_rows")
    assert report == [("OW1", 3), ("OW2", 0)]
    assert archive.read("observation").count() == 0
    jobs.groundwater(archive, landing, reg, AS_OF)
    assert archive.read("observation").count() == 1  # one key inside the 30 days
    jobs.groundwater(archive, landing, reg, AS_OF, window="EntirePeriodOfRecord")
    assert rows(archive.read("observation"), "series_uid", "source", "datetime_utc") == [
        ("BC-OW1-GW-instant-bc", "bc", datetime(2023, 1, 30)), ("BC-OW1-GW-instant-bc", "bc", datetime(2024, 1, 30))]
    well = archive.read("station").filter("operator = 'BC'").collect()
    assert [(w.station_uid, w.station_type, w.geom.lon) for w in well] == [("BC-OW1", "groundwater_well", -119.0)]
    assert rows(archive.read("series"), "source_series_id") == [("SGWL.Working@OW1",)]
    jobs.provincial(archive, landing, reg, AS_OF)
    assert rows(archive.read("station").filter("operator = 'BC'"), "station_type") == [("groundwater_well",)]


def test_firstcut_then_backfill(archive, spark, tmp_path):
    flows = spark.createDataFrame([("1", datetime(2020, 1, 1).date(), 5.0, "E"), ("1", datetime(2020, 2, 1).date(), None, None)], S.DAILY_HISTORY)
    levels = flows.limit(0)
    jobs.backfill(archive, flows, levels, AS_OF)
    assert rows(archive.read("observation"), "series_uid", "approval_level", "value") == [("WSC-1-Q-daily", "approved", 5.0)]
    # A smaller history empties a month; its folder must go.
    later = spark.createDataFrame([("1", datetime(2021, 1, 1).date(), 6.0, None)], S.DAILY_HISTORY)
    jobs.backfill(archive, later, levels, AS_OF)
    assert rows(archive.read("observation"), "datetime_utc", "value") == [(datetime(2021, 1, 1), 6.0)]
    landing = tmp_path / "landing"
    pages(landing, ("08", "2024-01-31T00:00:00Z", 1.0, None, None))
    reg = tmp_path / "st.csv"
    reg.write_text(",".join(S.STATION_REGISTRY.names) + "\nWSC-08,08,NA,NA,n,WSC,active,1,2,Okanagan,NA,NA\n")
    jobs.firstcut(archive, str(reg), str(landing), AS_OF)
    assert rows(archive.read("observation"), "series_uid") == [("WSC-08-H-instant",)]  # the daily record is gone too
    assert rows(archive.read("station"), "wsc_id") == [("08",)]
    assert rows(archive.read("series"), "series_uid") == [("WSC-08-H-instant",)]


def test_migrate_roundtrip(archive, spark, obs, make, tmp_path):
    archive.append("pull_run", make(S.PULL_RUN, {"run_id": 7, "source": "x", "started_ts": "2024-01-01", "status": "ok"}))
    archive.add_series(make(S.SERIES, {"series_uid": "a", "station_uid": "WSC-1", "parameter": "Q", "interval": "daily", "units": "m"}))
    archive.upsert_observations(obs({"series_uid": "a", "datetime_utc": "2024-01-01 00:00:00.25", "qualifier_flags": ["E"]},
                                    {"series_uid": "a", "datetime_utc": "2024-02-01", "approval_level": "working"}), merge.WSC_UPDATES)
    sink.export_tables({"observation": archive.read("observation").drop("ym"), "series": archive.read("series"),
                        "station": archive.read("station"), "pull_run": archive.read("pull_run")}, str(tmp_path / "csv"))
    copy = Archive(spark, str(tmp_path / "copy"))
    for _ in range(2):  # loading again changes nothing
        jobs.migrate(str(tmp_path / "csv"), copy, AS_OF)
    cols = ("series_uid", "datetime_utc", "value", "approval_level", "qualifier_flags", "source")
    assert rows(copy.read("observation"), *cols) == rows(archive.read("observation"), *cols)
    assert rows(copy.read("pull_run"), "run_id") == [(7,)]
    assert rows(reports.load_verify(copy.tables())) == [(2, 1, 2)]
    from gaugelake.operators.audit import next_id
    assert next_id(copy.read("pull_run"), "run_id") == 8


def files_of(archive):
    """Files of the newest state: inputFiles() lists whole versions, the filter on folders comes after."""
    return {r[0] for r in archive.read("observation").select(F.input_file_name()).distinct().collect()}


def test_an_upsert_of_one_series_rewrites_one_bucket(archive, obs):
    archive.upsert_observations(obs(*({"series_uid": f"s{i}", "datetime_utc": "2024-01-01"} for i in range(20))), merge.WSC_UPDATES)
    before = files_of(archive)
    assert len({p.rsplit("/", 2)[1] for p in before}) == 4
    archive.upsert_observations(obs({"series_uid": "s3", "datetime_utc": "2024-01-02"}), merge.WSC_UPDATES)
    after = files_of(archive)
    changed = {p.rsplit("/", 2)[1] for p in before ^ after}
    assert len(changed) == 1 and len(before & after) == len(before) - 1
    assert Archive(archive.spark, archive.root, buckets=9).buckets() == 4  # stored with the archive


def test_a_new_daily_history_leaves_instant_files_alone(archive, obs, spark):
    archive.upsert_observations(obs(*({"series_uid": f"WSC-1-Q-{span}", "datetime_utc": f"2024-0{m}-01"}
                                      for m in (1, 2) for span in ("instant", "daily"))), merge.WSC_UPDATES)
    before = {p for p in files_of(archive) if "span=instant" in p}
    flows = spark.createDataFrame([("1", datetime(2024, 1, 5).date(), 2.0, "")], S.DAILY_HISTORY)
    run = jobs.backfill(archive, flows, flows.limit(0), AS_OF)
    assert {p for p in files_of(archive) if "span=instant" in p} == before and len(before) == 2
    assert rows(archive.read("observation").filter("series_uid LIKE '%daily'"), "datetime_utc", "value") == [(datetime(2024, 1, 5), 2.0)]
    assert rows(archive.read("pull_run").filter(F.col("run_id") == run), "rows_in") == [(1,)]


def test_other_months_are_left_alone(archive, obs, tmp_path):
    archive.upsert_observations(obs({"series_uid": "a", "datetime_utc": "2023-05-01"}, {"series_uid": "a", "datetime_utc": "2024-01-01"}), merge.WSC_UPDATES)
    def may():
        return sorted(p for p in files_of(archive) if "/ym=202305/" in p)
    before = may()
    n = archive.upsert_observations(obs({"series_uid": "a", "datetime_utc": "2024-01-01", "value": 5.0}, {"series_uid": "b", "datetime_utc": "2024-01-02"}), merge.WSC_UPDATES)
    assert n == 2 and may() == before and len(before) > 0
    assert archive.read("observation").count() == 3


def test_opening_an_archive_leaves_a_write_under_way_alone(archive, spark, obs):
    archive.upsert_observations(obs({"series_uid": "a", "datetime_utc": "2024-01-01"}), merge.WSC_UPDATES)
    path = archive.path("observation")
    staged = archive.place(obs({"series_uid": "a", "datetime_utc": "2024-01-01", "value": 8.0}))
    staged.write.partitionBy(*archive.PARTITION).parquet(f"{path}/v=underway")
    reader = Archive(spark, archive.root)
    assert rows(reader.read("observation"), "value") == [(1.0,)]  # no manifest names it
    assert sink.exists(spark, f"{path}/v=underway/_SUCCESS")
    with archive.lock("cleaner"):  # too young to be a leftover
        pass
    assert sink.exists(spark, f"{path}/v=underway/_SUCCESS")
    with Archive(spark, archive.root, leftover_seconds=0).lock("cleaner"):
        pass
    assert not sink.exists(spark, f"{path}/v=underway") and rows(reader.read("observation"), "value") == [(1.0,)]


def test_one_writer_at_a_time(archive, spark, tmp_path):
    pages(tmp_path / "landing", ("1", "2024-01-31T00:00:00Z", 1.0, None, None))
    with archive.lock("first"):
        with pytest.raises(RuntimeError, match="in use: first"):
            jobs.daily(Archive(spark, archive.root), str(tmp_path / "landing"), AS_OF)
    jobs.daily(archive, str(tmp_path / "landing"), AS_OF)


def test_a_write_between_read_and_commit_is_not_lost(archive, spark, obs, monkeypatch):
    archive.upsert_observations(obs({"series_uid": "a", "datetime_utc": "2024-01-01"}), merge.WSC_UPDATES)
    path = archive.path("observation")
    plain = sink.manifest
    seen = plain(spark, path)
    archive.upsert_observations(obs({"series_uid": "b", "datetime_utc": "2024-01-01"}), merge.WSC_UPDATES)
    monkeypatch.setattr(sink, "manifest", lambda s, p: seen if p == path else plain(s, p))
    with pytest.raises(RuntimeError, match="another writer"):
        archive.write_observations(obs({"series_uid": "c", "datetime_utc": "2024-01-01"}))
    monkeypatch.undo()
    assert rows(archive.read("observation"), "series_uid") == [("a",), ("b",)]


def test_readers_keep_their_files_over_a_commit(archive, obs):
    archive.upsert_observations(obs({"series_uid": "a", "datetime_utc": "2024-01-01"}), merge.WSC_UPDATES)
    before = archive.read("observation")
    archive.upsert_observations(obs({"series_uid": "a", "datetime_utc": "2024-01-01", "value": 7.0}), merge.WSC_UPDATES)
    assert rows(before, "value") == [(1.0,)] and rows(archive.read("observation"), "value") == [(7.0,)]


def test_a_running_job_is_in_the_ledger(archive):
    def body(run_id):
        assert rows(archive.read("pull_run"), "run_id", "status", "finished_ts") == [(run_id, "running", None)]
        return 5
    assert jobs.with_ledger(archive, "x", AS_OF, body) == 1
    assert rows(archive.read("pull_run"), "run_id", "status", "rows_in") == [(1, "ok", 5)]


def test_the_newest_pull_wins(archive, tmp_path):
    import os
    landing = tmp_path / "landing"
    pages(landing, ("1", "2024-01-31T00:00:00Z", 9.0, None, None))
    os.utime(landing / "0.json", (1, 1))
    jobs.daily(archive, str(landing), AS_OF)
    pages(landing, ("1", "2024-01-31T00:00:00Z", 1.5, None, None))
    jobs.daily(archive, str(landing), AS_OF)
    assert rows(archive.read("observation"), "value") == [(1.5,)]


def test_the_newest_export_wins(archive, tmp_path):
    import os
    landing, reg = exports(tmp_path)
    head = "\n".join(["m"] * 5 + ["t,v,g,a,q"])
    for when, value, code in ((1, 9, 1200), (2, 1.5, 800)):
        folder = tmp_path / "exports" / f"pull{when}"
        folder.mkdir()
        file = folder / "SGWL.Working@OW2.csv"
        file.write_text(f"{head}\n2024-01-30 00:00:00,{value},,{code},\n")
        os.utime(file, (10**9 * when, 10**9 * when))
    jobs.groundwater(archive, landing, reg, AS_OF)
    got = rows(archive.read("observation").filter("series_uid LIKE 'BC-OW2%'"), "value", "approval_level")
    assert got == [(1.5, "working")]


def test_dropped_rows_and_files_are_counted(archive, tmp_path, caplog):
    landing, reg = exports(tmp_path)
    head = "\n".join(["m"] * 5 + ["t,v,g,a,q"])
    (tmp_path / "exports/SGWL.Working@OW1b.csv").write_text("m\nm\n")
    (tmp_path / "exports/SGWL.Working@OW2.csv").write_text(f"{head}\nyesterday,1,,800,\n")
    jobs.groundwater(archive, landing, reg, AS_OF)
    assert "1 left out, export line: unreadable time" in caplog.text and "2 left out, export line: short file" in caplog.text


def test_backfill_takes_registered_stations_only(archive, spark):
    flows = spark.createDataFrame([("1", datetime(2020, 1, 1).date(), 5.0, None), ("99ZZ", datetime(2020, 1, 1).date(), 5.0, None)], S.DAILY_HISTORY)
    jobs.backfill(archive, flows, flows, AS_OF)
    assert rows(archive.read("observation"), "series_uid") == [("WSC-1-H-daily",), ("WSC-1-Q-daily",)]


def test_migrate_by_column_name(archive, spark, tmp_path):
    root = tmp_path / "csv"
    root.mkdir()
    (root / "station").mkdir(), (root / "series").mkdir(), (root / "observation").mkdir()
    (root / "station/a.csv").write_text("regulation_status,station_uid,name,lat,lon,operator\nnatural,WSC-9,nine,49.5,-119.5,WSC\n")
    (root / "series/a.csv").write_text("series_uid,station_uid,parameter,units,interval,source_series_id\ns9,WSC-9,Q,m3/s,instant,x\n")
    (root / "observation/a.csv").write_text(
        "series_uid,datetime_utc,value,grade_code,approval_level,qualifier_flags,source,pull_run_id\n"
        's9,2024-01-01 00:00:00+00,1.5,"",approved,E,wsc,3\n')
    jobs.migrate(str(root), archive, AS_OF)
    got = archive.read("observation").first()
    assert (got.datetime_utc, got.value, got.grade_code, got.qualifier_flags, got.source, got.pull_run_id) == (
        datetime(2024, 1, 1), 1.5, None, ["E"], "wsc", 3)
    station = archive.read("station").filter("station_uid = 'WSC-9'").first()
    assert (station.regulation_status, station.geom.lon, station.name) == ("natural", -119.5, "nine")
    (root / "series/a.csv").write_text("series_uid,parameter\ns9,Q\n")
    with pytest.raises(ValueError, match="lacks station_uid, interval"):
        jobs.migrate(str(root), archive, AS_OF)
    assert not sink.exists(spark, archive.path("_lock"))


def test_dry_run_lists_all_datasets_and_the_total(spark, tmp_path):
    landing, reg = exports(tmp_path)
    lines = list(jobs.dry_run_lines(jobs.groundwater_dry_run(spark, landing, reg)))
    assert len(lines) == 3 and lines[-1] == "total 3 readings in 1 datasets"


def test_raw_landing_is_immutable(spark, tmp_path):
    df = spark.createDataFrame([("1", "NA")], "a string, b string")
    on = datetime(2024, 1, 5).date()
    assert sink.land_raw(df, str(tmp_path), "bc/1-H", 3, on)
    assert not sink.land_raw(df, str(tmp_path), "bc/1-H", 3, on)
    assert (tmp_path / "bc/1-H/2024/01/05/bc/1-H-run3.csv/_SUCCESS").exists()


def test_cli_rejects_unknown_modes_and_missing_inputs(capsys):
    for args in (["--mode", "hourly", "--archive", "x"], ["--mode", "gw", "--archive", "x", "--landing", "y"],
                 ["--mode", "provincial", "--archive", "x", "--landing", "y", "--registry", "z", "--dry-run"]):
        with pytest.raises(SystemExit) as stop:
            jobs.main(args)
        assert stop.value.code != 0


def test_a_hot_month_is_written_by_many_tasks(spark, obs, tmp_path):
    session = spark.newSession()
    for key, value in {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000", "spark.sql.session.timeZone": "UTC",
                       "spark.sql.shuffle.partitions": "4"}.items():
        session.conf.set(key, value)
    rows_ = session.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("series_uid"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("datetime_utc"),
        F.lit("bc").alias("source"), F.rand(1).alias("value"))
    Archive(session, str(tmp_path / "hot")).write_observations(S.conform(rows_, S.OBSERVATION))
    files = list((tmp_path / "hot/observation").glob("v=*/span=instant/ym=202401/bucket=*/*.parquet"))
    assert len(files) > 3
    assert Archive(session, str(tmp_path / "hot")).read("observation").count() == 60000


def test_export_files_are_written_as_partitionby_names_them(spark, tmp_path):
    from gaugelake.suite import queries
    lines = spark.createDataFrame([("a:b/c%", 1, "x"), ("a:b/c%", 1, None), (None, 2, "é"), ("", 2, "w"), ("q@1", None, "l")], "dataset string, pull long, line string")
    for folder in ("ours", "ours", "spark"):
        ordered = lines.repartition(3, "dataset", "pull").sortWithinPartitions("dataset", "pull")
        if folder == "ours":
            queries._land(ordered, str(tmp_path / folder))
        else:
            ordered.write.partitionBy("dataset", "pull").text(str(tmp_path / folder))
    found = {folder: sorted({str(p.parent.relative_to(tmp_path / folder)) for p in (tmp_path / folder).rglob("part-*.txt")}) for folder in ("ours", "spark")}
    assert found["ours"] == found["spark"] and len(found["ours"]) == 3
    text = spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "ours"))
    assert sorted(r[0] for r in text.collect()) == sorted(["", "l", "w", "x", "é"] * 2)  # a second landing adds files
    assert not list((tmp_path / "ours").rglob(".*"))  # no checksums, nothing half written


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    import time
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {f.getName() for f in (lambda found: [found.apply(i) for i in range(found.size())])(manager.getAllFiles()) if f.getName().startswith("shuffle_")}
    before = shuffles()
    for write in (lambda df: sink.stage(df, str(tmp_path), "x"), lambda df: sink.write_csv(df, str(tmp_path / "csv")),
                  lambda df: sink.commit(df, str(tmp_path / "table"), sort_by=["id"])):
        write(spark.range(1000).repartition(3, "id"))
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before


def test_bulk_exports_are_packed(spark, tmp_path):
    sink.export_tables({"t": spark.sql("SELECT 1 a, timestamp_ntz'2024-01-01 00:00:00.25' b")}, str(tmp_path))
    assert [p.suffix for p in (tmp_path / "t").glob("part-*")] == [".gz"]
    assert rows(files.by_name(spark, str(tmp_path / "t"), ["a"])) == [("1", "2024-01-01 00:00:00.25")]


def test_a_first_load_joins_nothing(spark, obs, tmp_path):
    new = Archive(spark, str(tmp_path / "new"))
    merged = merge.insert_ignore(new._in_folders(["span=instant/ym=202401/bucket=0"]), obs({"series_uid": "a", "datetime_utc": "2024-01-01"}), S.OBSERVATION_KEY)
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString() and merged.count() == 1
