import pytest
from pyspark.sql import functions as F
from row_sets import rows

from gaugelake import schemas as S
from gaugelake.operators import merge, rollup
from gaugelake.plans import reports
from gaugelake.plans.archive import Archive
from gaugelake.sinks import tables as sink

AS_OF = "2024-03-01"
FROM_PARTIALS = {
    "kpi_overview": lambda t: reports.kpi_overview(t, AS_OF), "coverage": reports.coverage, "coverage_firstcut": reports.coverage_firstcut,
    "coverage_interval": reports.coverage_interval, "coverage_timeline": reports.coverage_timeline,
    "freshness_by_source": lambda t: reports.freshness_by_source(t, AS_OF), "daily_record_span": reports.daily_record_span,
    "station_summary": reports.station_summary, "network_audit_status": lambda t: reports.network_audit_status(t, AS_OF),
    "network_totals": lambda t: reports.network_totals(t, AS_OF), "approval_by_station": reports.approval_by_station,
    "station_year_heatmap": reports.station_year_heatmap, "gw_wells": lambda t: reports.gw_wells(t, AS_OF),
    "longest_records": reports.longest_records,
}


@pytest.fixture
def archive(spark, make, tmp_path):
    a = Archive(spark, str(tmp_path / "archive"), buckets=2)
    a.write_dimension("station", make(
        S.STATION, *({"station_uid": f"BC-{i}", "bc_aquarius_loc_id": str(i), "name": f"n{i}", "operator": "BC", "status": "active",
                      "station_type": "groundwater_well" if i == 3 else None, "lat": 50.0, "lon": -120.0} for i in range(5))))
    a.write_dimension("series", make(
        S.SERIES, *({"series_uid": f"BC-{i}-Q-{span}", "station_uid": f"BC-{i}", "parameter": "Q", "interval": span, "units": "m3/s"}
                    for i in range(5) for span in ("instant", "daily"))))
    return a


def readings(obs, *days, approval="working", **more):
    return obs(*({"series_uid": f"BC-{i}-Q-{span}", "datetime_utc": day, "source": "bc" if i < 4 else "wsc", "approval_level": approval, **more}
                 for i in range(5) for span in ("instant", "daily") for day in days))


def assert_same(archive):
    """The stored counts are those of the readings: on them alone all the reports below rest."""
    tables = archive.tables()
    keys = "source", "approval_level"
    assert rows(rollup.merged_partials(tables["partial"], *keys)) == rows(rollup.by_series(tables["observation"], *keys))


def assert_same_reports(archive):
    tables = archive.tables()
    scanned = {k: v for k, v in tables.items() if k != "partial"}
    for name, report in FROM_PARTIALS.items():
        got, want = report(tables), report(scanned)
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema], name
        assert rows(got) == rows(want), name


def test_reports_from_partials_after_every_kind_of_write(archive, obs):
    assert_same(archive)  # empty
    assert rows(reports.kpi_overview(archive.tables(), AS_OF), "obs", "latest") == [(0, None)]
    archive.insert_observations(readings(obs, "2023-12-31 23:59:59", "2024-01-01", "2024-02-29"))
    assert_same(archive)
    archive.insert_observations(readings(obs, "2024-01-01", "2024-01-02", approval=None))  # half of it known
    assert_same(archive)
    assert archive.upsert_observations(readings(obs, "2024-01-01", approval="approved"), merge.BC_UPDATES) == 10
    assert_same(archive)
    assert_same_reports(archive)
    archive.replace_observations(F.col("series_uid").like("%daily"), readings(obs, "2024-05-01").filter("series_uid LIKE '%daily'"), "daily")
    assert_same(archive)
    archive.replace_observations(F.col("series_uid") == "BC-1-Q-instant", readings(obs, "2024-01-01").limit(0))
    assert_same(archive)
    archive.replace_observations(F.lit(True), readings(obs, "2024-01-01").limit(0))  # everything goes
    assert archive.partials().count() == 0
    assert_same(archive)


def test_reports_from_partials_open_no_readings(archive, obs):
    archive.insert_observations(readings(obs, "2024-01-01"))
    tables = archive.tables()
    for name, report in FROM_PARTIALS.items():
        assert f"{archive.root}/observation/" not in "".join(report(tables).inputFiles()), name
    assert f"{archive.root}/partial/" in "".join(reports.coverage(tables).inputFiles())


def test_versions_without_partials_are_counted_from_readings(archive, obs):
    archive.insert_observations(readings(obs, "2024-01-01"))
    sink.delete(archive.spark, archive.path("partial"))
    assert_same(archive)
    archive.insert_observations(readings(obs, "2024-02-01"))  # some with, some without
    assert archive.partials().count() == 20
    assert_same(archive)


def test_tables_show_one_state(archive, obs):
    archive.insert_observations(readings(obs, "2024-01-01"))
    before = archive.tables()
    archive.insert_observations(readings(obs, "2024-01-02"))
    assert before["observation"].count() == 10 == before["partial"].agg(F.sum("n")).first()[0]
    assert archive.tables()["partial"].agg(F.sum("n")).first()[0] == 20


def test_a_writer_that_dies_before_its_manifest_changes_nothing(archive, obs, monkeypatch):
    archive.insert_observations(readings(obs, "2024-01-01"))
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(sink, "create", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        archive.write_observations(readings(obs, "2024-01-02"))
    assert archive.partials().agg(F.sum("n")).first()[0] == 10
    assert len(sink.children(archive.spark, archive.path("partial"))) == 2
    with Archive(archive.spark, archive.root, leftover_seconds=0).lock("cleaner"):
        pass
    assert len(sink.children(archive.spark, archive.path("partial"))) == 1
    assert_same(archive)


def test_partials_of_replaced_versions_are_swept(archive, obs):
    for value in (1.0, 2.0, 3.0, 4.0):
        archive.upsert_observations(readings(obs, "2024-01-01", value=value), merge.WSC_UPDATES)
    with Archive(archive.spark, archive.root, leftover_seconds=0).lock("cleaner"):
        pass
    assert len(sink.children(archive.spark, archive.path("partial"))) == 2  # of the last two states
    assert_same(archive)
