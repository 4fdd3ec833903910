import json
from datetime import datetime

from row_sets import rows
from pyspark.sql import functions as F

from gaugelake import schemas as S
from gaugelake.operators import normalize
from gaugelake.sources import files, registry


def test_pages(spark, tmp_path):
    def feature(**p):
        return {"type": "Feature", "properties": {"STATION_NUMBER": "08NM002", **p}}
    (tmp_path / "1.json").write_text(json.dumps({"type": "FeatureCollection", "features": [
        feature(DATETIME="2024-01-01T00:00:00Z", LEVEL=1.5, DISCHARGE=None, LEVEL_SYMBOL_EN="E"),
        feature(DATETIME="2024-01-01T00:05:00Z", DISCHARGE=2.0),
        feature(DATETIME="2024-01-01T00:10:00Z", LEVEL=None, DISCHARGE=None)]}, indent=1))
    (tmp_path / "2.json").write_text(json.dumps({"features": []}))
    (tmp_path / "3.json").write_text('{"features": [ {"prop')
    pages = files.geojson_pages(spark, str(tmp_path))
    assert files.unreadable_pages(pages).count() == 1
    pull = files.wide_pull(pages)
    assert pull.count() == 3
    long = normalize.reshape_long(pull)
    assert rows(long, "series_uid", "datetime_utc", "value", "qflag") == [
        ("WSC-08NM002-H-instant", datetime(2024, 1, 1), 1.5, "E"),
        ("WSC-08NM002-Q-instant", datetime(2024, 1, 1, 0, 5), 2.0, None)]
    assert rows(normalize.series_discovery(long, "instant"), "series_uid", "source_series_id") == [
        ("WSC-08NM002-H-instant", "WSC-08NM002:H"), ("WSC-08NM002-Q-instant", "WSC-08NM002:Q")]


HEAD = ["meta", "2020-01-01 00:00:00,9,31,1200,looks like data", "", "m", "UTC"]


def export(tmp_path, name, header, lines):
    (tmp_path / name).write_text("\n".join([*HEAD, header, *lines]) + "\n")


def test_exports(spark, tmp_path):
    full = "Timestamp,Value,Grade,Approval,Qualifier"
    export(tmp_path, "Discharge.Working@1.csv", full, [
        '2024-01-01 00:00:00,1.5,31,1200,"ICE, heavy"', "2024-01-01 00:05:00.000,2,,950,", "x,2,31,1200,",
        "2024-01-01 00:10:00,bad,31,1200,", "2024-01-01 00:15:00,,31,1200,", "2024-01-01 00:20:00,NaN,31,1200,",
        "2024-01-01 00:25:00,3,NA,,E"])
    export(tmp_path, "Empty.Working@2.csv", full, [])
    export(tmp_path, "A B+C.Working@5.csv", full, ["2024-01-01 00:00:00,7,31,800,"])
    export(tmp_path, "Narrow.Working@3.csv", "Timestamp,Value,Grade", ["2024-01-01 00:00:00,1.5,31"])
    export(tmp_path, "NoFlag.Working@4.csv", "Timestamp,Value,\"Grade, code\",Approval", ["2024-01-01 00:00:00,1.5,31,7"])
    out = normalize.export_normalise(files.export_rows(files.export_lines(spark, str(tmp_path))))
    assert rows(out.drop(*files.PULL_ORDER)) == [
        ("A B+C.Working@5", datetime(2024, 1, 1), 7.0, "31", "working", None),
        ("Discharge.Working@1", datetime(2024, 1, 1, 0, 0), 1.5, "31", "approved", "ICE, heavy"),
        ("Discharge.Working@1", datetime(2024, 1, 1, 0, 25), 3.0, None, "unspecified", "E"),
        ("Discharge.Working@1", datetime(2024, 1, 1, 0, 5), 2.0, None, "reviewed", None),
        ("NoFlag.Working@4", datetime(2024, 1, 1), 1.5, "31", "unspecified", None)]


def test_large_export_is_read_in_splits(spark, tmp_path):
    lines = [f"2024-01-01 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d},{i},31,1200," for i in range(20000)]
    export(tmp_path, "Big.Working@1.csv", "Timestamp,Value,Grade,Approval,Qualifier", lines)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    text = files.export_lines(session, str(tmp_path))
    assert session.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    out = normalize.export_normalise(files.export_rows(text))
    assert out.agg(F.count("*"), F.sum("value")).first() == (20000, sum(range(20000)))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_small_exports_are_read_once_and_lines_meet_no_heads(spark, tmp_path):
    full = "Timestamp,Value,Grade,Approval,Qualifier"
    export(tmp_path, "A.Working@1.csv", full, ["2024-01-01 00:00:00,1.5,31,1200,"])
    (tmp_path / "B.Working@2.csv").write_bytes(b"\xef\xbb\xbfm\r\nm\rm\nm\nm\na,b,c,d\r\n2024-01-01 00:00:00,2,,,\r\n\n")
    (tmp_path / "C.Working@3.csv").write_bytes(b"\xef\xbb\xbftorn\n\noff")
    lines = files.tagged_lines(spark, str(tmp_path))
    assert "Join" not in plan_of(lines) and "Window" not in plan_of(lines)
    got = [("A.Working@1", "2024-01-01 00:00:00,1.5,31,1200,", True), ("B.Working@2", "", True), ("B.Working@2", "2024-01-01 00:00:00,2,,,", True),
           ("C.Working@3", "", False), ("C.Working@3", "off", False), ("C.Working@3", "torn", False)]
    assert rows(lines, "dataset", "line", "complete") == got


def test_large_and_packed_exports_are_read_in_splits(spark, tmp_path, monkeypatch):
    import gzip
    full = "Timestamp,Value,Grade,Approval,Qualifier"
    export(tmp_path, "A.Working@1.csv", full, ["2024-01-01 00:00:00,1.5,31,1200,"])
    export(tmp_path, "B.Working@2.csv", full, [f"2024-01-01 00:00:{i:02d},1,,," for i in range(30)])
    with gzip.open(tmp_path / "C.Working@3.csv.gz", "wt") as packed:
        packed.write("\n".join([*HEAD, full, "2024-01-01 00:00:00,7,,,"]) + "\n")
    monkeypatch.setattr(files, "_WHOLE_BYTES", 300)
    lines = files.tagged_lines(spark, str(tmp_path))
    assert sorted(r[0] for r in lines.groupBy("dataset").count().collect()) == ["A.Working@1", "B.Working@2", "C.Working@3.csv.gz"]
    assert lines.count() == 32 and lines.filter("complete").count() == 32
    heads = files._export_heads(spark.sql("SELECT string(id % 2) pulled_from, id line_id, string(id) line, id - id block_start FROM range(9)"))
    assert "WindowGroupLimit" in heads._jdf.queryExecution().executedPlan().toString()  # six lines a file move, not the text


def test_a_landing_is_listed_by_few_tasks(spark):
    before = spark.conf.get(files._LISTING)
    with files._listed_by_few_tasks(spark):
        assert int(spark.conf.get(files._LISTING)) == 8 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(files._LISTING) == before


def test_plain_lines_are_cut_as_the_csv_parser_cuts_them(spark):
    lines = ["2024-01-01 00:00:00,1,31,1200,E", "a", "", ",,,,", "NA,NA,x,,", " a , b,c,d,e,f,g", "a\\,b", '"a,b",c', 'a"b,c', '"a""b",,NA', "a\nb,c", "a\rb", "\x00a,b"]
    text = spark.createDataFrame([("d", line, True) for line in lines], "dataset string, line string, complete boolean")
    plain = F.from_csv("line", "ts string, value string, grade string, approval string, qualifier string", {"nullValue": "NA"})
    assert rows(files.export_rows(text)) == rows(text.select("dataset", F.inline(F.array(plain))))
    assert files.export_rows(text.filter(files.plain_line(F.col("line")))).count() == 7


def test_registries(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "station_uid,wsc_id,bc_aquarius_loc_id,ona_id,name,operator,status,lat,lon,basin,telemetry_type,goes_dcp_id\n"
        'WSC-08NM002,0800,NA,NA,"RIVER AT ""THE"" FALLS, UPPER",WSC,active,49.1,-119.5,Okanagan,NA,NA\n')
    row = files.station_registry(spark, str(tmp_path / "s.csv")).first()
    assert (row.wsc_id, row.ona_id, row.name, row.lat) == ("0800", None, 'RIVER AT "THE" FALLS, UPPER', 49.1)
    (tmp_path / "d.csv").write_text('"moe_id","name","lat","lon","parameter","label","unit_id","canon","units"\n'
                                    '"0NM1","Creek",NA,-119.2,"Stage","Working",306,"H","m"\n')
    reg = files.dataset_registry(spark, str(tmp_path / "d.csv"))
    assert rows(normalize.bc_series(reg), "series_uid", "station_uid", "source_series_id") == [
        ("BC-0NM1-H-instant-bc", "BC-0NM1", "Stage.Working@0NM1")]
    station = normalize.bc_stations(reg).first()
    assert (station.lat, station.geom, station.station_type) == (None, None, None)


def test_registry_build_and_active_ids(spark, make):
    network = spark.createDataFrame([("08NM2", "B", 1.0, 2.0), ("08NM1", "A", 1.0, 2.0), ("08NL1", "C", 1.0, 2.0)],
                                    S.STATION_NETWORK)
    reg = registry.build_registry(network)
    assert [r.station_uid for r in reg.collect()] == ["WSC-08NM1", "WSC-08NM2"]
    station = make(S.STATION, {"station_uid": "1", "operator": "WSC", "wsc_id": "b"},
                   {"station_uid": "2", "operator": "WSC", "wsc_id": "a"}, {"station_uid": "3", "operator": "WSC"},
                   {"station_uid": "4", "operator": "BC", "wsc_id": "c"})
    assert [r.wsc_id for r in registry.active_wsc_ids(station).collect()] == ["a", "b"]


def test_daily_history_and_staged(spark, tmp_path):
    (tmp_path / "flows.csv").write_text("STATION_NUMBER,Date,Value,Symbol\n1,2024-01-01,2.5,E\n1,2024-01-02,NA,\n2,2024-01-01,1,\n")
    stations = spark.createDataFrame([("1",)], "STATION_NUMBER string")
    history = files.daily_history(spark, str(tmp_path / "flows.csv"), "csv", stations)
    assert rows(normalize.daily_normalise(history, "Q", "m3/s"), "series_uid", "datetime_utc", "value") == [
        ("WSC-1-Q-daily", datetime(2024, 1, 1), 2.5)]
    (tmp_path / "o.csv").write_text(
        "series_uid,datetime_utc,value,grade_code,approval_level,qualifier_flags,source,pull_run_id\n"
        'a,2024-01-01 00:00:00,1,"","",E,wsc,3\nb,2024-01-01 00:00:00,1,,working,"",wsc,3\n')
    out = normalize.staged_to_observation(files.staged_observations(spark, str(tmp_path / "o.csv")), "2024-02-01")
    assert rows(out, "series_uid", "grade_code", "approval_level", "qualifier_flags") == [
        ("a", None, None, ["E"]), ("b", None, "working", None)]


def test_since(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-28 00:00:00' t UNION ALL SELECT timestamp_ntz'2024-01-28 00:00:01'")
    assert files.since(df, "t", "2024-01-31", 3).count() == 2
    assert files.since(df, "t", "2024-01-31", 3, strict=True).count() == 1
    assert files.since(df, "t", "2024-01-31", None).count() == 2


def test_dry_run(spark, make):
    reg = make(S.DATASET_REGISTRY, {"moe_id": "1", "name": "n" * 50}, {"moe_id": "2", "name": "b"})
    readings = spark.sql("SELECT '1' dataset, timestamp_ntz'2024-01-01 00:00:00' datetime_utc")
    assert rows(normalize.dry_run_report(reg, readings), "moe_id", "name", "n_rows") == [("1", "n" * 50, 1), ("2", "b", 0)]
