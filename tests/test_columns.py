from datetime import datetime

from pyspark.sql import functions as F

from gaugelake.functions import columns as C
from gaugelake.functions import text


def one_each(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_export_time(spark):
    got = one_each(spark, C.parse_export_time, ["2024-03-10 02:30:00", "2024-03-10 02:30:00.000", "x", "", None,
                                                "2024-03-10", "2024-13-01 00:00:00", "2024-1-2 3:04:05"])
    assert got == [datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10, 2, 30), None, None, None, None, None,
                   datetime(2024, 1, 2, 3, 4, 5)]


def test_wsc_time_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    try:
        # A local time that daylight saving skips.
        got = one_each(spark, C.parse_wsc_time, ["2024-03-10T02:30:00Z", "2024-03-10T02:30:00", "junk"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [datetime(2024, 3, 10, 2, 30), None, None]


def test_numbers(spark):
    got = one_each(spark, C.parse_number, ["1.5", " 2 ", "-3e2", ".5", "5.", "bad", "", "NaN", None, "1d", "Inf"])
    assert got == [1.5, 2.0, -300.0, 0.5, 5.0, None, None, None, None, None, float("inf")]


def test_qualifier_array(spark):
    assert one_each(spark, C.qualifier_array, [None, "", "E"]) == [None, None, ["E"]]


def test_approval_codes(spark):
    got = one_each(spark, C.approval_from_code, ["1200", "950", "900", "800", "7", "", None])
    assert got == ["approved", "reviewed", "in_review", "working", *["unspecified"] * 3]


def test_labels(spark):
    assert one_each(spark, C.parameter_label, ["Q", "GW", "OTHER"]) == ["Discharge", "Groundwater", "OTHER"]
    df = spark.createDataFrame([("GW", "bc"), ("Q", "bc"), ("Q", "wsc"), ("GW", "ona")], "p string, s string")
    got = [r[0] for r in df.select(C.source_label(F.col("p"), F.col("s"))).collect()]
    assert got == ["BC groundwater", "BC surface", "WSC", "BC groundwater"]


def test_buckets(spark):
    assert one_each(spark, C.freshness_colour, [26.0, 26.01, 48.0, 48.01, None], "double") == \
        ["green", "amber", "amber", "red", "grey"]
    assert one_each(spark, C.well_colour, [14, 15, 180, 181, None], "int") == ["green", "amber", "amber", "red", "grey"]
    assert one_each(spark, C.audit_freshness, [2, 3, 14, 15, None], "int") == \
        ["Current", "Recent", "Recent", "Stale", None]
    assert one_each(spark, C.qaqc_status, [9.9, 10.0, 89.9, 90.0, None], "double") == [
        "Provisional (working)", "Partially reviewed", "Partially reviewed", "Approved", "Provisional (working)"]


def test_ages_round_half_away_from_zero(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' t")
    row = df.select(C.days_stale("2024-01-03 12:00:00", F.col("t")).alias("up"),
                    C.days_stale("2023-12-30 12:00:00", F.col("t")).alias("down"),
                    F.round(C.hours_old("2024-01-01 00:15:00", F.col("t")), 1).alias("h")).first()
    assert (row.up, row.down, row.h) == (3, -2, 0.3)


def test_round_to_second(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.5' a, timestamp_ntz'2024-01-01 00:00:00.499999' b")
    row = df.select(C.round_to_second(F.col("a")).alias("a"), C.round_to_second(F.col("b")).alias("b")).first()
    assert (row.a, row.b) == (datetime(2024, 1, 1, 0, 0, 1), datetime(2024, 1, 1))


def test_percent_guards_zero(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a long, b long")
    assert [r[0] for r in df.select(C.percent(F.col("a"), F.col("b"))).collect()] == [33.3, None]


def test_point_needs_both(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (None, 2.0)], "lon double, lat double")
    got = [r.p for r in df.select(C.point(F.col("lon"), F.col("lat")).alias("p")).collect()]
    assert [tuple(p) if p else None for p in got] == [(1.0, 2.0), None, None]


def python_trigrams(s):
    import re
    return {f"  {w} "[i:i + 3] for w in re.split(r"[\W_]+", s.lower()) if w for i in range(len(w) + 1)}


def test_trigrams(spark):
    names = ["Okanagan River", "a", "", "at the-lake 12", "one two one"]
    got = one_each(spark, text.trigrams, names)
    assert [set(g) for g in got] == [python_trigrams(n) for n in names]
    assert all(len(g) == len(set(g)) for g in got)
