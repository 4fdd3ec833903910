import math
from datetime import datetime

from row_sets import rows
from pyspark.sql import functions as F

from gaugelake import schemas as S
from gaugelake.operators import lineage, search


def test_canonical_prefers_approval_then_source_then_ingest(obs):
    k = {"series_uid": "a", "datetime_utc": "2024-01-01"}
    got = lineage.canonical(obs(
        {**k, "source": "ona", "approval_level": "working", "value": 1.0},
        {**k, "source": "wsc", "approval_level": "approved", "value": 2.0},
        {**k, "source": "bc", "approval_level": "approved", "value": 3.0},
        {**k, "source": "bc", "approval_level": "approved", "value": 4.0, "ingest_ts": "2024-02-01"},
        {"series_uid": "b", "datetime_utc": "2024-01-01", "source": "goes", "value": 5.0}),
        ["series_uid", "datetime_utc"], "2024-03-01")
    assert rows(got, "series_uid", "value", "authoritative_source") == [("a", 4.0, "bc"), ("b", 5.0, "goes")]


def test_corrections_match_brute_force(spark, obs):
    readings = obs(*[{"series_uid": s, "datetime_utc": f"20{y}-{m:02d}-15 12:00:00"}
                     for s in "ab" for y in (22, 23, 24) for m in (1, 6, 12)])
    intervals = [(1, "a", datetime(2022, 1, 15, 12), datetime(2022, 6, 15, 12)), (2, "a", None, datetime(2023, 1, 1)),
                 (3, "a", datetime(2023, 6, 1), None), (4, "b", None, None), (5, "b", datetime(2030, 1, 1), None),
                 (6, "b", datetime(2022, 2, 1), datetime(2022, 2, 2)), (7, "c", None, None)]
    df = spark.createDataFrame([(*i, "drift") for i in intervals],
                               "correction_id long, series_uid string, applied_from timestamp_ntz, applied_to timestamp_ntz, correction_type string")
    want = sorted((r.series_uid, r.datetime_utc, i) for r in readings.collect() for i, s, a, b in intervals
                  if s == r.series_uid and (a is None or r.datetime_utc >= a) and (b is None or r.datetime_utc <= b))
    assert sorted(rows(lineage.with_corrections(readings, df), "series_uid", "datetime_utc", "correction_id")) == want
    assert lineage.with_corrections(readings.limit(0), df).count() == 0


def test_ratings(spark):
    ratings = spark.createDataFrame(
        [("r1", "s", None, datetime(2024, 1, 1), '{"a": 2.0, "b": 1.5}', 1.0),
         ("r2", "s", datetime(2024, 1, 1), None, '{"a": 3.0, "b": 2.0}', 0.5)],
        "rating_uid string, station_uid string, effective_from timestamp_ntz, effective_to timestamp_ntz, equation_params string, offset double")
    stage = spark.createDataFrame(
        [("s", datetime(2023, 12, 31), 5.0, 20.0), ("s", datetime(2024, 1, 1), 2.5, 12.0), ("s", datetime(2024, 2, 1), 0.5, 1.0)],
        "station_uid string, datetime_utc timestamp_ntz, stage_h double, measured_q double")
    got = rows(lineage.rating_deviation(stage, ratings), "rating_uid", "rated_q", "rating_deviation_pct")
    assert got == [("r1", 16.0, 25.0), ("r2", 12.0, 0.0), ("r2", None, None)]


def test_decodes(obs):
    df = obs({"series_uid": "a", "datetime_utc": "2024-01-01", "qualifier_flags": ["E"], "grade_code": "31"},
             {"series_uid": "b", "datetime_utc": "2024-01-01", "qualifier_flags": ["B", "?"], "grade_code": "x"},
             {"series_uid": "c", "datetime_utc": "2024-01-01"})
    assert rows(lineage.decode_qualifiers(df), "series_uid", "qualifier_labels", "estimate_flag", "ice_flag") == [
        ("a", "estimate", True, False), ("b", "ice,?", False, True), ("c", None, False, False)]
    assert rows(lineage.decode_grades(df), "series_uid", "grade_label") == [("a", "GOOD"), ("b", None), ("c", None)]


def test_name_search(spark):
    names = ["Okanagan River at Oliver", "Okanogan Rivr", "Mission Creek", "", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")

    def grams(s):
        return {f"  {w} "[i:i + 3] for w in s.lower().split() for i in range(len(w) + 1)}
    term = "okanagan river"
    want = {n: len(grams(n) & grams(term)) / len(grams(n) | grams(term)) for n in names[:3]}
    got = {r.name: r.similarity for r in search.name_search(df, "name", [term]).collect()}
    assert got == {n: s for n, s in want.items() if s >= 0.3} and len(got) == 2


def test_location_search(spark, make):
    places = [(49.0, -119.0), (49.5, -119.5), (None, None), (60.0, 10.0)]
    st = make(S.STATION, *[{"station_uid": str(i), "lat": a, "lon": o} for i, (a, o) in enumerate(places)])
    assert rows(search.in_bbox(st, 48.5, -120, 49.0, -118), "station_uid") == [("0",)]

    def km(a, b):
        p, q = math.radians(a[0]), math.radians(b[0])
        d = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(d))
    got = rows(search.nearest(st, [("p", 49.2, -119.1), ("q", 59.0, 11.0)]))
    assert [(g[0], g[1]) for g in got] == [("p", "0"), ("q", "3")]
    assert abs(got[0][2] - km((49.2, -119.1), (49.0, -119.0))) < 1e-6


def test_lookup_tables(spark):
    assert S.grade_codes(spark).count() == 19 and S.qualifier_codes(spark).count() == 5
    ranks = dict(rows(S.approval_levels(spark), "approval_level", "rank"))
    assert ranks == {"approved": 30, "reviewed": 25, "in_review": 20, "working": 10, "unspecified": 0}
    assert S.grade_codes(spark).filter(F.col("grade_code").isin("1", "2")).count() == 2
