"""Operators in which two tables meet: places, names, ids, intervals, snapshots."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from row_sets import rows

from gaugelake import schemas as S
from gaugelake.operators import audit, crosswalk, lineage, search
from gaugelake.sinks import tables as sink
from gaugelake.streaming import legs


def km(a, b):
    la, lo, lb, ln = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ln - lo) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_points_round_the_globe(spark, seed):
    """Dense and empty regions, both poles, both sides of the date line, equal distances."""
    rng = random.Random(seed)
    place = lambda: rng.choice([(rng.uniform(49, 50), rng.uniform(-120, -119)), (rng.uniform(-90, 90), rng.uniform(-180, 180)),
                                (rng.choice([-90.0, 90.0, 89.99]), rng.uniform(-180, 180)), (10.0, rng.choice([-180.0, 179.999, 180.0]))])
    stations = [(f"S{i}", *place()) for i in range(25 if seed == 1 else 3)] + [("S9a", 49.5, -119.5), ("S1a", 49.5, -119.5), ("none", None, 1.0)]
    points = [(i, *place()) for i in range(300)] + [(300, 49.5, -119.5), (301, None, None)]
    got = search.nearest_points(spark.createDataFrame(stations, "station_uid string, lat double, lon double"),
                                spark.createDataFrame(points, "point_id long, lat double, lon double"))
    near = {r.point_id: r for r in got.collect()}
    assert set(near) == set(range(301))
    for i, *p in points[:301]:
        own = sorted((km(p, s[1:]), s[0]) for s in stations if s[1] is not None)
        assert abs(near[i].distance_km - own[0][0]) < 1e-5
        assert near[i].station_uid in [u for d, u in own if d - own[0][0] < 1e-9]
    assert near[300].station_uid == "S1a"
    plan = search.nearest_points(spark.createDataFrame(stations, "station_uid string, lat double, lon double"),
                                 spark.createDataFrame(points, "point_id long, lat double, lon double"))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_far_points_do_not_meet_every_station(spark):
    """Points far from a dense region: the stations compared with a point stay few, whatever their number."""
    rng = random.Random(5)
    stations = [(f"S{i}", rng.uniform(49, 50), rng.uniform(-120, -119)) for i in range(3000)]
    points = [(i, rng.uniform(-80, 30), rng.uniform(-60, 60)) for i in range(60)]
    got = search.nearest_points(spark.createDataFrame(stations, "station_uid string, lat double, lon double"),
                                spark.createDataFrame(points, "point_id long, lat double, lon double"))
    near = {r.point_id: r.station_uid for r in got.collect()}
    assert near == {i: min(stations, key=lambda s: km(p, s[1:]))[0] for i, *p in points}
    met = []

    def visit(plan):
        if "Join" in plan.nodeName() and "numOutputRows" in (m := dict_of(plan.metrics())):
            met.append(m["numOutputRows"].value())
        for child in list_of(plan.children()):
            visit(child)
        for inner in ("executedPlan", "plan"):
            if plan.nodeName() == ("AdaptiveSparkPlan" if inner == "executedPlan" else "") or (inner == "plan" and "QueryStage" in plan.getClass().getSimpleName()):
                visit(getattr(plan, inner)())

    def list_of(seq):
        return [seq.apply(i) for i in range(seq.size())]

    def dict_of(scala_map):
        return {pair._1(): pair._2() for pair in list_of(scala_map.toSeq())}

    visit(got._jdf.queryExecution().executedPlan())
    assert met and max(met) < 60 * 3000 / 20


def test_nearest_points_without_rows(spark):
    stations = spark.createDataFrame([], "station_uid string, lat double, lon double")
    points = spark.createDataFrame([(1, 1.0, 1.0)], "point_id long, lat double, lon double")
    assert search.nearest_points(stations, points).collect() == []
    assert search.nearest_points(points.select(F.lit("a").alias("station_uid"), "lat", "lon"), points.limit(0)).collect() == []


def test_intervals_of_many_months_are_not_sent_through_the_driver(spark):
    """A few intervals, small as a table, are many rows once laid out by month: the sides are merged."""
    obs = spark.range(10).select(F.lit("a").alias("series_uid"), F.expr("timestamp_ntz'2000-01-01' + make_interval(0, id * 12)").alias("datetime_utc"),
                                 F.lit(1.0).alias("value"))
    c = spark.createDataFrame([("c1", "a", "drift"), ("c2", "a", "datum")], "correction_id string, series_uid string, correction_type string").selectExpr(
        "*", "timestamp_ntz'2001-06-01' AS applied_from", "IF(correction_id = 'c1', timestamp_ntz'2004-01-01', NULL) AS applied_to")
    out = lineage.with_corrections(obs, c)
    assert sorted((r.datetime_utc.year, r.correction_id) for r in out.collect()) == sorted(
        [(y, "c1") for y in (2002, 2003, 2004)] + [(y, "c2") for y in range(2002, 2010)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def grams(name):
    out = set()
    for word in "".join(c if c.isalnum() else " " for c in name.lower()).split():
        padded = f"  {word} "
        out |= {padded[i:i + 3] for i in range(len(word) + 1)}
    return out


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 1.0])
def test_similar_names_against_all_pairs(spark, threshold):
    rng = random.Random(3)
    words = ["mill", "creek", "upper", "lower", "okanagan", "lake", "river", "vernon", "at", "near", "mouth", "b"]
    left = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) for _ in range(60)] + [None, "", "--", "MILL creek"]
    right = [n.replace("e", "i") if rng.random() < 0.3 else n for n in (" ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) for _ in range(60))] + [None, ""]
    want = set()
    for a in {n for n in left if n}:
        for b in {n for n in right if n}:
            x, y = grams(a), grams(b)
            if x and y and len(x & y) / len(x | y) >= threshold:
                want.add((a, b, round(len(x & y) / len(x | y), 9)))
    found = search.similar_names(spark.createDataFrame([(n,) for n in left], "name string"), spark.createDataFrame([(n,) for n in right], "name string"), threshold)
    assert {(r.left_name, r.right_name, round(r.similarity, 9)) for r in found.collect()} == want and want


def test_components_of_long_chains(spark):
    links = [(f"{i:03d}", f"{i + 1:03d}") for i in range(200) if i not in (50, 120)] + [("x", "x"), ("z", "y")]
    got = dict(tuple(r) for r in crosswalk.components(spark.createDataFrame(links, "a string, b string")).collect())
    assert got["050"] == "000" and got["120"] == "051" and got["200"] == "121" and got["z"] == "y" and got["x"] == "x"
    assert len(got) == 204


def test_canonical_stations(make):
    station = make(S.STATION,
                   {"station_uid": "WSC-1", "operator": "WSC", "wsc_id": "1", "bc_aquarius_loc_id": "b1"},
                   {"station_uid": "BC-1", "operator": "BC", "bc_aquarius_loc_id": "b1"},
                   {"station_uid": "ONA-1", "operator": "ONA", "ona_id": "o1", "wsc_id": "1"},
                   {"station_uid": "BC-2", "operator": "BC", "bc_aquarius_loc_id": "1"},  # another authority's 1
                   {"station_uid": "WSC-3", "operator": "WSC", "wsc_id": "3"}, {"station_uid": "WSC-2", "operator": "WSC", "wsc_id": "3"},
                   {"station_uid": "OTHER-1", "operator": "OTHER"}, {"station_uid": "E-1", "operator": None, "wsc_id": ""})
    assert dict(rows(crosswalk.canonical_stations(station))) == {
        "WSC-1": "ONA-1", "BC-1": "ONA-1", "ONA-1": "ONA-1", "BC-2": "BC-2", "WSC-3": "WSC-2", "WSC-2": "WSC-2", "OTHER-1": "OTHER-1", "E-1": "E-1"}
    assert crosswalk.canonical_stations(station.limit(0)).collect() == []


def test_disjoint_intervals(spark):
    """Every hour of every key has the interval that an hour-by-hour search gives; no two pieces overlap."""
    rng = random.Random(4)
    day = datetime(2024, 1, 30)
    given = []
    for i in range(40):
        a, b = (None if rng.random() < 0.15 else day + timedelta(hours=rng.randrange(200)) for _ in range(2))
        given.append((f"k{i % 4}", f"r{i:02d}", a, b))
    given.append(("open", "all", None, None))
    df = spark.createDataFrame(given, "key string, uid string, lo timestamp_ntz, hi timestamp_ntz")
    pieces = lineage.disjoint(df, "key", "lo", "hi", ["lo", "uid"]).collect()
    for key in ("k0", "k1", "k2", "k3", "open"):
        for hour in range(-5, 210, 3):
            at = day + timedelta(hours=hour, minutes=30)
            holds = lambda lo, hi: (lo is None or lo <= at) and (hi is None or at < hi)
            own = [(lo is not None, lo or day, uid) for k, uid, lo, hi in given if k == key and holds(lo, hi) and not (lo and hi and lo >= hi)]
            found = [p.uid for p in pieces if p.key == key and holds(p.lo, p.hi)]
            assert found == ([max(own)[2]] if own else [])
    assert lineage.disjoint(df.limit(0), "key", "lo", "hi", ["lo"]).collect() == []


def test_comparison_by_months_reads_unlike_months_only(spark, obs):
    ours = obs(*({"series_uid": s, "datetime_utc": f"2024-0{m}-0{d}", "value": 1.0} for s in "ab" for m in (1, 2, 3) for d in (1, 2)))
    theirs = ours.filter("NOT (series_uid = 'b' AND month(datetime_utc) = 3)").withColumn(
        "value", F.when((F.col("series_uid") == "a") & (F.month("datetime_utc") == 2), F.lit(None)).otherwise(F.col("value")))
    assert rows(audit.unlike_months(ours, theirs)) == [("a", 202402), ("b", 202403)]
    for a, b in ((ours, theirs), (theirs, ours), (ours, ours), (ours, ours.limit(0))):
        assert rows(audit.compare_by_month(a, b)) == rows(audit.compare(a, b))


def test_open_outages_show_while_they_last(spark, obs, tmp_path):
    path, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))

    def pull(*readings):
        obs(*[{"series_uid": s, "datetime_utc": t} for s, t in readings]).coalesce(1).write.mode("append").parquet(path)
        legs.last_seen(legs.landed(spark, path), out, state, buckets=3)
        return rows(legs.open_outages(spark, out))
    assert legs.open_outages(spark, out).collect() == []
    assert pull(("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-04")) == []  # 3 days of delay: now is the first
    got = pull(("a", "2024-01-09"), ("a", "2024-01-02"))  # late readings change nothing
    assert got == [("b", datetime(2024, 1, 1), datetime(2024, 1, 6), 432000.0), ("c", datetime(2024, 1, 4), datetime(2024, 1, 6), 172800.0)]
    before = sink.manifest(spark, out)[1]
    assert [r[0] for r in pull(("b", "2024-01-08"))] == ["c"]
    after = sink.manifest(spark, out)[1]
    assert sum(before[k] != after[k] for k in after) == 1  # only b's bucket is written
    legs.last_seen(legs.landed(spark, path), out, state + "2", buckets=3)  # all again
    assert [r[0] for r in rows(legs.open_outages(spark, out))] == ["c"]
