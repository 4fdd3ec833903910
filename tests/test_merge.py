import pytest
from row_sets import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugelake import schemas as S
from gaugelake.operators import merge

T = "2024-01-01 00:00:00"


def test_wsc_upsert_keeps_grade_approval_and_run(obs):
    old = obs({"series_uid": "a", "datetime_utc": T, "value": 1.0, "grade_code": "31", "approval_level": "approved",
               "qualifier_flags": ["E"], "pull_run_id": 1})
    new = obs({"series_uid": "a", "datetime_utc": T, "value": None, "grade_code": "11", "approval_level": "working",
               "qualifier_flags": None, "pull_run_id": 2, "ingest_ts": "2024-02-01"},
              {"series_uid": "b", "datetime_utc": T, "value": 5.0, "approval_level": "working", "pull_run_id": 2})
    out = merge.upsert_wsc(old, new)
    assert rows(out, "series_uid", "value", "grade_code", "approval_level", "qualifier_flags", "pull_run_id") == [
        ("a", None, "31", "approved", None, 1), ("b", 5.0, None, "working", None, 2)]
    assert str(out.filter("series_uid = 'a'").first().ingest_ts) == "2024-02-01 00:00:00"


def test_bc_upsert_keeps_qualifier_and_run(obs):
    old = obs({"series_uid": "a", "datetime_utc": T, "grade_code": "31", "approval_level": "working",
               "qualifier_flags": ["E"], "pull_run_id": 1, "source": "bc"})
    new = obs({"series_uid": "a", "datetime_utc": T, "value": 7.0, "grade_code": None, "approval_level": "approved",
               "qualifier_flags": ["B"], "pull_run_id": 2, "source": "bc"})
    assert rows(merge.upsert_bc(old, new), "value", "grade_code", "approval_level", "qualifier_flags",
                "pull_run_id") == [(7.0, None, "approved", ["E"], 1)]


def test_sources_do_not_collide(obs):
    a = obs({"series_uid": "a", "datetime_utc": T, "source": "bc"})
    b = obs({"series_uid": "a", "datetime_utc": T, "source": "ona"})
    assert merge.upsert_bc(a, b).count() == 2


def test_duplicate_keys_in_a_batch(obs):
    old = obs().limit(0)
    new = obs({"series_uid": "a", "datetime_utc": T, "value": 9.0, "pull_run_id": 1},
              {"series_uid": "a", "datetime_utc": T, "value": 2.0, "pull_run_id": 2})
    assert rows(merge.upsert_wsc(old, new, order_by=["pull_run_id"]), "value", "pull_run_id") == [(2.0, 2)]
    with pytest.raises(Exception, match="twice in the batch"):
        merge.upsert_wsc(old, new, on_dup="error").collect()
    assert merge.upsert_wsc(new.filter("value = 9"), new.filter("value = 2"), on_dup="error").count() == 1


def test_insert_ignore_takes_the_first(obs):
    old = obs({"series_uid": "a", "datetime_utc": T, "value": 1.0})
    new = obs({"series_uid": "a", "datetime_utc": T, "value": 2.0},
              {"series_uid": "b", "datetime_utc": T, "value": 4.0, "pull_run_id": 2},
              {"series_uid": "b", "datetime_utc": T, "value": 3.0, "pull_run_id": 1})
    out = merge.insert_ignore(old, new, S.OBSERVATION_KEY, ["pull_run_id"])
    assert rows(out, "series_uid", "value") == [("a", 1.0), ("b", 3.0)]


def test_merge_counts(obs):
    old = obs({"series_uid": "a", "datetime_utc": T})
    new = obs({"series_uid": "a", "datetime_utc": T}, {"series_uid": "b", "datetime_utc": T},
              {"series_uid": "b", "datetime_utc": T, "value": 2.0})
    assert rows(merge.merge_counts(old, new, S.OBSERVATION_KEY)) == [(1, 1, 2)]


def test_station_upsert(make):
    old = make(S.STATION, {"station_uid": "BC-1", "name": "old", "operator": "BC", "status": "seasonal",
                           "station_type": "stream", "lat": 1.0, "lon": 2.0})
    new = make(S.STATION, {"station_uid": "BC-1", "name": "new", "operator": "OTHER", "status": "active",
                           "station_type": "groundwater_well"})
    cols = ("name", "operator", "status", "station_type", "lat")
    assert rows(merge.upsert_station(old, new), *cols) == [("new", "BC", "seasonal", "stream", None)]
    assert rows(merge.upsert_station(old, new, wells=True), *cols) == [
        ("new", "BC", "seasonal", "groundwater_well", None)]


def test_replace_slice_keeps_rows_the_predicate_cannot_judge(obs):
    old = obs({"series_uid": "a", "datetime_utc": T, "grade_code": "1"},
              {"series_uid": "b", "datetime_utc": T, "grade_code": "2"},
              {"series_uid": "c", "datetime_utc": T, "grade_code": None})
    out = merge.replace_slice(old, F.col("grade_code") == "1", obs({"series_uid": "d", "datetime_utc": T}))
    assert rows(out, "series_uid") == [("b",), ("c",), ("d",)]


def test_enrich_fills_coordinates_and_overwrites_the_rest(spark, make):
    old = make(S.STATION,
               {"station_uid": "1", "wsc_id": "1", "lat": 1.0, "lon": 1.0, "drainage_area_km2": 9.0, "regulation_status": "natural"},
               {"station_uid": "2", "wsc_id": "2", "drainage_area_km2": 8.0, "regulation_status": "natural"},
               {"station_uid": "3", "wsc_id": None, "drainage_area_km2": 7.0})
    meta = spark.createDataFrame([("1", None, None, 5.0, True), ("9", 1.0, 1.0, 1.0, False)],
                                 "STATION_NUMBER string, DRAINAGE_AREA_GROSS double, LATITUDE double, LONGITUDE double, REGULATED boolean")
    assert rows(merge.enrich_stations(old, meta), "station_uid", "lat", "lon", "drainage_area_km2", "regulation_status") == [
        ("1", 1.0, 5.0, None, "regulated"), ("2", None, None, 8.0, "natural"), ("3", None, None, 7.0, None)]


reading = st.tuples(st.sampled_from("ab"), st.integers(1, 3), st.sampled_from(["wsc", "bc"]),
                    st.one_of(st.none(), st.integers(0, 5)), st.integers(1, 4))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, max_size=8), st.lists(reading, max_size=8))
def test_upsert_matches_a_keyed_loop_and_is_idempotent(obs, first, second):
    def frame(batch):
        return obs(*[{"series_uid": s, "datetime_utc": f"2024-01-0{d}", "source": src,
                      "value": None if v is None else float(v), "pull_run_id": run, "grade_code": str(run)}
                     for s, d, src, v, run in batch]) if batch else obs({"series_uid": "x"}).limit(0)

    def loop(table, batch):
        table = dict(table)
        order = sorted(batch, key=lambda r: (r[4], r[3] is not None, r[3] or 0))
        for s, d, src, v, run in {r[:3]: r for r in order}.values():
            kept = table[(s, d, src)][1:] if (s, d, src) in table else (str(run), run)
            table[(s, d, src)] = (None if v is None else float(v), *kept)
        return table

    empty = obs({"series_uid": "x"}).limit(0)
    one = merge.upsert_wsc(empty, frame(first), order_by=["pull_run_id"])
    two = merge.upsert_wsc(one, frame(second), order_by=["pull_run_id"])
    want = loop(loop({}, first), second)
    got = {(r.series_uid, r.datetime_utc.day, r.source): (r.value, r.grade_code, r.pull_run_id) for r in two.collect()}
    assert got == want
    again = merge.upsert_wsc(two, frame(second), order_by=["pull_run_id"])
    assert rows(again) == rows(two)


def test_rows_are_ranked_after_they_are_dealt_by_key(obs):
    """A sort of whole input splits before the shuffle spills as splits grow."""
    many = obs(*({"series_uid": "a", "datetime_utc": T, "pull_run_id": i, "value": float(i)} for i in range(9)))
    for batch in (many, many.withColumn("source", F.lit("bc"))):  # a constant in the key costs no second shuffle
        out = merge.last_of_batch(batch, S.OBSERVATION_KEY, ["pull_run_id"], S.OBSERVATION.names)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" in plan and "Sort [" not in plan.split("Exchange hashpartitioning", 1)[1]
        assert plan.count("Exchange") == 1
        assert rows(out, "value") == [(8.0,)]


def test_a_large_batch_is_merged_by_one_join(obs, monkeypatch):
    old = obs({"series_uid": "a", "datetime_utc": T, "value": 1.0, "pull_run_id": 1}, {"series_uid": "a", "datetime_utc": T, "value": 2.0, "pull_run_id": 2},
              {"series_uid": None, "datetime_utc": T}, {"series_uid": "c", "datetime_utc": T, "grade_code": "31"})
    new = obs({"series_uid": "a", "datetime_utc": T, "value": None, "grade_code": "11", "pull_run_id": 8}, {"series_uid": None, "datetime_utc": T, "value": 7.0},
              {"series_uid": "b", "datetime_utc": T, "grade_code": "21"}, {"series_uid": "b", "datetime_utc": T, "grade_code": "22"})
    monkeypatch.setattr(merge, "_absent", None)  # new keys come from the same join
    got = merge.upsert_bc(old, new, touched="touched", large=True)
    monkeypatch.undo()
    want = merge.upsert_bc(old, new, touched="touched")
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 6
    with pytest.raises(Exception, match="twice in the batch"):
        merge.upsert_bc(old, new, on_dup="error", large=True).collect()


def test_an_archive_knows_a_large_batch(spark, obs, tmp_path, monkeypatch):
    from gaugelake.plans import archive
    store = archive.Archive(spark, str(tmp_path / "archive"), buckets=2)
    monkeypatch.setattr(archive, "LARGE_BATCH", 2)
    monkeypatch.setattr(merge, "_absent", None)
    days = [{"series_uid": "a", "datetime_utc": f"2024-0{m}-01", "value": float(m)} for m in (1, 2, 3)]
    assert store.upsert_observations(obs(*days), merge.BC_UPDATES) == 3
    assert store.upsert_observations(obs(*({**d, "value": 9.0} for d in days[1:])), merge.BC_UPDATES) == 2
    assert rows(store.read("observation"), "value") == [(1.0,), (9.0,), (9.0,)]
