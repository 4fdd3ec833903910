"""Every registered query against its SQL at the smallest scale, and the shape of its plan."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical
from gaugelake.sinks import tables as sink
from gaugelake.suite import driver_tables as D
from gaugelake.suite.oracle import sql
from gaugelake.suite.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(sql()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow", plan)
    got, want = df.toPandas(), con.execute(sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_scan_only_what_they_need(spark):
    from gaugelake.plans import reports
    t = D.archive(spark, SF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000000")  # else the printed filters are cut
    try:
        recent = plan_of(reports.obs_per_day(t, D.EVENTS_AS_OF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "ym#" in recent and ">= 202312" in recent and "GreaterThan(datetime_utc" in recent
    assert re.search(r"ReadSchema: struct<datetime_utc:timestamp_ntz>", recent)
    cover = plan_of(reports.coverage(t))
    assert "struct<series_uid:string,datetime_utc:timestamp_ntz,source:string>" in cover
    assert "SortAggregate" not in cover
    latest = plan_of(reports.latest_per_series(t))
    assert "HashAggregate" in latest and not re.search("SortAggregate|Window", latest)
    audit = plan_of(reports.network_audit(t, D.BC_AS_OF))
    assert "EqualTo(source,bc)" in audit
    assert "TakeOrderedAndProject" in plan_of(reports.recent_runs(t))


def test_small_batches_leave_the_target_where_it_is(spark, tmp_path):
    """No sort aggregate, and the only shuffles are of the batch, once it is staged and its size known."""
    from gaugelake.operators import merge
    from gaugelake import schemas as S
    t = D.archive(spark, SF)["observation"].drop("ym")
    batch, _ = sink.stage(spark.createDataFrame(t.limit(5).toPandas(), t.schema), str(tmp_path), "batch")
    for merged in (merge.upsert_wsc(t, batch), merge.insert_ignore(t, batch, S.OBSERVATION_KEY)):
        plan = plan_of(merged)
        assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
        assert "BroadcastHashJoin" in plan


def test_canonical_ranks_once(spark):
    assert "SortAggregate" not in plan_of(QUERIES["canonical"](spark, SF))


def test_flagship(spark):
    assert entry.entry(spark).count() == 9


@pytest.mark.parametrize("name", ["series_gaps", "freshness_by_source", "freshness_buckets", "network_year", "recent_runs",
                                  "recent_audits", "stream_outages", "stream_daily_counts", "migrate_roundtrip", "audit_gaps"])
def test_results_do_not_depend_on_the_session_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    try:
        got = QUERIES[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert canonical(got) == canonical(con.execute(sql()[name]).df())


def test_series_ids_are_made_once_a_series(spark, tmp_path):
    """The same ids as from the staged readings, unknown and missing values too, from a few distinct rows."""
    spark.createDataFrame([(s, n) for s in (1, 4, None) for n in (1, 2, 1, 3)], "l_suppkey long, l_linenumber int").selectExpr(
        "*", "timestamp_ntz'2000-01-01' AS l_shipdate", "1.0D AS l_quantity", "'A' AS l_returnflag", "'F' AS l_linestatus", "1L AS l_orderkey",
        "1L AS l_partkey", "1.0D AS l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(u, t) for u in (7, 8, None) for t in ("view", "click", "view", "odd", "other", None)], "user_id long, event_type string").selectExpr(
        "*", "timestamp_ntz'2024-01-01' AS ts", "1.0D AS value", "'{}' AS props", "1L AS event_id").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(7,), (7,), (9,), (None,)], "o_custkey long").selectExpr(
        "*", "timestamp_ntz'2000-01-01' AS o_orderdate", "1.0D AS o_totalprice", "1L AS o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    found = D.series_rows(spark, str(tmp_path))
    assert sorted(map(repr, D.series(found).collect())) == sorted(map(repr, D.series(D.staged(spark, str(tmp_path))).collect()))
    assert found.count() < D.staged(spark, str(tmp_path)).count()
