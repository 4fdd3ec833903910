from datetime import datetime

import pytest
from row_sets import rows
from pyspark.sql import functions as F

from gaugelake.operators import merge
from gaugelake.plans.archive import Archive
from gaugelake.sinks import tables as sink
from gaugelake.streaming import legs


@pytest.fixture
def landing(spark, obs, tmp_path):
    class Landing:
        path, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))

        def pull(self, *readings):
            obs(*[{"series_uid": s, "datetime_utc": t, "value": v} for s, t, v in readings]).coalesce(1).write.mode("append").parquet(self.path)
            return legs.landed(spark, self.path)
    return Landing()


def test_ingest_takes_each_file_once(spark, landing):
    for v in (1.0, 2.0):
        legs.ingest(landing.pull(("a", "2024-01-01", v)), landing.out, landing.state)
    legs.ingest(legs.landed(spark, landing.path), landing.out, landing.state)
    assert rows(spark.read.parquet(landing.out), "value") == [(1.0,), (2.0,)]


def test_upsert_equals_batch_whatever_the_order(spark, landing, tmp_path):
    archive = Archive(spark, str(tmp_path / "archive"))
    legs.upsert(landing.pull(("a", "2024-03-01", 1.0), ("a", "2024-03-02", 1.0)), archive, merge.WSC_UPDATES, landing.state)
    # Older than any watermark, and a revision.
    legs.upsert(landing.pull(("a", "2020-01-01", 5.0), ("a", "2024-03-02", 2.0)), archive, merge.WSC_UPDATES, landing.state)
    want = [(datetime(2020, 1, 1), 5.0), (datetime(2024, 3, 1), 1.0), (datetime(2024, 3, 2), 2.0)]
    assert rows(archive.read("observation"), "datetime_utc", "value") == want
    # The whole landing zone replayed with a fresh checkpoint, one file per batch.
    again = Archive(spark, str(tmp_path / "again"))
    legs.upsert(legs.landed(spark, landing.path, files_per_batch=1), again, merge.WSC_UPDATES, landing.state + "2")
    assert rows(again.read("observation"), "datetime_utc", "value") == want


def test_a_job_between_a_streams_write_and_its_manifest(spark, obs, landing, tmp_path, monkeypatch):
    """A job that starts meanwhile is refused; one that breaks the lock deletes nothing fresh. No row is lost."""
    archive = Archive(spark, str(tmp_path / "archive"))
    archive.upsert_observations(obs({"series_uid": "a", "datetime_utc": "2024-02-01"}), merge.WSC_UPDATES)
    plain, refused = sink.create, []

    def create(session, path, text):
        if "/observation/_manifest/" in path and not refused:
            with pytest.raises(RuntimeError, match="in use: stream batch 0"):
                with Archive(spark, archive.root).lock("job"):
                    pass
            archive.unlock()
            refused.append(path)
            with Archive(spark, archive.root).lock("job that broke the lock"):
                pass
        return plain(session, path, text)
    monkeypatch.setattr(sink, "create", create)
    legs.upsert(landing.pull(("a", "2024-03-01", 3.0)), archive, merge.WSC_UPDATES, landing.state)
    assert refused and rows(Archive(spark, archive.root).read("observation"), "value") == [(1.0,), (3.0,)]


def test_a_batch_waits_for_the_lock(spark, landing, tmp_path):
    archive = Archive(spark, str(tmp_path / "archive"))
    pulled = landing.pull(("a", "2024-03-01", 3.0))
    with archive.lock("job"):
        with pytest.raises(Exception, match="in use: job"):
            legs.upsert(pulled, archive, merge.WSC_UPDATES, landing.state, wait_seconds=0)
    legs.upsert(pulled, archive, merge.WSC_UPDATES, landing.state)
    assert rows(archive.read("observation"), "value") == [(3.0,)]


def test_dedupe_and_late_rows(spark, landing):
    legs.dedupe(landing.pull(("a", "2024-01-01", 1.0), ("a", "2024-01-10", 1.0)), landing.out, landing.state)
    legs.dedupe(landing.pull(("a", "2024-01-10", 1.0), ("a", "2024-01-08", 1.0), ("a", "2024-01-05", 1.0)), landing.out, landing.state)
    taken = spark.read.parquet(landing.out)
    assert [r[0].day for r in rows(taken, "datetime_utc")] == [1, 10, 8] and taken.count() == 3
    late = legs.late_rows(spark.read.parquet(landing.path), taken)
    assert [r[0].day for r in rows(late, "datetime_utc")] == [5]


def test_daily_counts(spark, landing):
    legs.daily_counts(landing.pull(("a", "2024-01-01 01:00:00", 1.0), ("b", "2024-01-02", 1.0)), landing.out, landing.state)
    legs.daily_counts(landing.pull(("a", "2024-01-02 23:59:59", 1.0), ("b", "2024-01-03", 1.0)), landing.out, landing.state)
    assert [(d.day, n) for d, n in rows(legs.current_daily_counts(spark, landing.out))] == [(1, 1), (2, 2), (3, 1)]


def test_outages(spark, landing):
    legs.sessions(landing.pull(
        ("a", "2024-01-01", 1.0), ("a", "2024-01-02", 1.0),              # exactly a day: no outage
        ("a", "2024-01-03 00:00:00.000001", 1.0),                        # a day and a microsecond
        ("b", "2024-01-01", 1.0), ("a", "2024-02-01", 1.0)), landing.out, landing.state)
    closed = spark.read.parquet(landing.out)
    got = rows(legs.outages(closed))
    assert got == [("a", datetime(2024, 1, 2), datetime(2024, 1, 3, 0, 0, 0, 1), 86400.000001)]
    # The last stretch stays open until the watermark passes it.
    assert closed.filter(F.col("start_ts") >= "2024-02-01").count() == 0
    legs.sessions(landing.pull(("b", "2024-03-01", 1.0)), landing.out, landing.state)
    assert len(rows(legs.outages(spark.read.parquet(landing.out)))) == 2
