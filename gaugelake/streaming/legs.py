"""Incremental legs: each reads landed files once, keeps a checkpoint, and may be run again at
any time. A run takes all files landed since the last one (``availableNow``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.columns import seconds_between
from ..plans.archive import Archive
from ..session import tuned
from ..sinks import tables as sink

WATERMARK = "3 days"


def landed(spark: SparkSession, path: str, schema: T.StructType = S.OBSERVATION,
           files_per_batch: int | None = None) -> DataFrame:
    """New files of a landing folder, read in a session set up for state (and for UTC)."""
    reader = tuned(spark).readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _run(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _timed(rows: DataFrame, delay: str) -> DataFrame:
    """Watermarks want a TIMESTAMP; in a UTC session the cast keeps the wall clock."""
    return rows.withColumn("event_time", F.col("datetime_utc").cast("timestamp")).withWatermark("event_time", delay)


def ingest(rows: DataFrame, out: str, checkpoint: str) -> None:
    """Append new rows to a raw table, each exactly once."""
    _run(rows.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def upsert(rows: DataFrame, archive: Archive, update: list[str], checkpoint: str,
           order_by: list[str] | None = None, wait_seconds: float = 3600.0) -> None:
    """Merge every batch into the archive. The merge is by key, so a batch that runs again after
    a crash changes nothing. Late rows of any age are taken. Each batch holds the archive's lock while it stages and
    commits, and waits for a job that has it."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        with archive.lock(f"stream batch {batch_id}", wait_seconds):
            archive.upsert_observations(archive.stage(batch, f"batch{batch_id}"), update, order_by)

    _run(rows.writeStream.foreachBatch(apply), checkpoint)


def dedupe(rows: DataFrame, out: str, checkpoint: str, delay: str = WATERMARK) -> None:
    """Drop repeats of overlapping pulls. Rows older than the watermark are dropped as well and
    belong to the weekly re-pull; see :func:`late_rows`."""
    unique = _timed(rows, delay).dropDuplicatesWithinWatermark(S.OBSERVATION_KEY).drop("event_time")
    _run(unique.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def late_rows(landed_rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """Landed keys the stateful stream did not take."""
    return landed_rows.join(accepted.select(*S.OBSERVATION_KEY), S.OBSERVATION_KEY, "left_anti")


def daily_counts(rows: DataFrame, out: str, checkpoint: str, delay: str = WATERMARK) -> None:
    """Readings per day, kept up to date: each batch writes the days it changed."""
    counts = (_timed(rows, delay)
              .groupBy(F.window("event_time", "1 day").alias("w"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.to_date("w.start").alias("d"), "n"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten if the batch runs again.
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    _run(counts.writeStream.outputMode("update").foreachBatch(apply), checkpoint)


def current_daily_counts(spark: SparkSession, out: str) -> DataFrame:
    rows = spark.read.schema("d date, n long, batch_id long").parquet(out)
    return rows.groupBy("d").agg(F.max_by("n", "batch_id").alias("n"))


def sessions(rows: DataFrame, out: str, checkpoint: str, delay: str = WATERMARK) -> None:
    """Stretches of readings with no pause over a day, written once the watermark has passed them."""
    stretches = (_timed(rows, delay)
                 .groupBy("series_uid", F.session_window("event_time", "1 day").alias("w"))
                 .agg(F.count(F.lit(1)).alias("n"))
                 .select("series_uid", F.col("w.start").cast("timestamp_ntz").alias("start_ts"),
                         (F.col("w.end") - F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz").alias("last_ts"), "n"))
    _run(stretches.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def outages(closed: DataFrame) -> DataFrame:
    """Pauses between consecutive closed stretches of a series."""
    in_series = Window.partitionBy("series_uid").orderBy("start_ts")
    return (closed.withColumn("until_ts", F.lead("start_ts").over(in_series))
            .filter(F.col("until_ts").isNotNull())
            .select("series_uid", F.col("last_ts").alias("from_ts"), "until_ts",
                    seconds_between(F.col("last_ts"), F.col("until_ts")).alias("outage_seconds")))


LAST_SEEN = T.StructType([T.StructField("series_uid", T.StringType()), T.StructField("last_ts", T.TimestampNTZType()),
                          T.StructField("bucket", T.IntegerType())])


def last_seen(rows: DataFrame, out: str, checkpoint: str, buckets: int = 16) -> None:
    """Keep the newest reading's time of every series, whatever order readings come in: a batch reads and rewrites the
    buckets of the series it holds. The merge takes the greater time, so a batch that runs again changes nothing."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.groupBy("series_uid").agg(F.max("datetime_utc").alias("last_ts"))
        new = sink.keep(new.withColumn("bucket", F.pmod(F.xxhash64("series_uid"), F.lit(buckets)).cast("int")), "seen")
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        known = sink.read(spark, out, LAST_SEEN)
        both = new if known is None else new.unionByName(known.filter(F.col("bucket").isin(touched)).select(new.columns))
        sink.commit(both.groupBy("series_uid", "bucket").agg(F.max("last_ts").alias("last_ts")), out, ["bucket"], ["series_uid"])
        sink.sweep(spark, out, min_age_seconds=86_400.0)

    _run(rows.writeStream.foreachBatch(apply), checkpoint)


def open_outages(spark: SparkSession, out: str, delay: str = WATERMARK, pause: str = "1 day") -> DataFrame:
    """Series that are silent now: no reading for over ``pause`` up to the newest reading of all less ``delay``, with how
    long that is so far. They show while the outage lasts, also if it never ends; :func:`outages` has those that have ended."""
    seen = sink.read(spark, out, LAST_SEEN)
    if seen is None:
        seen = spark.createDataFrame([], LAST_SEEN)
    now = seen.agg((F.max("last_ts") - F.expr(f"INTERVAL {delay}")).alias("now")).scalar()
    silent = seen.withColumn("as_of_ts", now).filter(F.col("last_ts") + F.expr(f"INTERVAL {pause}") < F.col("as_of_ts"))
    return silent.select("series_uid", F.col("last_ts").alias("from_ts"), "as_of_ts",
                         seconds_between(F.col("last_ts"), F.col("as_of_ts")).alias("outage_seconds"))
