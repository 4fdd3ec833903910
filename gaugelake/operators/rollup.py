"""Per-series partial results and gap finding.

Reports never join raw readings to the dimensions: readings are first reduced per series (and
source, day, year or approval level) with aggregates that combine before the shuffle, and only
those few rows are joined. A series holding most of the archive costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import seconds_between


def by_series(obs: DataFrame, *keys) -> DataFrame:
    """Count, span and approval counts per series and extra keys; unused columns are pruned."""
    approval = F.col("approval_level")
    return obs.groupBy("series_uid", *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("datetime_utc").alias("first_ts"), F.max("datetime_utc").alias("last_ts"),
        F.count_if(approval == "approved").alias("n_approved"),
        F.count_if(approval.isin("approved", "reviewed")).alias("n_qaqc"))


def partials(obs: DataFrame, folder: list[str]) -> DataFrame:
    """Readings counted per series, source, approval level and folder, to be stored beside them."""
    return obs.groupBy("series_uid", "source", "approval_level", *folder).agg(
        F.count(F.lit(1)).alias("n"), F.min("datetime_utc").alias("first_ts"), F.max("datetime_utc").alias("last_ts"))


def merged_partials(kept: DataFrame, *keys) -> DataFrame:
    """What :func:`by_series` gives, from stored partials. A key must be one value per partial: source, approval
    level, month or year."""
    approval, nothing = F.col("approval_level"), F.lit(0).cast("long")
    return kept.groupBy("series_uid", *keys).agg(
        F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.sum(F.when(approval == "approved", F.col("n")).otherwise(nothing)).alias("n_approved"),
        F.sum(F.when(approval.isin("approved", "reviewed"), F.col("n")).otherwise(nothing)).alias("n_qaqc"))


def days_with_gap_before(obs: DataFrame) -> DataFrame:
    """One row per series and day with readings; ``after_gap`` marks days whose first reading
    comes more than one day after the series' previous reading.

    Readings of one calendar day are less than a day apart, so only the step from one day's
    last reading to the next day's first can exceed a day. The window therefore runs over
    days - at most the calendar's length per series - and not over readings.
    """
    days = by_series(obs, F.to_date("datetime_utc").alias("day"))
    in_series = Window.partitionBy("series_uid").orderBy("day")
    step = F.col("first_ts") - F.lag("last_ts").over(in_series)
    return days.select("series_uid", "day", "n",
                       F.coalesce(step > F.expr("INTERVAL 1 DAY"), F.lit(False)).alias("after_gap"))


def reading_gaps(obs: DataFrame, bucket: str = "month") -> DataFrame:
    """Every reading with the seconds since the previous reading of its series (NULL for the first).

    A plain ``lag`` over the series would sort a whole series in one task. Here each series is
    cut into time buckets: the last reading before a bucket (found over one row per bucket) is
    added to that bucket, and ``lag`` runs within buckets.
    """
    rows = obs.select("series_uid", "datetime_utc", "source",
                      F.date_trunc(bucket, "datetime_utc").cast("timestamp_ntz").alias("bucket"),
                      F.lit(True).alias("is_row"))
    ends = rows.groupBy("series_uid", "bucket").agg(F.max("datetime_utc").alias("end_ts"))
    over_buckets = Window.partitionBy("series_uid").orderBy("bucket")
    carried = (ends.withColumn("datetime_utc", F.lag("end_ts").over(over_buckets))
               .filter(F.col("datetime_utc").isNotNull())
               .select("series_uid", "datetime_utc", F.lit(None).cast("string").alias("source"),
                       "bucket", F.lit(False).alias("is_row")))
    # The carried reading is earlier than all of the bucket; ties by source keep the order total.
    in_bucket = Window.partitionBy("series_uid", "bucket").orderBy("datetime_utc", "source")
    return (rows.unionByName(carried)
            .withColumn("previous_ts", F.lag("datetime_utc").over(in_bucket)).filter("is_row")
            .select("series_uid", "datetime_utc", "source",
                    seconds_between(F.col("previous_ts"), F.col("datetime_utc")).alias("gap_seconds")))
