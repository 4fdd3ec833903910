"""Calendar gap scan, audit headers, snapshot comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..sinks.tables import keep
from ..sources.files import since


def gap_scan(obs: DataFrame, series: DataFrame, as_of, window_days: int = 30,
             scope: str = "reference", source: str = "wsc") -> DataFrame:
    """Days from ``window_days`` ago to today on which an instant series has no reading.

    ``scope='reference'`` scans every instant series although only ``source`` readings count, so
    series of other sources are all gap; ``scope='source'`` scans only series that have the source
    at all. The days a series has (at most the calendar window's length) are gathered in one
    pre-combined grouping and subtracted from the calendar.
    """
    start, end = F.to_date(C.days_before(as_of, window_days)), F.to_date(C.instant(as_of))
    calendar = F.sequence(start, end)
    recent = since(obs.filter(F.col("source") == source), "datetime_utc", as_of, window_days, strict=True)
    recent = recent.filter(F.col("datetime_utc") < end.cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    present = recent.groupBy("series_uid").agg(F.collect_set(F.to_date("datetime_utc")).alias("present"))
    scanned = series.filter(F.col("interval") == "instant").select("series_uid")
    if scope == "source":
        having = obs.filter(F.col("source") == source).select("series_uid").distinct()
        scanned = scanned.join(having, "series_uid", "left_semi")
    missing = F.array_except(calendar, F.coalesce("present", F.expr("cast(array() as array<date>)")))
    return scanned.join(present, "series_uid", "left").select(
        "series_uid", F.explode(missing).alias("day"), F.lit("gap").alias("kind"))


def discrepancies(gaps: DataFrame, audit_id: int, as_of) -> DataFrame:
    return S.conform(gaps.select(
        F.lit(audit_id).alias("audit_id"), "series_uid",
        F.col("day").cast("timestamp_ntz").alias("datetime_utc"), "kind",
        C.instant(as_of).alias("detected_ts")), S.AUDIT_DISCREPANCY)


def new_only(found: DataFrame, known: DataFrame) -> DataFrame:
    """Findings not already open, for audits that should not repeat themselves."""
    keys = ["series_uid", "datetime_utc", "kind"]
    return found.join(open_discrepancies(known).select(*keys).distinct(), keys, "left_anti")


def open_discrepancies(found: DataFrame) -> DataFrame:
    return found.filter(F.col("action_taken").isNull())


def audit_header(station: DataFrame, gaps: DataFrame) -> DataFrame:
    """One row: active federal stations checked, discrepancies found."""
    checked = station.filter((F.col("operator") == "WSC") & F.col("wsc_id").isNotNull())
    one = station.sparkSession.range(1)
    return one.select(
        checked.agg(F.count(F.lit(1))).scalar().alias("stations_checked"),
        gaps.agg(F.count(F.lit(1))).scalar().alias("discrepancies"))


def compare(ours: DataFrame, theirs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Differences of two snapshots of the same readings.

    Kinds: 'gap' (they have it, we do not), 'value_mismatch', 'grade_change'; a reading with both
    differences yields both rows. Comparisons are null-safe.
    """
    keys = keys or ["series_uid", "datetime_utc"]
    a = ours.select(*keys, F.col("value").alias("ours"), F.col("grade_code").alias("our_grade"),
                    F.lit(True).alias("in_ours"))
    b = theirs.select(*keys, F.col("value").alias("theirs"), F.col("grade_code").alias("their_grade"),
                      F.lit(True).alias("in_theirs"))
    both = a.join(b, keys, "full_outer")
    paired = F.col("in_ours") & F.col("in_theirs")
    kinds = F.array_compact(F.array(
        F.when(F.col("in_ours").isNull(), "gap"),
        F.when(paired & ~F.col("ours").eqNullSafe(F.col("theirs")), "value_mismatch"),
        F.when(paired & ~F.col("our_grade").eqNullSafe(F.col("their_grade")), "grade_change")))
    return both.select(*keys, "ours", "theirs", F.explode(kinds).alias("kind"))


def month_digests(rows: DataFrame) -> DataFrame:
    """Number of readings and two sums of hashes of time, value and grade per series and month: equal for equal sets of readings,
    and added up before anything moves."""
    content = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in ("datetime_utc", "value", "grade_code")]
    return rows.groupBy("series_uid", C.year_month(F.col("datetime_utc")).alias("ym")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*content).cast("decimal(38,0)")).alias("h1"),
        F.sum(F.xxhash64(F.lit("2"), *reversed(content)).cast("decimal(38,0)")).alias("h2"))


def unlike_months(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Series and months whose digests differ; of months that one side lacks only those that only they have matter, but both
    are told."""
    a = month_digests(ours).select("series_uid", "ym", F.struct("n", "h1", "h2").alias("a"))
    b = month_digests(theirs).select("series_uid", "ym", F.struct("n", "h1", "h2").alias("b"))
    return a.join(b, ["series_uid", "ym"], "full_outer").filter(~F.col("a").eqNullSafe(F.col("b"))).select("series_uid", "ym")


def compare_by_month(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """What :func:`compare` gives for whole archives, from the series and months whose digests differ alone: readings of
    equal months are summed up where they lie and never moved. Filters on ``ym`` skip the folders of months that are
    equal for all series, where the sides have that column."""
    unlike = keep(unlike_months(ours, theirs), "unlike")
    months = [r.ym for r in unlike.select("ym").distinct().collect()]  # at most the calendar's length

    def part(rows: DataFrame) -> DataFrame:
        own = rows.filter(F.col("ym").isin(months)) if "ym" in rows.columns else rows.withColumn("ym", C.year_month(F.col("datetime_utc")))
        return own.join(unlike, ["series_uid", "ym"], "left_semi")
    return compare(part(ours), part(theirs))


def next_id(df: DataFrame, column: str) -> int:
    return int(df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).alias("n")).first()["n"])


def in_domain(c: Column, members: list[str]) -> Column:
    """NULL passes, as for a CHECK constraint."""
    return c.isNull() | c.isin(members)
