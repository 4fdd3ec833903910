"""Reconciliation and lineage. The reference declares these tables but computes none of them;
where it names no formula, the choice made here is stated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C

# Which source wins between equally approved readings (greater wins).
SOURCE_PRIORITY = {"ona": 4, "bc": 3, "wsc": 2, "goes": 1}


def _priority(source: Column) -> Column:
    rank = F.lit(0)
    for name, n in SOURCE_PRIORITY.items():
        rank = F.when(source == name, n).otherwise(rank)
    return rank


def _approval_rank(level: Column) -> Column:
    rank = F.lit(-1)
    for name, n, _ in S.APPROVAL_LEVELS:
        rank = F.when(level == name, n).otherwise(rank)
    return rank


def canonical(obs: DataFrame, keys: list[str], reconciled_ts) -> DataFrame:
    """The authoritative reading per key: best approval, then source, then latest ingest.

    Remaining ties go to the greatest value, so the pick is one total order. Keys are nearly unique, so
    nothing is gained by combining before the shuffle; rows move once and are ranked.
    """
    order = [_approval_rank(F.col("approval_level")), _priority(F.col("source")), F.col("ingest_ts"),
             *(F.col(c) for c in ("value", "grade_code", "approval_level", "source"))]
    ranked = obs.withColumn("_row", F.row_number().over(
        Window.partitionBy(*keys).orderBy(*(c.desc_nulls_last() for c in order))))
    return ranked.filter("_row = 1").select(
        *keys, "value", "grade_code", "approval_level", F.col("source").alias("authoritative_source"),
        C.instant(reconciled_ts).alias("last_reconciled_ts"))


def interval_join(facts: DataFrame, intervals: DataFrame, key: str, ts: str, start: str, end: str,
                  how: str = "inner", closed_end: bool = True) -> DataFrame:
    """Facts with every interval of the same key that holds their time.

    Intervals are laid out per calendar month they touch (a NULL bound reaches to the facts' own
    first or last time, a subquery of the plan), so the join is on key and month with the exact bounds checked after, and
    adaptive skew handling can split a hot series' month. The planner's estimate does not know how many months an interval
    has and would send the laid-out rows through the driver; so the sides are shuffled and merged.
    """
    span = facts.agg(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    begin, finish = F.greatest(F.coalesce(start, lo), lo), F.least(F.coalesce(end, hi), hi)
    intervals = intervals.filter(begin <= finish)
    months = F.sequence(F.trunc(begin, "MM"), F.trunc(finish, "MM"), F.expr("INTERVAL 1 MONTH"))
    laid = intervals.withColumn("_month", F.explode(months)).withColumnRenamed(key, "_key")
    f = facts.withColumn("_fact_month", F.trunc(ts, "MM"))
    upper = F.col(ts) <= F.col(end) if closed_end else F.col(ts) < F.col(end)
    on = ((F.col(key) == F.col("_key")) & (F.col("_fact_month") == F.col("_month"))
          & (F.col(start).isNull() | (F.col(ts) >= F.col(start)))
          & (F.col(end).isNull() | upper))
    return f.join(laid.hint("merge"), on, how).drop("_key", "_month", "_fact_month")


def disjoint(intervals: DataFrame, key: str, start: str, end: str, order: list[str]) -> DataFrame:
    """Intervals (half-open, NULL bounds open) flattened to disjoint pieces of each key: where several hold, the one with the
    greatest ``order`` columns does, NULL being least. Columns stay, the bounds are those of the piece.

    A sweep: the bounds of a key in order cut it into elementary pieces; each piece meets the intervals of its key that hold
    its beginning (:func:`interval_join`, on key and month), and neighbours that the same interval won are put together
    again. Intervals that hold nothing are dropped.
    """
    rows = intervals.filter(F.col(start).isNull() | F.col(end).isNull() | (F.col(start) < F.col(end)))
    span = rows.select(F.explode(F.array(start, end)).alias("at")).agg(F.struct(F.min("at").alias("lo"), F.max("at").alias("hi"))).scalar()
    some = F.lit("1970-01-01").cast("timestamp_ntz")
    low, high = (F.coalesce(b, some) + F.expr(f"INTERVAL '{n}' DAY") for b, n in ((span["lo"], -1), (span["hi"], 1)))
    closed = rows.withColumns({"_lo": F.coalesce(F.col(start), low), "_hi": F.coalesce(F.col(end), high), "_row": F.struct(*intervals.columns)})
    ordered = Window.partitionBy(key).orderBy("_at")
    pieces = (closed.select(key, F.explode(F.array("_lo", "_hi")).alias("_at")).distinct()
              .withColumn("_until", F.lead("_at").over(ordered)).filter("_until IS NOT NULL"))
    held = interval_join(pieces, closed.select(key, "_lo", "_hi", "_row"), key, "_at", "_lo", "_hi", closed_end=False)
    best = F.struct(*(F.col(f"_row.{c}").alias(f"o{i}") for i, c in enumerate(order)), F.col("_row").alias("row"))
    won = held.groupBy(key, "_at", "_until").agg(F.max(best).alias("w")).select(key, "_at", "_until", "w.row")
    before = F.lag("row").over(ordered).eqNullSafe(F.col("row")) & (F.lag("_until").over(ordered) == F.col("_at"))
    runs = won.withColumn("_new", F.when(F.coalesce(before, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(ordered))
    joined = runs.groupBy(key, "_run").agg(F.min("_at").alias("_at"), F.max("_until").alias("_until"), F.first("row").alias("row"))
    bounds = {start: F.when(F.col("_at") > low, F.col("_at")), end: F.when(F.col("_until") < high, F.col("_until"))}
    return joined.select(*((bounds[c] if c in bounds else F.col(f"row.{c}")).alias(c) for c in intervals.columns))


def with_corrections(obs: DataFrame, corrections: DataFrame) -> DataFrame:
    """Readings with every correction that holds at their time; several kinds apply at once."""
    c = corrections.select("correction_id", "series_uid", "applied_from", "applied_to", "correction_type")
    return interval_join(obs, c, "series_uid", "datetime_utc", "applied_from", "applied_to")


def rated_discharge(stage: DataFrame, ratings: DataFrame) -> DataFrame:
    """Discharge from stage by the rating in effect; half-open effective intervals. Where ratings of a station overlap, the
    one that came into effect last holds, then the greater id, so a reading has one rating at most.

    The equation's form is this package's choice: q = a * (stage - offset) ^ b with a and b from
    the JSON parameters, NULL at or below the offset.
    """
    params = F.from_json("equation_params", "map<string,double>")
    r = ratings.select("rating_uid", "station_uid", "effective_from", "effective_to",
                       params["a"].alias("_a"), params["b"].alias("_b"), F.col("offset").alias("_offset"))
    r = disjoint(r, "station_uid", "effective_from", "effective_to", ["effective_from", "rating_uid"])
    rated = interval_join(stage, r, "station_uid", "datetime_utc", "effective_from", "effective_to",
                          closed_end=False)
    depth = F.col("stage_h") - F.col("_offset")
    q = F.when(depth > 0, F.col("_a") * F.pow(depth, F.col("_b")))
    return rated.withColumn("rated_q", q).drop("_a", "_b", "_offset", "effective_from", "effective_to")


def rating_deviation(measurements: DataFrame, ratings: DataFrame) -> DataFrame:
    """(measured - rated) / rated * 100; the formula is this package's choice."""
    rated = rated_discharge(measurements, ratings)
    return rated.withColumn("rating_deviation_pct", F.round(
        (F.col("measured_q") - F.col("rated_q")) / F.nullif(F.col("rated_q"), F.lit(0.0)) * 100, 4))


def decode_qualifiers(obs: DataFrame) -> DataFrame:
    """Flags as labels, with estimate and ice flags set from 'E' and 'B'.

    The legend is a handful of fixed rows, so it is a literal map and no join is needed.
    """
    legend = F.create_map(*[F.lit(x) for code, _, label, _ in S.QUALIFIER_CODES for x in (code, label)])
    flags = F.col("qualifier_flags")
    return obs.withColumns({
        "qualifier_labels": F.array_join(F.transform(flags, lambda f: F.coalesce(legend[f], f)), ","),
        "estimate_flag": F.coalesce(F.array_contains(flags, "E"), F.lit(False)),
        "ice_flag": F.coalesce(F.array_contains(flags, "B"), F.lit(False)),
    })


def decode_grades(obs: DataFrame) -> DataFrame:
    legend = S.grade_codes(obs.sparkSession).select(
        "grade_code", F.col("label").alias("grade_label"), F.col("description").alias("grade_description"))
    # Bounded: the legend is a constant of this package.
    return obs.join(F.broadcast(legend), "grade_code", "left")
