"""Keyed merges: upsert, insert-ignore, slice replacement, keyed update.

Only the batch is reduced to one row per key. The target is joined to it in place: while the batch
is small the planner broadcasts it and the target is neither shuffled nor sorted; beyond that the
join is a sort-merge with skew splitting, or one full join where the caller knows the batch to be large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S

WSC_UPDATES = ["value", "qualifier_flags", "ingest_ts"]
BC_UPDATES = ["value", "grade_code", "approval_level", "ingest_ts"]
STATION_UPDATES = ["bc_aquarius_loc_id", "name", "lat", "lon", "geom"]
WELL_UPDATES = [*STATION_UPDATES, "station_type"]


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], update: list[str],
           order_by: list[str] | None = None, on_dup: str = "last",
           touched: str | None = None, large: bool = False) -> DataFrame:
    """New keys are inserted whole; known keys take only the ``update`` columns.

    Several incoming rows of one key: ``on_dup='last'`` takes the greatest by ``order_by`` and
    then by the row's own columns (a total order), ``'error'`` fails the job. ``touched`` names
    an extra boolean column marking inserted and updated rows. ``large`` says that the batch is too big to be broadcast:
    known and new keys then come from one full join, so either side moves once.
    """
    rest = [c for c in target.columns if c not in keys]
    batch = _one_per_key(incoming, keys, order_by, rest, last=True, unique=on_dup == "error")
    new = batch.select(*keys, F.struct(*rest).alias("_new"))
    hit = F.col("_new").isNotNull()
    if large:
        held = F.col("_old").isNotNull()
        values = {c: F.when(hit if c in update else ~held, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")) for c in rest}
        both = target.select(*keys, F.struct(*rest).alias("_old")).join(new, keys, "full")
        return both.select(*(values[c].alias(c) if c in values else F.col(c) for c in target.columns), *([hit.alias(touched)] if touched else []))
    columns = [F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
               for c in target.columns]
    kept = target.join(new, keys, "left").select(*columns, *([hit.alias(touched)] if touched else []))
    added = _absent(batch, target, keys).select(target.columns)
    return kept.unionByName(added.withColumn(touched, F.lit(True)) if touched else added)


def _absent(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key the target lacks; only the batch side and the keys it hits move."""
    present = target.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(present, keys, "left_anti")


def upsert_wsc(target: DataFrame, incoming: DataFrame, **kw) -> DataFrame:
    return upsert(target, incoming, S.OBSERVATION_KEY, WSC_UPDATES, **kw)


def upsert_bc(target: DataFrame, incoming: DataFrame, **kw) -> DataFrame:
    return upsert(target, incoming, S.OBSERVATION_KEY, BC_UPDATES, **kw)


def upsert_station(target: DataFrame, incoming: DataFrame, wells: bool = False, **kw) -> DataFrame:
    return upsert(target, incoming, ["station_uid"], WELL_UPDATES if wells else STATION_UPDATES, **kw)


def last_of_batch(incoming: DataFrame, keys: list[str], order_by: list[str], columns: list[str]) -> DataFrame:
    """One row per key: the last by ``order_by``, then by the remaining columns."""
    return _one_per_key(incoming, keys, order_by, [c for c in columns if c not in keys], last=True).select(columns)


def _one_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None, rest: list[str], last: bool,
                 unique: bool = False) -> DataFrame:
    """The first or last row per key in a total order: the one with none before it. Unlike a rank limited to 1, which the
    planner also takes before the shuffle, this sorts shuffled partitions only, never whole input splits, whose rows do
    not fit a task's memory as inputs grow."""
    order = [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_first() for c in [*(order_by or []), *rest]]
    window = Window.partitionBy(*keys)
    if unique:
        df = df.withColumn("_n", F.count(F.lit(1)).over(window)).filter(
            F.when(F.col("_n") > 1, F.raise_error(F.lit("one key occurs twice in the batch")).cast("boolean")).otherwise(True))
    return (df.withColumn("_before", F.lag(F.lit(True)).over(window.orderBy(*order))).filter("_before IS NULL")
            .select(*keys, *rest))


def batch_duplicates(incoming: DataFrame, keys: list[str]) -> DataFrame:
    return incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: list[str],
                  order_by: list[str] | None = None) -> DataFrame:
    """Adds only keys not yet present; of several incoming rows of a key the first one."""
    first = _one_per_key(incoming, keys, order_by, [c for c in target.columns if c not in keys], last=False)
    return target.unionByName(_absent(first, target, keys).select(target.columns))


def merge_counts(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """One row: inserted, updated, and affected (their sum)."""
    sides = (target.select(*keys, F.lit(0).alias("_side"))
             .unionByName(incoming.select(*keys, F.lit(1).alias("_side")))
             .groupBy(*keys).agg(F.min("_side").alias("lo"), F.max("_side").alias("hi")))
    return sides.agg(F.count_if(F.col("lo") == 1).alias("inserted"),
                     F.count_if((F.col("lo") == 0) & (F.col("hi") == 1)).alias("updated"),
                     F.count_if(F.col("hi") == 1).alias("affected"))


def replace_slice(target: DataFrame, predicate: Column, new: DataFrame) -> DataFrame:
    """Delete by predicate, then append. Rows whose predicate is NULL stay, as in SQL DELETE."""
    return target.filter(~F.coalesce(predicate, F.lit(False))).unionByName(new)


def enrich_stations(station: DataFrame, meta: DataFrame) -> DataFrame:
    """Update stations by wsc_id: area and regulation are overwritten, coordinates only filled in."""
    m = meta.select(
        F.col("STATION_NUMBER").alias("wsc_id"), F.lit(True).alias("_hit"),
        F.col("DRAINAGE_AREA_GROSS").alias("_area"),
        F.when(F.col("REGULATED"), "regulated").when(F.col("REGULATED").isNotNull(), "natural").alias("_reg"),
        F.col("LATITUDE").alias("_lat"), F.col("LONGITUDE").alias("_lon"))
    hit = F.col("_hit").isNotNull()
    rules = {
        "drainage_area_km2": F.when(hit, F.col("_area")).otherwise(F.col("drainage_area_km2")),
        "regulation_status": F.when(hit, F.col("_reg")).otherwise(F.col("regulation_status")),
        "lat": F.coalesce("_lat", "lat"),
        "lon": F.coalesce("_lon", "lon"),
    }
    return station.join(m, "wsc_id", "left").select(
        [rules.get(c, F.col(c)).alias(c) for c in station.columns])
