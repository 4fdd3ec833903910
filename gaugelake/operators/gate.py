"""Constraints as a gate before a write: rows of a batch that break a rule are told apart before the merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from .audit import in_domain

KEYS = {**S.PRIMARY_KEYS, **S.DECLARED_KEYS}
NOT_NULL = {**S.NOT_NULL, **S.DECLARED_NOT_NULL}


def _own_rules(table: str) -> Column:
    """The first rule that a row breaks by itself."""
    reason = F.lit(None).cast("string")
    for column in NOT_NULL.get(table, []):
        reason = F.coalesce(reason, F.when(F.col(column).isNull(), f"null {column}"))
    for column, members in S.DOMAINS.get(table, {}).items():
        reason = F.coalesce(reason, F.when(~in_domain(F.col(column), members), f"domain {column}"))
    return reason


def _clashes(batch: DataFrame, committed: DataFrame | None, key: list[str], unique: list[str]) -> DataFrame:
    """Values of UNIQUE columns that rows of different keys hold, in the batch or against the committed rows; NULLs never
    clash. One row a value, from aggregates that combine before the shuffle."""
    own = F.struct(*key)
    rows = batch.select(*unique, own.alias("k"), F.lit(True).alias("new"))
    if committed is not None:
        rows = rows.unionByName(committed.select(*unique, own.alias("k"), F.lit(False).alias("new")))
    found = rows.dropna(subset=unique).groupBy(*unique).agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.max("new").alias("new"))
    return found.filter("new AND lo <> hi").select(*unique)


def tagged(batch: DataFrame, table: str, committed: dict[str, DataFrame]) -> DataFrame:
    """The batch with ``reason``: the first rule a row breaks, or NULL. Rules in order: NOT NULL, domains, a key twice in the batch
    (the first row by its columns stays), UNIQUE columns, references. ``committed`` has the archive's tables; a parent that is
    not among them has no rows. A row whose key is committed already is an update and no violation.

    References are looked up by the batch's distinct values, so a parent that a third of the rows name is one of them.
    """
    spark, key = batch.sparkSession, KEYS.get(table)
    rows = batch.withColumn("reason", _own_rules(table))
    if key:
        first = Window.partitionBy(*key).orderBy(F.col("reason").isNotNull(), *batch.columns)
        twice = F.row_number().over(first) > 1
        rows = rows.withColumn("_nth", twice).withColumn("reason", F.coalesce("reason", F.when(F.col("_nth"), "duplicate key"))).drop("_nth")
    for unique in S.UNIQUE_KEYS.get(table, []):
        clash = _clashes(batch, committed.get(table), key, unique).withColumn("_clash", F.lit(True))
        rows = (rows.join(clash, unique, "left")
                .withColumn("reason", F.coalesce("reason", F.when(F.col("_clash"), "unique " + ",".join(unique)))).drop("_clash"))
    lookups = {"grade_code": S.grade_codes, "approval_level": S.approval_levels, "qualifier_code": S.qualifier_codes}
    for column, parent in S.REFERENCES.get(table, {}).items():
        held = committed.get(parent)
        if held is None and parent in lookups:
            held = lookups[parent](spark)
        used = batch.select(F.col(column).alias("_value")).filter("_value IS NOT NULL").distinct()
        if held is not None:
            used = used.join(held.select(F.col(KEYS[parent][0]).alias("_value")), "_value", "left_anti")
        rows = (rows.join(used.withColumn("_missing", F.lit(True)), F.col(column) == F.col("_value"), "left")
                .withColumn("reason", F.coalesce("reason", F.when(F.col("_missing"), f"reference {column}"))).drop("_value", "_missing"))
    return rows.select(*batch.columns, "reason")


def with_body(rows: DataFrame, table: str, source: str) -> DataFrame:
    """Tagged rows as the quarantine wants them: the bad ones with their columns as JSON, named after where they came from."""
    columns = [c for c in rows.columns if c != "reason"]
    return rows.withColumns({"body": F.when(F.col("reason").isNotNull(), F.to_json(F.struct(*columns))),
                             "pulled_from": F.lit(f"{source}#{table}"), "pulled_at": F.lit(None).cast("timestamp_ntz")})
