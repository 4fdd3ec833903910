"""Table constraints as queries that return the violations."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .audit import in_domain

ROWS_A_TASK = 1_000_000  # whose keys, some 100 bytes each, a task holds twice while it counts them


def duplicate_keys(df: DataFrame, table: str, keys: list[str], null_is_distinct: bool = False) -> DataFrame:
    """Keys held by more than one row. UNIQUE keys let NULLs repeat (``null_is_distinct``).

    Nearly all keys are held once, so counting them before the shuffle saves nothing and holds a whole split's keys. Bare keys are
    dealt first, over as many tasks as their number asks for: a task's memory does not grow with the table.
    """
    if null_is_distinct:
        df = df.dropna(subset=keys)
    # Dealt by a code of the key, which stays a column where a key column is a constant that the planner drops.
    df = df.select(*keys, F.xxhash64(*keys).alias("_code"))
    df = df.repartition(max(1, math.ceil(df.count() / ROWS_A_TASK)), "_code")
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return (df.groupBy("_code", *keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                    key.alias("key"), "n"))


def all_duplicate_keys(tables: dict[str, DataFrame]) -> DataFrame:
    checks = [duplicate_keys(tables[t], t, k) for t, k in S.PRIMARY_KEYS.items() if t in tables]
    checks += [duplicate_keys(tables[t], t, k, True)
               for t, ks in S.UNIQUE_KEYS.items() if t in tables for k in ks]
    return reduce(DataFrame.unionByName, checks)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str) -> DataFrame:
    """Referenced values without a parent row, and how often each occurs; NULL passes.

    The child is reduced to its distinct values before the join.
    """
    used = (child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))
    known = parent.select(F.col(parent_column).alias("value"))
    return (used.join(known, "value", "left_anti")
            .select(F.lit(name).alias("reference"), F.col("value").cast("string").alias("value"), "n"))


def all_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    spark = tables["station"].sparkSession
    references = [
        ("series", "station_uid", tables["station"], "station_uid"),
        ("observation", "series_uid", tables["series"], "series_uid"),
        ("observation", "grade_code", S.grade_codes(spark), "grade_code"),
        ("observation", "approval_level", S.approval_levels(spark), "approval_level"),
        ("audit_discrepancy", "audit_id", tables["audit_log"], "audit_id"),
        ("audit_discrepancy", "series_uid", tables["series"], "series_uid"),
    ]
    return reduce(DataFrame.unionByName, [
        orphans(tables[t], c, parent, pc, f"{t}.{c}") for t, c, parent, pc in references])


def domain_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Values outside their column's domain, with counts."""
    found = []
    for table, rules in S.DOMAINS.items():
        for column, members in rules.items():
            bad = tables[table].filter(~in_domain(F.col(column), members))
            found.append(bad.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
                         .select(F.lit(f"{table}.{column}").alias("column_name"), "value", "n"))
    return reduce(DataFrame.unionByName, found)


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs per required column; each table is scanned once."""
    found = []
    for table, columns in S.NOT_NULL.items():
        counts = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        found.append(counts.unpivot([], columns, "column_name", "n_null")
                     .select(F.concat(F.lit(f"{table}."), F.col("column_name")).alias("column_name"), "n_null"))
    return reduce(DataFrame.unionByName, found)
