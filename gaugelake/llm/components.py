"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label`` (least id of its component) for every id in links ``a``, ``b``; self-links are ignored.

    Each step points neighbours at the least id among them, first those above a node, then those below, until
    nothing changes. Links move by joins on ids with partial minima; no component is gathered in one place.
    """
    edges = (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                                               F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        edges = keep(small, "components")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
    tops = edges.select(F.col("b").alias("id"), F.col("b").alias("label"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(tops).distinct()
