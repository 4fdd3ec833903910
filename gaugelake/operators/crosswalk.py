"""One station for all the names it has with the authorities.

Each authority knows a station by an id of its own, and a station row may carry the ids of others. Rows that share an id
are one station, and so are rows connected over several; the rows of such a group get one canonical station.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.tables import keep
from .lineage import SOURCE_PRIORITY

AUTHORITY_IDS = ["wsc_id", "bc_aquarius_loc_id", "ona_id"]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``least`` (the least node that can be reached) of every node of links ``a``, ``b``.

    Rounds of two steps: every node takes the least label among its neighbours and itself, then the label of its label. The
    second step doubles how far a label reaches, so a chain of n takes about log n rounds. Labels are written each round.
    """
    both = keep(links.filter("a <> b").select("a", "b").unionByName(links.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    labels = keep(nodes.withColumn("least", F.col("node")), "labels")
    while True:
        heard = (both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "least")
                 .unionByName(labels).groupBy("node").agg(F.min("least").alias("least")))
        heard = keep(heard, "labels")
        far = heard.select(F.col("node").alias("via"), F.col("least").alias("beyond"))
        jumped = keep(heard.join(far, F.col("least") == F.col("via")).select("node", F.least("least", "beyond").alias("least")), "labels")
        moved = jumped.join(labels.withColumnRenamed("least", "before"), "node").filter("least <> before")
        if moved.isEmpty():
            return jumped
        labels = jumped


def canonical_stations(station: DataFrame, ids: list[str] = AUTHORITY_IDS) -> DataFrame:
    """``station_uid`` and ``canonical_uid`` for every station row.

    Stations meet at the ids they share, which are nodes of their own, so an id that many rows carry makes a link a row
    and no pairs. The group's row of the authority that wins between sources is its canonical station, then the least uid.
    """
    named = F.array_compact(F.array(*(F.when(F.col(c) != "", F.concat(F.lit(f"{c}:"), F.col(c))) for c in ids)))
    links = station.select(F.concat(F.lit("station:"), "station_uid").alias("a"), F.explode(named).alias("b"))
    found = components(links)
    group = (station.select("station_uid", "operator").join(found, F.concat(F.lit("station:"), "station_uid") == F.col("node"), "left")
             .select("station_uid", "operator", F.coalesce("least", F.concat(F.lit("station:"), "station_uid")).alias("least")))
    rank = F.lit(0)
    for name, n in SOURCE_PRIORITY.items():
        rank = F.when(F.lower("operator") == name, n).otherwise(rank)
    heads = group.groupBy("least").agg(F.min(F.struct((-rank).alias("rank"), "station_uid")).alias("head"))
    return group.join(heads, "least").select("station_uid", F.col("head.station_uid").alias("canonical_uid"))


def by_canonical_station(obs: DataFrame, series: DataFrame, stations: DataFrame) -> DataFrame:
    """Observations with ``canonical_uid``, ``parameter`` and ``interval`` of their series: the key of the reconciliation across
    authorities (:func:`lineage.canonical`)."""
    keyed = series.join(stations, "station_uid").select("series_uid", "canonical_uid", "parameter", "interval")
    return obs.join(keyed, "series_uid")
