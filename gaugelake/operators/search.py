"""Fuzzy name search and location search over stations. A few literal terms or points are compared while the table is
read; two tables meet on rare trigrams or on map cells, never row by row.

The reference declares the indexes for these look-ups and runs none of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from ..sinks.tables import keep


def name_search(df: DataFrame, column: str, terms: list[str], threshold: float = 0.3) -> DataFrame:
    """Rows whose name resembles a search term, with the similarity."""
    # The few terms are cut up once, not per row.
    given = df.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    cut = given.select("term", text.trigrams(F.col("term")).alias("grams")).collect()
    wanted = F.array(*[F.struct(F.lit(r.term).alias("term"), F.array(*[F.lit(g) for g in r.grams]).alias("grams"))
                       for r in cut])
    scored = df.withColumn("_grams", text.trigrams(F.col(column))).select(
        "*", F.inline(F.transform(wanted, lambda w: F.struct(
            w["term"].alias("term"), text.similarity(F.col("_grams"), w["grams"]).alias("similarity")))))
    return scored.filter(F.col("similarity") >= threshold).drop("_grams")


def in_bbox(station: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    return station.filter(geo.in_box(F.col("lat"), F.col("lon"), south, west, north, east))


def nearest(station: DataFrame, points: list[tuple[str, float, float]]) -> DataFrame:
    """For each (id, lat, lon) the closest station; equal distances go to the lower uid.

    Every station is compared with the given points while it is read, and the per-point minimum
    combines before the shuffle.
    """
    given = F.array(*[F.struct(F.lit(i).alias("point_id"), F.lit(float(a)).alias("lat"),
                               F.lit(float(o)).alias("lon")) for i, a, o in points])
    located = station.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    distance = geo.haversine_km(F.col("p.lat"), F.col("p.lon"), F.col("lat"), F.col("lon"))
    best = (located.select("station_uid", "lat", "lon", F.explode(given).alias("p"))
            .groupBy(F.col("p.point_id").alias("point_id"))
            .agg(F.min(F.struct(distance.alias("km"), "station_uid")).alias("best")))
    return best.select("point_id", "best.station_uid", F.round("best.km", 6).alias("distance_km"))


# Stations a leaf cell of the search may hold before it is split further, and the finest split (some metres).
LEAF, FINEST = 32, 10


def _unit(lat: Column, lon: Column) -> dict[str, Column]:
    """A place on the unit sphere. The straight way through the sphere grows with the great circle and knows neither poles nor
    a date line."""
    lat, lon = F.radians(lat), F.radians(lon)
    return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}


def _cube(level: int) -> Column:
    """Number of the cube cell that holds (x, y, z), 4 ** level cells along each axis; a place that is no number has its own."""
    n = 4 ** level
    cx, cy, cz = (F.least(F.floor((F.col(c) + 1) / 2 * n), F.lit(n - 1)) for c in "xyz")
    return (F.when(F.isnan("x"), -1).otherwise(cx) * n + cy) * n + cz


def _cube_levels(places: DataFrame) -> list[DataFrame]:
    """Cells that hold places, level by level until all are small: each with its parent, its bounds and one of its places."""
    levels = []
    for level in range(1, FINEST + 1):
        bounds = [f(c).alias(f"{name}_{c}") for c in "xyz" for name, f in (("lo", F.min), ("hi", F.max))]
        cells = keep(places.groupBy(_cube(level - 1).alias("parent"), _cube(level).alias("child"))
                     .agg(*bounds, F.min(F.struct(*"xyz")).alias("one"), F.count(F.lit(1)).alias("n")), "cells")
        levels.append(cells.drop("n"))
        if cells.filter(F.col("n") > LEAF).isEmpty():
            break
    return levels


def nearest_points(station: DataFrame, points: DataFrame) -> DataFrame:
    """For each row of ``points(point_id, lat, lon)`` the closest station; equal distances go to the lower uid.

    A descent through cells that are split by four along each axis: at each level a point keeps the cells that may hold its
    closest station, those that begin no farther off than the nearest place known from the cells seen so far. Only the
    stations of the smallest cells left are compared by distance. A point far from all stations keeps few cells too. Points
    without a place are left out; without stations there are no rows. A point_id names one place.
    """
    located = station.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    places = keep(located.groupBy("lat", "lon").agg(F.min("station_uid").alias("station_uid")).withColumns(_unit(F.col("lat"), F.col("lon"))), "places")
    levels = _cube_levels(places)
    who = ["point_id", "p_lat", "p_lon"]
    asked = points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("point_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    at = {f"p_{c}": place for c, place in _unit(F.col("p_lat"), F.col("p_lon")).items()}
    roots = F.array(F.lit(0).cast("long"), F.lit(-1).cast("long"))  # the second one holds places that are no number
    left = asked.distinct().withColumns({**at, "cell": F.explode(roots), "near": F.lit(3.0)})

    def apart(axis: Callable[[str], Column]) -> Column:
        return F.sqrt(sum((axis(c) * axis(c) for c in "yz"), axis("x") * axis("x")))

    for cells in levels:
        met = left.join(cells, F.col("cell") == F.col("parent")).select(
            *who, *at, F.col("child").alias("cell"), "near",
            apart(lambda c: F.greatest(F.col(f"lo_{c}") - F.col(f"p_{c}"), F.col(f"p_{c}") - F.col(f"hi_{c}"), F.lit(0.0))).alias("begins"),
            apart(lambda c: F.col(f"one.{c}") - F.col(f"p_{c}")).alias("some"))
        # Far more than what rounding does to either distance.
        may = (F.col("begins") <= F.col("near") * (1 + 1e-12) + 1e-12) | (F.isnan("begins") & (F.col("near") == 3.0))
        left = (met.filter(may).withColumn("near", F.min(F.least("near", "some")).over(Window.partitionBy(*who)))
                .filter(may).drop("begins", "some"))
    held = places.select("station_uid", "lat", "lon", _cube(len(levels)).alias("held_in"))
    km = geo.haversine_km(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lon"))
    best = (left.join(held, F.col("cell") == F.col("held_in")).groupBy(*who)
            .agg(F.min(F.struct(km.alias("km"), "station_uid")).alias("best")))
    return best.select("point_id", "best.station_uid", F.round("best.km", 6).alias("distance_km"))


def similar_names(left: DataFrame, right: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Pairs ``left_name``, ``right_name``, ``similarity`` of distinct names of ``left(name)`` and ``right(name)`` whose
    trigrams reach ``threshold``, which is over 0. Names without trigrams resemble nothing.

    An inverted index over trigrams, by prefixes: with a name's trigrams in order of rarity, two names that are similar
    enough share one among the first n - ceil(threshold * n) + 1 of each. Only those meet, if their numbers of trigrams
    allow it; the candidates' whole trigrams are compared after. Very common trigrams come last and index few names.
    """
    sides = {}
    for side, names in (("left", left), ("right", right)):
        own = names.filter(F.col("name").isNotNull()).select(F.col("name").alias(f"{side}_name")).distinct()
        sides[side] = keep(own.select("*", text.trigrams(F.col(f"{side}_name")).alias(f"{side}_grams")).filter(F.size(f"{side}_grams") > 0), "names")
    every = sides["left"].select(F.explode("left_grams").alias("gram")).unionByName(sides["right"].select(F.explode("right_grams").alias("gram")))
    rarity = keep(every.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams")

    def index(side: str) -> DataFrame:
        name, grams = f"{side}_name", f"{side}_grams"
        size = F.size(grams)
        placed = (sides[side].select(name, size.alias(f"{side}_size"), F.explode(grams).alias("gram")).join(rarity, "gram")
                  .groupBy(name, f"{side}_size").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("order")))  # a name's own trigrams
        prefix = F.col(f"{side}_size") - F.ceil(F.col(f"{side}_size") * threshold - 1e-9).cast("int") + 1
        return placed.select(name, f"{side}_size", F.explode(F.slice("order", F.lit(1), prefix)["gram"]).alias("gram"))

    low, high = F.least("left_size", "right_size"), F.greatest("left_size", "right_size")
    pairs = index("left").join(index("right"), "gram").filter(low >= high * threshold - 1e-9).select("left_name", "right_name").distinct()
    scored = (pairs.join(sides["left"], "left_name").join(sides["right"], "right_name")
              .select("left_name", "right_name", text.similarity(F.col("left_grams"), F.col("right_grams")).alias("similarity")))
    return scored.filter(F.col("similarity") >= threshold)
