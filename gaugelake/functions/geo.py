"""Distances and boxes on longitude/latitude pairs in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), F.lit(2.0))
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), F.lit(2.0)))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def in_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)
