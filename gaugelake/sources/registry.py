"""Station registry building and id lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C


def build_registry(network: DataFrame, prefix: str = "08NM", basin: str = "Okanagan") -> DataFrame:
    """Stations of one sub-basin as registry rows, in station order."""
    number = F.col("STATION_NUMBER")
    rows = network.filter(number.startswith(prefix)).select(
        C.wsc_station_uid(number).alias("station_uid"), number.alias("wsc_id"),
        F.col("STATION_NAME").alias("name"), F.lit("WSC").alias("operator"),
        F.lit("active").alias("status"), F.col("LATITUDE").alias("lat"),
        F.col("LONGITUDE").alias("lon"), F.lit(basin).alias("basin"))
    return S.conform(rows, S.STATION_REGISTRY).orderBy("wsc_id")


def active_wsc_ids(station: DataFrame) -> DataFrame:
    return (station.filter((F.col("operator") == "WSC") & F.col("wsc_id").isNotNull())
            .select("wsc_id").orderBy("wsc_id"))
