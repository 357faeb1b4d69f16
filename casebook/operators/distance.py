"""Distance of facts to the reference point of their key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.geo import flat_distance_m
from casebook.operators.joining import BROADCAST_BYTES, attach_dimension


def distance_by_key(
    facts: DataFrame,
    points: DataFrame,
    key: str,
    point_key: str,
    *,
    lat: str = "latitude",
    lon: str = "longitude",
    point_lat: str = "latitude",
    point_lon: str = "longitude",
    mean_name: str = "avg_dist_to_station_m",
    count_name: str = "crime_count",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mean distance in metres and number of facts per key.

    A fact is measured to the points of its own key, which need not be the nearest, and counts
    once per such point.
    """
    paired = attach_dimension(
        facts.select(key, lat, lon),
        points,
        key,
        point_key,
        {point_lat: "_point_lat", point_lon: "_point_lon"},
        max_bytes=max_bytes,
    )
    distance = flat_distance_m(F.col(lat), F.col(lon), F.col("_point_lat"), F.col("_point_lon"))
    return paired.groupBy(key).agg(
        F.round(F.avg(distance), 2).alias(mean_name),
        F.count(F.lit(1)).alias(count_name),
    )
