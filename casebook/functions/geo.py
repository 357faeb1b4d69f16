"""Coordinate predicates and distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: metres per degree used by the flat-earth distance.
METRES_PER_DEGREE = 111_000.0


def usable(coordinate: Column) -> Column:
    """A coordinate that was really measured: present, a finite number, not the filler 0."""
    return coordinate.isNotNull() & (F.abs(coordinate) < float("inf")) & (coordinate != 0)


def flat_distance_m(lat: Column, lon: Column, to_lat: Column, to_lon: Column, digits: int = 2) -> Column:
    """Local flat-earth distance in metres, null when either point is missing.

    The meridians close in with the latitude of the starting point.
    """
    north = (lat - to_lat) * METRES_PER_DEGREE
    east = (lon - to_lon) * METRES_PER_DEGREE * F.cos(F.radians(lat))
    return F.round(F.sqrt(north * north + east * east), digits)
