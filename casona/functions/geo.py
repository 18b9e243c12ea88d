"""Great-circle distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """The distance of two places; null if a coordinate is."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), F.lit(2.0))
    return 2 * EARTH_KM * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))
