"""Column expressions on coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between two points in degrees."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    # Rounding may carry `a` past 1; a missing coordinate stays missing, which least() would not give.
    return F.asin(F.when(a > 1, F.lit(1.0)).otherwise(F.sqrt(a))) * (2 * EARTH_RADIUS_M)


def point_text(lat: Column, lon: Column) -> Column:
    """Coordinates as text, longitude first."""
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
