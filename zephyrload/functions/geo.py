"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius.
EARTH_RADIUS_KM = 6371


def haversine_km(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_KM
) -> Column:
    """Great-circle distance between two points given in degrees."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    h = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    return F.asin(F.least(F.lit(1.0), F.sqrt(h))) * (2 * radius)


def unit_vector(lat: Column, lon: Column) -> list[Column]:
    """x, y, z on the unit sphere."""
    phi, lam = F.radians(lat), F.radians(lon)
    return [F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)]
