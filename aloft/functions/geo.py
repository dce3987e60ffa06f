"""Great-circle distance (X8) and the grid cells used by the radius join."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km used by the distance formula.
EARTH_RADIUS_KM = 6371.0


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km between two points given in degrees (atan2 form)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = F.radians(_c(lat2) - _c(lat1))
    dlon = F.radians(_c(lon2) - _c(lon1))
    a = F.sin(dlat / 2) * F.sin(dlat / 2) + F.cos(p1) * F.cos(p2) * F.sin(dlon / 2) * F.sin(dlon / 2)
    return F.lit(radius_km) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))


def lat_span_deg(radius_km: float, earth_km: float = EARTH_RADIUS_KM) -> float:
    """Latitude half-width (degrees) of a circle of ``radius_km``."""
    return math.degrees(radius_km / earth_km)


def lon_span_deg(lat: Column, radius_km: float, earth_km: float = EARTH_RADIUS_KM) -> Column:
    """Longitude half-width (degrees) of the circle at latitude ``lat``.

    asin(sin(r) / cos(lat)); where the circle reaches a pole the whole
    circle of longitude (180) is returned.
    """
    r = radius_km / earth_km
    ratio = F.lit(math.sin(r)) / F.cos(F.radians(lat))
    return F.when(F.abs(F.radians(lat)) + F.lit(r) >= F.lit(math.pi / 2), F.lit(180.0)) \
        .when(ratio >= 1, F.lit(180.0)) \
        .otherwise(F.degrees(F.asin(ratio)))
