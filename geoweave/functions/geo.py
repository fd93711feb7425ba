"""Great-circle distance and coordinate predicates as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical distances.
EARTH_RADIUS_KM = 6371.0

INF = float("inf")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def coord_present(lat, lon) -> Column:
    """P5: both coordinates present (not NULL and not NaN)."""
    lat, lon = _c(lat), _c(lon)
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km with ``a`` clamped to 1 (atan2 form).

    Returns +inf when either endpoint lacks coordinates, so such an edge can never be chosen by
    a minimum-cost operator.
    """
    lat1, lon1, lat2, lon2 = _c(lat1), _c(lon1), _c(lat2), _c(lon2)
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), 2
    )
    a = F.least(a, F.lit(1.0))
    dist = F.lit(EARTH_RADIUS_KM) * 2 * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))
    return F.when(coord_present(lat1, lon1) & coord_present(lat2, lon2), dist).otherwise(
        F.lit(INF)
    )


def key_lat(key) -> Column:
    """Coordinates derived from an integer key (fixture rule shared with the SQL oracle)."""
    k = _c(key).cast("long")
    return ((k * 7919) % 18000 - 9000).cast("double") / F.lit(100.0)


def key_lon(key) -> Column:
    k = _c(key).cast("long")
    return ((k * 104729) % 36000 - 18000).cast("double") / F.lit(100.0)
