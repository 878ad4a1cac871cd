"""Distances and hexagon cells as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from acreage.constants import EARTH_RADIUS_KM, MANHATTAN_CENTER


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; each argument is a column or a number."""
    lat1, lon1, lat2, lon2 = (_column(v) for v in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def flat_distance(lat1, lon1, lat2, lon2) -> Column:
    """Straight line in radian latitude and longitude, scaled to km."""
    dlat = F.radians(lat1) - F.radians(lat2)
    dlon = F.radians(lon1) - F.radians(lon2)
    return F.sqrt(dlat * dlat + dlon * dlon) * F.lit(EARTH_RADIUS_KM)


def hex_cell(lat: Column, lon: Column, edge_km: float = 1.2) -> Column:
    """Id `q_r` of the planar hexagon around a point, on a plane centred on Manhattan."""
    lat0, lon0 = MANHATTAN_CENTER
    x = F.radians(lon - F.lit(lon0)) * F.lit(EARTH_RADIUS_KM * math.cos(math.radians(lat0)))
    y = F.radians(lat - F.lit(lat0)) * F.lit(EARTH_RADIUS_KM)
    q = (x * F.lit(math.sqrt(3) / 3) - y / 3) / F.lit(float(edge_km))
    r = (y * 2 / 3) / F.lit(float(edge_km))
    s = -q - r
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    fix_q = (dq > dr) & (dq > ds)
    fix_r = ~fix_q & (dr > ds)
    hq = F.when(fix_q, -rr - rs).otherwise(rq).cast("long")
    hr = F.when(fix_r, -rq - rs).otherwise(rr).cast("long")
    return F.concat_ws("_", hq.cast("string"), hr.cast("string"))
