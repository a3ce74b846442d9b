"""Geographic column expressions: great-circle distance, grid and hex cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.config import EARTH_RADIUS_KM


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Haversine distance in km (arcsine form), R = 6371; null if any input is null."""
    lat1, lng1, lat2, lng2 = (F.radians(_c(v)) for v in (lat1, lng1, lat2, lng2))
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lng2 - lng1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def grid(coord) -> Column:
    """0.01-degree grid (half-even rounding of coord*100, as NumPy does)."""
    return F.rint(_c(coord) * 100) / 100


def hex_scales(size_km: float) -> tuple[float, float]:
    """km-per-degree factors divided by the hex size (fixed reference latitude 12.97)."""
    km_per_deg = math.pi * EARTH_RADIUS_KM / 180.0
    return km_per_deg / size_km, km_per_deg * math.cos(math.radians(12.97)) / size_km


def hex_cell(lat, lng, size_km: float) -> Column:
    """Planar axial hexagon id of a point (pointy-top hexes of edge ``size_km``).

    Coordinates are projected with an equirectangular projection around the
    point's latitude, converted to fractional axial (q, r) and rounded with
    cube rounding.  The id is the string ``"q:r"``.
    """
    lat, lng = _c(lat), _c(lng)
    ky, kx = hex_scales(size_km)
    y = lat * ky
    x = lng * kx
    qf = F.lit(math.sqrt(3) / 3) * x - F.lit(1.0 / 3) * y
    rf = F.lit(2.0 / 3) * y
    sf = -qf - rf
    q, r, s = F.rint(qf), F.rint(rf), F.rint(sf)
    dq, dr, ds = F.abs(q - qf), F.abs(r - rf), F.abs(s - sf)
    q_fix = F.when((dq > dr) & (dq > ds), -r - s).otherwise(q)
    r_fix = F.when((dq > dr) & (dq > ds), r).when(dr > ds, -q - s).otherwise(r)
    return F.concat_ws(":", q_fix.cast("bigint").cast("string"), r_fix.cast("bigint").cast("string"))
