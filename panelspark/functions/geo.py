"""Distances and raster cells as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .nulls import ColumnOrName, as_col

# WGS84 ellipsoid, metres.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
MEAN_RADIUS = 6371008.8


def _central_angle(p1: Column, l1: Column, p2: Column, l2: Column) -> Column:
    half = F.pow(F.sin((p2 - p1) / 2), F.lit(2)) + F.cos(p1) * F.cos(p2) * F.pow(
        F.sin((l2 - l1) / 2), F.lit(2)
    )
    return 2 * F.asin(F.sqrt(F.least(half, F.lit(1.0))))


def great_circle_m(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance on the mean sphere."""
    rad = [F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2)]
    return F.lit(MEAN_RADIUS) * _central_angle(*rad)


def geodesic_m(lat1, lon1, lat2, lon2) -> Column:
    """Ellipsoidal distance by Lambert's long-line formula (about 10 m error)."""
    p1, l1, p2, l2 = [F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2)]
    b1 = F.atan(F.tan(p1) * (1 - FLATTENING))
    b2 = F.atan(F.tan(p2) * (1 - FLATTENING))
    angle = _central_angle(b1, l1, b2, l2)
    mid, diff = (b1 + b2) / 2, (b2 - b1) / 2
    x = (
        (angle - F.sin(angle))
        * F.pow(F.sin(mid) * F.cos(diff), F.lit(2))
        / F.pow(F.cos(angle / 2), F.lit(2))
    )
    y = (
        (angle + F.sin(angle))
        * F.pow(F.cos(mid) * F.sin(diff), F.lit(2))
        / F.pow(F.sin(angle / 2), F.lit(2))
    )
    metres = F.lit(SEMI_MAJOR) * (angle - (x + y) * (FLATTENING / 2))
    return F.when(angle == 0, F.lit(0.0)).otherwise(metres)


def raster_col(lon: ColumnOrName, x0: ColumnOrName, dx: ColumnOrName) -> Column:
    return F.floor((as_col(lon) - as_col(x0)) / as_col(dx)).cast("int")


def raster_row(lat: ColumnOrName, y0: ColumnOrName, dy: ColumnOrName) -> Column:
    return F.floor((as_col(y0) - as_col(lat)) / as_col(dy)).cast("int")
