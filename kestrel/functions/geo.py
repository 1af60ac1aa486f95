"""Geodesy as native Column expressions (no UDF: stays in codegen, no serde)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in km used by the distance formula.
EARTH_RADIUS_KM = 6371.0
DEG_TO_RAD = math.pi / 180.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_m(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance in metres between two (lat, lng) points in degrees."""
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    dlat = (lat2 - lat1) * DEG_TO_RAD
    dlng = (lng2 - lng1) * DEG_TO_RAD
    s_lat = F.sin(dlat / 2)
    s_lng = F.sin(dlng / 2)
    a = s_lat * s_lat + F.cos(lat1 * DEG_TO_RAD) * F.cos(lat2 * DEG_TO_RAD) * s_lng * s_lng
    c = F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)) * 2.0
    return F.lit(EARTH_RADIUS_KM) * c * 1000.0


def distance_3d_m(lat1, lng1, alt1, lat2, lng2, alt2) -> Column:
    """Haversine distance combined with the altitude difference (metres).

    A missing altitude on either side means a 2-D distance (the row is kept
    rather than lost to a NULL distance).
    """
    d = haversine_m(lat1, lng1, lat2, lng2)
    h = F.coalesce(_c(alt1).cast("double") - _c(alt2).cast("double"), F.lit(0.0))
    return F.sqrt(d * d + h * h)


def ecef_m(lat, lng) -> tuple[Column, Column, Column]:
    """Point on the sphere of radius EARTH_RADIUS_KM as (x, y, z) metres.

    The straight-line (chord) distance between two such points never exceeds
    their great-circle distance, so a cube grid of side s over (x, y, z)
    puts every pair within s metres of arc in the same or adjacent cells.
    """
    lat, lng = _c(lat) * DEG_TO_RAD, _c(lng) * DEG_TO_RAD
    r = EARTH_RADIUS_KM * 1000.0
    return (F.cos(lat) * F.cos(lng) * r, F.cos(lat) * F.sin(lng) * r, F.sin(lat) * r)


def grid_cell(lat, lng, cell_m: float) -> Column:
    """Cube-grid cell (struct gx, gy, gz) of a point for cells of side ``cell_m``."""
    x, y, z = ecef_m(lat, lng)
    return F.struct(F.floor(x / cell_m).alias("gx"), F.floor(y / cell_m).alias("gy"),
                    F.floor(z / cell_m).alias("gz"))
