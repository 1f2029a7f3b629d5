"""Distance functions as native Column expressions (no UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius and the flat-earth helper's factors.
EARTH_RADIUS_M = 6_371_000.0
FLAT_M_PER_DEG = 111_320.0
FLAT_LON_FACTOR = 0.88


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle metres, ``R * 2 * atan2(sqrt(a), sqrt(1 - a))``.

    NaN propagates (an out-of-range ``a`` gives NaN, and ``NaN < r`` is false,
    so such a pair counts as far, as in the reference).
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), 2
    )
    return F.lit(EARTH_RADIUS_M) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def flat_earth_m(lat1, lon1, lat2, lon2) -> Column:
    """Equirectangular approximation used by the reference's generator (helper)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dy = (lat2 - lat1) * FLAT_M_PER_DEG
    dx = (lon2 - lon1) * FLAT_M_PER_DEG * FLAT_LON_FACTOR
    return F.sqrt(dy * dy + dx * dx)


def unit_vector(lat, lon) -> tuple[Column, Column, Column]:
    """3-D unit vector of a (lat, lon) in degrees.

    The haversine term equals ``|P1 - P2|^2 / 4`` for these vectors for *any*
    real angles, so chord distance on the unit sphere bounds the haversine
    distance exactly, also for out-of-range coordinates.
    """
    lat, lon = _c(lat), _c(lon)
    rl, rg = F.radians(lat), F.radians(lon)
    return F.cos(rl) * F.cos(rg), F.cos(rl) * F.sin(rg), F.sin(rl)


def chord_cell_size(radius_m: float, margin: float = 1.001) -> float:
    """Grid cell edge (unit-sphere units) such that points nearer than
    ``radius_m`` always fall in the same or an adjacent cell."""
    return 2 * math.sin(radius_m / (2 * EARTH_RADIUS_M)) * margin
