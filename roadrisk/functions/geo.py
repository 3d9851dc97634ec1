"""Planar and spherical geometry as native Column expressions.

Everything here is a pure ``pyspark.sql.functions`` expression, so it stays
inside whole-stage codegen. Constants are Python floats emitted as literals;
the DuckDB oracle uses the same literals and the same operation order, which
keeps doubles bit-identical across the two engines.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadrisk import config as C


def lit(v: float) -> Column:
    return F.lit(float(v))


def round_half_up(c: Column, decimals: int) -> Column:
    """Round half toward +inf on the binary value: floor(v*10^d + 0.5) / 10^d.

    Spark's ``round`` goes through decimal text while other engines multiply;
    this form is the same IEEE arithmetic everywhere.
    """
    scale = float(10 ** decimals)
    return (F.floor(c * lit(scale) + lit(0.5)).cast("double") / lit(scale))


class Origin(NamedTuple):
    """Centre of the local metric projection, (latitude, longitude) in degrees.
    Distances are true near it, so each study area names its own."""

    lat: float = C.ORIGIN_LAT
    lon: float = C.ORIGIN_LON

    @property
    def m_per_deg_x(self) -> float:
        return C.EARTH_RADIUS_M * math.cos(self.lat * C.DEG) * C.DEG


ORIGIN = Origin()


def project_x(lon: Column, origin: Origin = ORIGIN) -> Column:
    """Equirectangular x in metres from the origin."""
    return (lon - lit(origin.lon)) * lit(origin.m_per_deg_x)


def project_y(lat: Column, origin: Origin = ORIGIN) -> Column:
    """Equirectangular y in metres from the origin."""
    return (lat - lit(origin.lat)) * lit(C.M_PER_DEG_Y)


def unproject_lon(x: Column, origin: Origin = ORIGIN) -> Column:
    return lit(origin.lon) + x / lit(origin.m_per_deg_x)


def unproject_lat(y: Column, origin: Origin = ORIGIN) -> Column:
    return lit(origin.lat) + y / lit(C.M_PER_DEG_Y)


def haversine_within(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_m: float) -> Column:
    """True when the great-circle distance (R = 6371 km) is <= radius_m.

    Compares the haversine term ``a`` with sin^2(r / 2R) instead of taking
    asin/sqrt per pair: the same predicate with fewer transcendental calls.
    """
    a = haversine_a(lat1, lon1, lat2, lon2)
    a_max = math.sin(radius_m / (2.0 * C.EARTH_RADIUS_M)) ** 2
    return a <= lit(a_max)


def haversine_a(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lit(C.DEG * 0.5)
    s_lat = F.sin((lat2 - lat1) * half)
    s_lon = F.sin((lon2 - lon1) * half)
    return s_lat * s_lat + F.cos(lat1 * lit(C.DEG)) * F.cos(lat2 * lit(C.DEG)) * s_lon * s_lon


def point_segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Planar distance from P to segment AB (degrees in, degrees out).

    The projection parameter is clamped to [0, 1]; a zero-length segment is the
    distance to its point.
    """
    dx = bx - ax
    dy = by - ay
    l2 = dx * dx + dy * dy
    safe_l2 = F.when(l2 == lit(0.0), lit(1.0)).otherwise(l2)
    t_raw = ((px - ax) * dx + (py - ay) * dy) / safe_l2
    t = F.when(l2 == lit(0.0), lit(0.0)).otherwise(F.greatest(lit(0.0), F.least(lit(1.0), t_raw)))
    ex = px - (ax + t * dx)
    ey = py - (ay + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def planar_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx = ax - bx
    dy = ay - by
    return F.sqrt(dx * dx + dy * dy)


def exact_mean(c: Column, scale: int = 9) -> Column:
    """Aggregate: mean computed from an exact DECIMAL sum.

    A double sum depends on the order rows arrive in, so the same data
    partitioned differently can give a different last bit (and a different
    rounded value). Summing DECIMAL(20+, scale) is exact and order-free.
    """
    dec = c.cast(f"decimal({18 + scale},{scale})")
    return F.sum(dec).cast("double") / F.count(c).cast("double")
