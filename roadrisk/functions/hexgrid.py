"""Native hexagon binning (pointy-top axial coordinates) as Column expressions.

A point is projected to metres (``geo.project_x/y``), converted to fractional
axial coordinates and cube-rounded. Rounding uses ``floor(v + 0.5)`` and the
component with the largest rounding error is repaired, so every point lands
in exactly one cell and no point lies farther than the edge length from its
cell centre. Ids are strings ``"<label>:<q>:<r>"``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadrisk.functions import geo

SQRT3 = math.sqrt(3.0)


def axial_coefficients(edge_m: float) -> tuple[float, float, float]:
    """(cq_x, cq_y, cr_y) with qf = x*cq_x - y*cq_y and rf = y*cr_y."""
    return (SQRT3 / 3.0 / edge_m, 1.0 / 3.0 / edge_m, 2.0 / 3.0 / edge_m)


def edge_from_flat_width(width_m: float) -> float:
    """Edge length of a pointy-top hexagon whose flat-to-flat width is given."""
    return width_m / SQRT3


def hex_axial(x: Column, y: Column, edge_m: float) -> Column:
    """struct<q: bigint, r: bigint> of the cell containing (x, y) metres."""
    cqx, cqy, cry = axial_coefficients(edge_m)
    qf = x * geo.lit(cqx) - y * geo.lit(cqy)
    rf = y * geo.lit(cry)
    sf = -qf - rf
    rq = F.floor(qf + geo.lit(0.5))
    rr = F.floor(rf + geo.lit(0.5))
    rs = F.floor(sf + geo.lit(0.5))
    dq = F.abs(rq - qf)
    dr = F.abs(rr - rf)
    ds = F.abs(rs - sf)
    # The component with the largest rounding error is rebuilt from the other two.
    q_worst = (dq > dr) & (dq > ds)
    q = F.when(q_worst, -rr - rs).otherwise(rq)
    r = F.when(q_worst, rr).when(dr > ds, -rq - rs).otherwise(rr)
    return F.struct(q.cast("bigint").alias("q"), r.cast("bigint").alias("r"))


def hex_of_lonlat(lon: Column, lat: Column, edge_m: float, origin: geo.Origin = geo.ORIGIN) -> Column:
    return hex_axial(geo.project_x(lon, origin), geo.project_y(lat, origin), edge_m)


def hex_id(label: str, q: Column, r: Column) -> Column:
    return F.concat(F.lit(f"{label}:"), q.cast("string"), F.lit(":"), r.cast("string"))


def hex_center_x(q: Column, r: Column, edge_m: float) -> Column:
    return (q + r * geo.lit(0.5)) * geo.lit(edge_m * SQRT3)


def hex_center_y(r: Column, edge_m: float) -> Column:
    return r * geo.lit(1.5 * edge_m)


def vertex_offsets(edge_m: float) -> list[tuple[float, float]]:
    """Six (dx, dy) vertex offsets of a pointy-top cell, angles 30 + 60*i."""
    return [
        (edge_m * math.cos(math.radians(30.0 + 60.0 * i)), edge_m * math.sin(math.radians(30.0 + 60.0 * i)))
        for i in range(6)
    ]


def hex_boundary(q: Column, r: Column, edge_m: float, decimals: int = 6, origin: geo.Origin = geo.ORIGIN) -> Column:
    """Closed ring ``array<array<double>>`` of [lng, lat] pairs, 7 entries."""
    cx = hex_center_x(q, r, edge_m)
    cy = hex_center_y(r, edge_m)
    verts = [
        F.array(
            geo.round_half_up(geo.unproject_lon(cx + geo.lit(dx), origin), decimals),
            geo.round_half_up(geo.unproject_lat(cy + geo.lit(dy), origin), decimals),
        )
        for dx, dy in vertex_offsets(edge_m)
    ]
    return F.array(*verts, verts[0])


def ring_offsets(rings: int) -> list[tuple[int, int]]:
    """Axial offsets of all cells within `rings` steps, including (0, 0)."""
    return [
        (dq, dr)
        for dq in range(-rings, rings + 1)
        for dr in range(-rings, rings + 1)
        if abs(dq + dr) <= rings
    ]


def offsets_array(offsets: list[tuple[int, int]]) -> Column:
    """Literal array<struct<dq:int, dr:int>> for explode / aggregate."""
    return F.array(*[F.struct(F.lit(dq).alias("dq"), F.lit(dr).alias("dr")) for dq, dr in offsets])


def offset_col(q: Column, r: Column) -> Column:
    """Odd-r offset column index of an axial cell: q + floor(r / 2)."""
    return q + F.floor(r / F.lit(2.0))


def cells_in_rect(q: Column, r: Column, offsets: list[tuple[int, int]], c0: Column, c1: Column, r0: Column, r1: Column) -> Column:
    """How many of the given neighbour offsets of (q, r) fall in the offset rectangle."""

    def inside(acc, o):
        tq = q + o["dq"]
        tr = r + o["dr"]
        tc = tq + F.floor(tr / F.lit(2.0))
        ok = (tc >= c0) & (tc <= c1) & (tr >= r0) & (tr <= r1)
        return acc + F.when(ok, F.lit(1)).otherwise(F.lit(0))

    return F.aggregate(offsets_array(offsets), F.lit(0), inside)
