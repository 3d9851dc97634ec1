"""Crash count to green-yellow-red colour as a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo


def relative_scale(max_count: Column, factor: float = C.RELATIVE_COLOR_FACTOR) -> Column:
    """max(max_count * factor, 1)."""
    return F.greatest(max_count.cast("double") * geo.lit(factor), geo.lit(1.0))


def count_to_rgb(count: Column, scale: Column) -> Column:
    """struct<r,g,b:int>. 0 -> fixed colour; else t = min(1, count/scale),
    t < 1/2 ramps green->yellow, t >= 1/2 ramps yellow->red (truncating)."""
    t = F.least(geo.lit(1.0), count.cast("double") / scale)
    s_lo = t * geo.lit(2.0)
    s_hi = (t - geo.lit(0.5)) * geo.lit(2.0)
    lo = t < geo.lit(0.5)
    r = F.when(lo, (geo.lit(255.0) * s_lo).cast("int")).otherwise(F.lit(255))
    g = F.when(lo, (geo.lit(200.0) + geo.lit(55.0) * (geo.lit(1.0) - s_lo)).cast("int")).otherwise(
        (geo.lit(200.0) * (geo.lit(1.0) - s_hi)).cast("int"))
    b = F.lit(0)
    z_r, z_g, z_b = C.ZERO_COUNT_COLOR
    zero = count == F.lit(0)
    return F.struct(
        F.when(zero, F.lit(z_r)).otherwise(r).alias("r"),
        F.when(zero, F.lit(z_g)).otherwise(g).alias("g"),
        F.when(zero, F.lit(z_b)).otherwise(b).alias("b"),
    )


def palette_color(index: Column, palette=C.ROAD_PALETTE) -> Column:
    """array<int> [r, g, b] of palette entry `index` (0-based)."""
    pal = F.array(*[F.array(*[F.lit(v) for v in rgb]) for rgb in palette])
    return F.element_at(pal, (index + F.lit(1)).cast("int"))
