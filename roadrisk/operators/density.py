"""Kernel density surface (G3): quartic kernel (Silverman 1986) on a grid.

Each distinct incident position is fanned out to the output cells whose
centre can lie within the search radius (about 346 of the 21x21 block for
500 m / 50 m, generated row by row with ``explode(sequence)``), the exact
distance test keeps those with u = d/r < 1, and the weighted kernel values are summed
per cell. The sum is partially aggregated on the map side, so the shuffle
carries at most one row per (map task, cell). Identical positions are
collapsed first, which bounds the fan-out by distinct positions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo


def reachable_offsets(radius_m: float, cell_m: float) -> list[tuple[int, int]]:
    """Cell offsets (di, dj) whose centre can be within radius of a point in cell (0, 0)."""
    k = int(math.ceil(radius_m / cell_m)) + 1
    out = []
    for di in range(-k, k + 1):
        for dj in range(-k, k + 1):
            gx = max(abs(di) - 0.5, 0.0) * cell_m
            gy = max(abs(dj) - 0.5, 0.0) * cell_m
            if gx * gx + gy * gy < radius_m * radius_m:
                out.append((di, dj))
    return out


def kernel_density(points: DataFrame, radius_m: float = C.KDE_RADIUS_M, cell_m: float = C.KDE_CELL_M,
                   weight_col: str | None = None, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """One row per cell with positive density: cell_i, cell_j, center_lon,
    center_lat, density (incidents per km^2). ``origin`` centres the projection;
    name one inside the study area."""
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    pos = (points.select(geo.project_x(F.col("longitude"), origin).alias("x"),
                         geo.project_y(F.col("latitude"), origin).alias("y"), w.alias("w"))
           .groupBy("x", "y").agg(F.sum("w").alias("w")))
    # The reachable offsets are symmetric and contiguous in dj for each |di|,
    # so they are generated as explode(sequence(-kd, kd)) for di and
    # explode(sequence(-m, m)) for dj, with m looked up per |di| from a small
    # literal row: the same set as reachable_offsets(), without a literal
    # array of ~350 structs (whose plan takes seconds to analyse).
    offs = reachable_offsets(radius_m, cell_m)
    half: dict[int, int] = {}
    for di, dj in offs:
        half[abs(di)] = max(half.get(abs(di), 0), abs(dj))
    kd = max(half)
    dj_max = F.element_at(F.array(*[F.lit(half[a]).cast("bigint") for a in range(kd + 1)]),
                          F.abs(F.col("di")).cast("int") + 1)
    c = geo.lit(cell_m)
    r2 = geo.lit(radius_m * radius_m)
    fan = (pos.select("x", "y", "w", F.floor(F.col("x") / c).alias("i0"), F.floor(F.col("y") / c).alias("j0"))
           .withColumn("di", F.explode(F.sequence(F.lit(-kd).cast("bigint"), F.lit(kd).cast("bigint"))))
           .withColumn("dj", F.explode(F.sequence(-dj_max, dj_max)))
           .select("x", "y", "w", (F.col("i0") + F.col("di")).alias("i"), (F.col("j0") + F.col("dj")).alias("j")))
    ex = F.col("x") - (F.col("i") + geo.lit(0.5)) * c
    ey = F.col("y") - (F.col("j") + geo.lit(0.5)) * c
    d2 = ex * ex + ey * ey
    v = geo.lit(1.0) - F.col("d2") / r2
    k = 3.0 / (math.pi * radius_m * radius_m) * 1e6
    cells = (fan.withColumn("d2", d2).filter(F.col("d2") < r2)
             .groupBy("i", "j").agg(F.sum(F.col("w") * v * v).alias("s")))
    return cells.select(
        F.col("i").alias("cell_i"), F.col("j").alias("cell_j"),
        geo.unproject_lon((F.col("i") + geo.lit(0.5)) * c, origin).alias("center_lon"),
        geo.unproject_lat((F.col("j") + geo.lit(0.5)) * c, origin).alias("center_lat"),
        (F.col("s") * geo.lit(k)).alias("density"))


TILE_CELLS = 64           # tiles are so many cells wide, at least as many as a kernel
TILE_POSITIONS = 50_000   # a tile with more positions is dealt out over several tasks


def _tile_rows(points: DataFrame, radius_m: float, cell_m: float, weight_col: str | None, origin: geo.Origin):
    """(positions with their tiles, half widths of the kernel per row distance, tile width): each
    position is copied to every tile that its kernel reaches, four at most."""
    half: dict[int, int] = {}
    for di, dj in reachable_offsets(radius_m, cell_m):
        half[abs(di)] = max(half.get(abs(di), 0), abs(dj))
    reach = max(half)
    width = max(TILE_CELLS, 2 * reach + 1)
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    c = geo.lit(cell_m)
    pos = (points.select(geo.project_x(F.col("longitude"), origin).alias("x"),
                         geo.project_y(F.col("latitude"), origin).alias("y"), w.alias("w"))
           .groupBy("x", "y").agg(F.sum("w").alias("w"))
           .withColumn("i0", F.floor(F.col("x") / c)).withColumn("j0", F.floor(F.col("y") / c)))
    tile = lambda cell: F.floor(cell / F.lit(width))
    both = lambda at: F.explode(F.sequence(tile(F.col(at) - reach), tile(F.col(at) + reach)))
    return pos.withColumn("ti", both("i0")).withColumn("tj", both("j0")), half, width


def _tile_cells(rows: DataFrame, half: dict[int, int], width: int, radius_m: float, cell_m: float, by: list[str]) -> DataFrame:
    """Kernel sums of the cells of each tile. ``rows`` is dealt out by ``by``, so the sums
    need no further exchange."""
    reach = max(half)
    c, r2 = geo.lit(cell_m), geo.lit(radius_m * radius_m)
    low, high = F.col("ti") * width, F.col("ti") * width + (width - 1)
    out = rows.withColumn("i", F.explode(F.sequence(F.greatest(F.col("i0") - reach, low), F.least(F.col("i0") + reach, high))))
    side = F.element_at(F.array(*[F.lit(half[a]).cast("bigint") for a in range(reach + 1)]), F.abs(F.col("i") - F.col("i0")).cast("int") + 1)
    out = (out.withColumn("a", F.greatest(F.col("j0") - side, F.col("tj") * width))
           .withColumn("z", F.least(F.col("j0") + side, F.col("tj") * width + (width - 1)))
           .filter(F.col("a") <= F.col("z")).withColumn("j", F.explode(F.sequence("a", "z"))))
    ex = F.col("x") - (F.col("i") + geo.lit(0.5)) * c
    ey = F.col("y") - (F.col("j") + geo.lit(0.5)) * c
    v = geo.lit(1.0) - F.col("d2") / r2
    return (out.withColumn("d2", ex * ex + ey * ey).filter(F.col("d2") < r2)
            .groupBy(*by, "i", "j").agg(F.sum(F.col("w") * v * v).alias("s")))


def kernel_density_tiles(points: DataFrame, radius_m: float = C.KDE_RADIUS_M, cell_m: float = C.KDE_CELL_M,
                         weight_col: str | None = None, origin: geo.Origin = geo.ORIGIN,
                         tile_positions: int = TILE_POSITIONS) -> DataFrame:
    """The surface of ``kernel_density``, computed tile by tile.

    The plane is cut into tiles of ``TILE_CELLS`` x ``TILE_CELLS`` cells. Each distinct
    position goes to the tiles that its kernel reaches, at most four rows instead of one per
    cell; the fan-out to cells and their sums happen inside the tile's task, so no cell
    row is shuffled. ``kernel_density`` shuffles up to one row per map task and cell.

    Tiles with more than ``tile_positions`` positions (counted first; one small row each) are
    dealt out by a hash of the position as well, and only their cells are added up over
    one more exchange. So a place that holds a third of the positions doesn't end in one task."""
    rows, half, width = _tile_rows(points, radius_m, cell_m, weight_col, origin)
    crowded = (rows.groupBy("ti", "tj").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile_positions)
               .select(F.col("ti").alias("hi"), F.col("tj").alias("hj"), F.ceil(F.col("n") / F.lit(tile_positions)).alias("parts")))
    at = (F.col("ti") == F.col("hi")) & (F.col("tj") == F.col("hj"))
    usual = rows.join(crowded, at, "left_anti").repartition("ti", "tj")
    cells = _tile_cells(usual, half, width, radius_m, cell_m, ["ti", "tj"]).select("i", "j", "s")
    dealt = (rows.join(crowded, at).withColumn("part", F.pmod(F.xxhash64("x", "y"), F.col("parts"))).drop("hi", "hj", "parts")
             .repartition("ti", "tj", "part"))
    added = (_tile_cells(dealt, half, width, radius_m, cell_m, ["ti", "tj", "part"])
             .groupBy("i", "j").agg(F.sum("s").alias("s")))
    c = geo.lit(cell_m)
    k = 3.0 / (math.pi * radius_m * radius_m) * 1e6
    return cells.unionByName(added).select(
        F.col("i").alias("cell_i"), F.col("j").alias("cell_j"),
        geo.unproject_lon((F.col("i") + geo.lit(0.5)) * c, origin).alias("center_lon"),
        geo.unproject_lat((F.col("j") + geo.lit(0.5)) * c, origin).alias("center_lat"),
        (F.col("s") * geo.lit(k)).alias("density"))
