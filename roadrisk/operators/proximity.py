"""Distance-within join of incidents and schools.

A distance predicate alone plans as a nested-loop join. Both sides get a grid
cell, the school side is copied to the neighbouring cells, and the join becomes
an equi-join on the cell followed by the exact haversine test.

The grid follows the data, at any latitude: rows are cut into latitude bands one
radius high, and inside a band a cell is as wide in longitude as the radius is
at the band's (and its neighbours') largest latitude. A school emits itself to
the three bands around it with each band's own cell width, and across the
antimeridian, so no pair within the radius is missed. Near a pole a band is one cell.

The school side is broadcast only behind a measured bound: its rows are counted
(one small job over the school table, each time a plan is built) and its copies
must stay under ``BROADCAST_MAX_CELLS``; otherwise the joins are pinned to
sort-merge joins on the cell (semi/anti), where a hot cell is split by adaptive
execution's skew-join rule. Rows are the same either way. Spark's own estimate is
not used for this: it does not see the fan-out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo


# About 64 bytes per school cell row in a hash relation: 2,000,000 rows are
# ~130 MB, which holds every school of a large country (~110k schools x 18).
BROADCAST_MAX_CELLS = 2_000_000
COPIES = 18  # at most, per school: 3 bands x 3 cells, twice beside the antimeridian


def _broadcast_fits(schools: DataFrame, max_cells: int | None = None) -> bool:
    """Counted size check (one small job over the school table)."""
    return schools.count() * COPIES <= (BROADCAST_MAX_CELLS if max_cells is None else max_cells)


def _school_side(schools: DataFrame, radius_m: float, broadcast: bool) -> DataFrame:
    """School cells with the join strategy pinned by hint."""
    return school_cells(schools, radius_m).hint("broadcast" if broadcast else "merge")


def band_deg(radius_m: float) -> float:
    """Height of a latitude band in degrees. The 0.1 % margin covers the gap
    between a parallel arc and the great-circle distance."""
    return radius_m / (C.EARTH_RADIUS_M * C.DEG) * 1.001


def lat_band(lat, radius_m: float):
    return F.floor(lat / geo.lit(band_deg(radius_m)))


def cell_width(band, radius_m: float):
    """Longitude width (degrees) of the cells of a band: at least the radius at
    any latitude of the band and the bands beside it; the whole circle at a pole."""
    h = band_deg(radius_m)
    widest = F.greatest(F.abs(band - 1), F.abs(band + 2)).cast("double") * geo.lit(h)
    cosine = F.cos(F.least(widest, geo.lit(90.0)) * geo.lit(C.DEG))
    return F.when(cosine > geo.lit(1e-3), geo.lit(h) / cosine).otherwise(geo.lit(360.0))


def lon_cell(lon, band, radius_m: float):
    return F.floor(lon / cell_width(band, radius_m))


def school_cells(schools: DataFrame, radius_m: float) -> DataFrame:
    """Each school copied to the cells of all points that can lie within the radius."""
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    width = cell_width(F.col("sgy"), radius_m)
    return (schools.select("school_lat", "school_lon")
            .withColumn("db", F.explode(around))
            .withColumn("sgy", lat_band(F.col("school_lat"), radius_m) + F.col("db"))
            .withColumn("turn", F.explode(F.array(*[geo.lit(t) for t in (0.0, 360.0, -360.0)])))
            .withColumn("at", F.col("school_lon") + F.col("turn"))
            .filter((F.col("turn") == geo.lit(0.0)) | (F.abs(F.col("at")) <= geo.lit(180.0) + width))
            .withColumn("dx", F.explode(around))
            .select((lon_cell(F.col("at"), F.col("sgy"), radius_m) + F.col("dx")).alias("sgx"), "sgy",
                    "school_lat", "school_lon"))


def _with_cell(incidents: DataFrame, radius_m: float) -> DataFrame:
    """Cell and coordinates under private names: outer references in the
    EXISTS must not share a name with any column in the school lineage."""
    return (incidents.withColumn("_gy", lat_band(F.col("latitude"), radius_m))
            .withColumn("_gx", lon_cell(F.col("longitude"), F.col("_gy"), radius_m))
            .withColumn("_plat", F.col("latitude"))
            .withColumn("_plon", F.col("longitude")))


def _near_condition(radius_m: float, outer: bool):
    lat = F.col("_plat").outer() if outer else F.col("_plat")
    lon = F.col("_plon").outer() if outer else F.col("_plon")
    gx = F.col("_gx").outer() if outer else F.col("_gx")
    gy = F.col("_gy").outer() if outer else F.col("_gy")
    return ((F.col("sgx") == gx) & (F.col("sgy") == gy)
            & geo.haversine_within(lat, lon, F.col("school_lat"), F.col("school_lon"), radius_m))


def near_school_join(incidents: DataFrame, schools: DataFrame, radius_m: float = C.SCHOOL_RADIUS_M) -> DataFrame:
    """Incidents within `radius_m` of any school (each incident once)."""
    inc = _with_cell(incidents, radius_m)
    side = _school_side(schools, radius_m, _broadcast_fits(schools))
    return inc.join(side, on=_near_condition(radius_m, False),
                    how="left_semi").drop("_gx", "_gy", "_plat", "_plon")


def add_near_school(incidents: DataFrame, schools: DataFrame | None, radius_m: float = C.SCHOOL_RADIUS_M) -> DataFrame:
    """``near_school`` 1/0 per incident, without duplicating rows.

    With a broadcastable school side this is a correlated EXISTS, which
    Spark plans as a broadcast existence join: one pass, one boolean per
    incident, no distinct and no join back. Beyond the bound it is a
    ``left_semi`` join (flag 1) unioned with a ``left_anti`` join (flag 0),
    both sort-merge on the cell: adaptive execution can split a hot cell
    in those join types, but not in an existence join, and a cell holding a
    third of the incidents must not end up in one task.
    ``schools=None`` gives a column of 0.
    """
    if schools is None:
        return incidents.withColumn("near_school", F.lit(0))
    inc = _with_cell(incidents, radius_m)
    helper = ["_gx", "_gy", "_plat", "_plon"]
    if _broadcast_fits(schools):
        hit = _school_side(schools, radius_m, True).where(_near_condition(radius_m, True)).exists()
        return inc.withColumn("near_school", F.when(hit, F.lit(1)).otherwise(F.lit(0))).drop(*helper)
    side = _school_side(schools, radius_m, False)
    cond = _near_condition(radius_m, False)
    near = inc.join(side, on=cond, how="left_semi").withColumn("near_school", F.lit(1))
    far = inc.join(side, on=cond, how="left_anti").withColumn("near_school", F.lit(0))
    return near.unionByName(far).drop(*helper)
