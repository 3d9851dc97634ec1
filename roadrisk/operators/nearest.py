"""k nearest schools of each incident, with distance.

The search goes by growing rings. A round with radius R joins the positions that are
still open with the schools of the 3 x 3 cells around them, in the grid of
``proximity`` for that radius: every school within R is met, at any latitude and across
the antimeridian. A position leaves once k schools lie within R, because no school
outside can be nearer; the others go on with a radius ``GROWTH`` times as large. The
last radius spans the globe, so the search ends after a number of rounds that depends on
the radii only. Positions beside many schools leave in the first rounds, so a wide
round only meets remote positions.

A remote position may face a whole city at once. So the schools of a round are not all
sent to it: they lie in boxes, the cells of a grid a quarter of the radius wide with their
counts and coordinate ranges. These give, per position, a distance within which k
schools are certain; only boxes that begin within that distance are opened. Where a box
holds more than ``BOX_SCHOOLS`` schools, the opened boxes are cut into smaller ones and
looked at again, so that a position meets the schools beside its k nearest and not a city.

Coordinates are degrees within +-90 and +-180. Incidents at the same place are searched once. Schools at equal distance (to the
millimetre) are ordered by id. With fewer than k schools all are returned.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadrisk import config as C
from roadrisk.functions import geo
from roadrisk.operators.proximity import BROADCAST_MAX_CELLS, COPIES, cell_width, lat_band, lon_cell
from roadrisk.sources.tables import remove_temporary, run_folder

FIRST_RADIUS_M = 1000.0
GROWTH = 4.0
MILLIMETRE = 0.001
FINER = 4                 # a box is cut into FINER x FINER
BOX_SCHOOLS = 256
LEAST_BOX_M = 1.0         # schools at one place can't be parted
_REST = math.pi * C.EARTH_RADIUS_M  # half the circumference: everything


def distance_m(lat1, lon1, lat2, lon2) -> F.Column:
    """Great-circle distance in metres, rounded to millimetres."""
    a = F.least(geo.haversine_a(lat1, lon1, lat2, lon2), geo.lit(1.0))
    return geo.round_half_up(geo.lit(2.0 * C.EARTH_RADIUS_M) * F.asin(F.sqrt(a)), 3)


def _box(lat, lon, cell_m: float) -> tuple[F.Column, F.Column]:
    """The grid cell (row, column) of a place."""
    row = lat_band(lat, cell_m)
    return row, lon_cell(lon, row, cell_m)


def _boxes(schools: DataFrame, cell_m: float, within: float | None = None) -> DataFrame:
    """The cells (fy, fx) that hold schools: how many, and the ranges of their coordinates. With
    ``within``, also the cell (oy, ox) of that larger grid, and a box never crosses two of them."""
    fy, fx = _box(F.col("school_lat"), F.col("school_lon"), cell_m)
    out, by = schools.withColumn("fy", fy).withColumn("fx", fx), ["fy", "fx"]
    if within is not None:
        oy, ox = _box(F.col("school_lat"), F.col("school_lon"), within)
        out, by = out.withColumn("oy", oy).withColumn("ox", ox), ["oy", "ox", *by]
    return out.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("school_lat").alias("s"), F.max("school_lat").alias("t"),
                                F.min("school_lon").alias("w"), F.max("school_lon").alias("e"))


def _reachable(boxes: DataFrame, radius_m: float) -> DataFrame:
    """Each box copied to the round's cells of all positions within the radius of it."""
    rows = F.sequence(lat_band(F.col("s"), radius_m) - 1, lat_band(F.col("t"), radius_m) + 1)
    out = boxes.withColumn("gy", F.explode(rows))
    width = cell_width(F.col("gy"), radius_m)
    turns = F.explode(F.array(*[geo.lit(t) for t in (0.0, 360.0, -360.0)]))
    out = (out.withColumn("turn", turns)
           .filter((F.col("turn") == geo.lit(0.0)) | (F.abs(F.col("w") + F.col("turn")) <= geo.lit(180.0) + width)
                   | (F.abs(F.col("e") + F.col("turn")) <= geo.lit(180.0) + width)))
    cells = F.sequence(lon_cell(F.col("w") + F.col("turn"), F.col("gy"), radius_m) - 1,
                       lon_cell(F.col("e") + F.col("turn"), F.col("gy"), radius_m) + 1)
    return out.withColumn("gx", F.explode(cells)).drop("turn").distinct()


def _nearest_in_box() -> F.Column:
    """A distance that no school of the box is nearer than (metres, a millimetre off)."""
    lat, lon = F.col("p_lat"), F.col("p_lon")
    up = F.greatest(F.col("s") - lat, lat - F.col("t"), geo.lit(0.0))
    # the nearer side of the box in longitude, also around the antimeridian
    def gap(side):
        d = F.abs(side - lon)
        return F.least(d, geo.lit(360.0) - d)
    across = F.when((lon >= F.col("w")) & (lon <= F.col("e")), geo.lit(0.0)).otherwise(F.least(gap(F.col("w")), gap(F.col("e"))))
    # sin^2(d / 2R) >= sin^2(up / 2) + cos(lat) * smallest cos * sin^2(across / 2)
    half = geo.lit(C.DEG * 0.5)
    widest = F.greatest(F.abs(F.col("s")), F.abs(F.col("t")))
    a_up = F.sin(up * half) * F.sin(up * half)
    a_across = F.cos(lat * geo.lit(C.DEG)) * F.cos(widest * geo.lit(C.DEG)) * F.sin(across * half) * F.sin(across * half)
    a = F.least(a_up + a_across, geo.lit(1.0))
    return geo.lit(2.0 * C.EARTH_RADIUS_M) * F.asin(F.sqrt(a)) - geo.lit(MILLIMETRE)


def _farthest_in_box() -> F.Column:
    """A distance that all schools of the box are within (metres, a millimetre on)."""
    lat, lon = F.col("p_lat"), F.col("p_lon")
    half = geo.lit(C.DEG * 0.5)
    up = F.greatest(F.abs(F.col("s") - lat), F.abs(F.col("t") - lat))

    def gap(side):
        d = F.abs(side - lon)
        return F.least(d, geo.lit(360.0) - d)
    # Within a box narrower than half the globe the farther side bounds the longitude, unless the
    # point opposite to the position lies inside.
    opposite = F.when(lon <= geo.lit(0.0), lon + geo.lit(180.0)).otherwise(lon - geo.lit(180.0))
    across = F.when((opposite >= F.col("w")) & (opposite <= F.col("e")), geo.lit(180.0)).otherwise(
        F.greatest(gap(F.col("w")), gap(F.col("e"))))
    least = F.when((F.col("s") <= geo.lit(0.0)) & (F.col("t") >= geo.lit(0.0)), geo.lit(1.0)).otherwise(
        F.greatest(F.cos(F.col("s") * geo.lit(C.DEG)), F.cos(F.col("t") * geo.lit(C.DEG))))
    a = (F.sin(up * half) * F.sin(up * half)
         + F.cos(lat * geo.lit(C.DEG)) * least * F.sin(across * half) * F.sin(across * half))
    return geo.lit(2.0 * C.EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, geo.lit(1.0)))) + geo.lit(MILLIMETRE)


def _certain(pairs: DataFrame, k: int, radius_m: float | None) -> DataFrame:
    """The (position, box) pairs that can hold one of the k nearest schools."""
    pairs = pairs.withColumn("near", _nearest_in_box()).withColumn("far", _farthest_in_box())
    if radius_m is not None:
        pairs = pairs.filter(F.col("near") <= geo.lit(radius_m))
    position = Window.partitionBy("p_lat", "p_lon")
    before = position.orderBy("far", "fy", "fx").rowsBetween(Window.unboundedPreceding, -1)
    pairs = pairs.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    enough = F.min(F.when(F.col("_before") + F.col("n") >= k, F.col("far"))).over(position)
    return pairs.withColumn("_enough", enough).filter(F.col("_enough").isNull() | (F.col("near") <= F.col("_enough")))


def _candidates(open_: DataFrame, schools: DataFrame, n_schools: int, radius_m: float, k: int) -> DataFrame:
    """Each open position with the schools that can be among its k nearest within the radius."""
    small = n_schools * COPIES <= BROADCAST_MAX_CELLS
    side = lambda df: df.hint("broadcast" if small else "merge")
    bound = None if radius_m >= _REST else radius_m
    cell = radius_m / FINER
    boxes = _boxes(schools, cell)
    if bound is None:  # at this size the globe has fewer than a hundred boxes
        pairs = open_.withColumn("_all", F.lit(1)).join(F.broadcast(boxes.withColumn("_all", F.lit(1))), "_all").drop("_all")
    else:
        gy, gx = _box(F.col("p_lat"), F.col("p_lon"), radius_m)
        pairs = (open_.withColumn("gy", gy).withColumn("gx", gx)
                 .join(side(_reachable(boxes, radius_m)), ["gy", "gx"]).drop("gy", "gx"))
    pairs = _certain(pairs, k, bound)
    by = ["fy", "fx"]
    while cell > LEAST_BOX_M and boxes.agg(F.max("n")).first()[0] > BOX_SCHOOLS:
        boxes = _boxes(schools, cell / FINER, within=cell)
        opened = pairs.select("p_lat", "p_lon", F.col("fy").alias("oy"), F.col("fx").alias("ox"))
        if len(by) == 4:  # parts of one box that lie in different larger cells come back together
            opened = opened.distinct()
        pairs = _certain(opened.join(side(boxes), ["oy", "ox"]), k, bound)
        cell, by = cell / FINER, ["oy", "ox", "fy", "fx"]
    fy, fx = _box(F.col("school_lat"), F.col("school_lon"), cell)
    inside = schools.withColumn("fy", fy).withColumn("fx", fx)
    if len(by) == 4:
        oy, ox = _box(F.col("school_lat"), F.col("school_lon"), cell * FINER)
        inside = inside.withColumn("oy", oy).withColumn("ox", ox)
    return pairs.select("p_lat", "p_lon", *by).join(side(inside), by)


def _one_round(open_: DataFrame, schools: DataFrame, n_schools: int, radius_m: float, k: int) -> DataFrame:
    """The k nearest schools within the radius of each open position (fewer where fewer are), with
    ``met``, the number of schools proven to lie within it, k at most."""
    found = (_candidates(open_, schools, n_schools, radius_m, k)
             .withColumn("distance_m", distance_m(F.col("p_lat"), F.col("p_lon"), F.col("school_lat"), F.col("school_lon"))))
    if radius_m < _REST:  # what lies beyond the radius may have nearer ones outside the cells
        found = found.filter(F.col("distance_m") <= geo.lit(radius_m - MILLIMETRE))
    position = Window.partitionBy("p_lat", "p_lon")
    best = found.withColumn("rank", F.row_number().over(position.orderBy("distance_m", "school_id"))).filter(F.col("rank") <= k)
    return best.select("p_lat", "p_lon", "rank", "school_id", "distance_m", F.count(F.lit(1)).over(position).alias("met"))


def nearest_schools(incidents: DataFrame, schools: DataFrame, k: int = 1, school_id: str = "school_id",
                    first_radius_m: float = FIRST_RADIUS_M, growth: float = GROWTH) -> DataFrame:
    """The columns of ``incidents`` with ``rank`` (1 to k), ``school_id`` and ``distance_m``, one
    row per incident and school found; incidents without coordinates and, when there are no schools,
    all incidents have no row. ``schools``: school_lat, school_lon and an id."""
    spark = incidents.sparkSession
    folders: list[str] = []

    def stored(df, name):
        folders.append(run_folder(spark, name))
        df.write.parquet(folders[-1])
        return spark.read.schema(df.schema).parquet(folders[-1])

    side = stored(schools.select(F.col(school_id).alias("school_id"), "school_lat", "school_lon")
                  .filter("school_lat IS NOT NULL AND school_lon IS NOT NULL"), "nearest-schools")
    n_schools = side.count()
    open_ = stored(incidents.select(F.col("latitude").alias("p_lat"), F.col("longitude").alias("p_lon"))
                   .filter("p_lat IS NOT NULL AND p_lon IS NOT NULL").distinct(), "nearest-open")
    radius, done = float(first_radius_m), []
    while n_schools and not open_.isEmpty():
        radius = radius if radius < _REST / 2 else _REST
        best = stored(_one_round(open_, side, n_schools, radius, k), "nearest-round")
        if radius >= _REST:
            done.append(best)
            break
        proven = best.filter(F.col("met") >= k)
        done.append(proven)
        open_ = stored(open_.join(proven.select("p_lat", "p_lon").distinct(), ["p_lat", "p_lon"], "left_anti"), "nearest-open")
        radius *= growth
    if not done:
        return incidents.limit(0).withColumns({"rank": F.lit(0), "school_id": F.lit(None).cast(side.schema["school_id"].dataType),
                                               "distance_m": geo.lit(0.0)})
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = stored(found.drop("met"), "nearest-found")
    remove_temporary(*folders[:-1])
    return (incidents.join(found, (F.col("latitude") == F.col("p_lat")) & (F.col("longitude") == F.col("p_lon")))
            .drop("p_lat", "p_lon"))
