"""Hexagon heatmap.

Both resolutions are aggregated by one groupBy: each incident is emitted once
per resolution with a generator, then grouped by (resolution, cell). That is
the union of the two per-resolution aggregates with one scan and one
shuffle instead of two. Boundaries are computed per output cell only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo, hexgrid
from roadrisk.functions.severity import count_of, severity_weight


def cell_qr(h3_index):
    parts = F.split(h3_index, ":")
    return parts.getItem(1).cast("bigint"), parts.getItem(2).cast("bigint")


def boundary_for(resolution, h3_index, resolutions=C.HEATMAP_RESOLUTIONS, origin: geo.Origin = geo.ORIGIN):
    q, r = cell_qr(h3_index)
    expr = None
    for label, edge in resolutions:
        b = hexgrid.hex_boundary(q, r, edge, origin=origin)
        expr = F.when(resolution == F.lit(label), b) if expr is None else expr.when(resolution == F.lit(label), b)
    return expr


def hex_heatmap(silver: DataFrame, resolutions=C.HEATMAP_RESOLUTIONS, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """Per (resolution, cell): crash_count, fatal/pedestrian/bicycle counts,
    severity_score (sum of weights), mean incident lat/lng, boundary ring.
    ``origin`` must be the one that the cells were made with (``add_hex_cells``)."""
    per_res = F.explode(F.array(*[
        F.struct(F.lit(label).alias("resolution"), F.col(f"h3_res{label}").alias("h3_index"))
        for label, _ in resolutions]))
    sev = F.col("severity")
    cells = (silver.select(per_res.alias("c"), "severity", "latitude", "longitude")
             .select("c.resolution", "c.h3_index", "severity", "latitude", "longitude")
             .filter(F.col("h3_index").isNotNull()))
    agg = (cells.groupBy("resolution", "h3_index")
           .agg(F.count(F.lit(1)).alias("crash_count"),
                count_of(sev, "fatal").alias("fatal_count"),
                count_of(sev, "pedestrian").alias("pedestrian_count"),
                count_of(sev, "bicycle").alias("bicycle_count"),
                F.sum(severity_weight(sev).cast("bigint")).alias("severity_score"),
                geo.exact_mean(F.col("latitude")).alias("center_lat"),
                geo.exact_mean(F.col("longitude")).alias("center_lng")))
    return (agg.withColumn("boundary", boundary_for(F.col("resolution"), F.col("h3_index"), resolutions, origin))
            .filter(F.col("boundary").isNotNull())
            .select("h3_index", "crash_count", "fatal_count", "pedestrian_count", "bicycle_count",
                    "severity_score", "center_lat", "center_lng", "boundary", "resolution"))


def cell_boundaries(silver: DataFrame, resolutions=C.HEATMAP_RESOLUTIONS, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """The boundary ring of every occupied cell, one row per vertex."""
    per_res = F.explode(F.array(*[
        F.struct(F.lit(label).alias("resolution"), F.col(f"h3_res{label}").alias("h3_index"))
        for label, _ in resolutions]))
    cells = silver.select(per_res.alias("c")).select("c.*").distinct()
    return (cells.withColumn("boundary", boundary_for(F.col("resolution"), F.col("h3_index"), resolutions, origin))
            .select("h3_index", "resolution", F.posexplode("boundary").alias("vertex", "pt"))
            .select("h3_index", "resolution", "vertex",
                    F.col("pt").getItem(0).alias("lng"), F.col("pt").getItem(1).alias("lat")))
