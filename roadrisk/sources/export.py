"""JSON exports for the map front end.

The source pipeline collected each gold table to the driver and dumped a
Python list. Here every export is a projection written by the executors as
JSON lines (one record per line), so no table passes through the driver.
The stats document is one record by nature: its lists are bounded (top-k
intersections, one entry per month) and arrive as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo, hexgrid

EXPORT_NAMES = ["vz-heatmap", "vz-corridors", "vz-hotspots", "vz-emerging", "vz-crashes", "vz-stats"]


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def heatmap_records(heat: DataFrame) -> DataFrame:
    """{h3, boundary, count, fatal, ped, bike, severity_score, res, lat, lng}."""
    return heat.select(
        F.col("h3_index").alias("h3"), "boundary",
        F.col("crash_count").alias("count"), F.col("fatal_count").alias("fatal"),
        F.col("pedestrian_count").alias("ped"), F.col("bicycle_count").alias("bike"),
        F.coalesce(F.col("severity_score"), F.lit(0).cast("bigint")).alias("severity_score"),
        F.col("resolution").cast("int").alias("res"),
        geo.round_half_up(F.col("center_lat"), 5).alias("lat"),
        geo.round_half_up(F.col("center_lng"), 5).alias("lng"))


def corridor_records(corr: DataFrame) -> DataFrame:
    """{path, color, crashes, fatal, pedestrian, bicycle, road_name}.

    Accepts the native table (array columns) or one with ``path_json`` /
    ``color_json`` text; rows whose text does not parse are dropped."""
    if "path_json" in corr.columns:
        corr = (corr.withColumn("path", F.from_json("path_json", "array<array<double>>"))
                .withColumn("color", F.from_json("color_json", "array<int>")))
    return (corr.filter(F.col("path").isNotNull() & F.col("color").isNotNull())
            .select("path", "color", F.col("crash_count").alias("crashes"), "fatal", "pedestrian", "bicycle",
                    F.coalesce(F.col("road_name"), F.lit("")).alias("road_name")))


def _boundary(q, r, bin_m: float, origin: geo.Origin):
    return hexgrid.hex_boundary(q, r, hexgrid.edge_from_flat_width(bin_m), origin=origin)


def hotspot_records(hs: DataFrame, bin_m: float = C.HOTSPOT_BIN_M, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """{bin_id, crash_count, z_score (4 dp), p_value (6 dp), classification, boundary}."""
    return hs.select(
        "bin_id", "crash_count",
        geo.round_half_up(F.col("z_score"), 4).alias("z_score"),
        geo.round_half_up(F.col("p_value"), 6).alias("p_value"),
        "classification", _boundary(F.col("q"), F.col("r"), bin_m, origin).alias("boundary"))


def emerging_records(es: DataFrame, bin_m: float = C.HOTSPOT_BIN_M, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """{bin_id, trend, quarters_hot, latest_z (4 dp), boundary}."""
    return es.select(
        "bin_id", "trend", "quarters_hot",
        geo.round_half_up(F.col("latest_z"), 4).alias("latest_z"),
        _boundary(F.col("q"), F.col("r"), bin_m, origin).alias("boundary"))


def crash_records(silver: DataFrame) -> DataFrame:
    """{lat, lng (5 dp), date (ISO), hour, sev, desc, loc, cross, ym}."""
    return silver.select(
        geo.round_half_up(F.col("latitude"), 5).alias("lat"),
        geo.round_half_up(F.col("longitude"), 5).alias("lng"),
        F.date_format("crash_date", "yyyy-MM-dd").alias("date"),
        F.col("crash_hour").alias("hour"), F.col("severity").alias("sev"),
        F.col("crm_cd_desc").alias("desc"), F.col("location").alias("loc"),
        F.col("cross_street").alias("cross"), F.col("year_month").alias("ym"))


def stats_document(summary: DataFrame, monthly: DataFrame) -> DataFrame:
    """One row holding the stats document: summary fields, top
    intersections, by-severity object and the month-ordered time series."""
    series = monthly.agg(F.array_sort(F.collect_list(F.struct(
        F.col("year_month").alias("month"), "total", *C.SEVERITY_LABELS))).alias("ts")).scalar()
    return summary.select(
        "total_crashes", *C.SEVERITY_LABELS, "date_from", "date_to", "school_zone_crashes",
        "school_zone_fatal", "top_intersections", "by_severity", series.alias("timeseries"))


def write_stats(doc: DataFrame, path: str) -> str:
    """The stats document as one JSON text line."""
    doc.select(F.to_json(F.struct(*doc.columns)).alias("value")).write.mode("overwrite").text(path)
    return path


def verify_outputs(spark: SparkSession, root: str, expected=EXPORT_NAMES) -> DataFrame:
    """Per expected export: whether it exists and its size in bytes,
    from the file listing (``binaryFile`` with the content column pruned)."""
    exp = spark.createDataFrame([(n,) for n in expected], "name string")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "part-*").load(root)
             .select(F.regexp_extract("path", r"/([^/]+)\.json/[^/]+$", 1).alias("name"), "length"))
    sizes = files.groupBy("name").agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
    return (exp.join(sizes, "name", "left")
            .select("name", F.col("bytes").isNotNull().alias("exists"),
                    F.coalesce("bytes", F.lit(0)).alias("bytes"),
                    F.coalesce("files", F.lit(0)).alias("files")))
