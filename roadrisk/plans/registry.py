"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query builds its inputs from the harness tables (through the fixture
adapters), runs one operator of the library over the whole input and
returns a flat, check-friendly projection: computed columns are aliased,
doubles are rounded half-up, arrays are flattened into scalar columns.
The DuckDB twin of every query with an ``oracle`` entry lives in
``plans.oracle_queries``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk.functions import color, geo
from roadrisk.operators import chains, clean, corridors, density, fdr, heatmap, hotspots, nearest, proximity, roads, rollups
from roadrisk.plans import gold_state, pipeline, upsert
from roadrisk.sources import clustering, export, fixtures, ingest, publish
from roadrisk.sources.tables import TableStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    return geo.round_half_up(F.col(c) if isinstance(c, str) else c, 6)


# ------------------------------------------------------------ rollups

@query("monthly_series")
def q_monthly_series(spark, sf_dir):
    return rollups.monthly_series(pipeline.silver(spark, sf_dir))


@query("crashes_by_year")
def q_crashes_by_year(spark, sf_dir):
    return rollups.crashes_by_year(spark, pipeline.bronze(spark, sf_dir))


@query("severity_breakdown")
def q_severity_breakdown(spark, sf_dir):
    return rollups.severity_breakdown(pipeline.silver(spark, sf_dir))


@query("severity_totals")
def q_severity_totals(spark, sf_dir):
    return rollups.severity_totals(pipeline.silver(spark, sf_dir))


@query("top_intersections")
def q_top_intersections(spark, sf_dir):
    t = rollups.top_intersections(pipeline.silver(spark, sf_dir))
    return t.select("intersection", "crash_count", "fatal", "pedestrian", "bicycle",
                    r6("lat").alias("lat"), r6("lng").alias("lng"))


@query("school_zone_stats")
def q_school_zone_stats(spark, sf_dir):
    return rollups.school_zone_stats(pipeline.silver(spark, sf_dir))


@query("summary_stats")
def q_summary_stats(spark, sf_dir):
    return _stats_entries(rollups.summary_stats(pipeline.silver(spark, sf_dir)))


def _entry(section, place, name, crashes, fatal=None, pedestrian=None, bicycle=None, lat=None, lng=None):
    number = lambda c: (F.lit(None) if c is None else c).cast("bigint")
    real = lambda c: (F.lit(None) if c is None else c).cast("double")
    return F.struct(F.lit(section).alias("section"), place.cast("int").alias("place"), name.cast("string").alias("name"),
                    number(crashes).alias("crashes"), number(fatal).alias("fatal"), number(pedestrian).alias("pedestrian"),
                    number(bicycle).alias("bicycle"), real(lat).alias("lat"), real(lng).alias("lng"))


def _stats_entries(doc, months=False):
    """Every entry of a stats document as a row: totals, dates, severities, top list, months."""
    zero = F.lit(0)
    single = [_entry("total", zero, F.lit("crashes"), F.col("total_crashes")),
              _entry("date_from", zero, F.col("date_from"), None), _entry("date_to", zero, F.col("date_to"), None),
              _entry("school_zone", zero, F.lit("near"), F.col("school_zone_crashes"), F.col("school_zone_fatal"))]
    single += [_entry("severity", zero, F.lit(s), F.col(s)) for s in rollups.C.SEVERITY_LABELS]
    single += [_entry("by_severity", zero, F.lit(s), F.col("by_severity")[s]) for s in rollups.C.SEVERITY_LABELS]
    parts = [F.array(*single), F.transform("top_intersections", lambda t, i: _entry(
        "top", i, t["name"], t["crashes"], t["fatal"], t["pedestrian"], t["bicycle"], t["lat"], t["lng"]))]
    if months:
        def month(s):
            return F.transform("timeseries", lambda t, i: _entry(f"month_{s}", i, t["month"], t[s]))

        parts += [month(s) for s in ["total", *rollups.C.SEVERITY_LABELS]]
    return doc.select(F.explode(F.concat(*parts)).alias("e")).select("e.*")


@query("enrichment_summary")
def q_enrichment_summary(spark, sf_dir):
    return rollups.enrichment_summary(pipeline.silver(spark, sf_dir))


# ------------------------------------------------------------ ingest and cleaning

@query("ingest_incidents")
def q_ingest_incidents(spark, sf_dir):
    store = TableStore(spark)
    landed = ingest.land_json(fixtures.incidents_raw(spark, sf_dir), store.path("landing_incidents"))
    return ingest.ingest_incidents(spark, landed)


@query("ingest_rejects")
def q_ingest_rejects(spark, sf_dir):
    """Landed pages with broken lines: how many records came in and how many were set aside."""
    landed = ingest.land_lines(fixtures.incident_lines(spark, sf_dir), TableStore(spark).path("landing_incidents"))
    good = ingest.ingest_incidents(spark, landed, since=None)
    bad = ingest.ingest_rejects(spark, landed)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n_lines")).select(F.lit(name).alias("status"), "n_lines")
    return count(good, "good").unionByName(count(bad, "rejected"))


@query("ingest_schools")
def q_ingest_schools(spark, sf_dir):
    store = TableStore(spark)
    landed = ingest.land_json(fixtures.schools_raw(spark, sf_dir), store.path("landing_schools"))
    pts = ingest.school_points(ingest.ingest_schools(spark, landed))
    return pts.select("school_id", "school_name", "latitude", "longitude", "school_lat", "school_lon")


@query("clean_incidents")
def q_clean_incidents(spark, sf_dir):
    c = clean.clean_incidents(pipeline.bronze(spark, sf_dir))
    return c.select("dr_no", "latitude", "longitude", "crash_date", "crash_hour")


@query("calendar_columns")
def q_calendar_columns(spark, sf_dir):
    s = pipeline.silver(spark, sf_dir)
    return s.select("dr_no", "crash_year", "crash_month", "year_month")


@query("bbox_filter")
def q_bbox_filter(spark, sf_dir):
    p = clean.bbox_filter(clean.valid_coordinates(clean.parse_incidents(pipeline.bronze(spark, sf_dir))))
    return p.select("dr_no", "latitude", "longitude")


@query("dedupe_incidents")
def q_dedupe_incidents(spark, sf_dir):
    c = clean.clean_incidents(pipeline.bronze(spark, sf_dir))
    return c.select("dr_no", "date_occ", "time_occ", "lat", "lon", "mocodes")


@query("classify_severity")
def q_classify_severity(spark, sf_dir):
    c = clean.add_severity(clean.clean_incidents(pipeline.bronze(spark, sf_dir)))
    return c.select("dr_no", "mocodes", "crm_cd_desc", "severity")


@query("intersection_label")
def q_intersection_label(spark, sf_dir):
    c = clean.add_intersection(clean.clean_incidents(pipeline.bronze(spark, sf_dir)))
    return c.select("dr_no", "intersection")


@query("point_column")
def q_point_column(spark, sf_dir):
    """P10: the point of every incident, field by field."""
    points = clean.add_geometry(clean.clean_incidents(pipeline.bronze(spark, sf_dir)))
    return points.select("dr_no", F.col("geometry.lon").alias("lon"), F.col("geometry.lat").alias("lat"), F.col("geometry.srid").alias("srid"))


@query("hex_bins")
def q_hex_bins(spark, sf_dir):
    return pipeline.silver(spark, sf_dir).select("dr_no", "h3_res9", "h3_res8")


@query("hex_boundary")
def q_hex_boundary(spark, sf_dir):
    return heatmap.cell_boundaries(pipeline.silver(spark, sf_dir))


@query("hex_heatmap")
def q_hex_heatmap(spark, sf_dir):
    h = heatmap.hex_heatmap(pipeline.silver(spark, sf_dir))
    b = F.col("boundary")
    return h.select("h3_index", "resolution", "crash_count", "fatal_count", "pedestrian_count",
                    "bicycle_count", "severity_score", r6("center_lat").alias("center_lat"),
                    r6("center_lng").alias("center_lng"),
                    F.size(b).cast("bigint").alias("boundary_points"),
                    b.getItem(0).getItem(0).alias("boundary_lng0"),
                    b.getItem(0).getItem(1).alias("boundary_lat0"))


# ------------------------------------------------------------ proximity

@query("near_school_join")
def q_near_school_join(spark, sf_dir):
    inc = clean.clean_incidents(pipeline.bronze(spark, sf_dir))
    return proximity.near_school_join(inc, pipeline.schools(spark, sf_dir)).select("dr_no", "latitude", "longitude")


@query("near_school_flag")
def q_near_school_flag(spark, sf_dir):
    return pipeline.silver(spark, sf_dir).select("dr_no", "near_school")


# ------------------------------------------------------------ spatial statistics

def r4(c) -> F.Column:
    return geo.round_half_up(F.col(c) if isinstance(c, str) else c, 4)


@query("hot_spots")
def q_hot_spots(spark, sf_dir):
    h = hotspots.hot_spots(pipeline.silver(spark, sf_dir))
    return h.select("bin_id", "crash_count", r4("z_score").alias("z_score"),
                    r6("p_value").alias("p_value"), "classification")


@query("top_hot_spots")
def q_top_hot_spots(spark, sf_dir):
    h = hotspots.hot_spots(pipeline.silver(spark, sf_dir)).withColumn("z_score", r4("z_score"))
    return rollups.top_n(h, "z_score", ["bin_id"]).select("bin_id", "crash_count", "z_score", "classification")


def _emerging(spark, sf_dir):
    return hotspots.emerging_hot_spots(pipeline.silver(spark, sf_dir))


@query("emerging_hot_spots")
def q_emerging_hot_spots(spark, sf_dir):
    e = _emerging(spark, sf_dir)
    return e.select("bin_id", "trend", "quarters_hot", r4("latest_z").alias("latest_z"),
                    r4("mk_z").alias("mk_z"), "n_steps")


@query("trend_breakdown")
def q_trend_breakdown(spark, sf_dir):
    return hotspots.trend_breakdown(_emerging(spark, sf_dir))


@query("kernel_density")
def q_kernel_density(spark, sf_dir):
    d = density.kernel_density(pipeline.silver(spark, sf_dir))
    return d.select("cell_i", "cell_j", r6("center_lon").alias("center_lon"),
                    r6("center_lat").alias("center_lat"), r4("density").alias("density"))


# ------------------------------------------------------------ roads

def r9(c) -> F.Column:
    return geo.round_half_up(F.col(c) if isinstance(c, str) else c, 9)


def _rgb(col: str, prefix: str = "color"):
    return [F.col(col).getItem(i).alias(f"{prefix}_{ch}") for i, ch in enumerate("rgb")]


@query("road_clean")
def q_road_clean(spark, sf_dir):
    landed = ingest.land_lines(fixtures.way_documents(spark, sf_dir), TableStore(spark).path("landing_ways"))
    w = roads.clean_ways(ingest.read_ways(spark, landed, lines=True))
    return w.select(F.col("id").alias("way_id"), F.size("geometry").cast("bigint").alias("n_geometry"),
                    F.col("tags").getItem("highway").alias("highway_tag"))


@query("road_dedup_points")
def q_road_dedup_points(spark, sf_dir):
    d = roads.dedup_points(roads.clean_ways(fixtures.ways(spark, sf_dir)))
    return (d.select(F.col("pos").alias("way_id"), F.posexplode("points").alias("idx", "pt"))
            .select("way_id", "idx", F.col("pt")[0].alias("lon"), F.col("pt")[1].alias("lat")))


@query("simplify_roads")
def q_simplify_roads(spark, sf_dir):
    d = roads.dedup_points(roads.clean_ways(fixtures.ways(spark, sf_dir)))
    return roads.simplify(d).select(F.col("pos").alias("way_id"), "idx", "lon", "lat")


@query("road_lengths")
def q_road_lengths(spark, sf_dir):
    p = roads.simplified_paths(fixtures.ways(spark, sf_dir))
    return p.select(F.col("pos").alias("way_id"), F.size("path").cast("bigint").alias("n_points"),
                    r9("length").alias("length"),
                    (F.col("length") >= geo.lit(roads.C.MIN_PATH_LENGTH_DEG)).alias("kept"))


def _trajectories(spark, sf_dir):
    return roads.trajectories(fixtures.ways(spark, sf_dir))


@query("road_color")
def q_road_color(spark, sf_dir):
    t = _trajectories(spark, sf_dir)
    return t.select(F.col("pos").alias("way_id"), "highway", "traj_index", "color_index", *_rgb("color"))


@query("sub_paths")
def q_sub_paths(spark, sf_dir):
    s = roads.sub_paths(_trajectories(spark, sf_dir))
    return s.select(F.col("pos").alias("way_id"), "sub", "start", "end",
                    F.size("path").cast("bigint").alias("n_points"), "color_index", *_rgb("color"))


@query("path_writeout")
def q_path_writeout(spark, sf_dir):
    """R8 and back: every written path record."""
    out = roads.write_paths(roads.all_paths(_trajectories(spark, sf_dir)), TableStore(spark).path("paths"))
    back = spark.read.schema("path array<array<double>>, color array<int>").json(out)
    return back.select(F.size("path").cast("bigint").alias("n_points"), *_rgb("color"))


@query("polyline_file")
def q_polyline_file(spark, sf_dir):
    """Road polylines landed as a file and read back."""
    landed = ingest.land_lines(fixtures.polyline_documents(spark, sf_dir), TableStore(spark).path("landing_polylines"))
    p = ingest.read_polylines(spark, landed, lines=True)
    return p.select("name", F.size("path").cast("bigint").alias("n_points"), F.col("path")[0][0].alias("lon0"),
                    F.col("path")[0][1].alias("lat0"), *_rgb("color"))


@query("road_totals")
def q_road_totals(spark, sf_dir):
    return roads.path_totals(roads.all_paths(_trajectories(spark, sf_dir)))


# ------------------------------------------------------------ corridors

@query("road_segments")
def q_road_segments(spark, sf_dir):
    s = corridors.road_segments(fixtures.road_polylines(spark, sf_dir))
    return s.select("road_index", "seg", "a_lon", "a_lat", "b_lon", "b_lat", r9("length").alias("length"))


@query("road_match")
def q_road_match(spark, sf_dir):
    return corridors.match_incidents(fixtures.road_polylines(spark, sf_dir), pipeline.silver(spark, sf_dir), unique=True)


def _corridors(spark, sf_dir, scale="relative"):
    return corridors.danger_corridors(fixtures.road_polylines(spark, sf_dir), pipeline.silver(spark, sf_dir),
                                      scale=scale, unique=True)


@query("danger_corridors")
def q_danger_corridors(spark, sf_dir):
    c = _corridors(spark, sf_dir)
    return c.select("road_index", F.size("path").cast("bigint").alias("n_points"), "crash_count", "fatal",
                    "pedestrian", "bicycle", "severe", *_rgb("color"), "road_name")


@query("danger_corridors_absolute")
def q_danger_corridors_absolute(spark, sf_dir):
    c = _corridors(spark, sf_dir, scale="absolute")
    return c.select("road_index", "crash_count", *_rgb("color"))


@query("corridor_color")
def q_corridor_color(spark, sf_dir):
    rel = _corridors(spark, sf_dir).select("crash_count").distinct()
    mx = rel.agg(F.greatest(F.max("crash_count"), F.lit(1))).scalar()
    r = color.count_to_rgb(F.col("crash_count"), F.col("_scale"))
    a = color.count_to_rgb(F.col("crash_count"), geo.lit(roads.C.ABSOLUTE_COLOR_SCALE))
    return rel.withColumn("_scale", color.relative_scale(mx)).select("crash_count", r["r"].alias("rel_r"), r["g"].alias("rel_g"), r["b"].alias("rel_b"),
                      a["r"].alias("abs_r"), a["g"].alias("abs_g"), a["b"].alias("abs_b"))


# ------------------------------------------------------------ tables and exports

@query("partitioned_roundtrip")
def q_partitioned_roundtrip(spark, sf_dir):
    """S3 + S6 by catalog name (``saveAsTable``, ``spark.table``)."""
    store = TableStore(spark, database=f"roadrisk_{uuid.uuid4().hex}", temporary=True)
    store.write(pipeline.bronze(spark, sf_dir), "bronze_crashes", partition_by=["crash_year"])
    return store.read("bronze_crashes")


@query("silver_roundtrip")
def q_silver_roundtrip(spark, sf_dir):
    silver = pipeline.write_silver(TableStore(spark), pipeline.silver(spark, sf_dir))
    return silver.select("dr_no", "crash_year", "crash_month", "crash_hour", "severity", "intersection",
                         "h3_res9", "near_school")


@query("append_roundtrip")
def q_append_roundtrip(spark, sf_dir):
    store = TableStore(spark)
    heat = heatmap.hex_heatmap(pipeline.silver(spark, sf_dir))
    fine, coarse = (label for label, _ in heatmap.C.HEATMAP_RESOLUTIONS)
    store.write(heat.filter(F.col("resolution") == fine), "gold_h3_heatmap", mode="overwrite")
    store.write(heat.filter(F.col("resolution") == coarse), "gold_h3_heatmap", mode="append")
    return q_hex_heatmap_from(store.read("gold_h3_heatmap"))


def q_hex_heatmap_from(h):
    b = F.col("boundary")
    return h.select("h3_index", "resolution", "crash_count", "fatal_count", "pedestrian_count",
                    "bicycle_count", "severity_score", r6("center_lat").alias("center_lat"),
                    r6("center_lng").alias("center_lng"),
                    F.size(b).cast("bigint").alias("boundary_points"),
                    b.getItem(0).getItem(0).alias("boundary_lng0"),
                    b.getItem(0).getItem(1).alias("boundary_lat0"))


def _export_dir(spark) -> str:
    return TableStore(spark).path("exports")


def _roundtrip(spark, df, name, schema):
    path = f"{_export_dir(spark)}/{name}.json"
    export.write_json(df, path)
    return spark.read.schema(schema).json(path)


@query("export_heatmap")
def q_export_heatmap(spark, sf_dir):
    recs = export.heatmap_records(heatmap.hex_heatmap(pipeline.silver(spark, sf_dir)))
    back = _roundtrip(spark, recs, "vz-heatmap",
                      "h3 string, boundary array<array<double>>, count bigint, fatal bigint, ped bigint, "
                      "bike bigint, severity_score bigint, res int, lat double, lng double")
    return back.select("h3", "count", "fatal", "ped", "bike", "severity_score", "res", "lat", "lng",
                       F.col("boundary")[3][0].alias("boundary_lng3"), F.col("boundary")[3][1].alias("boundary_lat3"))


@query("export_corridors")
def q_export_corridors(spark, sf_dir):
    recs = export.corridor_records(_corridors(spark, sf_dir))
    back = _roundtrip(spark, recs, "vz-corridors",
                      "path array<array<double>>, color array<int>, crashes bigint, fatal bigint, "
                      "pedestrian bigint, bicycle bigint, road_name string")
    return back.select(F.size("path").cast("bigint").alias("n_points"),
                       F.col("path")[0][0].alias("lon0"), F.col("path")[0][1].alias("lat0"),
                       *_rgb("color"), "crashes", "fatal", "pedestrian", "bicycle", "road_name")


@query("export_hotspots")
def q_export_hotspots(spark, sf_dir):
    recs = export.hotspot_records(hotspots.hot_spots(pipeline.silver(spark, sf_dir)))
    back = _roundtrip(spark, recs, "vz-hotspots",
                      "bin_id string, crash_count bigint, z_score double, p_value double, "
                      "classification string, boundary array<array<double>>")
    return back.select("bin_id", "crash_count", "z_score", "p_value", "classification",
                       F.col("boundary")[0][0].alias("boundary_lng0"), F.col("boundary")[0][1].alias("boundary_lat0"))


@query("export_emerging")
def q_export_emerging(spark, sf_dir):
    recs = export.emerging_records(_emerging(spark, sf_dir))
    back = _roundtrip(spark, recs, "vz-emerging",
                      "bin_id string, trend string, quarters_hot bigint, latest_z double, "
                      "boundary array<array<double>>")
    return back.select("bin_id", "trend", "quarters_hot", "latest_z",
                       F.size("boundary").cast("bigint").alias("boundary_points"),
                       F.col("boundary")[2][0].alias("boundary_lng2"), F.col("boundary")[2][1].alias("boundary_lat2"))


@query("export_crashes")
def q_export_crashes(spark, sf_dir):
    recs = export.crash_records(pipeline.silver(spark, sf_dir))
    return _roundtrip(spark, recs, "vz-crashes",
                      "lat double, lng double, date string, hour int, sev string, desc string, loc string, "
                      "cross string, ym string")


@query("export_stats")
def q_export_stats(spark, sf_dir):
    silver = pipeline.silver(spark, sf_dir)
    doc = export.stats_document(rollups.summary_stats(silver), rollups.monthly_series(silver))
    path = export.write_stats(doc, f"{_export_dir(spark)}/vz-stats.json")
    return _stats_entries(spark.read.schema(doc.schema).json(path), months=True)


GOLD_TABLES = ["gold_hotspots", "gold_emerging_hotspots", "gold_crash_density", "gold_h3_heatmap",
               "gold_danger_corridors", "gold_stats", "gold_timeseries"]


def gold_tables(spark, sf_dir, silver) -> dict[str, DataFrame]:
    """Every gold table of the chain by name."""
    return {"gold_hotspots": hotspots.hot_spots(silver), "gold_emerging_hotspots": hotspots.emerging_hot_spots(silver),
            "gold_crash_density": density.kernel_density(silver), "gold_h3_heatmap": heatmap.hex_heatmap(silver),
            "gold_danger_corridors": corridors.danger_corridors(fixtures.road_polylines(spark, sf_dir), silver, unique=True),
            "gold_stats": rollups.summary_stats(silver), "gold_timeseries": rollups.monthly_series(silver)}


def write_gold(spark, sf_dir) -> TableStore:
    """Every gold table of the chain written to the table store."""
    store = TableStore(spark)
    silver = pipeline.write_silver(store, pipeline.silver(spark, sf_dir))  # cleaned once, read by every step
    for name, df in gold_tables(spark, sf_dir, silver).items():
        store.write(df, name)
    return store


@query("table_row_counts")
def q_table_row_counts(spark, sf_dir):
    return write_gold(spark, sf_dir).row_counts(GOLD_TABLES)


@query("verify_outputs")
def q_verify_outputs(spark, sf_dir):
    """Writes all six exports into a fresh folder, then checks the listing."""
    store = TableStore(spark)
    root = store.path("exports_verify")
    silver = pipeline.write_silver(store, pipeline.silver(spark, sf_dir))
    export.write_json(export.heatmap_records(heatmap.hex_heatmap(silver)), f"{root}/vz-heatmap.json")
    export.write_json(export.corridor_records(
        corridors.danger_corridors(fixtures.road_polylines(spark, sf_dir), silver, unique=True)), f"{root}/vz-corridors.json")
    export.write_json(export.hotspot_records(hotspots.hot_spots(silver)), f"{root}/vz-hotspots.json")
    export.write_json(export.emerging_records(hotspots.emerging_hot_spots(silver)), f"{root}/vz-emerging.json")
    export.write_json(export.crash_records(silver), f"{root}/vz-crashes.json")
    export.write_stats(export.stats_document(rollups.summary_stats(silver), rollups.monthly_series(silver)),
                       f"{root}/vz-stats.json")
    return export.verify_outputs(spark, root).select("name", "exists", (F.col("bytes") > 0).alias("non_empty"))


@query("ingest_incidents_stream")
def q_ingest_incidents_stream(spark, sf_dir):
    """S1 + S3 as an incremental file stream (fresh folders per call)."""
    from roadrisk.streaming.incremental import incremental_ingest
    base = TableStore(spark).path("stream")
    landed = ingest.land_json(fixtures.incidents_raw(spark, sf_dir), f"{base}/landing")
    incremental_ingest(spark, landed, f"{base}/bronze", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/bronze")


# ------------------------------------------------------------ refresh without rebuilding

def _corrected_silver(spark, sf_dir):
    """A store whose silver took two pages, and what the second one changed."""
    store = TableStore(spark)
    side = pipeline.schools(spark, sf_dir)
    upsert.apply_page(store, 0, pipeline.bronze(spark, sf_dir), side)
    first = store.read(upsert.SILVER)
    batch = F.pmod(F.xxhash64("dr_no"), F.lit(3))
    for b in range(3):
        gold_state.add_batch(store, first.filter(batch == b), f"batch-{b}")
    change = upsert.apply_page(store, 1, ingest.normalise_incidents(fixtures.incident_corrections(spark, sf_dir)), side)
    return store, change


@query("silver_upsert")
def q_silver_upsert(spark, sf_dir):
    """Silver after a page of corrections, brought up to date year by year."""
    store = TableStore(spark)
    side = pipeline.schools(spark, sf_dir)
    upsert.apply_page(store, 0, pipeline.bronze(spark, sf_dir), side)
    upsert.apply_page(store, 1, ingest.normalise_incidents(fixtures.incident_corrections(spark, sf_dir)), side)
    return upsert.read_upserted(store).select("dr_no", "crash_year", "crash_month", "crash_hour", "severity", "intersection",
                                              "latitude", "longitude", "h3_res9", "h3_res8", "near_school")


@query("gold_refresh")
def q_gold_refresh(spark, sf_dir):
    """Gold from partial aggregates: three batches, then the years that a page of corrections touched."""
    store, change = _corrected_silver(spark, sf_dir)
    gold_state.refresh_years(store, upsert.read_upserted(store), change.years)

    def rows(section, df, name, total, fatal, pedestrian, bicycle, lat=None, lng=None):
        real = lambda c: (F.lit(None).cast("double") if c is None else r6(c))
        number = lambda c: (F.lit(None) if c is None else F.col(c)).cast("bigint")
        return df.select(F.lit(section).alias("section"), F.col(name).cast("string").alias("name"), number(total).alias("total"),
                         number(fatal).alias("fatal"), number(pedestrian).alias("pedestrian"), number(bicycle).alias("bicycle"),
                         real(lat).alias("lat"), real(lng).alias("lng"))

    cells = gold_state.hex_heatmap(store)
    total = gold_state.totals(store)
    distinct = gold_state.distinct_cells(store)
    near = F.abs(F.col("estimate") - F.col("cells")) <= 1 + 3 * gold_state.SKETCH_ERROR * F.col("cells")
    parts = [
        rows("month", gold_state.monthly_series(store), "year_month", "total", "fatal", "pedestrian", "bicycle"),
        rows("cell", cells, "h3_index", "crash_count", "fatal_count", "pedestrian_count", "bicycle_count", "center_lat", "center_lng"),
        rows("intersection", gold_state.top_intersections(store), "intersection", "crash_count", "fatal", "pedestrian", "bicycle", "lat", "lng"),
        rows("dates", total.withColumn("name", F.concat_ws(" ", "first_date", "last_date")), "name", "total_crashes", "fatal",
             "pedestrian", "bicycle"),
        rows("school_zone", total.withColumn("name", F.lit("near")), "name", "school_zone_crashes", "school_zone_fatal", None, None),
        rows("distinct", distinct, "grain", "cells", None, None, None),
        rows("sketch_within_3_errors", distinct.withColumn("ok", near.cast("int")), "grain", "ok", None, None, None)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("nearest_school")
def q_nearest_school(spark, sf_dir):
    """The three nearest schools of every incident."""
    inc = clean.clean_incidents(pipeline.bronze(spark, sf_dir)).select("dr_no", "latitude", "longitude")
    return (nearest.nearest_schools(inc, pipeline.schools(spark, sf_dir), k=3)
            .select("dr_no", F.col("rank").cast("bigint").alias("rank"), "school_id", "distance_m"))


@query("road_chains")
def q_road_chains(spark, sf_dir):
    """Connected ways as chains and rings."""
    return chains.road_chains(fixtures.connected_ways(spark, sf_dir))


@query("road_rejects")
def q_road_rejects(spark, sf_dir):
    """Way and polyline lines, some broken: how many came in, how many were set aside."""
    store = TableStore(spark)
    ways = ingest.land_lines(fixtures.broken_way_documents(spark, sf_dir), store.path("landing_ways"))
    lines = ingest.land_lines(fixtures.broken_polyline_documents(spark, sf_dir), store.path("landing_polylines"))

    def count(df, kind, status):
        return df.agg(F.count(F.lit(1)).alias("n_lines")).select(F.lit(kind).alias("kind"), F.lit(status).alias("status"), "n_lines")

    return (count(ingest.read_ways(spark, ways, lines=True), "way", "good")
            .unionByName(count(ingest.way_rejects(spark, ways), "way", "rejected"))
            .unionByName(count(ingest.read_polylines(spark, lines, lines=True), "polyline", "good"))
            .unionByName(count(ingest.polyline_rejects(spark, lines), "polyline", "rejected")))


# ------------------------------------------------------------ other ways to the same results

@query("density_tiles")
def q_density_tiles(spark, sf_dir):
    """G3 by tiles: the same surface as ``kernel_density``."""
    d = density.kernel_density_tiles(pipeline.silver(spark, sf_dir))
    return d.select("cell_i", "cell_j", r6("center_lon").alias("center_lon"),
                    r6("center_lat").alias("center_lat"), r4("density").alias("density"))


@query("hot_spots_fdr")
def q_hot_spots_fdr(spark, sf_dir):
    h = fdr.fdr_classes(hotspots.hot_spots(pipeline.silver(spark, sf_dir)))
    return h.select("bin_id", r4("z_score").alias("z_score"), r6("p_adjusted").alias("p_adjusted"), "fdr_class")


#: A part of the city, as a box of latitudes and longitudes.
DOWNTOWN = {"lat_min": 34.02, "lat_max": 34.07, "lon_min": -118.36, "lon_max": -118.28}


@query("silver_clustered")
def q_silver_clustered(spark, sf_dir):
    """A box of the city, read from silver in Morton order."""
    store = TableStore(spark)
    clustering.write_clustered(store, pipeline.silver(spark, sf_dir), "silver_clustered", row_group_bytes=64 * 1024)
    return (clean.bbox_filter(store.read("silver_clustered"), **DOWNTOWN)
            .select("dr_no", "latitude", "longitude", "severity", "near_school"))


@query("observed_counts")
def q_observed_counts(spark, sf_dir):
    """S16 without scans: the rows of every gold table, counted while they were written."""
    store = TableStore(spark)
    silver = pipeline.write_silver(store, pipeline.silver(spark, sf_dir))
    counts = [(name, store.write_counted(df, name)) for name, df in gold_tables(spark, sf_dir, silver).items()]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


@query("export_publish")
def q_export_publish(spark, sf_dir):
    """S9-S14 published twice; the rows that a reader of the first version and one of the second see."""
    store = TableStore(spark)
    silver = pipeline.write_silver(store, pipeline.silver(spark, sf_dir))
    root = store.path("published")
    heat = export.heatmap_records(heatmap.hex_heatmap(silver))
    outputs = {"vz-heatmap.json": lambda p: export.write_json(heat, p),
               "vz-crashes.json": lambda p: export.write_json(export.crash_records(silver), p)}
    first = silver.filter(F.col("crash_year") == 2022)
    publish.publish(spark, root, outputs | {"vz-crashes.json": lambda p: export.write_json(export.crash_records(first), p)})
    early = publish.Snapshot(spark, root)
    publish.publish(spark, root, outputs)
    late = publish.Snapshot(spark, root)

    def count(version, snapshot, name, schema):
        return (snapshot.json(name, schema).agg(F.count(F.lit(1)).alias("n_records"))
                .select(F.lit(version).alias("version"), F.lit(name).alias("output"), "n_records"))

    out = None
    for version, snapshot in (("first", early), ("second", late)):
        for name, schema in (("vz-heatmap.json", "h3 string"), ("vz-crashes.json", "lat double")):
            one = count(version, snapshot, name, schema)
            out = one if out is None else out.unionByName(one)
    return out


@query("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """P7 on the stream: every page lands twice, the second time after a restart."""
    from roadrisk.streaming.incremental import incremental_ingest
    base = TableStore(spark).path("stream")
    raw = fixtures.incidents_raw(spark, sf_dir)
    for _ in range(2):
        raw.write.mode("append").json(f"{base}/landing")
        incremental_ingest(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_checkpoint", remember="30 days")
    return spark.read.parquet(f"{base}/bronze")


@query("corridor_bucketed")
def q_corridor_bucketed(spark, sf_dir):
    """J3 against road cells that are stored once, in buckets."""
    store = TableStore(spark, database=f"roadrisk_{uuid.uuid4().hex}", temporary=True)
    corridors.store_road_cells(store, fixtures.road_polylines(spark, sf_dir))
    return corridors.match_stored(store, pipeline.silver(spark, sf_dir), unique=True)
