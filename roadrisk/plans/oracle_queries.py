"""name -> DuckDB SQL for every registered query that SQL can express."""

from __future__ import annotations

from roadrisk.plans import oracle as O
from roadrisk.plans.oracle import L, rnd, with_

ORACLE: dict[str, str] = {}


def sql(name: str, ctes: str, select: str) -> None:
    ORACLE[name] = with_(ctes, select)


sql("monthly_series", O.SILVER, f"""
SELECT year_month, count(*) AS total, {O.sev_counts()}
FROM silver GROUP BY year_month ORDER BY year_month""")

sql("crashes_by_year", O.BRONZE, """
SELECT crash_year, count(*) AS cnt FROM bronze GROUP BY 1 ORDER BY 1""")

sql("severity_breakdown", O.SILVER, """
SELECT severity, count(*) AS crash_count FROM silver GROUP BY severity ORDER BY crash_count DESC, severity""")

sql("severity_totals", O.SILVER, f"""
SELECT count(*) AS total_crashes, {O.sev_counts()} FROM silver""")

_TOP = f""",
top AS (
  SELECT intersection, count(*) AS crash_count,
    CAST(count_if(severity = 'fatal') AS BIGINT) AS fatal,
    CAST(count_if(severity = 'pedestrian') AS BIGINT) AS pedestrian,
    CAST(count_if(severity = 'bicycle') AS BIGINT) AS bicycle,
    {O.exact_mean('latitude')} AS lat, {O.exact_mean('longitude')} AS lng
  FROM silver WHERE intersection IS NOT NULL
  GROUP BY intersection ORDER BY crash_count DESC, intersection LIMIT {O.C.TOP_INTERSECTIONS}
)"""

sql("top_intersections", O.SILVER + _TOP, f"""
SELECT intersection, crash_count, fatal, pedestrian, bicycle, {rnd('lat', 6)} AS lat, {rnd('lng', 6)} AS lng FROM top""")

sql("school_zone_stats", O.SILVER, """
SELECT CAST(count_if(near_school = 1) AS BIGINT) AS school_zone_crashes,
       CAST(count_if(near_school = 1 AND severity = 'fatal') AS BIGINT) AS school_zone_fatal FROM silver""")

def _stats_rows(months: bool = False) -> str:
    """One SELECT per section of the stats document."""
    null = "CAST(NULL AS BIGINT)"
    real = "CAST(NULL AS DOUBLE)"

    def row(section, name, crashes, fatal=null, place="0", source="FROM silver", ped=null, bike=null, lat=real, lng=real):
        return (f"SELECT '{section}' AS section, CAST({place} AS INTEGER) AS place, {name} AS name, CAST({crashes} AS BIGINT) AS crashes, "
                f"CAST({fatal} AS BIGINT) AS fatal, {ped} AS pedestrian, {bike} AS bicycle, {lat} AS lat, {lng} AS lng {source}")

    rows = [row("total", "'crashes'", "count(*)"), row("date_from", "CAST(min(crash_date) AS VARCHAR)", "NULL"),
            row("date_to", "CAST(max(crash_date) AS VARCHAR)", "NULL"),
            row("school_zone", "'near'", "count_if(near_school = 1)", "count_if(near_school = 1 AND severity = 'fatal')")]
    for section in ("severity", "by_severity"):
        rows += [row(section, f"'{s}'", f"count_if(severity = '{s}')") for s in O.C.SEVERITY_LABELS]
    rows.append(row("top", "intersection", "crash_count", "fatal", "row_number() OVER (ORDER BY crash_count DESC, intersection) - 1",
                    "FROM top", "pedestrian", "bicycle", rnd("lat", 5), rnd("lng", 5)))
    if months:
        order = "row_number() OVER (ORDER BY year_month) - 1"
        for s in ["total", *O.C.SEVERITY_LABELS]:
            n = "count(*)" if s == "total" else f"count_if(severity = '{s}')"
            rows.append(row(f"month_{s}", "year_month", n, place=order, source="FROM silver GROUP BY year_month"))
    return "\nUNION ALL\n".join(rows)


sql("summary_stats", O.SILVER + _TOP, _stats_rows())

sql("enrichment_summary", O.SILVER, """
SELECT count(*) AS total_rows, count(DISTINCT h3_res9) AS distinct_fine_cells,
  count(DISTINCT h3_res8) AS distinct_coarse_cells, count(*) AS with_geometry,
  CAST(count_if(near_school = 1) AS BIGINT) AS near_school FROM silver""")

sql("ingest_incidents", O.BRONZE, "SELECT * FROM bronze")

sql("ingest_schools", "schools_dummy AS (SELECT 1)" + O.SCHOOLS, """
SELECT school_id, school_name, latitude, longitude, school_lat, school_lon FROM schools""")

sql("clean_incidents", O.CLEAN, "SELECT dr_no, latitude, longitude, crash_date, crash_hour FROM cleaned")

sql("calendar_columns", O.SILVER, "SELECT dr_no, crash_year, crash_month, year_month FROM silver")

sql("point_column", O.CLEAN, "SELECT dr_no, longitude AS lon, latitude AS lat, 4326 AS srid FROM cleaned")

sql("bbox_filter", O.CLEAN, "SELECT dr_no, latitude, longitude FROM valid")

sql("dedupe_incidents", O.CLEAN, "SELECT dr_no, date_occ, time_occ, lat, lon, mocodes FROM cleaned")

sql("classify_severity", O.CLEAN, f"SELECT dr_no, mocodes, crm_cd_desc, {O.severity_case()} AS severity FROM cleaned")

sql("intersection_label", O.CLEAN, """
SELECT dr_no, CASE WHEN cross_street IS NOT NULL AND cross_street <> ''
  THEN nullif(location, '') || ' / ' || cross_street ELSE nullif(location, '') END AS intersection FROM cleaned""")

sql("hex_bins", O.SILVER, "SELECT dr_no, h3_res9, h3_res8 FROM silver")


def _cells_cte() -> str:
    parts = [f"SELECT DISTINCT '{label}' AS resolution, h3_res{label} AS h3_index, c{label}_q AS q, c{label}_r AS r, "
             f"{edge!r} AS edge FROM silver" for label, edge in O.C.HEATMAP_RESOLUTIONS]
    return ",\ncells AS (" + " UNION ALL ".join(parts) + ")"


def _vertex_select(src: str, i: int, out_i: int) -> str:
    sels = []
    for label, edge in O.C.HEATMAP_RESOLUTIONS:
        lng, lat = O.hex_vertex("q", "r", edge, i)
        sels.append(f"SELECT h3_index, resolution, CAST({out_i} AS INTEGER) AS vertex, {lng} AS lng, {lat} AS lat "
                    f"FROM {src} WHERE resolution = '{label}'")
    return " UNION ALL ".join(sels)


sql("hex_boundary", O.SILVER + _cells_cte(),
    " UNION ALL ".join(_vertex_select("cells", i % 6, i) for i in range(7)))


def _heat_cte() -> str:
    parts = [f"SELECT '{label}' AS resolution, h3_res{label} AS h3_index, c{label}_q AS q, c{label}_r AS r, "
             f"severity, latitude, longitude FROM silver" for label, _ in O.C.HEATMAP_RESOLUTIONS]
    return f""",
heat_in AS ({' UNION ALL '.join(parts)}),
heat AS (
  SELECT resolution, h3_index, any_value(q) AS q, any_value(r) AS r, count(*) AS crash_count,
    CAST(count_if(severity = 'fatal') AS BIGINT) AS fatal_count,
    CAST(count_if(severity = 'pedestrian') AS BIGINT) AS pedestrian_count,
    CAST(count_if(severity = 'bicycle') AS BIGINT) AS bicycle_count,
    CAST(sum({O.severity_weight_case()}) AS BIGINT) AS severity_score,
    {O.exact_mean('latitude')} AS center_lat, {O.exact_mean('longitude')} AS center_lng
  FROM heat_in GROUP BY resolution, h3_index
)"""


def _heat_select() -> str:
    sels = []
    for label, edge in O.C.HEATMAP_RESOLUTIONS:
        lng, lat = O.hex_vertex("q", "r", edge, 0)
        sels.append(f"""SELECT h3_index, resolution, crash_count, fatal_count, pedestrian_count, bicycle_count,
  severity_score, {rnd('center_lat', 6)} AS center_lat, {rnd('center_lng', 6)} AS center_lng,
  CAST(7 AS BIGINT) AS boundary_points, {lng} AS boundary_lng0, {lat} AS boundary_lat0
FROM heat WHERE resolution = '{label}'""")
    return "\nUNION ALL\n".join(sels)


sql("hex_heatmap", O.SILVER + _heat_cte(), _heat_select())

sql("near_school_join", O.CLEAN + O.SCHOOLS, f"""
SELECT dr_no, latitude, longitude FROM cleaned c
WHERE EXISTS (SELECT 1 FROM schools s WHERE {O.haversine_within('c.latitude', 'c.longitude', 's.school_lat', 's.school_lon', O.C.SCHOOL_RADIUS_M)})""")

sql("near_school_flag", O.SILVER, "SELECT dr_no, near_school FROM silver")

sql("hot_spots", O.SILVER + O.HOT_SPOTS, f"""
SELECT bin_id, crash_count, {rnd('z_score', 4)} AS z_score, {rnd(O.p_value('z_score'), 6)} AS p_value,
  {O.classify('z_score')} AS classification FROM hs""")

sql("emerging_hot_spots", O.SILVER + O.EMERGING, f"""
SELECT bin_id, trend, quarters_hot, {rnd('latest_z', 4)} AS latest_z, {rnd('mk_z', 4)} AS mk_z, n_steps FROM emerging""")

sql("trend_breakdown", O.SILVER + O.EMERGING, """
SELECT trend, count(*) AS bins FROM emerging GROUP BY trend ORDER BY bins DESC, trend""")

sql("kernel_density", O.SILVER + O.kde_ctes(), f"""
SELECT cell_i, cell_j, {rnd('center_lon', 6)} AS center_lon, {rnd('center_lat', 6)} AS center_lat,
  {rnd('density', 4)} AS density FROM density""")

sql("road_clean", O.ROADS, """
SELECT k AS way_id, n_geometry, highway_tag FROM rw_clean""")

sql("road_dedup_points", O.ROADS, "SELECT k AS way_id, idx, lon, lat FROM rw_dd")

sql("simplify_roads", O.ROADS, "SELECT k AS way_id, idx, lon, lat FROM rw_simple")

sql("road_lengths", O.ROADS, f"""
SELECT k AS way_id, n_points, {rnd('length', 9)} AS length, length >= {L(O.C.MIN_PATH_LENGTH_DEG)} AS kept FROM rw_paths""")

sql("road_color", O.ROADS, f"""
SELECT t.k AS way_id, t.highway, t.traj_index, t.color_index, p.pr AS color_r, p.pg AS color_g, p.pb AS color_b
FROM rw_traj_c t JOIN {O.PALETTE} p ON p.ci = t.color_index""")

sql("sub_paths", O.ROADS, f"""
SELECT s.k AS way_id, s.sub, s.start, s."end", CAST(s."end" - s.start AS BIGINT) AS n_points, s.color_index,
  p.pr AS color_r, p.pg AS color_g, p.pb AS color_b
FROM rw_sub s JOIN {O.PALETTE} p ON p.ci = s.color_index""")

sql("road_totals", O.ROADS, """
SELECT (SELECT count(*) FROM rw_traj_c) AS trajectories, (SELECT count(*) FROM rw_sub) AS sub_paths,
  (SELECT count(*) FROM rw_traj_c) + (SELECT count(*) FROM rw_sub) AS total_paths,
  CAST((SELECT sum(n_points) FROM rw_traj_c) + coalesce((SELECT sum("end" - start) FROM rw_sub), 0) AS BIGINT) AS total_points""")

sql("road_segments", O.POLYLINES, f"""
SELECT road_index, seg, a_lon, a_lat, b_lon, b_lat, {rnd(O.planar('a_lon', 'a_lat', 'b_lon', 'b_lat'), 9)} AS length FROM rp_seg""")

sql("road_match", O.SILVER + "," + O.POLYLINES + O.MATCH, "SELECT road_index, dr_no, severity FROM rm_pairs")

sql("danger_corridors", O.SILVER + "," + O.POLYLINES + O.MATCH, f"""
SELECT road_index, n_points, crash_count, fatal, pedestrian, bicycle, severe,
  {O.rgb_cols('crash_count', O.relative_scale('(SELECT mx FROM rm_max)'), 'color')}, road_name FROM corr""")

sql("corridor_color", O.SILVER + "," + O.POLYLINES + O.MATCH + """,
cc AS (SELECT DISTINCT crash_count FROM corr),
cc_max AS (SELECT greatest(max(crash_count), 1) AS mx FROM cc)""", f"""
SELECT crash_count, {O.rgb_cols('crash_count', O.relative_scale('(SELECT mx FROM cc_max)'), 'rel')},
  {O.rgb_cols('crash_count', L(O.C.ABSOLUTE_COLOR_SCALE), 'abs')} FROM cc""")

sql("partitioned_roundtrip", O.BRONZE, "SELECT * FROM bronze")

sql("append_roundtrip", O.SILVER + _heat_cte(), _heat_select())


def _heat_export_select() -> str:
    sels = []
    for label, edge in O.C.HEATMAP_RESOLUTIONS:
        lng, lat = O.hex_vertex("q", "r", edge, 3)
        sels.append(f"""SELECT h3_index AS h3, crash_count AS count, fatal_count AS fatal, pedestrian_count AS ped,
  bicycle_count AS bike, coalesce(severity_score, 0) AS severity_score, CAST(resolution AS INTEGER) AS res,
  {rnd('center_lat', 5)} AS lat, {rnd('center_lng', 5)} AS lng, {lng} AS boundary_lng3, {lat} AS boundary_lat3
FROM heat WHERE resolution = '{label}'""")
    return "\nUNION ALL\n".join(sels)


sql("export_heatmap", O.SILVER + _heat_cte(), _heat_export_select())

sql("export_corridors", O.SILVER + "," + O.POLYLINES + O.MATCH, f"""
SELECT n_points, {O.road_lon('road_index', '0')} AS lon0, {O.road_lat('road_index', '0')} AS lat0,
  {O.rgb_cols('crash_count', O.relative_scale('(SELECT mx FROM rm_max)'), 'color')},
  crash_count AS crashes, fatal, pedestrian, bicycle, road_name FROM corr""")

_HS_V0 = O.hex_vertex("q", "r", O.HS_EDGE, 0)
sql("export_hotspots", O.SILVER + O.HOT_SPOTS, f"""
SELECT bin_id, crash_count, {rnd('z_score', 4)} AS z_score, {rnd(O.p_value('z_score'), 6)} AS p_value,
  {O.classify('z_score')} AS classification, {_HS_V0[0]} AS boundary_lng0, {_HS_V0[1]} AS boundary_lat0 FROM hs""")

_HS_V2 = O.hex_vertex("q", "r", O.HS_EDGE, 2)
sql("export_emerging", O.SILVER + O.EMERGING, f"""
SELECT bin_id, trend, quarters_hot, {rnd('latest_z', 4)} AS latest_z, CAST(7 AS BIGINT) AS boundary_points,
  {_HS_V2[0]} AS boundary_lng2, {_HS_V2[1]} AS boundary_lat2 FROM emerging""")

sql("export_crashes", O.SILVER, f"""
SELECT {rnd('latitude', 5)} AS lat, {rnd('longitude', 5)} AS lng, strftime(crash_date, '%Y-%m-%d') AS date,
  crash_hour AS hour, severity AS sev, crm_cd_desc AS "desc", location AS loc, cross_street AS "cross",
  year_month AS ym FROM silver""")

sql("export_stats", O.SILVER + _TOP, _stats_rows(months=True))

sql("table_row_counts",
    O.SILVER + O.HOT_SPOTS + O.EMERGING + O.kde_ctes() + _heat_cte() + "," + O.POLYLINES + O.MATCH, """
SELECT 'gold_hotspots' AS table_name, count(*) AS row_count FROM hs
UNION ALL SELECT 'gold_emerging_hotspots', count(*) FROM emerging
UNION ALL SELECT 'gold_crash_density', count(*) FROM density
UNION ALL SELECT 'gold_h3_heatmap', count(*) FROM heat
UNION ALL SELECT 'gold_danger_corridors', count(*) FROM corr
UNION ALL SELECT 'gold_stats', 1
UNION ALL SELECT 'gold_timeseries', count(DISTINCT year_month) FROM silver""")

sql("ingest_incidents_stream", O.BRONZE, "SELECT * FROM bronze")

sql("ingest_rejects", O.INCIDENTS_RAW.strip(), """
SELECT 'good' AS status, count(*) AS n_lines FROM incidents_raw WHERE dr_no NOT LIKE '%7'
UNION ALL SELECT 'rejected', count(*) FROM incidents_raw WHERE dr_no LIKE '%7'""")

sql("silver_roundtrip", O.SILVER, """
SELECT dr_no, crash_year, crash_month, crash_hour, severity, intersection, h3_res9, near_school FROM silver""")

sql("top_hot_spots", O.SILVER + O.HOT_SPOTS, f"""
SELECT bin_id, crash_count, {rnd('z_score', 4)} AS z_score, {O.classify('z_score')} AS classification FROM hs
ORDER BY 3 DESC NULLS LAST, bin_id LIMIT 10""")

sql("danger_corridors_absolute", O.SILVER + "," + O.POLYLINES + O.MATCH, f"""
SELECT road_index, crash_count, {O.rgb_cols('crash_count', L(O.C.ABSOLUTE_COLOR_SCALE), 'color')} FROM corr""")

sql("path_writeout", O.ROADS, f"""
SELECT CAST(x.n AS BIGINT) AS n_points, p.pr AS color_r, p.pg AS color_g, p.pb AS color_b
FROM (SELECT n_points AS n, color_index FROM rw_traj_c UNION ALL SELECT "end" - start, color_index FROM rw_sub) x
JOIN {O.PALETTE} p ON p.ci = x.color_index""")

sql("polyline_file", "poly_dummy AS (SELECT 1)", f"""
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS name, CAST(p_partkey % 10 + 1 AS BIGINT) AS n_points,
  {O.road_lon('p_partkey', '0')} AS lon0, {O.road_lat('p_partkey', '0')} AS lat0, 0 AS color_r, 238 AS color_g, 255 AS color_b
FROM part""")

sql("verify_outputs", "names AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}')" for n in (
    "vz-heatmap", "vz-corridors", "vz-hotspots", "vz-emerging", "vz-crashes", "vz-stats")) + ") AS t(name))", """
SELECT name, TRUE AS "exists", TRUE AS non_empty FROM names""")


# ------------------------------------------------------------ refresh, nearest schools, chains

sql("silver_upsert", O.SILVER_CORRECTED, """
SELECT dr_no, crash_year, crash_month, crash_hour, severity, intersection, latitude, longitude, h3_res9, h3_res8, near_school
FROM silver""")


def _gold_rows() -> str:
    def row(section, name, total="count(*)", fatal="count_if(severity = 'fatal')", pedestrian="count_if(severity = 'pedestrian')",
            bicycle="count_if(severity = 'bicycle')", lat=None, lng=None, source="FROM silver"):
        real = lambda c: "CAST(NULL AS DOUBLE)" if c is None else rnd(c, 6)
        return (f"SELECT '{section}' AS section, {name} AS name, CAST({total} AS BIGINT) AS total, CAST({fatal} AS BIGINT) AS fatal, "
                f"CAST({pedestrian} AS BIGINT) AS pedestrian, CAST({bicycle} AS BIGINT) AS bicycle, {real(lat)} AS lat, {real(lng)} AS lng {source}")

    means = {"lat": O.exact_mean("latitude"), "lng": O.exact_mean("longitude")}
    rows = [row("month", "year_month", source="FROM silver GROUP BY year_month"),
            row("intersection", "intersection", "crash_count", "fatal", "pedestrian", "bicycle", "lat", "lng", "FROM top"),
            row("dates", "CAST(min(crash_date) AS VARCHAR) || ' ' || CAST(max(crash_date) AS VARCHAR)"),
            row("school_zone", "'near'", "count_if(near_school = 1)", "count_if(near_school = 1 AND severity = 'fatal')", "NULL", "NULL")]
    for label, _ in O.C.HEATMAP_RESOLUTIONS:
        rows.append(row("cell", f"h3_res{label}", **means, source=f"FROM silver GROUP BY h3_res{label}"))
        rows.append(row("distinct", f"'cell{label}'", f"count(DISTINCT h3_res{label})", "NULL", "NULL", "NULL"))
        rows.append(row("sketch_within_3_errors", f"'cell{label}'", "1", "NULL", "NULL", "NULL", source=""))
    return "\nUNION ALL\n".join(rows)


sql("gold_refresh", O.SILVER_CORRECTED + _TOP, _gold_rows())

_DISTANCE = rnd(f"{L(2.0 * O.C.EARTH_RADIUS_M)} * asin(sqrt(least({O.haversine_a('cleaned.latitude', 'cleaned.longitude', 'school_lat', 'school_lon')}, 1.0)))", 3)

sql("nearest_school", O.CLEAN + O.SCHOOLS, f"""
SELECT dr_no, row_number() OVER (PARTITION BY dr_no ORDER BY distance_m, school_id) AS rank, school_id, distance_m
FROM (SELECT dr_no, school_id, {_DISTANCE} AS distance_m FROM cleaned, schools)
QUALIFY rank <= 3""")

sql("road_chains", O.CHAINS, """
SELECT p.head // 2 AS chain_id, CAST(w.position AS BIGINT) AS position, w.state // 2 AS way_id, w.state % 2 = 1 AS backward,
  false AS closed, p.n AS n_ways
FROM paths p JOIN walk w ON w.head = p.head WHERE p.head // 2 < p.tail // 2 OR (p.n = 1 AND p.head % 2 = 0)
UNION ALL
SELECT r.head // 2, CAST(w.position AS BIGINT), w.state // 2, w.state % 2 = 1, true, r.n
FROM rings r JOIN ring_walk w ON w.head = r.head WHERE r.head = r.low AND r.head % 2 = 0""")

sql("road_rejects", "part_k AS (SELECT p_partkey AS k FROM part)", """
SELECT 'way' AS kind, CASE WHEN k % 7 = 3 THEN 'rejected' ELSE 'good' END AS status, count(*) AS n_lines FROM part_k GROUP BY ALL
UNION ALL
SELECT 'polyline', CASE WHEN k % 5 = 2 THEN 'rejected' ELSE 'good' END, count(*) FROM part_k GROUP BY ALL""")


# ------------------------------------------------------------ other ways to the same results

ORACLE["density_tiles"] = ORACLE["kernel_density"]

sql("hot_spots_fdr", O.SILVER + O.HOT_SPOTS + f""",
tested AS (SELECT bin_id, z_score, {O.p_value('z_score')} AS p, count(*) OVER () AS m FROM hs WHERE z_score IS NOT NULL),
ranked AS (SELECT *, count(*) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS j FROM tested),
stepped AS (SELECT bin_id, min(least(CAST(m AS DOUBLE) * p / CAST(j AS DOUBLE), 1.0))
              OVER (ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p_adjusted FROM ranked)""", f"""
SELECT bin_id, {rnd('z_score', 4)} AS z_score, {rnd('p_adjusted', 6)} AS p_adjusted,
  CASE WHEN z_score > 0 AND p_adjusted <= 0.01 THEN 'hot_99' WHEN z_score < 0 AND p_adjusted <= 0.01 THEN 'cold_99'
       WHEN z_score > 0 AND p_adjusted <= 0.05 THEN 'hot_95' WHEN z_score < 0 AND p_adjusted <= 0.05 THEN 'cold_95'
       WHEN z_score > 0 AND p_adjusted <= 0.10 THEN 'hot_90' WHEN z_score < 0 AND p_adjusted <= 0.10 THEN 'cold_90'
       ELSE 'not_significant' END AS fdr_class
FROM hs LEFT JOIN stepped USING (bin_id)""")

sql("silver_clustered", O.SILVER, """
SELECT dr_no, latitude, longitude, severity, near_school FROM silver
WHERE latitude BETWEEN 34.02 AND 34.07 AND longitude BETWEEN -118.36 AND -118.28""")

ORACLE["observed_counts"] = ORACLE["table_row_counts"]

_CELLS_9_8 = "(SELECT count(DISTINCT h3_res9) + count(DISTINCT h3_res8) FROM silver)"
sql("export_publish", O.SILVER, f"""
SELECT v.version, 'vz-heatmap.json' AS output, {_CELLS_9_8} AS n_records FROM (VALUES ('first'), ('second')) AS v(version)
UNION ALL SELECT 'first', 'vz-crashes.json', count(*) FROM silver WHERE crash_year = 2022
UNION ALL SELECT 'second', 'vz-crashes.json', count(*) FROM silver""")

sql("stream_dedupe", O.BRONZE, "SELECT DISTINCT * FROM bronze")

ORACLE["corridor_bucketed"] = ORACLE["road_match"]
