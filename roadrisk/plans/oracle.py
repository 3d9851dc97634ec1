"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query is a WITH-chain built from the fragments below: fixture rows from
the harness tables, bronze, silver, then the gold step. The fragments use the
same literal constants and the same arithmetic order as the Spark
expressions, so doubles agree bit for bit; rounding is written as
``floor(v * 10^d + 0.5) / 10^d`` on both sides. Spatial joins here are brute
force (no grid), which also checks that the Spark grids lose no pair.
"""

from __future__ import annotations

import math

from roadrisk import config as C
from roadrisk.functions import hexgrid


def L(v: float) -> str:
    """A double literal DuckDB parses to exactly the Python float."""
    r = repr(float(v))
    return f"CAST('{r}' AS DOUBLE)"


def rnd(expr: str, d: int) -> str:
    s = float(10 ** d)
    return f"(CAST(floor(({expr}) * {L(s)} + {L(0.5)}) AS DOUBLE) / {L(s)})"


def dec_text(v: str) -> str:
    return f"format('{{}}.{{:06d}}', ({v}) // 1000000, ({v}) % 1000000)"


# ---------------------------------------------------------------- fixtures

INCIDENTS_RAW = f"""
ev_base AS (
  SELECT event_id AS e, user_id AS u,
         (event_id * 7919 + 104729) % 10007 AS h1,
         (event_id * 6271 + 31337) % 10009 AS h2,
         hour(ts) * 100 + minute(ts) AS hm
  FROM events
),
ev_coord AS (
  SELECT *,
    CASE WHEN e % 5 = 0 THEN 33800000 + h1 * 50
         ELSE 34000000 + (u % 12) * 10000 + ((h1 % 201) - 100) * 50 END AS lat_u,
    CASE WHEN e % 5 = 0 THEN 118100000 + h2 * 50
         ELSE 118400000 - ((u * 7) % 12) * 15000 + ((h2 % 201) - 100) * 50 END AS lon_u
  FROM ev_base
),
incidents_once AS (
  SELECT
    'DR' || CAST(e AS VARCHAR) AS dr_no,
    strftime(DATE '2022-01-01' + CAST((e * 37) % 1096 AS INTEGER), '%Y-%m-%d') || 'T00:00:00.000' AS date_occ,
    lpad(CAST(hm AS VARCHAR), 4, '0') AS time_occ,
    'Central' AS area_name,
    CASE WHEN e % 97 = 0 THEN 'Pedestrian struck' WHEN e % 89 = 0 THEN 'MOTORBIKE COLLISION'
         WHEN e % 83 = 0 THEN 'HIT AND RUN FELONY' ELSE 'TRAFFIC COLLISION' END AS crm_cd_desc,
    '' AS vict_age, 'X' AS vict_sex, '' AS vict_descent, 'STREET' AS premis_desc,
    'STREET ' || CAST(u % 12 AS VARCHAR) AS location,
    CASE WHEN e % 4 = 0 THEN '' WHEN e % 9 = 0 THEN NULL ELSE 'AVE ' || CAST(u % 6 AS VARCHAR) END AS cross_street,
    CASE WHEN e % 101 = 0 THEN '' WHEN e % 103 = 0 THEN '0' WHEN e % 107 = 0 THEN '40.5'
         ELSE {dec_text('lat_u')} END AS lat,
    CASE WHEN e % 101 = 0 THEN '' WHEN e % 103 = 0 THEN '0' ELSE '-' || {dec_text('lon_u')} END AS lon,
    CASE WHEN e % 40 = 0 THEN '3036 0449' WHEN e % 11 = 0 THEN '1920' WHEN e % 13 = 0 THEN ' 1822  3004'
         WHEN e % 7 = 0 THEN '0448' WHEN e % 3 = 0 THEN '' ELSE NULL END AS mocodes,
    e
  FROM ev_coord
),
incidents_raw AS (
  SELECT * EXCLUDE (e) FROM incidents_once
  UNION ALL
  SELECT * EXCLUDE (e) REPLACE (CASE WHEN e % 100 = 0 THEN '0000' ELSE '2359' END AS time_occ, 'Annex' AS area_name)
  FROM incidents_once WHERE e % 50 = 0
)"""

FIELDS = C.INCIDENT_FIELDS

BRONZE = INCIDENTS_RAW + f""",
bronze_norm AS (
  SELECT {', '.join(f"coalesce({f}, '') AS {f}" for f in FIELDS)} FROM incidents_raw
),
bronze AS (
  SELECT *, CAST(year(CAST(TRY_CAST(date_occ AS TIMESTAMP) AS DATE)) AS INTEGER) AS crash_year
  FROM bronze_norm
  WHERE TRY_CAST(date_occ AS TIMESTAMP) > TIMESTAMP '{C.INGEST_SINCE}'
)"""

SCHOOLS = f""",
schools_raw AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS school_id, s_name AS school_name,
    {dec_text("34000000 + (s_suppkey % 12) * 10000 + (((s_suppkey * 61) % 201) - 100) * 45")} AS latitude,
    '-' || {dec_text("118400000 - ((s_suppkey * 5) % 12) * 15000 - (((s_suppkey * 43) % 201) - 100) * 45")} AS longitude
  FROM supplier
  UNION ALL
  SELECT 'S-missing', 'Unplaced school', NULL, NULL FROM supplier WHERE s_suppkey = 0
),
schools AS (
  SELECT *, TRY_CAST(latitude AS DOUBLE) AS school_lat, TRY_CAST(longitude AS DOUBLE) AS school_lon
  FROM schools_raw
  WHERE TRY_CAST(latitude AS DOUBLE) IS NOT NULL AND TRY_CAST(longitude AS DOUBLE) IS NOT NULL
)"""


# ---------------------------------------------------------------- expressions

def proj_x(lon: str) -> str:
    return f"(({lon}) - {L(C.ORIGIN_LON)}) * {L(C.M_PER_DEG_X)}"


def proj_y(lat: str) -> str:
    return f"(({lat}) - {L(C.ORIGIN_LAT)}) * {L(C.M_PER_DEG_Y)}"


def unproj_lon(x: str) -> str:
    return f"({L(C.ORIGIN_LON)} + ({x}) / {L(C.M_PER_DEG_X)})"


def unproj_lat(y: str) -> str:
    return f"({L(C.ORIGIN_LAT)} + ({y}) / {L(C.M_PER_DEG_Y)})"


def hex_qr_cols(x: str, y: str, edge: float, prefix: str) -> str:
    """SELECT-list text producing {prefix}q, {prefix}r (BIGINT) via cube rounding."""
    cqx, cqy, cry = hexgrid.axial_coefficients(edge)
    qf = f"(({x}) * {L(cqx)} - ({y}) * {L(cqy)})"
    rf = f"(({y}) * {L(cry)})"
    sf = f"(-{qf} - {rf})"
    rq = f"floor({qf} + {L(0.5)})"
    rr = f"floor({rf} + {L(0.5)})"
    rs = f"floor({sf} + {L(0.5)})"
    dq = f"abs({rq} - {qf})"
    dr = f"abs({rr} - {rf})"
    ds = f"abs({rs} - {sf})"
    qworst = f"({dq} > {dr} AND {dq} > {ds})"
    q = f"CAST(CASE WHEN {qworst} THEN -{rr} - {rs} ELSE {rq} END AS BIGINT)"
    r = f"CAST(CASE WHEN {qworst} THEN {rr} WHEN {dr} > {ds} THEN -{rq} - {rs} ELSE {rr} END AS BIGINT)"
    return f"{q} AS {prefix}q, {r} AS {prefix}r"


def hex_id(label: str, q: str, r: str) -> str:
    return f"('{label}:' || CAST({q} AS VARCHAR) || ':' || CAST({r} AS VARCHAR))"


def hex_center_x(q: str, r: str, edge: float) -> str:
    return f"(({q}) + ({r}) * {L(0.5)}) * {L(edge * math.sqrt(3.0))}"


def hex_center_y(r: str, edge: float) -> str:
    return f"({r}) * {L(1.5 * edge)}"


def hex_vertex(q: str, r: str, edge: float, i: int, d: int = 6) -> tuple[str, str]:
    dx, dy = hexgrid.vertex_offsets(edge)[i]
    lng = rnd(unproj_lon(f"{hex_center_x(q, r, edge)} + {L(dx)}"), d)
    lat = rnd(unproj_lat(f"{hex_center_y(r, edge)} + {L(dy)}"), d)
    return lng, lat


def haversine_a(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    half = L(C.DEG * 0.5)
    deg = L(C.DEG)
    s_lat = f"sin((({lat2}) - ({lat1})) * {half})"
    s_lon = f"sin((({lon2}) - ({lon1})) * {half})"
    return f"({s_lat} * {s_lat} + cos(({lat1}) * {deg}) * cos(({lat2}) * {deg}) * {s_lon} * {s_lon})"


def haversine_within(lat1, lon1, lat2, lon2, radius_m: float) -> str:
    a_max = math.sin(radius_m / (2.0 * C.EARTH_RADIUS_M)) ** 2
    return f"({haversine_a(lat1, lon1, lat2, lon2)} <= {L(a_max)})"


def severity_case(mocodes: str = "mocodes", desc: str = "crm_cd_desc") -> str:
    codes = f"regexp_split_to_array(trim(coalesce({mocodes}, '')), '\\s+')"
    d = f"upper(coalesce({desc}, ''))"
    parts = []
    for label, rule_codes, words in C.SEVERITY_RULES:
        conds = [f"list_contains({codes}, '{c}')" for c in rule_codes] + [f"contains({d}, '{w}')" for w in words]
        parts.append(f"WHEN {' OR '.join(conds)} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{C.SEVERITY_OTHER}' END"


def severity_weight_case(col: str = "severity") -> str:
    parts = [f"WHEN {col} = '{k}' THEN {v}" for k, v in C.SEVERITY_WEIGHTS.items() if k != C.SEVERITY_OTHER]
    return f"CASE {' '.join(parts)} ELSE {C.SEVERITY_WEIGHTS[C.SEVERITY_OTHER]} END"


def exact_mean(col: str, scale: int = 9) -> str:
    return f"(CAST(sum(CAST({col} AS DECIMAL({18 + scale},{scale}))) AS DOUBLE) / CAST(count({col}) AS DOUBLE))"


def sev_counts(col: str = "severity") -> str:
    return ", ".join(f"CAST(count_if({col} = '{s}') AS BIGINT) AS {s}" for s in C.SEVERITY_LABELS)


# ---------------------------------------------------------------- silver

_ORDER = [f for f in FIELDS if f != "dr_no"] + ["crash_year", "latitude", "longitude", "crash_date", "crash_hour"]

CLEAN = BRONZE + f""",
parsed AS (
  SELECT *, TRY_CAST(lat AS DOUBLE) AS latitude, TRY_CAST(lon AS DOUBLE) AS longitude,
         TRY_CAST(date_occ AS DATE) AS crash_date,
         TRY_CAST(substring(time_occ, 1, 2) AS INTEGER) AS crash_hour
  FROM bronze
),
valid AS (
  SELECT * FROM parsed
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND latitude <> 0 AND longitude <> 0
    AND latitude BETWEEN {L(C.LAT_MIN)} AND {L(C.LAT_MAX)}
    AND longitude BETWEEN {L(C.LON_MIN)} AND {L(C.LON_MAX)}
),
cleaned AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY dr_no ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in _ORDER)}) = 1
)"""

_HEX_SEL = ", ".join(
    hex_qr_cols(proj_x("longitude"), proj_y("latitude"), edge, f"c{label}_")
    for label, edge in C.HEATMAP_RESOLUTIONS)

SILVER = CLEAN + SCHOOLS + f""",
enriched AS (
  SELECT * REPLACE (CAST(year(crash_date) AS INTEGER) AS crash_year),
    {severity_case()} AS severity,
    CAST(month(crash_date) AS INTEGER) AS crash_month,
    strftime(crash_date, '%Y-%m') AS year_month,
    CASE WHEN cross_street IS NOT NULL AND cross_street <> ''
         THEN nullif(location, '') || ' / ' || cross_street ELSE nullif(location, '') END AS intersection,
    {_HEX_SEL}
  FROM cleaned
),
silver AS (
  SELECT *,
    {', '.join(hex_id(label, f'c{label}_q', f'c{label}_r') + f' AS h3_res{label}' for label, _ in C.HEATMAP_RESOLUTIONS)},
    CASE WHEN EXISTS (SELECT 1 FROM schools s
                      WHERE {haversine_within('enriched.latitude', 'enriched.longitude', 's.school_lat', 's.school_lon', C.SCHOOL_RADIUS_M)})
         THEN 1 ELSE 0 END AS near_school
  FROM enriched
)"""


def with_(ctes: str, select: str) -> str:
    kw = "WITH RECURSIVE" if "rw_iv(" in ctes or "ring_walk" in ctes else "WITH"
    return f"{kw} {ctes}\n{select}"


# ---------------------------------------------------------------- statistics

def gi_z(sum_x: str, w: str, n: str, total: str, sumsq: str) -> str:
    d = lambda e: f"CAST({e} AS DOUBLE)"
    xbar = f"({d(total)} / NULLIF({d(n)}, {L(0.0)}))"
    s = f"sqrt(greatest({d(sumsq)} / NULLIF({d(n)}, {L(0.0)}) - {xbar} * {xbar}, {L(0.0)}))"
    num = f"({d(sum_x)} - {xbar} * {d(w)})"
    inner = f"(({d(n)} * {d(w)} - {d(w)} * {d(w)}) / NULLIF({d(n)} - {L(1.0)}, {L(0.0)}))"
    den = f"({s} * sqrt(greatest({inner}, {L(0.0)})))"
    return f"({num} / NULLIF({den}, {L(0.0)}))"


def p_value(z: str) -> str:
    x = f"(abs({z}) / {L(2.0 ** 0.5)})"
    t = f"({L(1.0)} / ({L(1.0)} + {L(C.AS_P)} * {x}))"
    a1, a2, a3, a4, a5 = (L(a) for a in C.AS_A)
    poly = f"({t} * ({a1} + {t} * ({a2} + {t} * ({a3} + {t} * ({a4} + {t} * {a5})))))"
    return f"({poly} * exp(-({x} * {x})))"


def classify(z: str) -> str:
    return (f"CASE WHEN {z} >= {L(C.Z_99)} THEN 'hot_99' WHEN {z} >= {L(C.Z_95)} THEN 'hot_95' "
            f"WHEN {z} >= {L(C.Z_90)} THEN 'hot_90' WHEN {z} <= {L(-C.Z_99)} THEN 'cold_99' "
            f"WHEN {z} <= {L(-C.Z_95)} THEN 'cold_95' WHEN {z} <= {L(-C.Z_90)} THEN 'cold_90' "
            f"ELSE 'not_significant' END")


def offsets_values(rings: int, with_dt: bool = False) -> str:
    rows = []
    for dq, dr in hexgrid.ring_offsets(rings):
        if with_dt:
            rows += [f"({dq}, {dr}, 0)", f"({dq}, {dr}, 1)"]
        else:
            rows.append(f"({dq}, {dr})")
    cols = "dq, dr, dt" if with_dt else "dq, dr"
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS t({cols}))"


def offcol(q: str, r: str) -> str:
    return f"(({q}) + CAST(floor(({r}) / 2.0) AS BIGINT))"


def w_in_rect(src: str, st: str, rings: int) -> str:
    """SELECT q, r, w: neighbour offsets of each (q, r) in `src` inside the rectangle."""
    return f"""SELECT c.q, c.r, count(*) AS w FROM {src} c, {offsets_values(rings)} o, {st} s
  WHERE {offcol('c.q + o.dq', 'c.r + o.dr')} BETWEEN s.c0 AND s.c1 AND c.r + o.dr BETWEEN s.r0 AND s.r1
  GROUP BY c.q, c.r"""


HS_EDGE = hexgrid.edge_from_flat_width(C.HOTSPOT_BIN_M)
HS_LABEL = f"{C.HOTSPOT_BIN_M:g}m"

HOT_SPOTS = f""",
hs_pts AS (SELECT {hex_qr_cols(proj_x('longitude'), proj_y('latitude'), HS_EDGE, '')} FROM silver),
hs_cnt AS (SELECT q, r, count(*) AS x FROM hs_pts GROUP BY q, r),
hs_st AS (SELECT min({offcol('q', 'r')}) AS c0, max({offcol('q', 'r')}) AS c1, min(r) AS r0, max(r) AS r1,
                 sum(x) AS total, sum(x * x) AS sumsq FROM hs_cnt),
hs_nb AS (SELECT c.q + o.dq AS q, c.r + o.dr AS r, sum(c.x) AS sum_x
          FROM hs_cnt c, {offsets_values(C.HOTSPOT_RINGS)} o GROUP BY 1, 2),
hs_w AS ({w_in_rect('hs_cnt', 'hs_st', C.HOTSPOT_RINGS)}),
hs AS (
  SELECT {hex_id(HS_LABEL, 'c.q', 'c.r')} AS bin_id, c.q, c.r, c.x AS crash_count, nb.sum_x, w.w,
    {gi_z('nb.sum_x', 'w.w', '(s.c1 - s.c0 + 1) * (s.r1 - s.r0 + 1)', 's.total', 's.sumsq')} AS z_score
  FROM hs_cnt c JOIN hs_nb nb ON nb.q = c.q AND nb.r = c.r JOIN hs_w w ON w.q = c.q AND w.r = c.r, hs_st s
)"""

EMERGING = f""",
es_pts AS (SELECT {hex_qr_cols(proj_x('longitude'), proj_y('latitude'), HS_EDGE, '')},
                  CAST(year(crash_date) * 12 + month(crash_date) - 1 AS INTEGER) AS m
           FROM silver WHERE crash_date IS NOT NULL),
es_m0 AS (SELECT min(m) AS m0 FROM es_pts),
es_cnt AS (SELECT q, r, CAST((m - m0) // {C.EMERGING_STEP_MONTHS} AS INTEGER) AS step, count(*) AS x
           FROM es_pts, es_m0 GROUP BY ALL),
es_st AS (SELECT min({offcol('q', 'r')}) AS c0, max({offcol('q', 'r')}) AS c1, min(r) AS r0, max(r) AS r1,
                 sum(x) AS total, sum(x * x) AS sumsq, max(step) + 1 AS t FROM es_cnt),
es_nb AS (SELECT c.q + o.dq AS q, c.r + o.dr AS r, c.step + o.dt AS step, sum(c.x) AS sum_x
          FROM es_cnt c, {offsets_values(C.HOTSPOT_RINGS, True)} o, es_st s
          WHERE c.step + o.dt < s.t GROUP BY 1, 2, 3),
es_bins AS (SELECT DISTINCT q, r FROM es_cnt),
es_ws AS ({w_in_rect('es_bins', 'es_st', C.HOTSPOT_RINGS)}),
es_grid AS (SELECT b.q, b.r, CAST(unnest(range(s.t)) AS INTEGER) AS step FROM es_bins b, es_st s),
es_z AS (
  SELECT g.q, g.r, g.step,
    {gi_z('coalesce(nb.sum_x, 0)', 'ws.w * CASE WHEN g.step = 0 THEN 1 ELSE 2 END',
          '(s.c1 - s.c0 + 1) * (s.r1 - s.r0 + 1) * s.t', 's.total', 's.sumsq')} AS z
  FROM es_grid g JOIN es_ws ws ON ws.q = g.q AND ws.r = g.r
  LEFT JOIN es_nb nb ON nb.q = g.q AND nb.r = g.r AND nb.step = g.step, es_st s
),
es_mk AS (SELECT a.q, a.r, sum(coalesce(sign(b.z - a.z), 0)) AS mk_s
          FROM es_z a JOIN es_z b ON a.q = b.q AND a.r = b.r AND a.step < b.step GROUP BY a.q, a.r),
es_bin AS (
  SELECT z.q, z.r, CAST(count_if(z.z >= {L(C.HOT_Z)}) AS BIGINT) AS quarters_hot,
    arg_max_null(z.z, z.step) AS latest_z, count(*) AS n_steps
  FROM es_z z GROUP BY z.q, z.r
),
es AS (
  SELECT b.*, {hex_id(HS_LABEL, 'b.q', 'b.r')} AS bin_id,
    CAST(coalesce(mk.mk_s, 0) AS DOUBLE) AS mk_s_d,
    sqrt(CAST(b.n_steps AS DOUBLE) * (CAST(b.n_steps AS DOUBLE) - {L(1.0)})
         * ({L(2.0)} * CAST(b.n_steps AS DOUBLE) + {L(5.0)}) / {L(18.0)}) AS mk_sd
  FROM es_bin b LEFT JOIN es_mk mk ON mk.q = b.q AND mk.r = b.r
),
es2 AS (
  SELECT *,
    CASE WHEN mk_s_d > 0 THEN (mk_s_d - {L(1.0)}) / NULLIF(mk_sd, {L(0.0)})
         WHEN mk_s_d < 0 THEN (mk_s_d + {L(1.0)}) / NULLIF(mk_sd, {L(0.0)}) ELSE {L(0.0)} END AS mk_z,
    coalesce(latest_z >= {L(C.HOT_Z)}, false) AS latest_hot,
    CAST(quarters_hot AS DOUBLE) >= {L(C.PERSIST_FRACTION)} * CAST(n_steps AS DOUBLE) AS mostly
  FROM es
),
emerging AS (
  SELECT *, CASE WHEN quarters_hot = 0 THEN 'none'
    WHEN NOT latest_hot AND mostly THEN 'historical'
    WHEN NOT latest_hot THEN 'sporadic'
    WHEN quarters_hot = 1 THEN 'new'
    WHEN mostly AND mk_z >= {L(C.MK_Z)} THEN 'intensifying'
    WHEN mostly AND mk_z <= {L(-C.MK_Z)} THEN 'diminishing'
    WHEN mostly THEN 'persistent'
    ELSE 'sporadic' END AS trend
  FROM es2
)"""


def kde_ctes(radius_m: float = C.KDE_RADIUS_M, cell_m: float = C.KDE_CELL_M) -> str:
    # Every cell of a square wider than the radius; the distance test below decides.
    k = int(radius_m / cell_m) + 2
    c = L(cell_m)
    r2 = L(radius_m * radius_m)
    ex = f"(x - (CAST(i AS DOUBLE) + {L(0.5)}) * {c})"
    ey = f"(y - (CAST(j AS DOUBLE) + {L(0.5)}) * {c})"
    v = f"({L(1.0)} - d2 / {r2})"
    norm = 3.0 / (math.pi * radius_m * radius_m) * 1e6
    return f""",
kd_pos AS (SELECT x, y, sum({L(1.0)}) AS w FROM
  (SELECT {proj_x('longitude')} AS x, {proj_y('latitude')} AS y FROM silver) GROUP BY x, y),
kd_fan AS (SELECT x, y, w, CAST(floor(x / {c}) AS BIGINT) + o.di AS i, CAST(floor(y / {c}) AS BIGINT) + o.dj AS j
  FROM kd_pos, (SELECT a.range AS di, b.range AS dj FROM range({-k}, {k + 1}) a, range({-k}, {k + 1}) b) o),
kd_d AS (SELECT i, j, w, {ex} * {ex} + {ey} * {ey} AS d2 FROM kd_fan),
kd AS (SELECT i, j, sum(w * {v} * {v}) AS s FROM kd_d WHERE d2 < {r2} GROUP BY i, j),
density AS (SELECT i AS cell_i, j AS cell_j,
  {unproj_lon(f'(CAST(i AS DOUBLE) + {L(0.5)}) * {c}')} AS center_lon,
  {unproj_lat(f'(CAST(j AS DOUBLE) + {L(0.5)}) * {c}')} AS center_lat,
  s * {L(norm)} AS density FROM kd)"""


# ---------------------------------------------------------------- roads

def road_lon(k: str, i: str) -> str:
    step = f"(CASE WHEN {k} % 17 = 0 THEN 40000 ELSE 400 + ({k} % 5) * 150 END)"
    return f"((-118400000 + (({k} * 7) % 12) * 15000 + ((({k} * 53) % 201) - 100) * 40 + {i} * {step}) / 1e6)"


def road_lat(k: str, i: str) -> str:
    return f"((34000000 + ({k} % 12) * 10000 + ((({k} * 37) % 201) - 100) * 40 + ((({i} * {i}) * ({k} % 7)) % 11) * 60) / 1e6)"


def seg_dist(px, py, ax, ay, bx, by) -> str:
    dx = f"(({bx}) - ({ax}))"
    dy = f"(({by}) - ({ay}))"
    l2 = f"({dx} * {dx} + {dy} * {dy})"
    t_raw = f"(((({px}) - ({ax})) * {dx} + (({py}) - ({ay})) * {dy}) / (CASE WHEN {l2} = {L(0.0)} THEN {L(1.0)} ELSE {l2} END))"
    t = f"(CASE WHEN {l2} = {L(0.0)} THEN {L(0.0)} ELSE greatest({L(0.0)}, least({L(1.0)}, {t_raw})) END)"
    ex = f"(({px}) - (({ax}) + {t} * {dx}))"
    ey = f"(({py}) - (({ay}) + {t} * {dy}))"
    return f"sqrt({ex} * {ex} + {ey} * {ey})"


def planar(ax, ay, bx, by) -> str:
    dx = f"(({ax}) - ({bx}))"
    dy = f"(({ay}) - ({by}))"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


PALETTE = "(SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {r}, {g}, {b})" for i, (r, g, b) in enumerate(C.ROAD_PALETTE)) + ") AS t(ci, pr, pg, pb))"

ROADS = f"""
rw_i AS (SELECT p_partkey AS k, CAST(unnest(range(0, p_partkey % 10 + 1)) AS BIGINT) AS i FROM part),
rw_geo AS (
  SELECT k, i, 0 AS copy FROM rw_i UNION ALL SELECT k, i, 1 AS copy FROM rw_i WHERE i % 3 = 0
),
rw_ways AS (
  SELECT p_partkey AS k, CASE WHEN p_partkey % 23 = 0 THEN 'node' ELSE 'way' END AS type,
    CASE p_partkey % 4 WHEN 0 THEN 'motorway' WHEN 1 THEN 'trunk' WHEN 2 THEN 'primary' ELSE NULL END AS highway_tag
  FROM part
),
rw_clean AS (
  SELECT w.k, w.highway_tag, count(*) AS n_geometry FROM rw_ways w JOIN rw_geo g ON g.k = w.k
  WHERE w.type = 'way' GROUP BY w.k, w.highway_tag HAVING count(*) >= 2
),
rw_round AS (
  SELECT g.k, g.i, g.copy,
    {rnd(road_lon('g.k', 'g.i'), C.ROAD_ROUND_DECIMALS)} AS lon,
    {rnd(road_lat('g.k', 'g.i'), C.ROAD_ROUND_DECIMALS)} AS lat
  FROM rw_geo g JOIN rw_clean c ON c.k = g.k
),
rw_lag AS (
  SELECT *, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat, row_number() OVER w AS gpos
  FROM rw_round WINDOW w AS (PARTITION BY k ORDER BY i, copy)
),
rw_kept AS (SELECT k, gpos, lon, lat FROM rw_lag WHERE gpos = 1 OR NOT (lon = plon AND lat = plat)),
rw_dd0 AS (SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY gpos) - 1 AS INTEGER) AS idx, lon, lat FROM rw_kept),
rw_dd AS (SELECT * FROM rw_dd0 WHERE k IN (SELECT k FROM rw_dd0 GROUP BY k HAVING count(*) >= 2)),
rw_n AS (SELECT k, count(*) AS n FROM rw_dd GROUP BY k),
rw_iv(k, lo, hi) AS (
  SELECT k, 0, CAST(n - 1 AS INTEGER) FROM rw_n
  UNION ALL
  SELECT s.k, CASE WHEN side = 0 THEN s.lo ELSE s.sp END, CASE WHEN side = 0 THEN s.sp ELSE s.hi END
  FROM (
    SELECT iv.k, iv.lo, iv.hi, p.idx AS sp, {seg_dist('p.lon', 'p.lat', 'a.lon', 'a.lat', 'b.lon', 'b.lat')} AS d,
      row_number() OVER (PARTITION BY iv.k, iv.lo, iv.hi
                         ORDER BY {seg_dist('p.lon', 'p.lat', 'a.lon', 'a.lat', 'b.lon', 'b.lat')} DESC, p.idx) AS rk
    FROM rw_iv iv JOIN rw_dd p ON p.k = iv.k AND p.idx > iv.lo AND p.idx < iv.hi
    JOIN rw_dd a ON a.k = iv.k AND a.idx = iv.lo JOIN rw_dd b ON b.k = iv.k AND b.idx = iv.hi
  ) s, (VALUES (0), (1)) t(side)
  WHERE s.rk = 1 AND s.d > {L(C.SIMPLIFY_EPS_DEG)}
),
rw_simple_idx AS (SELECT DISTINCT k, lo AS idx FROM rw_iv UNION SELECT DISTINCT k, hi AS idx FROM rw_iv),
rw_simple AS (
  SELECT s.k, s.idx, d.lon, d.lat,
    CAST(row_number() OVER (PARTITION BY s.k ORDER BY s.idx) - 1 AS INTEGER) AS spos
  FROM rw_simple_idx s JOIN rw_dd d ON d.k = s.k AND d.idx = s.idx
),
rw_len AS (
  SELECT a.k, sum({planar('a.lon', 'a.lat', 'b.lon', 'b.lat')}) AS length
  FROM rw_simple a JOIN rw_simple b ON b.k = a.k AND b.spos = a.spos + 1 GROUP BY a.k
),
rw_paths AS (
  SELECT s.k, count(*) AS n_points, coalesce(any_value(l.length), {L(0.0)}) AS length
  FROM rw_simple s LEFT JOIN rw_len l ON l.k = s.k GROUP BY s.k
),
rw_traj AS (
  SELECT p.k, p.n_points, p.length, coalesce(nullif(c.highway_tag, ''), '{C.DEFAULT_HIGHWAY}') AS highway,
    row_number() OVER (ORDER BY p.k) - 1 AS traj_index
  FROM rw_paths p JOIN rw_clean c ON c.k = p.k
  WHERE p.n_points >= 2 AND p.length >= {L(C.MIN_PATH_LENGTH_DEG)}
),
rw_traj_c AS (
  SELECT t.*, CAST(CASE WHEN highway = 'motorway' THEN {C.HIGHWAY_COLOR_INDEX['motorway']}
                        WHEN highway = 'trunk' THEN {C.HIGHWAY_COLOR_INDEX['trunk']}
                        ELSE traj_index % {len(C.ROAD_PALETTE)} END AS INTEGER) AS color_index
  FROM rw_traj t
),
rw_sub0 AS (
  SELECT t.k, t.n_points AS l, t.color_index, least({C.SUB_PATH_MAX_COUNT}, t.n_points // {C.SUB_PATH_DIVISOR}) AS nsub
  FROM rw_traj_c t WHERE t.n_points >= {C.SUB_PATH_MIN_POINTS}
),
rw_sub1 AS (SELECT k, l, color_index, nsub, CAST(unnest(range(0, nsub)) AS INTEGER) AS sub FROM rw_sub0),
rw_sub2 AS (SELECT *, CAST((sub * l) // (nsub + 1) AS INTEGER) AS start FROM rw_sub1),
rw_sub AS (
  SELECT k, sub, start, CAST(least(l, start + l // 2) AS INTEGER) AS "end",
    CAST((color_index + sub + {C.SUB_PATH_COLOR_SHIFT}) % {len(C.ROAD_PALETTE)} AS INTEGER) AS color_index
  FROM rw_sub2 WHERE least(l, start + l // 2) - start >= {C.SUB_PATH_MIN_KEEP}
)"""

POLYLINES = f"""
rp_pts AS (
  SELECT road_index, seq, {road_lon('road_index', 'seq')} AS lon, {road_lat('road_index', 'seq')} AS lat
  FROM (SELECT p_partkey AS road_index, CAST(unnest(range(0, p_partkey % 10 + 1)) AS BIGINT) AS seq FROM part)
),
rp_seg AS (
  SELECT a.road_index, CAST(a.seq AS INTEGER) AS seg, a.lon AS a_lon, a.lat AS a_lat, b.lon AS b_lon, b.lat AS b_lat
  FROM rp_pts a JOIN rp_pts b ON b.road_index = a.road_index AND b.seq = a.seq + 1
)"""

MATCH = f""",
rm_pairs AS (
  SELECT DISTINCT s.road_index, c.dr_no, c.severity
  FROM rp_seg s JOIN silver c
    ON c.longitude BETWEEN least(s.a_lon, s.b_lon) - {L(C.MATCH_THRESHOLD_DEG)} AND greatest(s.a_lon, s.b_lon) + {L(C.MATCH_THRESHOLD_DEG)}
   AND c.latitude BETWEEN least(s.a_lat, s.b_lat) - {L(C.MATCH_THRESHOLD_DEG)} AND greatest(s.a_lat, s.b_lat) + {L(C.MATCH_THRESHOLD_DEG)}
  WHERE {seg_dist('c.longitude', 'c.latitude', 's.a_lon', 's.a_lat', 's.b_lon', 's.b_lat')} < {L(C.MATCH_THRESHOLD_DEG)}
),
rm_counts AS (
  SELECT road_index, count(*) AS crash_count, {sev_counts()} FROM rm_pairs GROUP BY road_index
),
rm_max AS (SELECT greatest(coalesce(max(crash_count), 1), 1) AS mx FROM rm_counts),
corr AS (
  SELECT p.road_index, p.n_points,
    coalesce(c.crash_count, 0) AS crash_count, coalesce(c.fatal, 0) AS fatal,
    coalesce(c.pedestrian, 0) AS pedestrian, coalesce(c.bicycle, 0) AS bicycle, coalesce(c.severe, 0) AS severe,
    coalesce(CASE WHEN p.road_index % 3 = 0 THEN NULL ELSE 'ROAD ' || CAST(p.road_index AS VARCHAR) END, '') AS road_name
  FROM (SELECT road_index, count(*) AS n_points FROM rp_pts GROUP BY road_index) p
  LEFT JOIN rm_counts c ON c.road_index = p.road_index
)"""


def rgb_cols(count: str, scale: str, prefix: str) -> str:
    t = f"least({L(1.0)}, CAST({count} AS DOUBLE) / ({scale}))"
    s_lo = f"({t} * {L(2.0)})"
    s_hi = f"(({t} - {L(0.5)}) * {L(2.0)})"
    zr, zg, zb = C.ZERO_COUNT_COLOR
    r = f"CASE WHEN {count} = 0 THEN {zr} WHEN {t} < {L(0.5)} THEN CAST(trunc({L(255.0)} * {s_lo}) AS INTEGER) ELSE 255 END"
    g = (f"CASE WHEN {count} = 0 THEN {zg} WHEN {t} < {L(0.5)} "
         f"THEN CAST(trunc({L(200.0)} + {L(55.0)} * ({L(1.0)} - {s_lo})) AS INTEGER) "
         f"ELSE CAST(trunc({L(200.0)} * ({L(1.0)} - {s_hi})) AS INTEGER) END")
    b = f"CASE WHEN {count} = 0 THEN {zb} ELSE 0 END"
    return f"CAST({r} AS INTEGER) AS {prefix}_r, CAST({g} AS INTEGER) AS {prefix}_g, CAST({b} AS INTEGER) AS {prefix}_b"


def relative_scale(mx: str) -> str:
    return f"greatest(CAST({mx} AS DOUBLE) * {L(C.RELATIVE_COLOR_FACTOR)}, {L(1.0)})"


# ---------------------------------------------------------------- refresh and chains

#: Silver after a page of corrections, rebuilt from both pages: the newest version of each record decides.
_CORRECTIONS = f""",
again AS (SELECT *, (e // 29) % 5 AS k FROM incidents_once WHERE e % 29 = 0 AND substring(date_occ, 1, 4) >= '2023'),
incident_pages AS (
  SELECT *, 0 AS page FROM incidents_raw
  UNION ALL BY NAME
  SELECT * EXCLUDE (e, k) REPLACE (
      CASE WHEN k = 1 THEN '3036 0449' ELSE mocodes END AS mocodes, CASE WHEN k = 1 THEN '0101' ELSE time_occ END AS time_occ,
      CASE WHEN k = 2 THEN '2024-06-15T00:00:00.000' ELSE date_occ END AS date_occ,
      CASE WHEN k = 3 THEN '' WHEN k = 4 THEN '34.050000' ELSE lat END AS lat, CASE WHEN k = 4 THEN '-118.250000' ELSE lon END AS lon),
    1 AS page FROM again
  UNION ALL BY NAME
  SELECT * EXCLUDE (e) REPLACE ('N' || CAST(e AS VARCHAR) AS dr_no), 1 AS page
  FROM incidents_once WHERE e % 31 = 0 AND substring(date_occ, 1, 4) = '2024'
),
incident_versions AS (
  SELECT * EXCLUDE (page) FROM incident_pages
  QUALIFY row_number() OVER (PARTITION BY dr_no ORDER BY page DESC, {', '.join(f"coalesce({f}, '')" for f in FIELDS if f != 'dr_no')}) = 1
)"""

SILVER_CORRECTED = (INCIDENTS_RAW + _CORRECTIONS
                    + SILVER[len(INCIDENTS_RAW):].replace("FROM incidents_raw\n)", "FROM incident_versions\n)", 1))

CHAINS = """
part_k AS (SELECT CAST(p_partkey AS BIGINT) AS k, p_partkey // 48 AS street, p_partkey % 48 = 47 AS last FROM part),
main_ways AS (SELECT k AS way_id, k AS n0, CASE WHEN last AND street % 3 = 0 THEN street * 48 WHEN last THEN -k - 1 ELSE k + 1 END AS n1,
                k % 5 = 0 AS turned FROM part_k WHERE k % 97 <> 96),
way_ends AS (
  SELECT way_id, CASE WHEN turned THEN n1 ELSE n0 END AS a, CASE WHEN turned THEN n0 ELSE n1 END AS b FROM main_ways
  UNION ALL SELECT k + 1000000000, k, CASE WHEN k % 200 = 0 THEN k ELSE -k * 1000 - 7 END FROM part_k WHERE k % 100 = 0),
ends AS (SELECT way_id * 2 AS e, a AS node FROM way_ends UNION ALL SELECT way_id * 2 + 1, b FROM way_ends),
meet AS (SELECT min(e) AS p, max(e) AS q FROM ends GROUP BY node HAVING count(*) = 2),
follow AS (SELECT xor(p, 1) AS state, q AS nxt FROM meet UNION ALL SELECT xor(q, 1), p FROM meet),
heads AS (SELECT e AS state FROM ends WHERE e NOT IN (SELECT nxt FROM follow)),
walk AS (SELECT state AS head, state, 0 AS position FROM heads
         UNION ALL SELECT w.head, f.nxt, w.position + 1 FROM walk w JOIN follow f ON f.state = w.state),
ring_states AS (SELECT e AS state FROM ends WHERE e NOT IN (SELECT state FROM walk)),
ring_walk AS (SELECT state AS head, state, 0 AS position FROM ring_states
              UNION ALL SELECT w.head, f.nxt, w.position + 1 FROM ring_walk w JOIN follow f ON f.state = w.state AND f.nxt <> w.head),
paths AS (SELECT head, count(*) AS n, arg_max(state, position) AS tail FROM walk GROUP BY head),
rings AS (SELECT head, count(*) AS n, min(state) AS low FROM ring_walk GROUP BY head)"""
