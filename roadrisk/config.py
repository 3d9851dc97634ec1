"""Parameters and fixed values shared by every operator.

Numbers here either must equal the source pipeline's (marked FIXED) or are
our own defaults for semantics the source leaves unstated (marked OURS).
Every operator takes them as keyword arguments, so another city (its box and
its projection origin) or another tolerance is a call-site change.
"""

from __future__ import annotations

import math

# --------------------------------------------------------------------------
# FIXED values: these must equal the source pipeline's for identical results.
# --------------------------------------------------------------------------

# Study bounding box (inclusive), degrees.
LAT_MIN, LAT_MAX = 33.5, 35.0
LON_MIN, LON_MAX = -119.0, -117.5

# Incident ingest: 14 string fields and the lower date bound (exclusive).
INCIDENT_FIELDS = [
    "dr_no", "date_occ", "time_occ", "area_name", "crm_cd_desc", "vict_age",
    "vict_sex", "vict_descent", "premis_desc", "location", "cross_street",
    "lat", "lon", "mocodes",
]
INGEST_SINCE = "2022-01-01 00:00:00"

# Severity rules, in priority order: (label, mo codes, description substrings).
SEVERITY_RULES = [
    ("fatal", ["0449"], ["KILLED"]),
    ("pedestrian", ["1920"], ["PEDESTRIAN"]),
    ("bicycle", ["1822"], ["BICYCLE", "BIKE"]),
    ("severe", ["0448"], ["FELONY"]),
]
SEVERITY_OTHER = "other"
SEVERITY_LABELS = ["fatal", "pedestrian", "bicycle", "severe", "other"]
# Heatmap severity weights.
SEVERITY_WEIGHTS = {"fatal": 5, "pedestrian": 4, "bicycle": 4, "severe": 3, "other": 1}

# Heatmap hexagon edge lengths (metres) and their resolution labels.
HEATMAP_RESOLUTIONS = [("9", 174.0), ("8", 460.0)]

# School proximity radius (metres).
SCHOOL_RADIUS_M = 300.0

# Hot spots: bin size (flat-to-flat, metres) and neighbourhood (rings).
HOTSPOT_BIN_M = 200.0
HOTSPOT_RINGS = 3
EMERGING_STEP_MONTHS = 3

# Kernel density: search radius and output cell (metres).
KDE_RADIUS_M = 500.0
KDE_CELL_M = 50.0

# Road corridors: match threshold in degrees; colour scales.
MATCH_THRESHOLD_DEG = 0.0005
ABSOLUTE_COLOR_SCALE = 15.0
RELATIVE_COLOR_FACTOR = 0.3
ZERO_COUNT_COLOR = (0, 100, 60)

# Road preprocessing.
ROAD_ROUND_DECIMALS = 5
SIMPLIFY_EPS_DEG = 0.00002
MIN_PATH_LENGTH_DEG = 0.0007
DEFAULT_HIGHWAY = "primary"
# Colour palette for road trajectories, index 0..11.
ROAD_PALETTE = [
    (0, 238, 255), (255, 50, 120), (255, 200, 0), (0, 255, 170),
    (140, 80, 255), (255, 120, 0), (0, 191, 255), (255, 70, 70),
    (80, 255, 80), (255, 160, 240), (0, 200, 200), (255, 255, 100),
]
HIGHWAY_COLOR_INDEX = {"motorway": 0, "trunk": 5}
SUB_PATH_MIN_POINTS = 8
SUB_PATH_MAX_COUNT = 3
SUB_PATH_DIVISOR = 5
SUB_PATH_MIN_KEEP = 3
SUB_PATH_COLOR_SHIFT = 2

# Top intersections.
TOP_INTERSECTIONS = 20

# --------------------------------------------------------------------------
# OURS: projection used for every metric computation (hexes, density).
# --------------------------------------------------------------------------
EARTH_RADIUS_M = 6371000.0
ORIGIN_LAT = 34.25
ORIGIN_LON = -118.25
# Metres per degree along x (at ORIGIN_LAT) and y. Computed once in Python and
# embedded as literals, so Spark and the DuckDB oracle multiply by the same
# double rather than each evaluating cos/radians.
DEG = math.pi / 180.0
M_PER_DEG_X = EARTH_RADIUS_M * math.cos(ORIGIN_LAT * DEG) * DEG
M_PER_DEG_Y = EARTH_RADIUS_M * DEG

# Significance cut-offs for Gi* classes (two-sided 90/95/99 %).
Z_90, Z_95, Z_99 = 1.645, 1.96, 2.576
# Abramowitz & Stegun 7.1.26 coefficients for erfc.
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

# Emerging trend thresholds.
HOT_Z = 1.96
PERSIST_FRACTION = 0.9
MK_Z = 1.96

