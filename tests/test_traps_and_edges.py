"""One test per known trap of the source pipeline (B1-B9, B12) and edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.operators import clean, corridors, density, hotspots, proximity, rollups
from roadrisk.plans import pipeline
from roadrisk.sources import ingest

from conftest import SF_SMALL

BRONZE_COLS = C.INCIDENT_FIELDS


def bronze_rows(spark, rows):
    """rows: list of dicts with some of the 14 fields; others ''."""
    full = [tuple(r.get(f, "") for f in BRONZE_COLS) for r in rows]
    df = spark.createDataFrame(full, ", ".join(f"{f} string" for f in BRONZE_COLS))
    return ingest.normalise_incidents(df, since=None)


def base(i, **kw):
    r = {"dr_no": f"DR{i}", "date_occ": "2023-03-04T00:00:00.000", "time_occ": "0930",
         "lat": "34.05", "lon": "-118.25", "location": "MAIN ST", "crm_cd_desc": "TRAFFIC COLLISION"}
    r.update(kw)
    return r


def pts(spark, coords, sev="other"):
    return spark.createDataFrame([(f"DR{i}", sev, lon, lat) for i, (lon, lat) in enumerate(coords)],
                                 "dr_no string, severity string, longitude double, latitude double")


def road(spark, paths):
    return spark.createDataFrame([(i, p, None) for i, p in enumerate(paths)],
                                 "road_index bigint, path array<array<double>>, name string")


def test_b1_each_road_incident_pair_counted_once(spark):
    # The incident sits on the shared vertex of two segments of one road.
    r = road(spark, [[[-118.25, 34.05], [-118.24, 34.05], [-118.24, 34.06]]])
    c = corridors.danger_corridors(r, pts(spark, [(-118.24, 34.0501)]))
    assert c.first().crash_count == 1


def test_b2_incident_beside_middle_of_long_segment(spark):
    r = road(spark, [[[-118.30, 34.05], [-118.26, 34.05]]])  # 0.04 degrees, no vertex near the middle
    m = corridors.match_incidents(r, pts(spark, [(-118.28, 34.0503), (-118.28, 34.0506)]))
    assert [x.dr_no for x in m.collect()] == ["DR0"]


def test_b3_no_column_named_count(spark):
    hs = hotspots.hot_spots(pipeline.silver(spark, SF_SMALL))
    assert "count" not in hs.columns and "crash_count" in hs.columns


def test_b4_school_flag_is_not_all_ones(spark):
    s = pipeline.silver(spark, SF_SMALL)
    flags = dict(s.groupBy("near_school").count().rdd.map(tuple).collect())
    semi = proximity.near_school_join(clean.clean_incidents(pipeline.bronze(spark, SF_SMALL)),
                                      pipeline.schools(spark, SF_SMALL)).count()
    assert flags.get(1, 0) == semi and flags.get(0, 0) > 0


def test_b5_empty_strings_parse_to_null(spark):
    df = clean.parse_incidents(bronze_rows(spark, [base(1, lat="", lon="", date_occ="", time_occ="")]))
    r = df.first()
    assert r.latitude is None and r.longitude is None and r.crash_date is None and r.crash_hour is None
    assert clean.clean_incidents(bronze_rows(spark, [base(1, lat="")])).count() == 0


def test_b6_dedupe_keeps_the_smallest_row(spark):
    rows = [base(1, location="B ST"), base(1, location="A ST"), base(2)]
    out = {r.dr_no: r.location for r in clean.clean_incidents(bronze_rows(spark, rows)).collect()}
    assert out == {"DR1": "A ST", "DR2": "MAIN ST"}


def test_b6_dedupe_of_a_hot_key_is_map_side_combined(spark):
    rows = [base(1)] * 3000 + [base(i) for i in range(2, 50)]
    df = clean.clean_incidents(bronze_rows(spark, rows))
    assert df.count() == 49
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The first row of a key is picked before the shuffle, so 3000 copies move as one row per task.
    assert "SortAggregate" not in plan and plan.index("Partial") > plan.index("Exchange hashpartitioning(dr_no")


def test_b7_top_intersections_tie_break_by_name(spark):
    rows = [base(i, location=loc) for i, loc in enumerate(["B ST", "A ST", "C ST", "C ST"])]
    s = clean.enrich(clean.clean_incidents(bronze_rows(spark, rows)))
    top = [r.intersection for r in rollups.top_intersections(s, 3).collect()]
    assert top == ["C ST", "A ST", "B ST"]


def test_b8_empty_location_is_not_an_intersection(spark):
    rows = [base(1, location=""), base(2, location="", cross_street="")]
    s = clean.enrich(clean.clean_incidents(bronze_rows(spark, rows)))
    assert [r.intersection for r in s.collect()] == [None, None]
    assert rollups.top_intersections(s).count() == 0


def test_b9_hour_rule_and_padding(spark):
    b = bronze_rows(spark, [base(1, time_occ="930")])
    assert clean.parse_incidents(b).first().crash_hour == 93
    assert clean.parse_incidents(b, pad_time=True).first().crash_hour == 9


def test_b12_grid_uses_floor(spark):
    df = spark.createDataFrame([(-118.2437,)], "x double")
    assert df.select(F.floor(F.col("x") / F.lit(0.005))).first()[0] == -23649


def test_edge_empty_inputs(spark):
    empty = pts(spark, [(-118.25, 34.05)]).limit(0).withColumn("crash_date", F.current_date())
    assert hotspots.hot_spots(empty).count() == 0
    assert hotspots.emerging_hot_spots(empty).count() == 0
    assert density.kernel_density(empty).count() == 0


def test_edge_all_outside_box(spark):
    rows = [base(1, lat="40.5"), base(2, lat="0"), base(3, lon="-120.1")]
    assert clean.clean_incidents(bronze_rows(spark, rows)).count() == 0


def test_edge_single_bin_gives_null_z(spark):
    hs = hotspots.hot_spots(pts(spark, [(-118.25, 34.05)] * 5)).first()
    assert hs.crash_count == 5 and hs.z_score is None and hs.classification == "not_significant"


def test_edge_one_point_road_has_zero_counts(spark):
    r = road(spark, [[[-118.25, 34.05]], [[-118.25, 34.05], [-118.24, 34.05]]])
    out = {x.road_index: (x.crash_count, list(x.color), x.road_name)
           for x in corridors.danger_corridors(r, pts(spark, [(-118.245, 34.05)])).collect()}
    assert out[0] == (0, [0, 100, 60], "")
    assert out[1][0] == 1


def test_edge_absent_school_table(spark):
    s = clean.clean_incidents(pipeline.bronze(spark, SF_SMALL))
    out = proximity.add_near_school(s, None)
    assert out.filter(F.col("near_school") != 0).count() == 0


def test_edge_null_description_and_codes(spark):
    rows = [base(1, crm_cd_desc="", mocodes=""), base(2, crm_cd_desc="", mocodes=" 1822  3004"),
            base(3, crm_cd_desc="bike lane", mocodes="0448"), base(4, crm_cd_desc="", mocodes="3036 0449")]
    s = clean.add_severity(clean.clean_incidents(bronze_rows(spark, rows)))
    got = {r.dr_no: r.severity for r in s.collect()}
    assert got == {"DR1": "other", "DR2": "bicycle", "DR3": "bicycle", "DR4": "fatal"}


@pytest.mark.parametrize("lat,lon", [(0.0, 0.0), (34.05, -118.25), (41.15, -8.61), (60.0, 10.0), (-75.0, 179.9995),
                                     (60.0, -179.9995), (89.97, 30.0)])
def test_near_school_equals_brute_force_at_any_latitude(spark, lat, lon):
    import random
    rng = random.Random(int(lat * 10) + 1)
    spread = 0.02 / max(math.cos(math.radians(lat)), 0.01)
    wrap = lambda x: (x + 180.0) % 360.0 - 180.0
    at = lambda: (min(90.0, lat + rng.uniform(-0.02, 0.02)), wrap(lon + rng.uniform(-spread, spread)))
    schools, points = [at() for _ in range(40)], [at() for _ in range(400)]

    def metres(a, b):
        (p, l), (q, m) = a, b
        p, l, q, m = map(math.radians, (p, l, q, m))
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((m - l) / 2) ** 2
        return 2 * C.EARTH_RADIUS_M * math.asin(math.sqrt(h))

    want = {f"DR{i}" for i, p in enumerate(points) if any(metres(p, s) <= 300.0 for s in schools)}
    inc = spark.createDataFrame([(f"DR{i}", p, l) for i, (p, l) in enumerate(points)], "dr_no string, latitude double, longitude double")
    sch = spark.createDataFrame(schools, "school_lat double, school_lon double")
    assert {r.dr_no for r in proximity.near_school_join(inc, sch).collect()} == want and want
    assert {r.dr_no for r in proximity.add_near_school(inc, sch).collect() if r.near_school} == want


@pytest.mark.parametrize("n", [1, 2, 3, 12, 33, 48])
def test_mann_kendall_s_matches_pairs(spark, n):
    from roadrisk.functions.stats import mann_kendall_s
    zs = [((i * 7) % 5) - 2.0 for i in range(n)]
    expect = sum((zs[j] > zs[i]) - (zs[j] < zs[i]) for i in range(n) for j in range(i + 1, n))
    df = spark.createDataFrame([(zs,)], "zs array<double>")
    assert df.select(mann_kendall_s(F.col("zs"))).first()[0] == expect


def _brute_pairs(paths, points, threshold):
    """(road, dr_no) pairs by checking every segment of every road in Python."""
    def dist(px, py, ax, ay, bx, by):
        dx, dy = bx - ax, by - ay
        l2 = dx * dx + dy * dy
        t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / l2))
        return math.hypot(px - (ax + t * dx), py - (ay + t * dy))
    out = set()
    for ri, p in enumerate(paths):
        for dr, (px, py) in points:
            if any(dist(px, py, *p[k], *p[k + 1]) < threshold for k in range(len(p) - 1)):
                out.add((ri, dr))
    return out


def test_road_match_with_a_hot_cell_equals_brute_force(spark):
    # A third of all incidents sit in one 0.001-degree cell next to a road
    # junction; the rest spread over the area. The cell join must still find
    # exactly the brute-force pairs, each once.
    import random
    rng = random.Random(7)
    paths = [[[-118.2500, 34.0500], [-118.2480, 34.0502], [-118.2460, 34.0500]],
             [[-118.2490, 34.0480], [-118.2490, 34.0520]],
             [[-118.2600, 34.0400], [-118.2300, 34.0600]],
             [[-118.2475, 34.0505]]]
    spread = [(-118.26 + rng.random() * 0.03, 34.04 + rng.random() * 0.02) for _ in range(400)]
    hot = [(-118.2489 + rng.random() * 0.0008, 34.0501 + rng.random() * 0.0008) for _ in range(200)]
    points = [(f"DR{i}", xy) for i, xy in enumerate(spread + hot)]
    inc = spark.createDataFrame([(d, "other", x, y) for d, (x, y) in points],
                                "dr_no string, severity string, longitude double, latitude double")
    got = corridors.match_incidents(road(spark, paths), inc)
    rows = [(r.road_index, r.dr_no) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == _brute_pairs(paths, points, C.MATCH_THRESHOLD_DEG)


def test_road_match_is_a_merge_join_on_the_cell(spark):
    from roadrisk.plans.registry import QUERIES
    p = QUERIES["road_match"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p


def test_school_join_same_flags_broadcast_or_merge(spark, monkeypatch):
    from roadrisk.plans.registry import QUERIES

    def run():
        df = QUERIES["near_school_flag"](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        return sorted((r.dr_no, r.near_school) for r in df.collect()), plan

    small, p_small = run()
    monkeypatch.setattr(proximity, "BROADCAST_MAX_CELLS", 0)
    big, p_big = run()
    assert "BroadcastHashJoin" in p_small and "SortMergeJoin" in p_big
    assert small == big and any(f for _, f in small)


def test_density_cells_of_one_point_equal_brute_force(spark):
    # Every cell whose centre lies strictly within the radius, found by
    # scanning a block wider than the radius in Python with the same formulas.
    lon, lat = -118.2437, 34.0522
    r, c = C.KDE_RADIUS_M, C.KDE_CELL_M
    x = (lon - C.ORIGIN_LON) * C.M_PER_DEG_X
    y = (lat - C.ORIGIN_LAT) * C.M_PER_DEG_Y
    i0, j0 = math.floor(x / c), math.floor(y / c)
    expect = {(i0 + di, j0 + dj) for di in range(-15, 16) for dj in range(-15, 16)
              if (x - (i0 + di + 0.5) * c) ** 2 + (y - (j0 + dj + 0.5) * c) ** 2 < r * r}
    got = {(row.cell_i, row.cell_j) for row in density.kernel_density(pts(spark, [(lon, lat)])).collect()}
    assert got == expect and len(got) > 300


@pytest.mark.parametrize("t", [1, 2, 5, 12, 33, 48])
def test_mann_kendall_unrolled_equals_loop(spark, t):
    from roadrisk.functions.stats import mann_kendall_s, mann_kendall_s_fixed
    import random
    rng = random.Random(t)
    rows = [([rng.choice([-1.0, 0.0, 0.5, 2.0, None]) for _ in range(t)],) for _ in range(40)]
    df = spark.createDataFrame(rows, "zs array<double>")
    got = df.select(mann_kendall_s_fixed(F.col("zs"), t).alias("a"), mann_kendall_s(F.col("zs")).alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_road_match_skew_split_keeps_exact_pairs(spark):
    # Force adaptive execution to treat the hot cell as skewed and split it;
    # the distinct on (road, incident) must still give the brute-force pairs.
    import random
    rng = random.Random(11)
    paths = [[[-118.2500, 34.0500], [-118.2480, 34.0502]], [[-118.2490, 34.0480], [-118.2490, 34.0520]]]
    spread = [(-118.26 + rng.random() * 0.03, 34.04 + rng.random() * 0.02) for _ in range(300)]
    hot = [(-118.2489 + rng.random() * 0.0008, 34.0501 + rng.random() * 0.0008) for _ in range(3000)]
    points = [(f"DR{i}", xy) for i, xy in enumerate(spread + hot)]
    inc = spark.createDataFrame([(d, "other", x, y) for d, (x, y) in points],
                                "dr_no string, severity string, longitude double, latitude double").repartition(8)
    conf = {"spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        m = corridors.match_incidents(road(spark, paths), inc)
        rows = [(r.road_index, r.dr_no) for r in m.collect()]
        plan = m._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "skew=true" in plan
    assert len(rows) == len(set(rows))
    assert set(rows) == _brute_pairs(paths, points, C.MATCH_THRESHOLD_DEG)


def test_school_flag_merge_path_skew_split_same_flags(spark, monkeypatch):
    # Beyond the broadcast bound the flag is semi + anti sort-merge joins;
    # with a hot cell forced to count as skewed, the split must keep every
    # incident exactly once with the same flag as the broadcast plan.
    import random
    rng = random.Random(5)
    schools = spark.createDataFrame([(34.0500, -118.2500), (34.0600, -118.2300), (34.0450, -118.2700)],
                                    "school_lat double, school_lon double")
    spread = [(-118.28 + rng.random() * 0.06, 34.03 + rng.random() * 0.04) for _ in range(300)]
    hot = [(-118.2503 + rng.random() * 0.002, 34.0497 + rng.random() * 0.002) for _ in range(3000)]
    inc = pts(spark, spread + hot).repartition(8)
    want = sorted((r.dr_no, r.near_school) for r in proximity.add_near_school(inc, schools).collect())
    monkeypatch.setattr(proximity, "BROADCAST_MAX_CELLS", 0)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = proximity.add_near_school(inc, schools)
        got = sorted((r.dr_no, r.near_school) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert got == want and len(got) == 3300 and sum(f for _, f in got) > 2000


def _shuffled(df):
    """The most rows that any exchange of the collected plan wrote."""
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_pairs_of_roads_and_incidents_are_not_shuffled(spark):
    # 40 roads and 300 incidents in one place: 12,000 pairs. Neither the pairs of unique incidents
    # nor their counts per road may pass through a shuffle.
    import random
    rng = random.Random(5)
    paths = [[[-118.2500 + i * 1e-6 + j * 1e-5, 34.0502] for j in range(7)] for i in range(40)]
    points = [(f"DR{i}", (-118.2499 + rng.random() * 1e-4, 34.0501 + rng.random() * 1e-4)) for i in range(300)]
    inc = spark.createDataFrame([(d, "fatal" if d.endswith("7") else "other", x, y) for d, (x, y) in points],
                                "dr_no string, severity string, longitude double, latitude double")
    roads = road(spark, paths + [paths[0]])
    got = corridors.match_incidents(roads, inc, unique=True)
    rows = [(r.road_index, r.dr_no) for r in got.collect()]
    assert len(rows) == len(set(rows)) == 41 * 300
    assert set(rows) == _brute_pairs(paths + [paths[0]], points, C.MATCH_THRESHOLD_DEG)
    assert _shuffled(got) < 2000
    counts = corridors.counted_roads(roads, inc)
    assert {(r.road_index, r.crash_count, r.fatal) for r in counts.collect()} == {(i, 300, 30) for i in range(41)}
    assert _shuffled(counts) < 2000


def test_a_road_in_several_polylines_and_incidents_that_repeat(spark):
    # Two polylines of one road_index (one of them twice) are one road; a dr_no at two places counts once.
    path = [[-118.2500, 34.0500], [-118.2480, 34.0500]]
    roads = spark.createDataFrame([(1, path, "a"), (1, path, "a"), (1, [[-118.2500, 34.0501], [-118.2480, 34.0501]], "b"), (2, None, None)],
                                  "road_index long, path array<array<double>>, name string")
    inc = spark.createDataFrame([("DR1", "other", -118.2490, 34.0500), ("DR1", "other", -118.2470, 34.0500), ("DR1", "other", -118.2481, 34.0500),
                                 (None, "fatal", -118.2485, 34.0502)], "dr_no string, severity string, longitude double, latitude double")
    got = sorted((r.road_index, r.dr_no or "", r.severity) for r in corridors.match_incidents(roads, inc).collect())
    assert got == [(1, "", "fatal"), (1, "DR1", "other")]
    one = inc.filter("latitude > 34.05 or longitude = -118.249")
    assert [tuple(r) for r in corridors.counted_roads(roads, one).collect()] == [(1, 2, 1, 0, 0, 0)]


def test_cells_of_roads_are_not_shuffled_for_counts(spark):
    # 40 roads of 21 to 61 segments and 0.03 degrees: some 3,000 cells, a few tiles. Points on both sides of
    # tile borders, one road_index in two polylines, a road that is a point, equal positions, a null position.
    import random
    rng = random.Random(17)
    paths = [[[-118.2500 + 0.03 * j / n, 34.0400 + 0.0004 * i + rng.random() * 2e-4] for j in range(n + 1)]
             for i, n in ((i, 21 + i) for i in range(40))] + [[[-118.24, 34.05], [-118.24, 34.05]]]
    points = [(f"DR{i}", (round(-118.255 + rng.random() * 0.04, 4), round(34.038 + rng.random() * 0.02, 4))) for i in range(1200)]
    inc = spark.createDataFrame([(d, "fatal" if d.endswith("7") else "other", x, y) for d, (x, y) in points] + [("DRn", "fatal", None, 34.05)],
                                "dr_no string, severity string, longitude double, latitude double")
    roads = road(spark, paths)
    roads = roads.unionByName(roads.filter("road_index = 3")).unionByName(roads.filter("road_index = 4").withColumn("road_index", F.lit(5).cast("long")))
    pairs = _brute_pairs(paths, points, C.MATCH_THRESHOLD_DEG)
    pairs |= {(5, d) for r, d in pairs if r == 4}
    want = {r: (sum(q == r for q, _ in pairs), sum(q == r and d.endswith("7") for q, d in pairs)) for r in {r for r, _ in pairs}}
    counts = corridors.counted_roads(roads, inc)
    assert {r.road_index: (r.crash_count, r.fatal) for r in counts.collect()} == want and len(want) > 39
    assert 0 < _shuffled(counts) < 1300
