"""Nearest schools against all pairs, and chains of ways against a walk on the driver."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.operators import chains, nearest
from roadrisk.plans.registry import QUERIES
from roadrisk.sources import fixtures, tables

from conftest import SF_SMALL


def haversine(a, b):
    h = math.radians(0.5)
    s1, s2 = math.sin((b[0] - a[0]) * h), math.sin((b[1] - a[1]) * h)
    x = min(1.0, s1 * s1 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * s2 * s2)
    return math.floor(2 * C.EARTH_RADIUS_M * math.asin(math.sqrt(x)) * 1000 + 0.5) / 1000


def all_pairs(points, schools, k):
    out = []
    for i, p in points:
        if None in p:
            continue
        near = sorted((haversine(p, s), name) for name, s in schools if None not in s)[:k]
        out += [(i, n + 1, name, d) for n, (d, name) in enumerate(near)]
    return sorted(out)


def close(got, want):
    got = sorted((r.id, r["rank"], r.school_id, r.distance_m) for r in got)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and abs(g[3] - w[3]) <= 0.0011, (g, w)
        assert g[2] == w[2] or abs(g[3] - w[3]) <= 0.0011


def world(r, n, spread):
    def one():
        kind = r.random()
        if kind < .2:
            return r.choice([-1, 1]) * r.uniform(80, 90), r.uniform(-180, 180)       # by a pole
        if kind < .4:
            return r.uniform(-60, 60), r.choice([-1, 1]) * r.uniform(179.9, 180)     # by the antimeridian
        return 34 + r.uniform(-spread, min(spread, 50)), -118 + r.uniform(-spread, spread)
    return [one() for _ in range(n)]


@pytest.mark.parametrize("k,spread,boxes,broadcast", [(1, 60, 256, True), (3, 2, 256, True), (3, 0.5, 2, True), (4, 30, 8, False),
                                                      (50, 10, 3, True)])
def test_nearest_schools_equal_all_pairs(spark, monkeypatch, k, spread, boxes, broadcast):
    monkeypatch.setattr(nearest, "BOX_SCHOOLS", boxes)
    if not broadcast:
        monkeypatch.setattr(nearest, "BROADCAST_MAX_CELLS", 0)
    r = random.Random(k)
    schools = [(f"s{i:03}", p) for i, p in enumerate(world(r, 40, spread))] + [("none", (None, 1.0))]
    schools += [("twin", schools[0][1]), ("town1", (34.001, -118.001)), ("town2", (34.001, -118.001))]
    points = list(enumerate(world(r, 60, spread) + [schools[3][1], (34.0, -118.0), (None, 3.0), (0.0, 62.0), (-34.0, 62.0)]))
    points += [(1000 + i, (34.0, -118.0)) for i in range(100)]  # a hot place
    inc = spark.createDataFrame([(i, *p, "mine") for i, p in points], "id int, latitude double, longitude double, fy string")
    sch = spark.createDataFrame([(n, *p) for n, p in schools], "school_id string, school_lat double, school_lon double")
    close(nearest.nearest_schools(inc, sch, k=k).collect(), all_pairs(points, schools, k))


def test_a_city_of_schools_is_not_sent_to_far_positions(spark, monkeypatch):
    """5,000 schools in one town; the positions lie far away. Only those beside the nearest are met."""
    r = random.Random(1)
    schools = [(f"s{i:05}", (34 + r.uniform(0, .2), -118 + r.uniform(0, .2))) for i in range(5000)]
    points = list(enumerate([(34 + r.uniform(-1, 1) * 2, -120 - r.uniform(0, 2)) for _ in range(20)]))
    inc = spark.createDataFrame([(i, *p) for i, p in points], "id int, latitude double, longitude double")
    sch = spark.createDataFrame([(n, *p) for n, p in schools], "school_id string, school_lat double, school_lon double")
    close(nearest.nearest_schools(inc, sch, k=2).collect(), all_pairs(points, schools, 2))
    open_ = inc.select(F.col("latitude").alias("p_lat"), F.col("longitude").alias("p_lon"))
    met = lambda: nearest._candidates(open_, sch, 5000, 1_024_000.0, 2).count()
    few = met()
    monkeypatch.setattr(nearest, "BOX_SCHOOLS", 10 ** 6)
    assert few < 20 * 600 < met() == 20 * 5000


def test_nearest_schools_of_empty_tables(spark):
    inc = spark.createDataFrame([(1, 34.0, -118.0)], "id int, latitude double, longitude double")
    sch = spark.createDataFrame([], "school_id string, school_lat double, school_lon double")
    got = nearest.nearest_schools(inc, sch)
    assert got.collect() == [] and {"rank", "school_id", "distance_m"} <= set(got.columns)
    assert nearest.nearest_schools(inc.limit(0), spark.createDataFrame([("a", 1.0, 2.0)], sch.schema)).collect() == []


def test_nearest_plan_has_no_nested_loop(spark):
    p = QUERIES["nearest_school"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "NestedLoop" not in p and "Python" not in p


# ------------------------------------------------------------ chains

def walked(ways):
    """way_id -> (chain_id, position, backward, closed, n_ways) by following links."""
    ends = defaultdict(list)
    for w, points in ways:
        if points and None not in points[0] and None not in points[-1]:
            ends[tuple(points[0])].append(2 * w)
            ends[tuple(points[-1])].append(2 * w + 1)
    follow = {}
    for pair in ends.values():
        if len(pair) == 2:
            a, b = pair
            follow[a ^ 1], follow[b ^ 1] = b, a
    out = {}
    states = [2 * w + d for w, _ in ways for d in (0, 1)]
    entered = set(follow.values())
    for head in states:
        if head not in entered:
            path = [head]
            while path[-1] in follow:
                path.append(follow[path[-1]])
            if head // 2 < path[-1] // 2 or (len(path) == 1 and head % 2 == 0):
                out |= {s // 2: (head // 2, i, s % 2 == 1, False, len(path)) for i, s in enumerate(path)}
    for w in sorted(w for w, _ in ways):
        if w not in out:
            path = [2 * w]
            while follow[path[-1]] != 2 * w:
                path.append(follow[path[-1]])
            out |= {s // 2: (w, i, s % 2 == 1, True, len(path)) for i, s in enumerate(path)}
    return out


def ranked(spark, ways):
    df = spark.createDataFrame([(w, p, "x", 1) for w, p in ways], "way_id long, points array<array<double>>, state string, low int")
    rows = chains.road_chains(df).collect()
    assert len(rows) == len(ways)
    return {r.way_id: (r.chain_id, r.position, r.backward, r.closed, r.n_ways) for r in rows}


def path(nodes, turned=()):
    """Ways between consecutive nodes."""
    return [[[float(a), 0.0], [float(b), 0.0]][::-1 if i in turned else 1] for i, (a, b) in enumerate(zip(nodes, nodes[1:]))]


def test_chains_of_all_shapes(spark):
    shapes = path(range(9), {2, 3, 7}) + path([20, 21, 22, 20], {1}) + path([30, 31, 30]) + path([40, 40])
    shapes += path([50, 51]) + path([51, 52]) + path([51, 53]) + path([53, 53])        # a fork, and a loop at an end
    r = random.Random(2)
    ids = r.sample(range(1000), len(shapes))
    ways = list(zip(ids, shapes)) + [(5000, None), (5001, []), (5002, [[None, 1.0], [0.0, 0.0]]), (5003, [[8.0, 0.0]])]
    assert ranked(spark, ways) == walked(ways)


@pytest.mark.parametrize("seed", range(3))
def test_chains_of_random_networks(spark, seed):
    r = random.Random(seed)
    ways = [(w, [[float(r.randrange(40)), 0.0], [float(r.randrange(40)), 0.0]]) for w in r.sample(range(10 ** 6), 25)]
    assert ranked(spark, ways) == walked(ways)


def test_long_chains_take_logarithmic_rounds(spark, monkeypatch):
    rounds = Counter()
    real = chains.run_folder
    monkeypatch.setattr(chains, "run_folder", lambda *a: rounds.update("f") or real(*a))
    r = random.Random(4)
    order = list(range(300))
    r.shuffle(order)
    ways = list(zip(order, path(range(301), set(r.sample(range(300), 150)))))
    ways += [(1000 + i, p) for i, p in enumerate(path([*range(1000, 1100), 1000]))]
    assert ranked(spark, ways) == walked(ways)
    # two tables a round; log2 of 300 for the path, of 100 twice for the ring
    assert rounds["f"] <= 2 * (9 + 2) + 2 * (7 + 2) + 6


def test_a_point_where_many_ways_meet(spark):
    ways = [(i, [[0.0, 0.0], [float(i + 1), 0.0]]) for i in range(500)]
    got = ranked(spark, ways)
    assert all(got[i] == (i, 0, False, False, 1) for i in range(500))
    df = spark.createDataFrame(ways, "way_id long, points array<array<double>>")
    plan = chains.way_links(df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Window" not in plan and plan.count("HashAggregate") >= 2


def test_chain_points_run_in_order(spark):
    ways = list(enumerate(path([3, 1, 2, 5], {1})))
    df = spark.createDataFrame(ways, "way_id long, points array<array<double>>")
    rows = chains.chain_points(df, chains.road_chains(df)).orderBy("chain_id", "position", "idx").collect()
    assert [r.x for r in rows] == [3.0, 1.0, 2.0, 5.0]


def test_chains_leave_no_tables_but_their_result(spark):
    tables.remove_temporary()
    chains.road_chains(fixtures.connected_ways(spark, SF_SMALL)).count()
    assert len([f for f in tables._temporary if "chains" in f]) == 1
    assert chains.road_chains(spark.createDataFrame([], "way_id long, points array<array<double>>")).collect() == []
