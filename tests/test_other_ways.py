"""Density by tiles, false-discovery-rate classes, Morton clustering, counts while writing, publishing, repeats on the stream."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from roadrisk.operators import clean, density, fdr
from roadrisk.plans.registry import DOWNTOWN, QUERIES
from roadrisk.sources import clustering, export, fixtures, ingest, publish
from roadrisk.sources.tables import TableStore
from roadrisk.streaming.incremental import incremental_ingest

from conftest import SF_MID, SF_SMALL


def nodes(df):
    """All nodes of the plan that was run, through its stages."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        n = todo.pop()
        out.append(n)
        name = n.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(n.executedPlan())
        elif "QueryStage" in name:
            todo.append(n.plan())
        else:
            kids = n.children()
            todo += [kids.apply(i) for i in range(kids.size())]
    return out


def metric(df, node, name):
    return sum(n.metrics().apply(name).value() for n in nodes(df) if n.nodeName().startswith(node))


# ------------------------------------------------------------ density

def surface(df):
    return {(r.cell_i, r.cell_j): r.density for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    assert all(math.isclose(a[k], b[k], rel_tol=1e-9) for k in a)


@pytest.fixture(scope="module")
def points(spark):
    return fixtures.incident_points(spark, SF_SMALL).checkpoint()


@pytest.mark.parametrize("radius,cell,crowd", [(500.0, 50.0, 50_000), (500.0, 50.0, 5), (120.0, 100.0, 3), (3000.0, 40.0, 50_000)])
def test_tiles_give_the_surface(spark, points, radius, cell, crowd):
    some = points.filter("pmod(hash(dr_no), 10) = 0") if radius > 1000 else points
    tiles = density.kernel_density_tiles(some, radius, cell, tile_positions=crowd)
    same(surface(tiles), surface(density.kernel_density(some, radius, cell)))


def test_tiles_weights_and_empty(spark, points):
    weighted = points.withColumn("w", F.pmod(F.hash("dr_no"), F.lit(5)) + 1)
    same(surface(density.kernel_density_tiles(weighted, weight_col="w")), surface(density.kernel_density(weighted, weight_col="w")))
    assert density.kernel_density_tiles(points.limit(0)).collect() == []


def test_tiles_shuffle_fewer_rows(spark, points):
    plain, tiles = density.kernel_density(points), density.kernel_density_tiles(points)
    plain.collect(), tiles.collect()
    positions = points.select("longitude", "latitude").distinct().count()
    shuffled = metric(tiles, "Exchange", "shuffleRecordsWritten")
    # positions once to merge equal ones, at most four tile rows, one count per tile and task
    assert shuffled <= 8 * positions and 10 * shuffled < metric(plain, "Exchange", "shuffleRecordsWritten")


# ------------------------------------------------------------ step-up rule

def stepped(ps):
    m = len(ps)
    order = sorted(range(m), key=lambda i: ps[i])
    out, low = [0.0] * m, 1.0
    for j in range(m, 0, -1):
        low = min(low, m * ps[order[j - 1]] / j)
        out[order[j - 1]] = low
    return out


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_adjusted_p_equals_the_step_up_rule(spark, ranges):
    r = random.Random(ranges)
    ps = [r.choice([r.random(), r.random() ** 4, 0.01, 0.5, 0.0, 1.0]) for _ in range(400)]
    df = spark.createDataFrame([(i, p, "x") for i, p in enumerate(ps)] + [(1000, None, "x")], "id int, p_value double, _p string")
    got = {x.id: x.p_adjusted for x in fdr.adjusted_p(df.drop("_p"), ranges=ranges).collect()}
    assert got.pop(1000) is None
    want = dict(enumerate(stepped(ps)))
    # equal p-values share the largest rank
    assert all(math.isclose(got[i], min(want[j] for j in want if ps[j] >= ps[i]), rel_tol=1e-12, abs_tol=1e-300) for i in want)


def test_adjusted_p_without_tests(spark):
    df = spark.createDataFrame([(1, None)], "id int, p_value double")
    assert [tuple(r) for r in fdr.adjusted_p(df).collect()] == [(1, None, None)]
    assert fdr.adjusted_p(df.limit(0)).collect() == []


def test_adjusted_p_has_no_one_task_window(spark):
    plan = QUERIES["hot_spots_fdr"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan.split("p_adjusted")[0]


# ------------------------------------------------------------ Morton order

def morton(x, y):
    return sum(((x >> b) & 1) << (2 * b) | ((y >> b) & 1) << (2 * b + 1) for b in range(clustering.BITS))


def test_morton_key(spark):
    r = random.Random(1)
    spots = [(r.uniform(-180, 180), r.uniform(-90, 90)) for _ in range(300)] + [(-180.0, -90.0), (180.0, 90.0), (200.0, 99.0), (0.0, 0.0)]
    df = spark.createDataFrame(spots + [(None, 1.0)], "lon double, lat double")
    got = [x.k for x in df.select(clustering.morton_key(F.col("lon"), F.col("lat")).alias("k")).collect()]
    top = 2 ** clustering.BITS
    cell = lambda v, h: max(0, min(top - 1, math.floor((v + h) * (top / (2 * h)))))
    assert got == [morton(cell(x, 180.0), cell(y, 90.0)) for x, y in spots] + [None]


def test_a_box_reads_a_fraction_of_the_rows(spark):
    points = fixtures.incident_points(spark, SF_MID)
    with TableStore(spark) as store:
        clustering.write_clustered(store, points, "near", files=48, row_group_bytes=16 * 1024)
        store.write(points.repartition(48, "dr_no"), "far")
        box = {n: clean.bbox_filter(store.read(n), **DOWNTOWN) for n in ("near", "far")}
        rows = {n: sorted(map(tuple, b.collect())) for n, b in box.items()}
        assert rows["near"] == rows["far"] != []
        read = {n: metric(b, "Scan parquet", "numOutputRows") for n, b in box.items()}
        assert read["far"] == points.count() and read["near"] < read["far"] / 2, read


def test_one_place_is_split_over_files(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("dr_no"), F.lit(34.0).alias("latitude"), F.lit(-118.0).alias("longitude"))
    with TableStore(spark) as store:
        path = clustering.write_clustered(store, df, "t", files=4)
        sizes = [r["n"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 4 and max(sizes) < 2000


# ------------------------------------------------------------ counts while writing

@pytest.mark.parametrize("partitioned", [None, ["crash_year"]])
def test_counts_come_from_the_write(spark, monkeypatch, partitioned):
    df = spark.range(1234).select("id", (F.col("id") % 3).alias("crash_year"))
    with TableStore(spark) as store:
        monkeypatch.setattr(TableStore, "read", None)
        assert store.write_counted(df, "t", partition_by=partitioned) == 1234
        assert store.write_counted(df.limit(0), "u") == 0


# ------------------------------------------------------------ publishing

def write(spark, n):
    return lambda p: export.write_json(spark.range(n), p)


def test_readers_see_one_whole_version(spark, tmp_path):
    root = str(tmp_path / "pub")
    with pytest.raises(FileNotFoundError):
        publish.Snapshot(spark, root)
    one = publish.publish(spark, root, {"a": write(spark, 3), "b": write(spark, 4)})
    reader = publish.Snapshot(spark, root)

    def late(p):  # while the second version is being written, the first one is current
        assert publish.Snapshot(spark, root).version == one
        write(spark, 6)(p)

    two = publish.publish(spark, root, {"a": write(spark, 5), "b": late})
    assert [reader.json(n, "id bigint").count() for n in "ab"] == [3, 4]
    now = publish.Snapshot(spark, root)
    assert now.version == two and [now.json(n, "id bigint").count() for n in "ab"] == [5, 6]
    assert now.complete() and set(now.outputs) == {"a", "b"}
    publish.publish(spark, root, {"a": write(spark, 1)})
    assert sorted(os.listdir(f"{root}/versions"))[0] == two  # the two newest stay


def test_a_broken_run_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "pub")
    one = publish.publish(spark, root, {"a": write(spark, 3)})

    def fails(_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish.publish(spark, root, {"a": write(spark, 9), "b": fails})
    assert publish.Snapshot(spark, root).version == one and publish.Snapshot(spark, root).complete()
    assert len(os.listdir(f"{root}/versions")) == 2
    publish.publish(spark, root, {"a": write(spark, 9)})
    assert len(os.listdir(f"{root}/versions")) == 2  # what the broken run left is gone


# ------------------------------------------------------------ repeats on the stream

def test_landed_again_changes_nothing(spark, tmp_path):
    raw = fixtures.incidents_raw(spark, SF_SMALL)
    run = lambda: incremental_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/bronze", f"{tmp_path}/c", remember="10 days")
    rows = lambda: sorted(map(repr, spark.read.parquet(f"{tmp_path}/bronze").collect()))
    half = raw.filter("pmod(hash(dr_no), 2) = 0")
    half.write.mode("append").json(f"{tmp_path}/in")
    run()
    first = rows()
    half.write.mode("append").json(f"{tmp_path}/in")   # again, under other names, after a restart
    run()
    assert rows() == first
    raw.write.mode("append").json(f"{tmp_path}/in")    # known and new records together
    raw.limit(5).withColumn("area_name", F.lit("Other")).write.mode("append").json(f"{tmp_path}/in")
    run()
    want = ingest.normalise_incidents(raw).distinct().count()
    corrected = ingest.normalise_incidents(raw.limit(5)).count()
    assert len(rows()) == want + corrected and set(first) < set(rows())




# ------------------------------------------------------------ stored road cells

def test_the_stored_side_is_not_shuffled(spark):
    import uuid

    from roadrisk.operators import corridors
    from roadrisk.plans import pipeline
    roads, silver = fixtures.road_polylines(spark, SF_SMALL), pipeline.silver(spark, SF_SMALL)
    with TableStore(spark, database=f"cells_{uuid.uuid4().hex}", temporary=True) as store:
        corridors.store_road_cells(store, roads, salts=3)
        match = corridors.match_stored(store, silver, salts=3)
        assert sorted(map(tuple, match.collect())) == sorted(map(tuple, corridors.match_incidents(roads, silver).collect())) != []
        join = next(n for n in nodes(match) if n.nodeName() == "SortMergeJoin")
        road = join.left().toString()
        assert "road_cells" in road and "Exchange" not in road and "Exchange" in join.right().toString()
