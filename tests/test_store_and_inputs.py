"""Repeated calls, grown inputs, stored silver, rejects, other cities."""

import math
import os
import shutil

import pytest
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo, hexgrid
from roadrisk.operators import clean, density, hotspots
from roadrisk.plans import pipeline
from roadrisk.plans.registry import QUERIES
from roadrisk.sources import export, ingest
from roadrisk.sources.tables import TableStore
from roadrisk.streaming.incremental import incremental_ingest

from conftest import SF_SMALL


@pytest.fixture
def grown(tmp_path):
    """A copy of the small tables whose events table is a folder that can grow."""
    for name in os.listdir(SF_SMALL):
        if name != "events.parquet":
            os.symlink(f"{SF_SMALL}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "events.parquet")
    shutil.copy(f"{SF_SMALL}/events.parquet", tmp_path / "events.parquet" / "part-1.parquet")
    return tmp_path


def test_a_file_that_lands_later_is_read(spark, grown):
    total = lambda: QUERIES["severity_totals"](spark, str(grown)).first().total_crashes
    before = total()
    more = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("event_id", F.col("event_id") + 50_000_000)
    more.coalesce(1).write.parquet(str(grown / "more"))
    part = next(f for f in os.listdir(grown / "more") if f.endswith(".parquet"))
    shutil.copy(grown / "more" / part, grown / "events.parquet" / "part-2.parquet")
    assert total() > 1.5 * before


def test_a_later_call_leaves_earlier_results_whole(spark, grown):
    store_queries = ["ingest_incidents", "ingest_schools", "partitioned_roundtrip", "silver_roundtrip", "export_crashes", "road_clean"]
    first = {n: QUERIES[n](spark, SF_SMALL) for n in store_queries}
    again = {n: QUERIES[n](spark, str(grown)).count() for n in store_queries}
    assert {n: df.count() for n, df in first.items()} == again


def test_stored_silver_prunes_years_and_is_read_once_made(spark):
    store = TableStore(spark)
    silver = pipeline.write_silver(store, pipeline.silver(spark, SF_SMALL))
    year = pipeline.read_silver(store, years=[2023])
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [crash_year" in plan.replace("isnotnull(crash_year", "[crash_year") or "2023" in plan
    assert 0 < year.count() == silver.filter("crash_year = 2023").count() < silver.count()
    gold = hotspots.hot_spots(silver)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in gold and "Window" not in gold  # no raw scan, no dedupe
    assert sorted(silver.columns) == sorted(pipeline.silver(spark, SF_SMALL).columns)


def test_catalog_tables_by_name(spark):
    store = TableStore(spark, database="roadrisk_test_db")
    try:
        store.write(spark.range(5).withColumn("crash_year", F.lit(2020)), "t", partition_by=["crash_year"])
        store.write(spark.range(2).withColumn("crash_year", F.lit(2021)), "t", mode="append", partition_by=["crash_year"])
        assert spark.sql("SELECT count(*) FROM roadrisk_test_db.t").first()[0] == 7
        assert store.read("t", years=[2021]).count() == 2
    finally:
        spark.sql("DROP DATABASE roadrisk_test_db CASCADE")


def test_broken_lines_are_rejected_not_lost(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    page = tmp_path / "landing" / "page.json"
    good = '{"dr_no": "A", "date_occ": "2023-05-01T00:00:00.000", "lat": "34.1"}'
    page.write_text("\n".join([good, '{"dr_no": "B", "date_occ": "2023-05-', "", good.replace('"A"', '"C"'), "[1]"]) + "\n")
    assert sorted(r.dr_no for r in ingest.ingest_incidents(spark, str(page)).collect()) == ["A", "C"]
    assert sorted(r.value for r in ingest.ingest_rejects(spark, str(page)).collect()) == ["[1]", '{"dr_no": "B", "date_occ": "2023-05-']
    out = str(tmp_path / "bronze")
    incremental_ingest(spark, str(page.parent), out, str(tmp_path / "ckpt"))
    assert spark.read.parquet(out).count() == 2 and spark.read.parquet(f"{out}_rejects").count() == 2


def test_lines_of_split_files_are_numbered_in_file_order(spark, tmp_path):
    n = 3000
    for name in ("a", "b"):
        (tmp_path / name).write_text("\n".join(f'{{"path": [[{i}.0, 1.0]], "color": [1, 2, 3], "name": "{name}{i}"}}' for i in range(n)) + "\n\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        rows = ingest.read_polylines(spark, str(tmp_path), lines=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 2 * n and all(r.name[1:] == str(r.road_index) and r.path[0][0] == r.road_index for r in rows)


def test_way_documents_and_way_lines_agree(spark, tmp_path):
    elements = ['{"type": "way", "id": %d, "tags": {"highway": "trunk"}, "geometry": [{"lat": 1.0, "lon": 2.0}]}' % i for i in range(4)]
    (tmp_path / "doc").mkdir()
    (tmp_path / "lines").mkdir()
    (tmp_path / "doc" / "d.json").write_text('{"elements": [' + ",\n".join(elements) + "]}")
    (tmp_path / "lines" / "d.json").write_text("\n".join(elements))
    cols = ["pos", "type", "id", "tags", "geometry"]
    doc = ingest.read_ways(spark, str(tmp_path / "doc")).select(*cols).collect()
    lines = ingest.read_ways(spark, str(tmp_path / "lines"), lines=True).select(*cols).collect()
    assert sorted(doc, key=lambda r: r.pos) == sorted(lines, key=lambda r: r.pos) and len(doc) == 4


PORTO = geo.Origin(41.15, -8.61)


def test_another_city_with_its_own_origin(spark):
    import random
    rng = random.Random(2)
    points = [(f"DR{i}", -8.61 + rng.uniform(-0.05, 0.05), 41.15 + rng.uniform(-0.04, 0.04)) for i in range(400)]
    df = spark.createDataFrame(points, "dr_no string, longitude double, latitude double")
    # A point is never farther than the edge length from the centre of its cell, in true metres.
    edge = 174.0
    cell = hexgrid.hex_of_lonlat(F.col("longitude"), F.col("latitude"), edge, PORTO)
    ring = df.select("longitude", "latitude", cell.alias("c")).select(
        "longitude", "latitude", hexgrid.hex_boundary(F.col("c.q"), F.col("c.r"), edge, 9, PORTO).alias("b")).collect()
    kx, ky = PORTO.m_per_deg_x, C.M_PER_DEG_Y
    for r in ring:
        centre = [sum(p[i] for p in r.b[:6]) / 6 for i in (0, 1)]
        assert math.hypot((r.longitude - centre[0]) * kx, (r.latitude - centre[1]) * ky) <= edge + 0.01
        area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r.b, r.b[1:]))) / 2 * kx * ky
        assert area == pytest.approx(1.5 * 3 ** 0.5 * edge ** 2, rel=1e-3)
    # The kernel's mass over all cells is the (weighted) number of points.
    weighted = df.withColumn("w", F.lit(3))
    for table, col, n in ((df, None, 400), (weighted, "w", 1200)):
        d = density.kernel_density(table, radius_m=400.0, cell_m=50.0, weight_col=col, origin=PORTO)
        assert d.agg(F.sum("density")).first()[0] * 0.05 ** 2 == pytest.approx(n, rel=0.01)
    assert hotspots.hot_spots(df, origin=PORTO).agg(F.sum("crash_count")).first()[0] == 400


def test_trend_labels(spark):
    cases = [(0, 10, -1.0, 0.0, "none"), (9, 10, 1.0, 0.0, "historical"), (5, 10, 1.0, 0.0, "sporadic"), (1, 10, 2.5, 0.0, "new"),
             (9, 10, 2.5, 2.2, "intensifying"), (9, 10, 2.5, -2.2, "diminishing"), (10, 10, 2.5, 0.0, "persistent"), (4, 10, 2.5, 3.0, "sporadic"),
             (3, 10, None, 0.0, "sporadic")]
    df = spark.createDataFrame(cases, "hot bigint, steps bigint, z double, mk double, want string")
    got = df.withColumn("got", hotspots.trend_label(F.col("hot"), F.col("steps"), F.col("z"), F.col("mk"))).collect()
    assert all(r.got == r.want for r in got)


def test_emerging_bins_that_are_new_or_historical(spark):
    # A cluster that burns in the last step only, one that burned in all steps but the last two, and a thin background.
    rows, n = [], 0

    def add(lon, lat, month, times):
        nonlocal n
        for _ in range(times):
            n += 1
            rows.append((f"DR{n}", lon, lat, f"{2022 + month // 12}-{month % 12 + 1:02d}-10"))

    for i in range(20):
        for month in range(24):
            add(-118.25 + (i % 5) * 0.01, 34.2 + (i // 5) * 0.01, month, 1)
    for month in range(22):  # the window of a step reaches one step back
        add(-118.30, 34.25, month, 30)
    add(-118.20, 34.25, 23, 90)
    df = spark.createDataFrame(rows, "dr_no string, longitude double, latitude double, d string").withColumn("crash_date", F.to_date("d"))
    e = hotspots.emerging_hot_spots(df, rings=0, step_months=1)
    trends = {r.trend: r.bins for r in hotspots.trend_breakdown(e).collect()}
    assert trends["new"] == 1 and trends["historical"] == 1


def test_corridor_export_from_text_columns(spark):
    table = spark.createDataFrame([("[[1.0,2.0]]", "[1,2,3]", 4, 1, 0, 0, None), ("broken", "[1]", 1, 0, 0, 0, "x")],
                                  "path_json string, color_json string, crash_count bigint, fatal bigint, pedestrian bigint, bicycle bigint, road_name string")
    rows = export.corridor_records(table).collect()
    assert [(r.path, r.color, r.crashes, r.road_name) for r in rows] == [([[1.0, 2.0]], [1, 2, 3], 4, "")]


def test_dedupe_keeps_the_smallest_row_without_a_sort_aggregate(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "a", 1), ("j", None, 5), ("j", "x", 0)], "dr_no string, x string, y int")
    out = clean.dedupe(df, "dr_no", ["x", "y"])
    assert sorted((r.dr_no, r.x, r.y) for r in out.collect()) == [("j", None, 5), ("k", "a", 1)]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_every_gold_step_of_a_run_reads_stored_silver(spark, monkeypatch):
    made = []
    real = pipeline.silver
    monkeypatch.setattr(pipeline, "silver", lambda *a: made.append(1) or real(*a))
    QUERIES["verify_outputs"](spark, SF_SMALL).collect()
    assert made == [1]
