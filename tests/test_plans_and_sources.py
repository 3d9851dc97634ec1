"""Plan-shape checks (no cartesian joins, no Python evaluation, pruned scans)
and the file sources/sinks."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from roadrisk.plans import pipeline
from roadrisk.plans.registry import QUERIES
from roadrisk.sources import fixtures, ingest
from roadrisk.sources.tables import TableStore

from conftest import SF_SMALL

PLAN_QUERIES = ["road_match", "near_school_flag", "near_school_join", "hot_spots", "emerging_hot_spots",
                "kernel_density", "hex_heatmap", "danger_corridors", "summary_stats", "monthly_series"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_cartesian_no_python(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "PythonUDF"):
        assert bad not in p, (name, bad)


def test_scan_reads_only_needed_columns(spark):
    p = plan_of(QUERIES["monthly_series"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p


def test_partition_pruning_on_year(spark):
    store = TableStore(spark)
    store.write(pipeline.bronze(spark, SF_SMALL), "bronze_crashes", partition_by=["crash_year"])
    df = store.read("bronze_crashes").filter(F.col("crash_year") == 2023)
    p = plan_of(df)
    assert "PartitionFilters: [isnotnull(crash_year" in p and "= 2023)" in p
    assert df.filter(F.col("crash_year") != 2023).count() == 0


def test_read_ways_document(spark):
    d = tempfile.mkdtemp(prefix="roadrisk-ways-")
    doc = {"elements": [
        {"type": "node", "id": 1},
        {"type": "way", "id": 2, "tags": {"highway": "trunk"},
         "geometry": [{"lat": 34.0, "lon": -118.0}, {"lat": 34.001, "lon": -118.001}]},
        {"type": "way", "id": 3, "geometry": [{"lat": 34.0, "lon": -118.0}]},
    ]}
    with open(os.path.join(d, "city.json"), "w") as f:
        json.dump(doc, f)
    ways = ingest.read_ways(spark, d)
    rows = sorted((r.pos, r.type, r.id) for r in ways.collect())
    assert rows == [(0, "node", 1), (1, "way", 2), (2, "way", 3)]
    from roadrisk.operators import roads
    assert [r.id for r in roads.clean_ways(ways).collect()] == [2]


def test_read_polylines(spark):
    d = tempfile.mkdtemp(prefix="roadrisk-poly-")
    with open(os.path.join(d, "roads.json"), "w") as f:
        json.dump([{"path": [[-118.0, 34.0], [-118.1, 34.1]], "color": [0, 238, 255]},
                   {"path": [[-118.2, 34.2]], "color": [1, 2, 3], "name": "X"}], f)
    rows = sorted((r.road_index, r.name, len(r.path)) for r in ingest.read_polylines(spark, d).collect())
    assert rows == [(0, None, 2), (1, "X", 1)]


def test_ingest_schools_keeps_scalars_only(spark):
    rows = QUERIES["ingest_schools"](spark, SF_SMALL)
    assert set(rows.columns) == {"school_id", "school_name", "latitude", "longitude", "school_lat", "school_lon"}
    landed = ingest.land_json(fixtures.schools_raw(spark, SF_SMALL), TableStore(spark).path("landing_schools"))
    raw = ingest.ingest_schools(spark, landed)
    assert "address" not in raw.columns and "grades" not in raw.columns
    assert raw.filter(F.col("latitude") == "").count() == 1


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["bin_id", "crash_count", "z_score", "p_value", "classification"]


def test_silver_for_some_years_prunes_partitions(spark):
    from roadrisk.operators import rollups
    store = TableStore(spark)
    store.write(pipeline.bronze(spark, SF_SMALL), "bronze_crashes", partition_by=["crash_year"])
    monthly = rollups.monthly_series(pipeline.silver_from_store(store, pipeline.schools(spark, SF_SMALL), years=[2023]))
    p = plan_of(monthly)
    assert "PartitionFilters: [isnotnull(crash_year" in p and "crash_year" in p and "2023" in p
    months = [r.year_month for r in monthly.collect()]
    assert months and all(m.startswith("2023-") for m in months)


@pytest.mark.parametrize("name,partial", [("hot_spots", "partial_count"), ("emerging_hot_spots", "partial_count"),
                                          ("kernel_density", "partial_sum"), ("hex_heatmap", "partial_count"),
                                          ("top_intersections", "partial_count")])
def test_fan_in_is_combined_map_side(spark, name, partial):
    # A hot bin or cell must reach the shuffle as one row per map task.
    p = plan_of(QUERIES[name](spark, SF_SMALL))
    assert partial in p, (name, partial)
