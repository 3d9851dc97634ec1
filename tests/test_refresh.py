"""Upserts of silver, gold from partial aggregates, temporary stores, rejects, optional imports."""

import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from roadrisk.operators import heatmap, rollups
from roadrisk.plans import gold_state, pipeline, upsert
from roadrisk.sources import fixtures, ingest, tables
from roadrisk.sources.tables import TableStore

from conftest import ROOT, SF_SMALL

FIELDS = ingest.C.INCIDENT_FIELDS


def page(spark, *records):
    """Bronze of (dr_no, date, lat, lon, other fields) records."""
    rows = []
    for dr_no, date, lat, lon, *rest in records:
        r = dict.fromkeys(FIELDS, "") | {"dr_no": dr_no, "date_occ": f"{date}T00:00:00.000", "time_occ": "1200", "lat": lat, "lon": lon}
        rows.append(tuple((r | (rest[0] if rest else {}))[f] for f in FIELDS))
    return ingest.normalise_incidents(spark.createDataFrame(rows, ", ".join(f"{f} string" for f in FIELDS)))


def content(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def files(store, year):
    folder = f"{store.root}/{upsert.SILVER}/crash_year={year}".removeprefix("file:")
    return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder) if f.endswith(".parquet")} if os.path.isdir(folder) else None


def all_pages(pages):
    out = None
    for n, p in pages.items():
        p = p.withColumn("page", F.lit(n))
        out = p if out is None else out.unionByName(p)
    return out


P0 = [("a", "2022-05-01", "34.0", "-118.2"), ("b", "2023-05-01", "34.1", "-118.2"), ("c", "2023-06-01", "34.2", "-118.2"),
      ("d", "2024-01-01", "34.3", "-118.2"), ("d", "2024-01-01", "34.3", "-118.2", {"time_occ": "0100"}), ("e", "2024-02-01", "", "")]
P1 = [("b", "2024-05-01", "34.1", "-118.2"), ("c", "2023-06-01", "34.2", "-118.2"), ("d", "2024-01-01", "0", "0"),
      ("e", "2024-02-01", "34.4", "-118.3"), ("f", "2024-03-01", "34.5", "-118.2")]


@pytest.mark.parametrize("catalog", [False, True])
def test_upsert_touches_only_its_years(spark, catalog):
    import uuid
    with TableStore(spark, database=f"upsert_{uuid.uuid4().hex}" if catalog else None, temporary=True) as store:
        first, second = page(spark, *P0), page(spark, *P1)
        assert upsert.apply_page(store, 0, first, None) == ([2022, 2023, 2024], 5)
        kept = files(store, 2022)
        assert kept
        assert upsert.apply_page(store, 1, second, None) == ([2023, 2024], 4)  # c is known as it is
        assert files(store, 2022) == kept
        now = upsert.read_upserted(store)
        assert content(now) == content(upsert.rebuild(all_pages({0: first, 1: second}), None).select(*now.columns))
        assert {(r.dr_no, r.crash_year) for r in now.collect()} == {("a", 2022), ("b", 2024), ("c", 2023), ("e", 2024), ("f", 2024)}
        before = {y: files(store, y) for y in (2022, 2023, 2024)}
        assert upsert.apply_page(store, 1, second, None) == ([], 0)            # a repeated page changes nothing
        assert upsert.apply_page(store, 0, first, None) == ([], 0)             # an older page neither
        assert {y: files(store, y) for y in before} == before
        # the last record of a year leaves it: its folder goes
        third = page(spark, ("a", "2023-09-09", "34.0", "-118.2"))
        assert upsert.apply_page(store, 2, third, None) == ([2022, 2023], 1)
        assert files(store, 2022) is None
        now = upsert.read_upserted(store)
        assert content(now) == content(upsert.rebuild(all_pages({0: first, 1: second, 2: third}), None).select(*now.columns))


def test_upsert_can_be_repeated_after_a_broken_run(spark, monkeypatch):
    with TableStore(spark) as store:
        first, second = page(spark, *P0), page(spark, *P1)
        upsert.apply_page(store, 0, first, None)
        real = TableStore.replace_partitions

        def broken(self, df, name, by):
            if name == upsert.LOG:
                raise RuntimeError("lost the driver here")
            real(self, df, name, by)

        monkeypatch.setattr(TableStore, "replace_partitions", broken)
        with pytest.raises(RuntimeError):
            upsert.apply_page(store, 1, second, None)
        monkeypatch.setattr(TableStore, "replace_partitions", real)
        upsert.apply_page(store, 1, second, None)
        now = upsert.read_upserted(store)
        assert content(now) == content(upsert.rebuild(all_pages({0: first, 1: second}), None).select(*now.columns))


def test_upsert_of_random_pages_equals_a_rebuild(spark):
    r = random.Random(3)
    pages = {}
    for n in range(4):
        pages[n] = page(spark, *[(f"k{r.randrange(12)}", f"{r.choice([2022, 2023, 2024])}-0{r.randrange(1, 9)}-11",
                                  r.choice(["34.0", "34.1", "", "0", "40"]), "-118.2", {"mocodes": r.choice(["", "0449", "1822"])})
                                 for _ in range(10)])
    with TableStore(spark) as store:
        for n in pages:
            upsert.apply_page(store, n, pages[n], None)
            now = upsert.read_upserted(store)
            want = upsert.rebuild(all_pages({m: p for m, p in pages.items() if m <= n}), None)
            assert content(now) == content(want.select(*now.columns)), n
        assert upsert.apply_page(store, 9, pages[0].limit(0), None) == ([], 0)


def test_upsert_reads_only_the_touched_years(spark):
    with TableStore(spark) as store:
        upsert.apply_page(store, 0, page(spark, *P0), None)
        plan = store.read(upsert.SILVER).filter(upsert._in_years([2023]))._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [crash_year" in plan.replace("isnotnull(crash_year", "crash_year") and "2023" in plan
        log = store.read(upsert.LOG)
        change = upsert.changed_versions(upsert.page_versions(page(spark, *P1)), 1, log)
        plan = change._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "LeftSemi" in plan and "WindowGroupLimit" in plan  # one log entry per key and task is shuffled


# ------------------------------------------------------------ gold state

@pytest.fixture(scope="module")
def silver(spark):
    return pipeline.silver(spark, SF_SMALL).checkpoint()


def check_gold(store, silver):
    assert gold_state.monthly_series(store).collect() == rollups.monthly_series(silver).collect()
    assert gold_state.top_intersections(store).collect() == rollups.top_intersections(silver).collect()
    assert content(gold_state.hex_heatmap(store)) == content(heatmap.hex_heatmap(silver))
    total, want = gold_state.totals(store).first(), rollups.summary_stats(silver).first()
    assert all(total[c] == want[c] for c in ["total_crashes", "school_zone_crashes", "school_zone_fatal", *rollups.C.SEVERITY_LABELS])
    assert (str(total.first_date), str(total.last_date)) == (want.date_from, want.date_to)
    enriched = rollups.enrichment_summary(silver).first()
    found = {r.grain: r for r in gold_state.distinct_cells(store).collect()}
    assert (found["cell9"].cells, found["cell8"].cells) == (enriched.distinct_fine_cells, enriched.distinct_coarse_cells)
    assert total.with_geometry == enriched.with_geometry
    for r in found.values():
        assert abs(r.estimate - r.cells) <= 1 + 3 * gold_state.SKETCH_ERROR * r.cells


def test_any_batches_merge_to_one_pass(spark, silver):
    part = F.pmod(F.xxhash64("dr_no"), F.lit(5))
    with TableStore(spark) as store:
        for b in (3, 0, 4, 1, 2, 0):  # any order; batch 0 comes twice
            gold_state.add_batch(store, silver.filter(part == b), f"b{b}")
        check_gold(store, silver)
        gold_state.compact(store)
        assert store.read(gold_state.STATE).select("batch").distinct().collect() == [(gold_state.BASE,)]
        check_gold(store, silver)
        with pytest.raises(ValueError):
            gold_state.add_batch(store, silver, gold_state.BASE)


def test_refreshed_years_replace_and_leave_the_others(spark, silver):
    with TableStore(spark) as store:
        gold_state.add_batch(store, silver, "all")
        stamp = lambda y: {f: os.stat(f"{p}/{f}").st_mtime_ns for p in [f"{store.root}/{gold_state.STATE}/crash_year={y}".removeprefix("file:")]
                           if os.path.isdir(p) for f in os.listdir(p)}
        kept = stamp(2022)
        less = silver.filter("crash_year = 2022 OR (crash_year = 2024 AND crash_month < 7)")
        gold_state.refresh_years(store, less, [2023, 2024])
        check_gold(store, less)
        assert stamp(2022) == kept and stamp(2023) == {}


def test_gold_state_is_combined_before_the_shuffle(spark, silver):
    plan = gold_state.partials(silver, "b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and plan.count("Exchange hashpartitioning") == 1


# ------------------------------------------------------------ temporary stores, rejects, imports

def test_ten_calls_leave_nothing(spark):
    from roadrisk.plans.registry import QUERIES
    tables.remove_temporary()
    root = f"{tables.shared_dir(spark)}/roadrisk-tables".removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    for _ in range(5):
        QUERIES["partitioned_roundtrip"](spark, SF_SMALL).count()
        QUERIES["ingest_schools"](spark, SF_SMALL).count()
    assert [d.name for d in spark.catalog.listDatabases() if d.name.startswith("roadrisk_")]
    tables.remove_temporary()
    assert set(os.listdir(root)) <= before
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("roadrisk_")]


def test_named_stores_stay(spark, tmp_path):
    with TableStore(spark, root=str(tmp_path / "kept")) as store:
        store.write(spark.range(3), "t")
    tables.remove_temporary()
    assert TableStore(spark, root=str(tmp_path / "kept")).read("t").count() == 3


def test_broken_lines_are_set_aside_and_keep_their_place(spark, tmp_path):
    lines = ['{"path": [[1, 2], [3, 4]], "name": "x"}', '{"path": [[1, 2', "", '{"path": [[5, 6]]}', "not json"]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text("\n".join(lines))
    good = ingest.read_polylines(spark, str(tmp_path / "p"), lines=True).orderBy("road_index").collect()
    assert [(r.road_index, r.name) for r in good] == [(0, "x"), (2, None)]
    assert {r.value for r in ingest.polyline_rejects(spark, str(tmp_path / "p")).collect()} == {lines[1], lines[4]}
    assert {r.value for r in ingest.way_rejects(spark, str(tmp_path / "p")).collect()} == {lines[1], lines[4]}


def test_queries_load_without_a_library_of_the_optional_part():
    code = ("import sys; sys.modules['zstandard'] = None; sys.path.insert(0, %r); import __spark_entry__ as e; "
            "from roadrisk.plans.registry import QUERIES; assert set(e.queries()) >= set(QUERIES) and set(e.oracle_sql()) >= set(QUERIES)")
    subprocess.run([sys.executable, "-c", code % ROOT], check=True)


def test_corrections_reach_every_case(spark):
    c = fixtures.incident_corrections(spark, "/root/testdata/sf0.01")
    assert c.filter("lat = ''").count() and c.filter("date_occ LIKE '2024-06-15%'").count() and c.filter("dr_no LIKE 'N%'").count()
