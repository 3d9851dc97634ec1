"""Gold tables from stored partial aggregates.

The state holds, per crash year, batch and group, what merges without loss: counts,
exact (decimal) sums, smallest and largest dates. The groups are the months, the hex
cells of both sizes, the intersections and the whole. One more table holds HLL sketches
of the distinct cells per year and batch.

- ``add_batch`` aggregates only the new rows and puts them beside the others of their
  years; the same batch added again takes its own place, so a repeated run counts
  nothing twice.
- ``refresh_years`` computes the given years anew from silver, which is how corrected and
  removed records (``upsert.apply_page`` names the years) reach gold. Counts could be
  subtracted, smallest dates and sketches could not.
- ``compact`` merges the batches of a year into one.

All three overwrite the touched years' partitions only. Reading merges what is stored:
merging any batches in any order gives the same rows as one pass over silver, and the
work depends on the groups, not on the incidents. The count of distinct cells is exact
from the cell groups; the sketches give it without them, with a relative standard
error of 1.04 / sqrt(2^SKETCH_LOG2) = 1.6 %, whatever way they were merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo
from roadrisk.functions.severity import count_of, severity_weight
from roadrisk.operators import heatmap
from roadrisk.sources.tables import TableStore, remove_temporary, run_folder

STATE = "gold_state"
SKETCHES = "gold_sketches"
YEAR = "crash_year"
SKETCH_LOG2 = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG2 / 2)
BASE = "base"   # the batch that a refresh or a compaction leaves

COUNTS = ["n", *C.SEVERITY_LABELS, "near", "near_fatal", "score", "n_lat", "n_lng", "n_geometry"]
SUMS = ["sum_lat", "sum_lng"]
CELLS = [label for label, _ in C.HEATMAP_RESOLUTIONS]


def partials(silver: DataFrame, batch: str) -> DataFrame:
    """One row per crash_year and group of a batch of silver rows (one scan, combined on the map side)."""
    group = lambda grain, key: F.struct(F.lit(grain).alias("grain"), F.col(key).alias("key"))
    groups = [F.struct(F.lit("all").alias("grain"), F.lit("").alias("key")), group("month", "year_month"),
              group("intersection", "intersection"), *[group(f"cell{c}", f"h3_res{c}") for c in CELLS]]
    sev = F.col("severity")
    near = F.col("near_school") == F.lit(1)
    exact = lambda c: F.sum(F.col(c).cast("decimal(27,9)")).cast("decimal(38,9)")
    return (silver.withColumn("_g", F.explode(F.array(*groups))).filter("_g.key IS NOT NULL")
            .groupBy(YEAR, F.col("_g.grain").alias("grain"), F.col("_g.key").alias("key"))
            .agg(F.count(F.lit(1)).alias("n"), *[count_of(sev, s).alias(s) for s in C.SEVERITY_LABELS],
                 F.count_if(near).alias("near"), F.count_if(near & (sev == F.lit("fatal"))).alias("near_fatal"),
                 F.sum(severity_weight(sev).cast("bigint")).alias("score"),
                 F.count("latitude").alias("n_lat"), F.count("longitude").alias("n_lng"), F.count("geometry").alias("n_geometry"),
                 exact("latitude").alias("sum_lat"), exact("longitude").alias("sum_lng"),
                 F.min("crash_date").alias("first_date"), F.max("crash_date").alias("last_date"))
            .withColumn("batch", F.lit(batch)))


def sketches(silver: DataFrame, batch: str) -> DataFrame:
    """Sketches of the distinct cells of a batch, one row per crash_year."""
    return (silver.groupBy(YEAR).agg(*[F.hll_sketch_agg(f"h3_res{c}", SKETCH_LOG2).alias(f"cells{c}") for c in CELLS])
            .withColumn("batch", F.lit(batch)))


def _merge(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTS], *[F.sum(c).cast("decimal(38,9)").alias(c) for c in SUMS],
                                 F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def _merge_sketches(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.hll_union_agg(f"cells{c}").alias(f"cells{c}") for c in CELLS])


def _replace(store: TableStore, name: str, rows: DataFrame) -> None:
    """Overwrite the years of ``rows``, which may read them."""
    folder = run_folder(store.spark, "gold-state")
    rows.write.parquet(folder)
    store.replace_partitions(store.spark.read.schema(rows.schema).parquet(folder), name, [YEAR])
    remove_temporary(folder)


def _years(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.select(YEAR).distinct().collect()]


def add_batch(store: TableStore, silver_batch: DataFrame, batch: str) -> None:
    """Put a batch of new silver rows into the state. Batches must not share rows; a name used
    again replaces the batch of that name in the years that it has rows for."""
    if batch == BASE:
        raise ValueError(f"{BASE!r} is the name of refreshed and compacted rows")
    years = _years(silver_batch)
    for name, new in ((STATE, partials(silver_batch, batch)), (SKETCHES, sketches(silver_batch, batch))):
        if store.exists(name):
            kept = store.read(name, years=years).filter(F.col("batch") != batch)
            new = kept.select(*new.columns).unionByName(new)
        _replace(store, name, new)


def refresh_years(store: TableStore, silver: DataFrame, years: list[int]) -> None:
    """Compute the state of whole years anew from silver."""
    rows = silver.filter(F.col(YEAR).isin(years)) if years else silver.limit(0)
    left = set(_years(rows))
    for name, new in ((STATE, partials(rows, BASE)), (SKETCHES, sketches(rows, BASE))):
        if left:
            _replace(store, name, new)
        for year in set(years) - left:
            store.drop_partition(name, YEAR, year)


def compact(store: TableStore) -> None:
    """Merge the batches of each year into one. A batch added again afterwards would count twice."""
    _replace(store, STATE, _merge(store.read(STATE), YEAR, "grain", "key").withColumn("batch", F.lit(BASE)))
    _replace(store, SKETCHES, _merge_sketches(store.read(SKETCHES), YEAR).withColumn("batch", F.lit(BASE)))


# ------------------------------------------------------------ gold from the state

def groups(store: TableStore, grain: str, years: list[int] | None = None) -> DataFrame:
    """The merged groups of one grain: all measures by ``key``."""
    return _merge(store.read(STATE, years=years).filter(F.col("grain") == grain), "key")


def _mean(c: str) -> F.Column:
    return F.col(f"sum_{c}").cast("double") / F.col(f"n_{c}").cast("double")


def monthly_series(store: TableStore) -> DataFrame:
    """A8."""
    return (groups(store, "month").select(F.col("key").alias("year_month"), F.col("n").alias("total"), *C.SEVERITY_LABELS)
            .orderBy("year_month"))


def top_intersections(store: TableStore, k: int = C.TOP_INTERSECTIONS) -> DataFrame:
    """A5."""
    return (groups(store, "intersection")
            .select(F.col("key").alias("intersection"), F.col("n").alias("crash_count"), "fatal", "pedestrian", "bicycle",
                    _mean("lat").alias("lat"), _mean("lng").alias("lng"))
            .orderBy(F.desc("crash_count"), F.asc("intersection")).limit(k))


def hex_heatmap(store: TableStore, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """A9, both resolutions."""
    cells = None
    for label in CELLS:
        one = groups(store, f"cell{label}").withColumn("resolution", F.lit(label))
        cells = one if cells is None else cells.unionByName(one)
    cells = (cells.select(F.col("key").alias("h3_index"), F.col("n").alias("crash_count"), F.col("fatal").alias("fatal_count"),
                          F.col("pedestrian").alias("pedestrian_count"), F.col("bicycle").alias("bicycle_count"),
                          F.col("score").alias("severity_score"), _mean("lat").alias("center_lat"), _mean("lng").alias("center_lng"),
                          "resolution"))
    ring = heatmap.boundary_for(F.col("resolution"), F.col("h3_index"), C.HEATMAP_RESOLUTIONS, origin)
    return (cells.withColumn("boundary", ring).filter(F.col("boundary").isNotNull())
            .select("h3_index", "crash_count", "fatal_count", "pedestrian_count", "bicycle_count", "severity_score",
                    "center_lat", "center_lng", "boundary", "resolution"))


def totals(store: TableStore) -> DataFrame:
    """Totals, severities, dates and school zone in one row."""
    return groups(store, "all").select(F.col("n").alias("total_crashes"), *C.SEVERITY_LABELS, "first_date", "last_date",
                                       F.col("near").alias("school_zone_crashes"), F.col("near_fatal").alias("school_zone_fatal"),
                                       F.col("n_geometry").alias("with_geometry"))


def distinct_cells(store: TableStore) -> DataFrame:
    """A10: per resolution the distinct cells, exact from the groups and estimated from the sketches."""
    exact = (store.read(STATE).filter(F.col("grain").startswith("cell")).select("grain", "key").distinct()
             .groupBy("grain").agg(F.count(F.lit(1)).alias("cells")))
    merged = store.read(SKETCHES).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"cells{c}")).alias(f"cell{c}") for c in CELLS])
    pairs = F.explode(F.array(*[F.struct(F.lit(f"cell{c}").alias("grain"), F.col(f"cell{c}").alias("estimate")) for c in CELLS]))
    return merged.select(pairs.alias("e")).select("e.*").join(exact, "grain").select("grain", "cells", "estimate")
