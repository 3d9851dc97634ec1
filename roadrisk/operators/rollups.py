"""Aggregations over silver incidents.

Severity counters are ``count_if`` columns of one aggregate, so each rollup is
one scan and one (map-side combined) shuffle, where the source ran one job
per severity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo
from roadrisk.functions.severity import count_of


def crashes_by_year(spark: SparkSession, bronze: DataFrame, view: str = "bronze_crashes") -> DataFrame:
    """A1: SQL ``GROUP BY 1 ORDER BY 1`` over the bronze table."""
    bronze.createOrReplaceTempView(view)
    return spark.sql(f"SELECT crash_year, count(*) AS cnt FROM {view} GROUP BY 1 ORDER BY 1")


def severity_breakdown(silver: DataFrame) -> DataFrame:
    """A2: count per severity, largest first (ties by label)."""
    return (silver.groupBy("severity").agg(F.count(F.lit(1)).alias("crash_count"))
            .orderBy(F.desc("crash_count"), F.asc("severity")))


def severity_counts(sev=None) -> list:
    sev = sev if sev is not None else F.col("severity")
    return [count_of(sev, label).alias(label) for label in C.SEVERITY_LABELS]


def severity_totals(silver: DataFrame) -> DataFrame:
    """A3: total and per-severity counts in one pass."""
    return silver.agg(F.count(F.lit(1)).alias("total_crashes"), *severity_counts())


def top_intersections(silver: DataFrame, k: int = C.TOP_INTERSECTIONS) -> DataFrame:
    """A5: the k intersections with most incidents (ties by name).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition
    keeps its own top k, so only k rows per partition reach the final merge.
    """
    sev = F.col("severity")
    return (silver.filter(F.col("intersection").isNotNull())
            .groupBy("intersection")
            .agg(F.count(F.lit(1)).alias("crash_count"),
                 count_of(sev, "fatal").alias("fatal"),
                 count_of(sev, "pedestrian").alias("pedestrian"),
                 count_of(sev, "bicycle").alias("bicycle"),
                 geo.exact_mean(F.col("latitude")).alias("lat"),
                 geo.exact_mean(F.col("longitude")).alias("lng"))
            .orderBy(F.desc("crash_count"), F.asc("intersection"))
            .limit(k))


def school_zone_stats(silver: DataFrame) -> DataFrame:
    """A6."""
    near = F.col("near_school") == F.lit(1)
    return silver.agg(F.count_if(near).alias("school_zone_crashes"),
                      F.count_if(near & (F.col("severity") == F.lit("fatal"))).alias("school_zone_fatal"))


def summary_stats(silver: DataFrame, k: int = C.TOP_INTERSECTIONS) -> DataFrame:
    """A4 + A7: one row: totals, severities, date range, school zone, top-k list.

    The scalar part is one aggregate; the top-k list (bounded by k) is
    attached as a scalar subquery, so there is no join.
    """
    near = F.col("near_school") == F.lit(1)
    sev = F.col("severity")
    top = top_intersections(silver, k)
    top_list = top.agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("crash_count")).alias("_order"),
        F.col("intersection").alias("name"),
        F.col("crash_count").alias("crashes"),
        "fatal", "pedestrian", "bicycle",
        geo.round_half_up(F.col("lat"), 5).alias("lat"),
        geo.round_half_up(F.col("lng"), 5).alias("lng"),
    ))).alias("items")).select(F.transform("items", lambda s: s.dropFields("_order")).alias("items"))
    return (silver.agg(
        F.count(F.lit(1)).alias("total_crashes"),
        *severity_counts(sev),
        F.min("crash_date").cast("string").alias("date_from"),
        F.max("crash_date").cast("string").alias("date_to"),
        F.count_if(near).alias("school_zone_crashes"),
        F.count_if(near & (sev == F.lit("fatal"))).alias("school_zone_fatal"))
        .withColumn("top_intersections", top_list.scalar())
        .withColumn("by_severity", F.struct(*[F.col(s) for s in C.SEVERITY_LABELS])))


def monthly_series(silver: DataFrame) -> DataFrame:
    """Per year_month: total and each severity, in month order."""
    return (silver.groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("total"), *severity_counts())
            .orderBy("year_month"))


def enrichment_summary(silver: DataFrame) -> DataFrame:
    """A10: rows, distinct fine/coarse cells, rows with geometry, near-school rows."""
    fine, coarse = (f"h3_res{C.HEATMAP_RESOLUTIONS[0][0]}", f"h3_res{C.HEATMAP_RESOLUTIONS[1][0]}")
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(F.col(fine)).alias("distinct_fine_cells"),
        F.count_distinct(F.col(coarse)).alias("distinct_coarse_cells"),
        F.count_if(F.col("geometry").isNotNull()).alias("with_geometry"),
        F.count_if(F.col("near_school") == F.lit(1)).alias("near_school"))


def top_n(df: DataFrame, col: str, tie_cols: list[str], n: int = 10) -> DataFrame:
    """First n rows by a descending column (nulls last), ties by ``tie_cols`` ascending."""
    return df.orderBy(F.desc_nulls_last(col), *[F.asc(c) for c in tie_cols]).limit(n)
