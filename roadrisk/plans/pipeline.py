"""The bronze -> silver chain as lazy DataFrames.

``bronze`` and ``schools`` build the raw layers from the harness tables;
``silver`` cleans and enriches; ``write_silver`` stores it for the gold steps
of a run. Gold operators take silver and return a DataFrame each. Building
silver counts the schools (one small job, see ``operators.proximity``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadrisk import config as C
from roadrisk.operators import clean, proximity
from roadrisk.sources import fixtures, ingest
from roadrisk.sources.tables import TableStore


def bronze(spark: SparkSession, sf_dir: str, since: str | None = C.INGEST_SINCE) -> DataFrame:
    """Bronze incidents (14 strings + crash_year) from the events table."""
    return ingest.normalise_incidents(fixtures.incidents_raw(spark, sf_dir), since=since)


def bronze_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.normalise_schools(fixtures.schools_raw(spark, sf_dir))


def schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schools with parsed coordinates (school_lat, school_lon)."""
    return ingest.school_points(bronze_schools(spark, sf_dir))


def silver_from(bronze_df: DataFrame, schools_df: DataFrame | None,
                radius_m: float = C.SCHOOL_RADIUS_M) -> DataFrame:
    cleaned = clean.clean_incidents(bronze_df)
    return proximity.add_near_school(clean.enrich(cleaned), schools_df, radius_m)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a lazy plan over the raw tables, listed anew on every call."""
    return silver_from(bronze(spark, sf_dir), schools(spark, sf_dir))


def write_silver(store: TableStore, silver_df: DataFrame, name: str = "silver_crashes") -> DataFrame:
    """Store silver once, partitioned by crash_year, and return its scan. A run
    with several gold steps reads this table instead of cleaning, deduplicating
    and joining again for each of them."""
    store.write(silver_df, name, partition_by=["crash_year"])
    return store.read(name).select(*silver_df.columns)


def read_silver(store: TableStore, years: list[int] | None = None, name: str = "silver_crashes") -> DataFrame:
    """The stored silver table; ``years`` reads only those folders."""
    return store.read(name, years=years)


def silver_from_store(store: TableStore, schools_df: DataFrame | None, years: list[int] | None = None,
                      bronze_table: str = "bronze_crashes", radius_m: float = C.SCHOOL_RADIUS_M) -> DataFrame:
    """Silver from the stored bronze table (partitioned by crash_year).

    ``years`` restricts the scan to those partitions, so a gold run over
    one year reads one year's folders; every gold operator takes the result.
    """
    return silver_from(store.read(bronze_table, years=years), schools_df, radius_m)
