"""Incremental upsert of silver (S1, S3, P7): new pages change only the years they touch.

A page of incidents may hold new records, corrected ones and ones that are known
already. The newest version of a record decides: of two pages the one with the larger
number, within a page the smallest row (P7). A newest version that isn't valid
(no coordinates, outside the box) takes the incident out of silver.

Next to silver, partitioned by crash_year, lies a log of versions (key, page, digest of
the raw record, the year in which silver holds it), partitioned by page. ``apply_page``

1. looks up the page's keys in the log (four narrow columns, a left semi join, the
   newest entry per key kept on the map side) and drops the records whose digest is the
   same or whose known version is from a later page;
2. cleans and enriches only the changed records;
3. reads only the touched years of silver, those where a changed record was or is now,
   takes the changed keys out by an anti join, adds the new rows and overwrites these
   partitions dynamically. All other partitions keep their files. A year left without
   rows loses its folder;
4. appends the page's changed versions to the log.

The result equals a rebuild from all pages (``rebuild``). A page that is applied again
changes nothing. A run that breaks between steps 3 and 4 is repeated by applying the page
again: the log then doesn't know it, and taking keys out before adding rows makes the
second application end in the same tables. New partitions are written to a table of
their own first, so a lost executor never meets a half-replaced silver table.

Nothing passes the driver but the list of touched years.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadrisk import config as C
from roadrisk.operators import clean, proximity
from roadrisk.sources.tables import TableStore, remove_temporary, run_folder

SILVER = "silver_crashes"
LOG = "silver_versions"
KEY = "dr_no"
YEAR = "crash_year"


class Change(NamedTuple):
    """What a page did: the years whose partitions were rewritten and how many records changed."""

    years: list[int]
    changed: int


def page_versions(bronze: DataFrame) -> DataFrame:
    """One version per key of a bronze page, with ``_digest`` of its raw fields."""
    fields = [c for c in bronze.columns if c != YEAR]
    one = clean.dedupe(bronze, KEY, [c for c in bronze.columns if c != KEY])
    return one.withColumn("_digest", F.md5(F.to_json(F.struct(*fields))))


def silver_rows(versions: DataFrame, schools: DataFrame | None, radius_m: float = C.SCHOOL_RADIUS_M) -> DataFrame:
    """Silver of records that are one per key already: no dedupe, so no shuffle."""
    valid = clean.bbox_filter(clean.valid_coordinates(clean.parse_incidents(versions)))
    return proximity.add_near_school(clean.enrich(valid), schools, radius_m)


def newest_versions(pages: DataFrame) -> DataFrame:
    """The newest version of every key of bronze rows with a column ``page``."""
    order = [c for c in pages.columns if c not in (KEY, "page")]
    turned = pages.withColumn("_age", -F.col("page"))
    return clean.dedupe(turned, KEY, ["_age", *order]).drop("_age", "page")


def rebuild(pages: DataFrame, schools: DataFrame | None) -> DataFrame:
    """Silver from all pages at once: what any order of upserts ends in."""
    return silver_rows(newest_versions(pages), schools)


def _stored(spark: SparkSession, df: DataFrame, folders: list[str], name: str) -> DataFrame:
    folders.append(run_folder(spark, name))
    df.write.parquet(folders[-1])
    return spark.read.schema(df.schema).parquet(folders[-1])


def _in_years(years: list[int | None]) -> F.Column:
    known = [y for y in years if y is not None]
    found = F.col(YEAR).isin(known) if known else F.lit(False)
    return found | F.col(YEAR).isNull() if None in years else found


def changed_versions(versions: DataFrame, page: int, log: DataFrame | None) -> DataFrame:
    """The versions that differ from what the log knows, with ``_was``, the year in which
    silver holds the key now (NULL: in none)."""
    if log is None:
        return versions.withColumn("_was", F.lit(None).cast("int"))
    known = log.join(versions.select(KEY), KEY, "left_semi")
    newest = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc("page")))
    known = (known.withColumn("_nth", newest).filter("_nth = 1")
             .select(F.col(KEY).alias("_key"), F.col("page").alias("_page"), F.col("digest").alias("_old"), F.col("year").alias("_was")))
    both = versions.join(known, F.col(KEY) == F.col("_key"), "left")
    news = F.col("_key").isNull() | ((F.col("_page") <= page) & (F.col("_old") != F.col("_digest")))
    return both.filter(news).drop("_key", "_page", "_old")


def apply_page(store: TableStore, page: int, bronze: DataFrame, schools: DataFrame | None,
               radius_m: float = C.SCHOOL_RADIUS_M) -> Change:
    """Bring silver up to date with one page of bronze incidents; ``page`` numbers grow with time."""
    spark = store.spark
    folders: list[str] = []
    try:
        log = store.read(LOG) if store.exists(LOG) else None
        changed = _stored(spark, changed_versions(page_versions(bronze), page, log), folders, "upsert-changed")
        fresh = _stored(spark, silver_rows(changed.drop("_digest", "_was"), schools, radius_m), folders, "upsert-fresh")
        here, there = (df.select(F.col(c).alias(YEAR)).distinct() for df, c in ((fresh, YEAR), (changed.filter("_was IS NOT NULL"), "_was")))
        touched = [r[0] for r in here.union(there).distinct().collect()]
        count = changed.count()
        if touched:
            rows = fresh
            if store.exists(SILVER):
                old = store.read(SILVER).filter(_in_years(touched)).select(*fresh.columns)
                gone = changed.filter("_was IS NOT NULL").select(KEY)
                # a broken run may have added keys that the log doesn't know, so all changed keys leave
                gone = gone.unionByName(fresh.select(KEY)).distinct()
                rows = _stored(spark, old.join(gone, KEY, "left_anti").unionByName(fresh), folders, "upsert-years")
            store.replace_partitions(rows, SILVER, [YEAR])
            left = {r[0] for r in rows.select(YEAR).distinct().collect()}
            for year in touched:
                if year not in left and year is not None:
                    store.drop_partition(SILVER, YEAR, year)
        if count:
            years = fresh.select(F.col(KEY).alias("_key"), F.col(YEAR).alias("year"))
            entries = (changed.select(KEY, F.col("_digest").alias("digest")).join(years, F.col(KEY) == F.col("_key"), "left")
                       .select(KEY, "digest", F.col("year").cast("int").alias("year"), F.lit(page).cast("int").alias("page")))
            if log is not None:  # entries of the same page that an earlier application made
                kept = log.filter(F.col("page") == page).join(changed.select(KEY), KEY, "left_anti").select(*entries.columns)
                entries = _stored(spark, entries.unionByName(kept), folders, "upsert-log")
            store.replace_partitions(entries, LOG, ["page"])
    finally:
        if folders:
            remove_temporary(*folders)
    return Change(sorted(y for y in touched if y is not None), count)


def read_upserted(store: TableStore, years: list[int] | None = None) -> DataFrame:
    return store.read(SILVER, years=years)
