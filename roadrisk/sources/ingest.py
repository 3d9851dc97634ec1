"""Readers for landed raw files: incident pages, schools, way documents, polylines.

The source pipeline fetched pages over HTTP on the driver and built a
DataFrame from Python tuples. Here the pages are files already landed in
shared storage, read by executors with an explicit schema, so nothing passes
through the driver and the date filter runs inside the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from roadrisk import config as C


def incident_schema(fields=C.INCIDENT_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def normalise_incidents(raw: DataFrame, fields=C.INCIDENT_FIELDS, since: str | None = C.INGEST_SINCE) -> DataFrame:
    """Bronze shape: the string fields (missing -> ''), rows after `since`,
    plus the integer partition column ``crash_year``."""
    out = raw.select(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields])
    if since is not None:
        out = out.filter(F.try_to_timestamp(F.col("date_occ")) > F.lit(since).cast("timestamp"))
    return out.withColumn("crash_year", F.year(F.try_to_date(F.col("date_occ"))))


def land_json(df: DataFrame, path: str) -> str:
    """Write records as JSON lines, as an API page dump would land them
    (NULL fields are omitted)."""
    df.write.mode("overwrite").json(path)
    return path


def land_lines(lines: DataFrame, path: str) -> str:
    """Write ready-made text lines (column ``value``)."""
    lines.select("value").write.mode("overwrite").text(path)
    return path


CORRUPT = "_corrupt_record"


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``value`` and ``r``, the line's record, for every line that isn't blank."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.filter(F.trim("value") != "").withColumn("r", record)


def _broken() -> F.Column:
    return F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()


def good_records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of the lines that parse, beside the other columns of ``lines``."""
    others = [c for c in lines.columns if c != "value"]
    return _parsed(lines, schema).filter(~_broken()).select(*others, *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def rejected_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The lines that don't parse, as they are (column ``value``). Every line that
    isn't blank is either a good record or a rejected line."""
    return _parsed(lines, schema).filter(_broken()).select("value")


def ingest_incidents(spark: SparkSession, path: str, fields=C.INCIDENT_FIELDS,
                     since: str | None = C.INGEST_SINCE) -> DataFrame:
    """Landed JSON pages (one record per line) -> bronze incidents. Lines
    that don't parse are left to ``ingest_rejects``."""
    return normalise_incidents(good_records(spark.read.text(path), incident_schema(fields)), fields, since)


def ingest_rejects(spark: SparkSession, path: str, fields=C.INCIDENT_FIELDS) -> DataFrame:
    """The landed lines that ``ingest_incidents`` can't parse, to store and look into."""
    return rejected_lines(spark.read.text(path), incident_schema(fields))


def scalar_fields(schema: T.StructType) -> list[str]:
    nested = (T.StructType, T.ArrayType, T.MapType)
    return [f.name for f in schema.fields if not isinstance(f.dataType, nested)]


def normalise_schools(raw: DataFrame) -> DataFrame:
    """Scalar columns only (nested structs/arrays/maps dropped), as strings,
    missing -> ''."""
    keep = scalar_fields(raw.schema)
    return raw.select(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in keep])


def ingest_schools(spark: SparkSession, path: str) -> DataFrame:
    """Landed school records -> bronze schools."""
    return normalise_schools(spark.read.json(path))


def _find_column(columns: list[str], *candidates: str) -> str:
    lower = {c.lower(): c for c in columns}
    for cand in candidates:
        if cand in lower:
            return lower[cand]
    raise ValueError(f"none of {candidates} in {columns}")


def school_points(schools: DataFrame) -> DataFrame:
    """Find the coordinate columns by name (case-insensitive), parse,
    drop rows without both coordinates."""
    lat_c = _find_column(schools.columns, "latitude", "lat")
    lon_c = _find_column(schools.columns, "longitude", "lon")
    return (schools
            .withColumn("school_lat", F.col(lat_c).try_cast("double"))
            .withColumn("school_lon", F.col(lon_c).try_cast("double"))
            .filter(F.col("school_lat").isNotNull() & F.col("school_lon").isNotNull()))


WAY_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.ArrayType(T.StructType([
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]))),
])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files: source (file), pos (0-based, in file order, blank
    lines not counted), value. Files are split over many tasks; lines are numbered
    inside a split and shifted by the counts of the splits before it."""
    raw = (spark.read.text(path)
           .select("value", F.col("_metadata.file_path").alias("source"),
                   F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_nth"))
           .filter(F.trim("value") != ""))
    earlier = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (raw.groupBy("source", "_block").agg(F.count(F.lit(1)).alias("_n"))
              .select("source", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")))
    inside = F.row_number().over(Window.partitionBy("source", "_block").orderBy("_nth"))
    return (raw.withColumn("_in", inside).join(starts, ["source", "_block"])
            .select("source", (F.col("_start") + F.col("_in") - 1).cast("bigint").alias("pos"), "value"))


def read_ways(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Way documents -> one row per element with its source file and
    position (the order the preprocessor walks them).

    ``lines=True`` reads one element per line, the form for large extracts: a
    file is split over tasks, and lines that don't parse are left to ``way_rejects``
    (they keep their place in the count of lines). Otherwise a file is one document ``{"elements":
    [...]}``, parsed whole by one task (multi-line JSON cannot be split).
    """
    if lines:
        return good_records(numbered_lines(spark, path), WAY_SCHEMA)
    doc = (spark.read.option("multiLine", True)
           .schema(T.StructType([T.StructField("elements", T.ArrayType(WAY_SCHEMA))]))
           .json(path)
           .select(F.col("_metadata.file_path").alias("source"), "elements"))
    return doc.select("source", F.posexplode("elements").alias("pos", "e")).select("source", "pos", "e.*")


POLYLINE_SCHEMA = T.StructType([
    T.StructField("path", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("color", T.ArrayType(T.IntegerType())),
    T.StructField("name", T.StringType()),
])


def read_polylines(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``{path, color, name?}`` records -> one row per road with a stable
    ``road_index`` (its position in the file).

    ``lines=True`` reads one record per line, the form for large files; lines that
    don't parse are left to ``polyline_rejects``. Otherwise a file is a JSON array: a multi-line document is parsed by one
    task, so numbering rows within each file adds no grouping beyond what the
    read already does.
    """
    if lines:
        return good_records(numbered_lines(spark, path), POLYLINE_SCHEMA).withColumnRenamed("pos", "road_index")
    raw = (spark.read.option("multiLine", True).schema(POLYLINE_SCHEMA).json(path)
           .withColumn("source", F.col("_metadata.file_path"))
           .withColumn("_mid", F.monotonically_increasing_id()))
    return (raw.withColumn("road_index", (F.row_number().over(
                Window.partitionBy("source").orderBy("_mid")) - 1).cast("bigint"))
            .drop("_mid"))


def way_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_ways(lines=True)`` can't parse, to store and look into."""
    return rejected_lines(spark.read.text(path), WAY_SCHEMA)


def polyline_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_polylines(lines=True)`` can't parse."""
    return rejected_lines(spark.read.text(path), POLYLINE_SCHEMA)
