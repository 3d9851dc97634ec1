"""Bronze -> silver cleaning and enrichment (P1-P11), all native expressions.

Parsing uses ``try_cast`` / ``try_to_date`` because ANSI mode (the Spark 4
default) raises on ``cast('' as double)``; the bronze layer writes '' for
missing values, so every parse must tolerate it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadrisk import config as C
from roadrisk.functions import geo, hexgrid, severity


def parse_incidents(bronze: DataFrame, pad_time: bool = False) -> DataFrame:
    """latitude/longitude doubles, crash_date, crash_hour.

    The hour is the first two characters of ``time_occ`` (so '930' gives 93,
    as in the source rule); ``pad_time=True`` left-pads to four digits first.
    """
    t = F.col("time_occ")
    if pad_time:
        t = F.lpad(t, 4, "0")
    return (bronze
            .withColumn("latitude", F.col("lat").try_cast("double"))
            .withColumn("longitude", F.col("lon").try_cast("double"))
            .withColumn("crash_date", F.try_to_date(F.col("date_occ")))
            .withColumn("crash_hour", F.substring(t, 1, 2).try_cast("int")))


def valid_coordinates(df: DataFrame) -> DataFrame:
    """P5: drop NULL and zero coordinates."""
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                     & (F.col("latitude") != 0.0) & (F.col("longitude") != 0.0))


def bbox_filter(df: DataFrame, lat_min: float = C.LAT_MIN, lat_max: float = C.LAT_MAX,
                lon_min: float = C.LON_MIN, lon_max: float = C.LON_MAX) -> DataFrame:
    """Inclusive bounding box."""
    return df.filter(F.col("latitude").between(lat_min, lat_max)
                     & F.col("longitude").between(lon_min, lon_max))


def dedupe(df: DataFrame, key: str = "dr_no", order_cols: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest row in the total order of `order_cols`
    (then of the other columns).

    ``row_number() = 1`` per key. Spark keeps only the first row of each key on
    the map side before the one shuffle (its window group limit), so a key with
    millions of copies moves one row per map task, not all of them.
    """
    cols = order_cols or [c for c in df.columns if c != key]
    others = [c for c in df.columns if c != key and c not in cols]
    first = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in cols + others]))
    return df.withColumn("_nth", first).filter(F.col("_nth") == 1).drop("_nth")


def clean_incidents(bronze: DataFrame, pad_time: bool = False, **bbox) -> DataFrame:
    """P1-P7 in the source order: parse, drop invalid, box, dedupe."""
    base_cols = bronze.columns
    parsed = bbox_filter(valid_coordinates(parse_incidents(bronze, pad_time)), **bbox)
    return dedupe(parsed, "dr_no", [c for c in base_cols if c != "dr_no"])


def add_severity(df: DataFrame) -> DataFrame:
    """P8."""
    return df.withColumn("severity", severity.severity_label(F.col("mocodes"), F.col("crm_cd_desc")))


def add_calendar(df: DataFrame) -> DataFrame:
    """crash_year, crash_month, year_month from crash_date."""
    d = F.col("crash_date")
    return (df.withColumn("crash_year", F.year(d))
            .withColumn("crash_month", F.month(d))
            .withColumn("year_month", F.date_format(d, "yyyy-MM")))


def intersection_label(location, cross_street):
    """P9: 'location / cross' when the cross street is non-empty, else location.

    '' is the bronze marker for missing, so an empty location becomes NULL
    here and is excluded by the top-intersection filter.
    """
    loc = F.nullif(location, F.lit(""))
    return F.when(cross_street.isNotNull() & (cross_street != F.lit("")),
                  F.concat(loc, F.lit(" / "), cross_street)).otherwise(loc)


def add_intersection(df: DataFrame) -> DataFrame:
    return df.withColumn("intersection", intersection_label(F.col("location"), F.col("cross_street")))


def add_hex_cells(df: DataFrame, resolutions=C.HEATMAP_RESOLUTIONS, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """Hex id per resolution (columns ``h3_res<label>``), rows without a
    fine cell dropped. Ids are native hex ids ``"<label>:<q>:<r>"``, counted
    from ``origin``."""
    out = df
    for label, edge in resolutions:
        cell = hexgrid.hex_of_lonlat(F.col("longitude"), F.col("latitude"), edge, origin)
        hid = F.when(F.col("latitude").isNull() | F.col("longitude").isNull(), F.lit(None).cast("string")) \
            .otherwise(hexgrid.hex_id(label, cell["q"], cell["r"]))
        out = out.withColumn(f"h3_res{label}", hid)
    finest = resolutions[0][0]
    return out.filter(F.col(f"h3_res{finest}").isNotNull())


def add_geometry(df: DataFrame, srid: int = 4326) -> DataFrame:
    """P10: point as struct<lon, lat, srid>."""
    return df.withColumn("geometry", F.struct(F.col("longitude").alias("lon"),
                                              F.col("latitude").alias("lat"),
                                              F.lit(srid).alias("srid")))


def enrich(clean: DataFrame, resolutions=C.HEATMAP_RESOLUTIONS, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """P4, P8-P11 on cleaned rows."""
    return add_geometry(add_hex_cells(add_intersection(add_calendar(add_severity(clean))), resolutions, origin))
