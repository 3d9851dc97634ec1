"""Adapters from the driver's generic tables to the pipeline's raw inputs.

The source pipeline reads police incident records, schools and road
polylines. The test harness ships TPC-H-like tables instead, so these
functions derive deterministic inputs from them with integer arithmetic
(FIXTURES.md): incidents from ``events``, schools from ``supplier`` and
roads from ``part``. Every row of output comes from a row of input, so the
work grows with the tables. All expressions are native; nothing is collected.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """Columns of a harness table. One that comes in fewer splits than the cluster has cores
    (the small tables are a single row group) is dealt out by its key first, three narrow
    columns at most, so that the text building and parsing after it runs on all cores. Larger
    inputs have more splits and are read as they are."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).select(key, *columns)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _decimal_text(micro: Column) -> Column:
    """Decimal text with 6 places of a non-negative micro-degree integer: the
    text of format_string('%d.%06d', v div 10^6, v % 10^6), built with concat
    and lpad, which cost far less per row than a format string."""
    whole = F.floor(micro / F.lit(1000000)).cast("string")
    frac = F.lpad((micro % F.lit(1000000)).cast("string"), 6, "0")
    return F.concat(whole, F.lit("."), frac)


def incident_micro_coords(e: Column, u: Column) -> tuple[Column, Column]:
    """(lat_u, lon_u) micro-degrees; lon_u is the positive magnitude.

    Twelve dense clusters keyed by user id hold 80 % of rows and a uniform
    background the rest, so hot and non-hot bins both occur.
    """
    h1 = (e * 7919 + 104729) % 10007
    h2 = (e * 6271 + 31337) % 10009
    background = (e % 5) == 0
    lat_u = F.when(background, 33800000 + h1 * 50).otherwise(
        34000000 + (u % 12) * 10000 + ((h1 % 201) - 100) * 50)
    lon_u = F.when(background, 118100000 + h2 * 50).otherwise(
        118400000 - ((u * 7) % 12) * 15000 + ((h2 % 201) - 100) * 50)
    return lat_u, lon_u


def incidents_raw(spark: SparkSession, sf_dir: str, duplicate: bool = True) -> DataFrame:
    """Raw incident records: the 14 string fields, '' or NULL for missing.

    With ``duplicate``, rows with event_id % 50 = 0 have a copy of the same
    ``dr_no`` that differs in time_occ and area_name: the copy's time is smaller
    for event_id % 100 = 0 and larger otherwise, so either of the two may be the
    row that the dedupe keeps.
    """
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts")
    e = F.col("event_id")
    u = F.col("user_id")
    lat_u, lon_u = incident_micro_coords(e, u)
    hm = F.hour("ts") * 100 + F.minute("ts")
    date = F.date_add(F.lit("2022-01-01").cast("date"), ((e * 37) % 1096).cast("int"))
    lat = (F.when(e % 101 == 0, F.lit("")).when(e % 103 == 0, F.lit("0"))
           .when(e % 107 == 0, F.lit("40.5")).otherwise(_decimal_text(lat_u)))
    lon = (F.when(e % 101 == 0, F.lit("")).when(e % 103 == 0, F.lit("0"))
           .otherwise(F.concat(F.lit("-"), _decimal_text(lon_u))))
    mocodes = (F.when(e % 40 == 0, F.lit("3036 0449")).when(e % 11 == 0, F.lit("1920"))
               .when(e % 13 == 0, F.lit(" 1822  3004")).when(e % 7 == 0, F.lit("0448"))
               .when(e % 3 == 0, F.lit("")).otherwise(F.lit(None).cast("string")))
    desc = (F.when(e % 97 == 0, F.lit("Pedestrian struck")).when(e % 89 == 0, F.lit("MOTORBIKE COLLISION"))
            .when(e % 83 == 0, F.lit("HIT AND RUN FELONY")).otherwise(F.lit("TRAFFIC COLLISION")))
    cross = (F.when(e % 4 == 0, F.lit("")).when(e % 9 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("AVE "), (u % 6).cast("string"))))
    out = ev.select(
        F.concat(F.lit("DR"), e.cast("string")).alias("dr_no"),
        F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T00:00:00.000")).alias("date_occ"),
        F.lpad(hm.cast("string"), 4, "0").alias("time_occ"),
        F.lit("Central").alias("area_name"),
        desc.alias("crm_cd_desc"),
        F.lit("").alias("vict_age"),
        F.lit("X").alias("vict_sex"),
        F.lit("").alias("vict_descent"),
        F.lit("STREET").alias("premis_desc"),
        F.concat(F.lit("STREET "), (u % 12).cast("string")).alias("location"),
        cross.alias("cross_street"),
        lat.alias("lat"),
        lon.alias("lon"),
        mocodes.alias("mocodes"),
        e.alias("_e"),
    )
    if duplicate:
        copies = F.when(F.col("_e") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        copy = F.col("_copy") == 1
        out = (out.withColumn("_copy", F.explode(copies))
               .withColumn("time_occ", F.when(copy, F.when(F.col("_e") % 100 == 0, "0000").otherwise("2359"))
                           .otherwise(F.col("time_occ")))
               .withColumn("area_name", F.when(copy, F.lit("Annex")).otherwise(F.col("area_name"))).drop("_copy"))
    # A generator ends the record: filters on a field read its text instead of building it anew for
    # every comparison, as they would read a landed file.
    return out.drop("_e").select(F.explode(F.array(F.struct(*[c for c in out.columns if c != "_e"]))).alias("_r")).select("_r.*")


def incident_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later page for ``incidents_raw``. Of the records of 2023 and 2024, those with
    event_id % 29 = 0 come again by (event_id div 29) % 5: 0 as they were, 1 with fatal
    codes and another time, 2 moved to June 2024, 3 without a latitude, 4 at another place.
    Records of 2024 with event_id % 31 = 0 also come under a new number."""
    raw = incidents_raw(spark, sf_dir, duplicate=False)
    e = F.substring("dr_no", 3, 20).cast("bigint")
    year = F.substring("date_occ", 1, 4)
    kind = F.floor(e / 29) % 5

    def put(column, *cases):
        value = F.col(column)
        for k, v in cases:
            value = F.when(F.col("_k") == k, F.lit(v)).otherwise(value)
        return value

    again = raw.withColumn("_k", kind).filter((e % 29 == 0) & (year >= F.lit("2023")))
    again = (again.withColumn("mocodes", put("mocodes", (1, "3036 0449"))).withColumn("time_occ", put("time_occ", (1, "0101")))
             .withColumn("date_occ", put("date_occ", (2, "2024-06-15T00:00:00.000")))
             .withColumn("lat", put("lat", (3, ""), (4, "34.050000"))).withColumn("lon", put("lon", (4, "-118.250000"))).drop("_k"))
    new = raw.filter((e % 31 == 0) & (year == F.lit("2024"))).withColumn("dr_no", F.concat(F.lit("N"), e.cast("string")))
    return again.unionByName(new)


def incident_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a clean point (no parsing, no filter): id, lon, lat, day offset.

    Used by the statistics tests that start from ``lat_u, lon_u`` directly.
    """
    ev = table(spark, sf_dir, "events", "event_id", "user_id")
    e = F.col("event_id")
    lat_u, lon_u = incident_micro_coords(e, F.col("user_id"))
    return ev.select(
        F.concat(F.lit("DR"), e.cast("string")).alias("dr_no"),
        (lat_u / F.lit(1e6)).alias("latitude"),
        (-lon_u / F.lit(1e6)).alias("longitude"),
        F.date_add(F.lit("2022-01-01").cast("date"), ((e * 37) % 1096).cast("int")).alias("crash_date"),
    )


def schools_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """School records as strings, one per supplier, plus one with NULL coordinates.

    Carries a nested ``address`` struct and a ``grades`` array, which the
    ingest drops (only scalar fields are kept).
    """
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    k = F.col("s_suppkey")
    lat_u = 34000000 + (k % 12) * 10000 + (((k * 61) % 201) - 100) * 45
    lon_u = 118400000 - ((k * 5) % 12) * 15000 - (((k * 43) % 201) - 100) * 45
    base = sup.select(
        F.concat(F.lit("S"), k.cast("string")).alias("school_id"),
        F.col("s_name").alias("school_name"),
        _decimal_text(lat_u).alias("latitude"),
        F.concat(F.lit("-"), _decimal_text(lon_u)).alias("longitude"),
        F.struct(F.lit("CA").alias("state"), (k % 90000).cast("string").alias("zip")).alias("address"),
        F.array(F.lit("K"), F.lit("5")).alias("grades"),
    )
    missing = (sup.filter(k == F.lit(0)).select(
        F.lit("S-missing").alias("school_id"),
        F.lit("Unplaced school").alias("school_name"),
        F.lit(None).cast("string").alias("latitude"),
        F.lit(None).cast("string").alias("longitude"),
        F.struct(F.lit("CA").alias("state"), F.lit("0").alias("zip")).alias("address"),
        F.array(F.lit("K")).alias("grades"),
    ))
    return base.unionByName(missing)


def _road_point(k: Column, i: Column) -> tuple[Column, Column]:
    """(lon, lat) degrees of waypoint i of road k."""
    step = F.when(k % 17 == 0, F.lit(40000)).otherwise(400 + (k % 5) * 150)
    lon_m = (-118400000 + ((k * 7) % 12) * 15000 + (((k * 53) % 201) - 100) * 40 + i * step)
    lat_m = (34000000 + (k % 12) * 10000 + (((k * 37) % 201) - 100) * 40 + (((i * i) * (k % 7)) % 11) * 60)
    return lon_m / F.lit(1e6), lat_m / F.lit(1e6)


def road_name(k: Column) -> Column:
    return F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("ROAD "), k.cast("string")))


def road_polylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road polylines as the corridor step reads them: road_index, path, color, name.

    ``path`` is array<array<double>> of [lon, lat]; built per row with a
    higher-order function, so no grouping is needed.
    """
    part = table(spark, sf_dir, "part", "p_partkey").select(F.col("p_partkey").alias("road_index"))
    k = F.col("road_index")

    def point(i):
        lon, lat = _road_point(k, i.cast("bigint"))
        return F.array(lon, lat)

    return part.select(
        "road_index",
        F.transform(F.sequence(F.lit(0), (k % 10).cast("int")), point).alias("path"),
        F.array(F.lit(0), F.lit(238), F.lit(255)).alias("color"),
        road_name(k).alias("name"),
    )


def raw_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Way elements as an Overpass-style document holds them, one row per element.

    struct fields: type, id, tags{highway}, geometry[{lat, lon}]. Waypoints with
    i % 3 = 0 are repeated once; highway by k % 4 (3 = absent); type 'node'
    when k % 23 = 0.
    """
    part = table(spark, sf_dir, "part", "p_partkey").select(F.col("p_partkey").alias("id"))
    k = F.col("id")

    def point(i):
        lon, lat = _road_point(k, i.cast("bigint"))
        return F.struct(lat.alias("lat"), lon.alias("lon"))

    idx = F.flatten(F.transform(
        F.sequence(F.lit(0), (k % 10).cast("int")),
        lambda i: F.when(i % 3 == 0, F.array(i, i)).otherwise(F.array(i))))
    highway = (F.when(k % 4 == 0, F.lit("motorway")).when(k % 4 == 1, F.lit("trunk"))
               .when(k % 4 == 2, F.lit("primary")).otherwise(F.lit(None).cast("string")))
    tags = F.when(highway.isNull(), F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(F.lit("highway"), highway))
    return part.select(
        F.when(k % 23 == 0, F.lit("node")).otherwise(F.lit("way")).alias("type"),
        k.alias("id"),
        tags.alias("tags"),
        F.transform(idx, point).alias("geometry"),
    ).withColumn("geometry", F.explode(F.array("geometry")))  # built once, see incidents_raw


def way_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Way elements as JSON lines (column ``value``), as an extract lands them one element per line."""
    return raw_ways(spark, sf_dir).select(F.to_json(F.struct("type", "id", "tags", "geometry")).alias("value"))


def _cut(line: Column, broken: Column) -> Column:
    """A line without its end where ``broken``, as a broken download leaves it."""
    return F.when(broken, F.substring(line, F.lit(1), F.length(line) - 9)).otherwise(line)


def broken_way_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``way_documents`` with the lines of id % 7 = 3 cut."""
    line = F.to_json(F.struct("type", "id", "tags", "geometry"))
    return raw_ways(spark, sf_dir).select(_cut(line, F.col("id") % 7 == 3).alias("value"))


def broken_polyline_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road polylines as JSON lines, those of road_index % 5 = 2 cut."""
    line = F.to_json(F.struct("path", "color", "name"))
    return road_polylines(spark, sf_dir).select(_cut(line, F.col("road_index") % 5 == 2).alias("value"))


def polyline_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road polylines as JSON lines (column ``value``); the part key is in the name."""
    return road_polylines(spark, sf_dir).select(F.to_json(F.struct(
        "path", "color", F.concat(F.lit("P"), F.col("road_index").cast("string")).alias("name"))).alias("value"))


def incident_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incidents as JSON lines (column ``value``); every line whose dr_no ends
    in 7 is cut in the middle, as a broken page leaves it."""
    raw = incidents_raw(spark, sf_dir)
    line = F.to_json(F.struct(*raw.columns))
    return raw.select(F.when(F.col("dr_no").endswith("7"), F.substring(line, F.lit(1), F.length(line) - 9)).otherwise(line).alias("value"))


def connected_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways that meet at their ends: way_id, points [lon, lat]. Each part key k is a way
    between the nodes k and k + 1 of a street of 48 keys; every third street is closed
    to a ring, the others end. Ways with k % 5 = 0 run backwards. At keys divisible by 100
    a side street leaves its node (three ends meet there), with k % 200 = 0 as a loop that
    returns to it. Keys with k % 97 = 96 have no way, so streets also break."""
    part = table(spark, sf_dir, "part", "p_partkey").select(F.col("p_partkey").cast("bigint").alias("k"))
    k = F.col("k")
    street = F.floor(k / 48)
    last = (k % 48) == 47

    def node(n):
        return F.array(n.cast("double") / F.lit(1000.0), (n % 7).cast("double") / F.lit(1000.0))

    def middle(n):
        return F.array(n.cast("double") / F.lit(1000.0) + F.lit(0.0005), F.lit(0.5))

    end = F.when(last & (street % 3 == 0), street * 48).when(last, -k - 1).otherwise(k + 1)
    main = (part.filter(k % 97 != 96).withColumn("_p", F.array(node(k), middle(k), node(end)))
            .select(k.alias("way_id"), F.when(k % 5 == 0, F.reverse("_p")).otherwise(F.col("_p")).alias("points")))
    side_end = F.when(k % 200 == 0, node(k)).otherwise(node(-k * 1000 - 7))
    side = part.filter(k % 100 == 0).select((k + 1000000000).alias("way_id"), F.array(node(k), middle(-k), side_end).alias("points"))
    return main.unionByName(side)


def ways(spark: SparkSession, sf_dir: str, source: str = "fixture") -> DataFrame:
    """Way elements with the (source, pos) key the road operators use; pos is
    the element's position, here the part key."""
    return raw_ways(spark, sf_dir).select(F.lit(source).alias("source"), F.col("id").alias("pos"), "*")
