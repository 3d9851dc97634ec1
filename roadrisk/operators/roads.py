"""Road preprocessing (R1-R8, W1-W3): way documents -> coloured polylines.

Per-road work that only looks at one road's own points (rounding, dropping
repeats, path length, sub-path slicing) runs as higher-order functions on
the road's array, inside its row: no shuffle, no Python. Douglas-Peucker is
iterative, so it runs as a Spark job over all roads at once: a frontier of
intervals, one aggregate, one join and one written table per round.
The colour cycle needs a running count of kept roads per source file, which
``indexing.running_index`` computes without a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import color, geo
from roadrisk.operators.indexing import running_index
from roadrisk.sources.tables import delete_path, ensure_checkpoint_dir, run_folder

KEY = ["source", "pos"]


def clean_ways(ways: DataFrame) -> DataFrame:
    """Keep ``way`` elements with at least two geometry points."""
    return ways.filter((F.col("type") == F.lit("way")) & F.col("geometry").isNotNull()
                       & (F.size("geometry") >= 2))


def dedup_points(ways: DataFrame, decimals: int = C.ROAD_ROUND_DECIMALS) -> DataFrame:
    """R2 + W2: ``points`` = [lon, lat] rounded half-up to `decimals`, a point
    equal to the previous one dropped; ways left with < 2 points dropped.

    On the 10^-d grid two rounded points are either equal or at least one
    grid step apart, so "equal to the previous point" is the same rule as
    "within 1e-6 of the last kept point"."""
    rounded = F.transform("geometry", lambda g: F.array(geo.round_half_up(g["lon"], decimals),
                                                        geo.round_half_up(g["lat"], decimals)))
    # Generators end both steps: the last filter reads their arrays. Otherwise it would move down to the
    # scan, whatever its splits, with the rounding of the whole path built anew for each point.
    kept = F.filter("_r", lambda p, i: (i == 0) | (p != F.element_at(F.col("_r"), i)))
    return (ways.withColumn("_r", F.explode(F.array(rounded)))
            .withColumn("points", F.explode(F.array(kept)))
            .drop("_r")
            .filter(F.size("points") >= 2))


def simplify(paths: DataFrame, key: list[str] = KEY, points_col: str = "points",
             eps: float = C.SIMPLIFY_EPS_DEG, carry: list[str] | None = None) -> DataFrame:
    """Douglas-Peucker over every path at once -> ``key + carry + [idx, lon,
    lat]`` of the kept points (idx = position in the input array).

    State is the set of interior points still inside an open interval, each
    carrying its interval (lo, hi) and endpoint coordinates, which it gets from
    its own path's row when that is exploded. A round takes, per interval, the
    point with the largest distance to the chord (ties to the lower index) as
    ``max(struct(d, -idx))`` (partially aggregated, so a long road does not load
    one task), splits where d > eps, marks the split point as kept and
    re-labels the others. Finished intervals drop out, so the state shrinks
    every round, and the loop ends when no interval splits: there is no round
    limit. Each round is one table in a folder of its own below the shared one;
    the kept points are checkpointed at the end and the folder is deleted.
    """
    spark = paths.sparkSession
    ensure_checkpoint_dir(spark)
    carry = carry or []
    folder = run_folder(spark, "simplify")

    def saved(df: DataFrame, number: int) -> DataFrame:
        df.write.parquet(f"{folder}/round={number}")
        return spark.read.schema(df.schema).parquet(f"{folder}/round={number}")

    first, last = F.element_at(points_col, 1), F.element_at(points_col, -1)
    xy = lambda p, x, y: [p.getItem(0).alias(x), p.getItem(1).alias(y)]
    points = paths.select(*key, *carry, F.posexplode(points_col).alias("idx", "pt"), (F.size(points_col) - 1).alias("hi"),
                          first.alias("a"), last.alias("b"))
    state = saved(points.select(
        *key, *carry, "idx", *xy(F.col("pt"), "lon", "lat"), F.lit(0).alias("lo"), "hi",
        *xy(F.col("a"), "alon", "alat"), *xy(F.col("b"), "blon", "blat"),
        ((F.col("idx") == 0) | (F.col("idx") == F.col("hi"))).alias("kept")), 0)
    out, rounds, iv = [*key, *carry, "idx", "lon", "lat"], [state], key + ["lo"]
    d = geo.point_segment_distance(F.col("lon"), F.col("lat"), F.col("alon"), F.col("alat"),
                                   F.col("blon"), F.col("blat"))
    while True:
        active = state.filter(~F.col("kept"))
        splits = (active.withColumn("d", d)
                  .groupBy(*iv).agg(F.max(F.struct("d", (-F.col("idx")).alias("nidx"), "lon", "lat")).alias("m"))
                  .filter(F.col("m.d") > geo.lit(eps))
                  .select(*iv, (-F.col("m.nidx")).alias("s"), F.col("m.lon").alias("slon"),
                          F.col("m.lat").alias("slat")))
        right = F.col("idx") > F.col("s")
        state = saved(active.join(splits, iv).select(
            *key, *carry, "idx", "lon", "lat",
            F.when(right, F.col("s")).otherwise(F.col("lo")).alias("lo"),
            F.when(right, F.col("hi")).otherwise(F.col("s")).alias("hi"),
            F.when(right, F.col("slon")).otherwise(F.col("alon")).alias("alon"),
            F.when(right, F.col("slat")).otherwise(F.col("alat")).alias("alat"),
            F.when(right, F.col("blon")).otherwise(F.col("slon")).alias("blon"),
            F.when(right, F.col("blat")).otherwise(F.col("slat")).alias("blat"),
            (F.col("idx") == F.col("s")).alias("kept")), len(rounds))
        if state.isEmpty():
            break
        rounds.append(state)
    kept = rounds[0].filter("kept").select(*out)
    for r in rounds[1:]:
        kept = kept.unionByName(r.filter("kept").select(*out))
    kept = kept.checkpoint()
    delete_path(spark, folder)
    return kept


def assemble(kept: DataFrame, key: list[str] = KEY, out_col: str = "path") -> DataFrame:
    """Kept points -> one ordered ``array<array<double>>`` per path (bounded
    by the path's own input array)."""
    return (kept.groupBy(*key)
            .agg(F.array_sort(F.collect_list(F.struct("idx", "lon", "lat"))).alias("_p"))
            .select(*key, F.transform("_p", lambda e: F.array(e["lon"], e["lat"])).alias(out_col)))


def path_length(path) -> F.Column:
    """Planar length, summed segment by segment in path order."""
    n = F.size(path)
    seg = lambda i: geo.planar_distance(
        F.element_at(path, i)[0], F.element_at(path, i)[1],
        F.element_at(path, i + 1)[0], F.element_at(path, i + 1)[1])
    return F.when(n < 2, geo.lit(0.0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), geo.lit(0.0), lambda acc, i: acc + seg(i)))


def highway_class(tags) -> F.Column:
    h = tags.getItem("highway")
    return F.when(h.isNull() | (h == F.lit("")), F.lit(C.DEFAULT_HIGHWAY)).otherwise(h)


def simplified_paths(ways: DataFrame, eps: float = C.SIMPLIFY_EPS_DEG) -> DataFrame:
    """R1-R4 before the length filter: source, pos, id, highway, path, length."""
    meta = ["id", "highway"]
    cleaned = dedup_points(clean_ways(ways)).select(*KEY, "id", highway_class(F.col("tags")).alias("highway"), "points")
    return assemble(simplify(cleaned, eps=eps, carry=meta), KEY + meta).withColumn("length", path_length(F.col("path")))


def trajectories(ways: DataFrame, eps: float = C.SIMPLIFY_EPS_DEG,
                 min_length: float = C.MIN_PATH_LENGTH_DEG) -> DataFrame:
    """Kept, simplified, coloured trajectories.

    Columns: source, pos, id, highway, path, length, traj_index (running
    index of kept roads in its source file), color_index, color.

    The kept roads are checkpointed before the running index (which reads
    them twice) and the result once more, since callers read it twice
    (originals and sub-paths); both are one row per road."""
    t = simplified_paths(ways, eps).filter(
        (F.size("path") >= 2) & (F.col("length") >= geo.lit(min_length))).checkpoint()
    t = running_index(t, "source", "pos", "traj_index")
    cidx = (F.col("traj_index") % len(C.ROAD_PALETTE)).cast("int")
    for cls, i in reversed(list(C.HIGHWAY_COLOR_INDEX.items())):
        cidx = F.when(F.col("highway") == F.lit(cls), F.lit(i)).otherwise(cidx)
    return (t.withColumn("color_index", cidx.cast("int"))
            .withColumn("color", color.palette_color(F.col("color_index")))
            .checkpoint())


def sub_paths(traj: DataFrame) -> DataFrame:
    """For paths of >= 8 points, up to 3 overlapping halves:
    n = min(3, L div 5); i < n: s = i*L div (n+1), e = min(L, s + L div 2);
    kept when e - s >= 3; colour shifted by i + 2."""
    L = F.size("path")
    n = F.least(F.lit(C.SUB_PATH_MAX_COUNT), (L / F.lit(C.SUB_PATH_DIVISOR)).cast("int"))
    base = traj.filter(L >= C.SUB_PATH_MIN_POINTS).select(
        *KEY, "id", "traj_index", "color_index", "path", L.alias("L"), n.alias("k"))
    subs = base.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("sub"))
    s = ((F.col("sub") * F.col("L")) / (F.col("k") + 1)).cast("int")
    subs = subs.withColumn("start", s).withColumn(
        "end", F.least(F.col("L"), F.col("start") + (F.col("L") / F.lit(2)).cast("int")))
    cidx = ((F.col("color_index") + F.col("sub") + C.SUB_PATH_COLOR_SHIFT) % len(C.ROAD_PALETTE)).cast("int")
    return (subs.filter(F.col("end") - F.col("start") >= C.SUB_PATH_MIN_KEEP)
            .select(*KEY, "id", "traj_index", "sub", "start", "end",
                    F.slice("path", F.col("start") + 1, F.col("end") - F.col("start")).alias("path"),
                    cidx.alias("color_index"))
            .withColumn("color", color.palette_color(F.col("color_index"))))


def all_paths(traj: DataFrame) -> DataFrame:
    """Originals followed by sub-paths, with an order key for writing."""
    orig = traj.select(*KEY, "traj_index", F.lit(-1).alias("sub"), "path", "color")
    subs = sub_paths(traj).select(*KEY, "traj_index", "sub", "path", "color")
    return orig.unionByName(subs)


def path_totals(paths: DataFrame) -> DataFrame:
    """Number of paths (originals, sub-paths) and points."""
    return paths.agg(F.count_if(F.col("sub") < 0).alias("trajectories"),
                     F.count_if(F.col("sub") >= 0).alias("sub_paths"),
                     F.count(F.lit(1)).alias("total_paths"),
                     F.sum(F.size("path")).cast("bigint").alias("total_points"))


def write_paths(paths: DataFrame, out: str) -> str:
    """``{path, color}`` records as JSON lines, originals first."""
    (paths.orderBy("source", F.when(F.col("sub") < 0, 0).otherwise(1), "traj_index", "sub")
     .select("path", "color").write.mode("overwrite").json(out))
    return out
