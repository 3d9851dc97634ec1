"""Gi* hot spots (G1), space-time emerging hot spots (G2), trend counts.

Semantics (the source only calls a closed package, so these are ours, from
the published methods):

* Bins: pointy-top hexagons, ``bin_m`` flat-to-flat.
* Study area: every hexagon in the rectangle of occupied offset columns x
  rows, so empty bins count: ``n = (c1-c0+1)(r1-r0+1)``.
* Neighbourhood: all cells within ``rings`` steps, the focal cell included,
  clipped to the study rectangle (binary weights).
* Gi*: ``z = (sum_x - xbar*W) / (S*sqrt((n*W - W^2)/(n-1)))``.

Plan shape: incidents are counted per bin (map-side combined), each occupied
bin is fanned out to its neighbours (37 rows for 3 rings) and summed by
target bin. There is no pairwise join and no grouping of raw incidents by
bin beyond a count, so a bin holding a third of all incidents costs one row
after the partial aggregate. Global sums come back as one scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo, hexgrid, stats
from roadrisk.sources.tables import ensure_checkpoint_dir


def _bin_cells(points: DataFrame, edge: float, origin: geo.Origin, *extra) -> DataFrame:
    c = hexgrid.hex_of_lonlat(F.col("longitude"), F.col("latitude"), edge, origin)
    return points.select(c["q"].alias("q"), c["r"].alias("r"), *extra)


def _rect_stats(counts: DataFrame, *extra) -> F.Column:
    """Scalar subquery: study rectangle and count sums as one struct."""
    col = hexgrid.offset_col(F.col("q"), F.col("r"))
    return counts.agg(F.struct(
        F.min(col).alias("c0"), F.max(col).alias("c1"),
        F.min("r").alias("r0"), F.max("r").alias("r1"),
        F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("sumsq"),
        *extra)).scalar()


RECT = ("c0", "c1", "r0", "r1")
# Up to this many time steps the Mann-Kendall sum is unrolled (496 terms).
MK_UNROLL_MAX_STEPS = 32


def _with_stats(df: DataFrame, st) -> DataFrame:
    """Attach the scalar subquery once, as a struct column ``_st``.

    Every ``st[field]`` written inline would be a separate subquery (planned
    and run once per reference); one column read by plain field access runs
    it once. Higher-order functions also cannot read a subquery directly.
    """
    return df.withColumn("_st", st)


def _rect_cols():
    return [F.col(f"_st.{k}") for k in RECT]


def _z(sum_x, w, n, total, sumsq):
    xbar = stats.global_mean(total, n)
    s = stats.global_sd(sumsq, n, xbar)
    return stats.gi_star_z(sum_x, w, n, xbar, s)


def _n_cells():
    st = F.col("_st")
    return (st["c1"] - st["c0"] + 1) * (st["r1"] - st["r0"] + 1)


def hot_spots(points: DataFrame, bin_m: float = C.HOTSPOT_BIN_M, rings: int = C.HOTSPOT_RINGS,
              label: str | None = None, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """G1: one row per occupied bin: bin_id, q, r, crash_count, neighbourhood
    sum and weight, z_score, p_value, classification."""
    edge = hexgrid.edge_from_flat_width(bin_m)
    label = label or f"{bin_m:g}m"
    offs = hexgrid.ring_offsets(rings)
    counts = _bin_cells(points, edge, origin).groupBy("q", "r").agg(F.count(F.lit(1)).alias("x"))
    fan = (counts.select("q", "r", "x", F.explode(hexgrid.offsets_array(offs)).alias("o"))
           .select((F.col("q") + F.col("o.dq")).alias("q"), (F.col("r") + F.col("o.dr")).alias("r"), "x",
                   ((F.col("o.dq") == 0) & (F.col("o.dr") == 0)).alias("self")))
    nb = (fan.groupBy("q", "r")
          .agg(F.sum("x").alias("sum_x"), F.max(F.when(F.col("self"), F.col("x"))).alias("crash_count"))
          .filter(F.col("crash_count").isNotNull()))
    w = hexgrid.cells_in_rect(F.col("q"), F.col("r"), offs, *_rect_cols())
    z = _z(F.col("sum_x"), F.col("w"), _n_cells(), F.col("_st.total"), F.col("_st.sumsq"))
    return (_with_stats(nb, _rect_stats(counts)).withColumn("w", w)
            .withColumn("z_score", z)
            .withColumn("p_value", stats.two_sided_p(F.col("z_score")))
            .withColumn("classification", stats.classify_z(F.col("z_score")))
            .select(hexgrid.hex_id(label, F.col("q"), F.col("r")).alias("bin_id"), "q", "r",
                    "crash_count", "sum_x", "w", "z_score", "p_value", "classification"))


def month_index(d) -> F.Column:
    return F.year(d) * 12 + F.month(d) - 1


def emerging_hot_spots(points: DataFrame, bin_m: float = C.HOTSPOT_BIN_M, rings: int = C.HOTSPOT_RINGS,
                       step_months: int = C.EMERGING_STEP_MONTHS, date_col: str = "crash_date",
                       label: str | None = None, origin: geo.Origin = geo.ORIGIN) -> DataFrame:
    """Gi* per (bin, time step) with a space-time neighbourhood
    (spatial rings x {t, t-1}), then a Mann-Kendall trend per bin.

    Every bin occupied at any time gets every step; ``n`` = cells x steps.
    Output: bin_id, q, r, trend, quarters_hot, latest_z, mk_z, n_steps.
    """
    edge = hexgrid.edge_from_flat_width(bin_m)
    label = label or f"{bin_m:g}m"
    offs = hexgrid.ring_offsets(rings)
    pts = _bin_cells(points.filter(F.col(date_col).isNotNull()), edge, origin, month_index(F.col(date_col)).alias("m"))
    # Count per (bin, month) first and checkpoint it (one row per occupied bin
    # and month): the month range, the study rectangle and the main plan all
    # read this small table, so the incidents are scanned once and the
    # lineage is cut there.
    ensure_checkpoint_dir(points.sparkSession)
    monthly = pts.groupBy("q", "r", "m").agg(F.count(F.lit(1)).alias("x")).checkpoint()
    # First and last month (one small job on the checkpoint): the step origin,
    # and the step count used to unroll Mann-Kendall below.
    m_lo, m_hi = monthly.agg(F.min("m"), F.max("m")).first()
    t_steps = 0 if m_lo is None else (m_hi - m_lo) // step_months + 1
    m0 = F.lit(m_lo).cast("int")
    counts = (monthly.withColumn("step", F.floor((F.col("m") - m0) / F.lit(step_months)).cast("int"))
              .groupBy("q", "r", "step").agg(F.sum("x").alias("x")))
    st = _rect_stats(counts, (F.max("step") + 1).alias("t"))
    st_offs = F.array(*[F.struct(F.lit(dq).alias("dq"), F.lit(dr).alias("dr"), F.lit(dt).alias("dt"))
                        for dq, dr in offs for dt in (0, 1)])
    # Sums for steps past the last one are dropped by the left join from the grid.
    nb = (counts.select("q", "r", "step", "x", F.explode(st_offs).alias("o"))
          .select((F.col("q") + F.col("o.dq")).alias("q"), (F.col("r") + F.col("o.dr")).alias("r"),
                  (F.col("step") + F.col("o.dt")).alias("step"), "x")
          .groupBy("q", "r", "step").agg(F.sum("x").alias("sum_x")))
    w_space = hexgrid.cells_in_rect(F.col("q"), F.col("r"), offs, *_rect_cols())
    grid = (_with_stats(counts.select("q", "r").distinct(), st)
            .withColumn("w_space", w_space)
            .select("q", "r", "w_space", "_st", F.explode(F.sequence(F.lit(0), F.col("_st.t") - 1)).alias("step")))
    w = F.col("w_space") * F.when(F.col("step") == 0, F.lit(1)).otherwise(F.lit(2))
    n = _n_cells() * F.col("_st.t")
    cube = (grid.join(nb, ["q", "r", "step"], "left")
            .withColumn("sum_x", F.coalesce(F.col("sum_x"), F.lit(0).cast("bigint")))
            .withColumn("z", _z(F.col("sum_x"), w, n, F.col("_st.total"), F.col("_st.sumsq"))))
    per_bin = (cube.groupBy("q", "r")
               .agg(F.array_sort(F.collect_list(F.struct("step", "z"))).alias("series"),
                    F.count_if(F.col("z") >= geo.lit(C.HOT_Z)).alias("quarters_hot"),
                    F.max_by("z", "step").alias("latest_z"),
                    F.count(F.lit(1)).alias("n_steps")))
    # Every bin has one z per step, so with few steps S is unrolled into
    # generated code.
    zs = F.col("_zs")
    mk_s = (stats.mann_kendall_s_fixed(zs, t_steps) if 0 < t_steps <= MK_UNROLL_MAX_STEPS
            else stats.mann_kendall_s(zs))
    per_bin = (per_bin.withColumn("_zs", F.transform("series", lambda e: e["z"]))
               .withColumn("mk_z", stats.mann_kendall_z(mk_s, F.col("n_steps")))
               .drop("_zs"))
    return per_bin.select(hexgrid.hex_id(label, F.col("q"), F.col("r")).alias("bin_id"), "q", "r",
                          trend_label(F.col("quarters_hot"), F.col("n_steps"), F.col("latest_z"), F.col("mk_z"))
                          .alias("trend"),
                          "quarters_hot", "latest_z", "mk_z", "n_steps")


def trend_label(hot, steps, latest_z, mk_z) -> F.Column:
    """First match: no hot step -> none; latest not hot -> historical when hot
    in >= 90 % of steps else sporadic; latest hot -> new when it is the only
    hot step, else (>= 90 % hot) intensifying / diminishing / persistent by
    the Mann-Kendall z, else sporadic."""
    latest_hot = F.coalesce(latest_z >= geo.lit(C.HOT_Z), F.lit(False))
    mostly = hot.cast("double") >= geo.lit(C.PERSIST_FRACTION) * steps.cast("double")
    return (F.when(hot == 0, F.lit("none"))
            .when(~latest_hot & mostly, F.lit("historical"))
            .when(~latest_hot, F.lit("sporadic"))
            .when(hot == 1, F.lit("new"))
            .when(mostly & (mk_z >= geo.lit(C.MK_Z)), F.lit("intensifying"))
            .when(mostly & (mk_z <= geo.lit(-C.MK_Z)), F.lit("diminishing"))
            .when(mostly, F.lit("persistent"))
            .otherwise(F.lit("sporadic")))


def trend_breakdown(emerging: DataFrame) -> DataFrame:
    """Bins per trend, largest first."""
    return (emerging.groupBy("trend").agg(F.count(F.lit(1)).alias("bins"))
            .orderBy(F.desc("bins"), F.asc("trend")))
