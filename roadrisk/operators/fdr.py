"""False-discovery-rate classes of hot spots (G1): Benjamini and Hochberg's step-up rule.

Gi* tests every bin, so some are significant by chance. The adjusted value of the bin
with the j-th smallest of m p-values is the least of m * p / j over all ranks from j on;
bins whose adjusted value is at most q are hot (or cold) at a false discovery rate of q.

Ranks are global, but no task sees all rows. Equal p-values are merged first; the
distinct ones are dealt out by range, each range counts its own rows, and the counts of
the ranges before it (one number per range, added up on the driver) shift its ranks. The
least value over larger ranks comes the same way from the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadrisk.sources.tables import remove_temporary, run_folder

#: (adjusted value at most, class) for hot and cold bins, strictest first.
LEVELS = ((0.01, "99"), (0.05, "95"), (0.10, "90"))


def adjusted_p(df: DataFrame, p_col: str = "p_value", ranges: int | None = None) -> DataFrame:
    """``df`` with ``p_adjusted``. Rows without a p-value are not counted as tests and get NULL."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = run_folder(spark, "fdr")
    (df.filter(F.col(p_col).isNotNull()).groupBy(F.col(p_col).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
     .repartitionByRange(ranges, "_p").withColumn("_range", F.spark_partition_id()).write.parquet(folder))
    values = spark.read.schema("_p double, _n bigint, _range int").parquet(folder)

    sizes = {r["_range"]: r["n"] for r in values.groupBy("_range").agg(F.sum("_n").alias("n")).collect()}
    m, before, seen = sum(sizes.values()), {}, 0
    for r in sorted(sizes):
        before[r], seen = seen, seen + sizes[r]
    shift = _by_range(spark, before, "bigint")
    up_to = Window.partitionBy("_range").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (values.join(F.broadcast(shift), "_range")
              .withColumn("_v", F.least(F.lit(float(m)) * F.col("_p") / (F.sum("_n").over(up_to) + F.col("_of")).cast("double"), F.lit(1.0))))

    least = {r["_range"]: r["v"] for r in ranked.groupBy("_range").agg(F.min("_v").alias("v")).collect()}
    after, low = {}, 1.0
    for r in sorted(least, reverse=True):
        after[r], low = low, min(low, least[r])
    from_on = Window.partitionBy("_range").orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, 0)
    done = run_folder(spark, "fdr-adjusted")
    (ranked.drop("_of").join(F.broadcast(_by_range(spark, after, "double")), "_range")
     .select("_p", F.least(F.min("_v").over(from_on), F.col("_of")).alias("p_adjusted")).write.parquet(done))
    remove_temporary(folder)
    adjusted = spark.read.schema("_p double, p_adjusted double").parquet(done)
    return df.join(adjusted, F.col(p_col) == F.col("_p"), "left").drop("_p")


def _by_range(spark, numbers: dict, kind: str) -> DataFrame:
    """A few numbers (one per range) as a table."""
    return spark.createDataFrame([(int(r), n) for r, n in numbers.items()], f"_range int, _of {kind}")


def fdr_classes(hot_spots: DataFrame, ranges: int | None = None) -> DataFrame:
    """``hot_spots`` (z_score, p_value) with ``p_adjusted`` and ``fdr_class``."""
    out = adjusted_p(hot_spots, "p_value", ranges)
    label = F.lit("not_significant")
    for q, name in reversed(LEVELS):
        hit = F.col("p_adjusted") <= F.lit(q)
        label = (F.when(hit & (F.col("z_score") > 0), F.lit(f"hot_{name}"))
                 .when(hit & (F.col("z_score") < 0), F.lit(f"cold_{name}")).otherwise(label))
    return out.withColumn("fdr_class", label)
