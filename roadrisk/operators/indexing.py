"""Dense running index within an ordered group, without a single-task window.

``row_number()`` over an unpartitioned (or one-group) window sends every row
to one task. Here rows are cut into fixed-size buckets of the order key,
bucket sizes are counted (one small row per bucket), the prefix sums of those
counts give each bucket's offset, and a window numbers rows only inside a
bucket. No group ever holds more than ``bucket_size`` rows of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_index(df: DataFrame, group_col: str, order_col: str, out_col: str = "running_index",
                  bucket_size: int = 4096) -> DataFrame:
    """Adds ``out_col`` = number of rows of the same group with a smaller
    ``order_col`` (0-based). ``order_col`` must be integral and unique per group."""
    b = F.floor(F.col(order_col) / F.lit(bucket_size)).alias("_bucket")
    with_b = df.withColumn("_bucket", b)
    sizes = with_b.groupBy(group_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group_col, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(group_col, "_bucket").orderBy(order_col)
    return (with_b.join(offsets, [group_col, "_bucket"])
            .withColumn(out_col, F.col("_off") + F.row_number().over(inner) - 1)
            .drop("_bucket", "_off"))
