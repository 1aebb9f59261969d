"""Exact per-group median that survives a group holding most of the rows.

`percentile` keeps every distinct value of a group in one task's map. Here equal
values are counted first, a coarse histogram (at most a few thousand buckets per
group) finds the bucket holding the middle rank, and only that bucket's distinct
values are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS_PER_OCTAVE = 256


def _bucket(value: Column) -> Column:
    """Order-preserving logarithmic bucket."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log2(F.lit(1.0) + F.abs(v)) * STEPS_PER_OCTAVE)).cast("bigint")


def grouped_median(rows: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """keys + the median of `value` (double, NULLs ignored), linear between the middle two."""
    keys = list(keys)
    counts = (rows.where(F.col(value).isNotNull())
              .groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
              .withColumn("_b", _bucket(F.col("_v"))))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = (counts.groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"))
            .withColumn("_through", F.sum("_bn").over(upto))
            .withColumn("_total", F.sum("_bn").over(group)))
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    middle = (hist.withColumn("_before", F.col("_through") - F.col("_bn"))
              .withColumn("_lo", low).withColumn("_hi", high)
              .where((F.col("_before") < F.col("_hi")) & (F.col("_through") >= F.col("_lo")))
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                      F.col("_b").alias("_mb"), "_before", "_lo", "_hi"))
    same = F.col("_b") == F.col("_mb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (counts.join(middle, same)
              .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
              .withColumn("_start", F.col("_end") - F.col("_n")))

    def at(rank: str) -> Column:
        hit = (F.col("_start") < F.col(rank)) & (F.col("_end") >= F.col(rank))
        return F.max(F.when(hit, F.col("_v"))).cast("double")

    return ranked.groupBy(*keys).agg(((at("_lo") + at("_hi")) / 2).alias(name))
