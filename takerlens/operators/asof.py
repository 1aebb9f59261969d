"""Backward as-of join of two tables, within a bounded look-back."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, window: timedelta,
              columns: Sequence[str], prefix: str = "prior_", order: Sequence[str] = (), strict: bool = True,
              buckets: int = 1) -> DataFrame:
    """Each left row with the newest right row of its keys less than `window` older, as `<prefix><column>`.

    Every left row stays once, with NULLs where nothing is near enough or a key or the time is NULL. `strict` leaves out right
    rows of the very same time. `order` settles right rows of the same time, the last wins.

    Time is cut into `buckets` parts per window. A left row meets its own bucket and one row a bucket of those before it:
    the last one in it. So a task holds a bucket of a key, never all of it, however long its history is; where one
    bucket of a hot key is still too much, more `buckets` make it smaller.
    """
    micros = window // timedelta(microseconds=1)
    if micros <= 0 or buckets < 1:
        raise ValueError("the window and the number of buckets must be positive")
    width, keys = max(1, -(-micros // buckets)), list(keys)

    def at(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    usable = F.lit(True)
    for c in [*keys, left_time]:
        usable = usable & F.col(c).isNotNull()
    picked = list(dict.fromkeys([right_time, *columns]))
    found = right.dropna(subset=[*keys, right_time]).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], at(right_time).alias("_at"),
        F.struct(*[F.col(c) for c in picked]).alias("_found"),
        (F.struct(*[F.col(c) for c in order]) if order else F.lit(0)).alias("_tie"))
    names = [f"_k{i}" for i in range(len(keys))]
    found = found.withColumn("_bucket", F.floor(F.col("_at") / width))
    last = found.groupBy(*names, "_bucket").agg(F.max(F.struct("_at", "_tie")).alias("_m"),
                                                F.max_by("_found", F.struct("_at", "_tie")).alias("_found"))
    carried = last.select(*names, F.col("_m._at").alias("_at"), "_found", F.col("_m._tie").alias("_tie"),
                          F.explode(F.sequence(F.col("_bucket") + 1, F.col("_bucket") + buckets + 1)).alias("_bucket"))
    asked = left.where(usable).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], at(left_time).alias("_at"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
    asked = asked.withColumn("_bucket", F.floor(F.col("_at") / width)).withColumn("_turn", F.lit(0 if strict else 2))
    shown = found.unionByName(carried).withColumn("_turn", F.lit(1))
    both = asked.unionByName(shown, allowMissingColumns=True)
    w = Window.partitionBy(*names, "_bucket").orderBy("_at", "_turn", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.select("*", F.last(F.when(F.col("_found").isNotNull(), F.struct("_at", "_found")), ignorenulls=True).over(w).alias("_seen"))
    near = F.col("_seen._at") > F.col("_at") - F.lit(micros)
    matched = seen.where(F.col("_row").isNotNull()).select(
        "_row.*", *[F.when(near, F.col(f"_seen._found.{c}")).alias(f"{prefix}{c}") for c in picked])
    alone = left.where(~usable)
    return matched.unionByName(alone.select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(f"{prefix}{c}") for c in picked]))
