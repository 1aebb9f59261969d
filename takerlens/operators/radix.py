"""The newest rows of every group without sorting a group: radix selection.

Rows get a text key that sorts like their order. Histograms over a few characters of it show which characters lie
above the cut, which below, and which hold it; only the rows that hold it go into the next round. What a round sorts are
histogram rows, a bounded number per group, never the group's own rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from takerlens.session import staged

DIGITS = 4


def sortable(column: Column, kind: T.DataType) -> Column:
    """Text that sorts like the column, NULL first, and of which none is the beginning of another."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        column, kind = F.unix_micros(column.cast("timestamp")), T.LongType()
    if isinstance(kind, T.BooleanType):
        column, kind = column.cast("long"), T.LongType()
    if isinstance(kind, T.DateType):
        column, kind = F.unix_date(column).cast("long"), T.LongType()
    if isinstance(kind, T.IntegralType):
        text = F.concat(F.when(column < 0, "0").otherwise("1"), F.lpad(F.hex(column.cast("long")), 16, "0"))
    elif isinstance(kind, T.DecimalType):
        # Digits of the value and of its distance from the least one, so negative values sort before positive ones.
        whole = (F.abs(column) * F.lit(Decimal(10 ** kind.scale))).cast("decimal(38,0)")
        place = F.lpad(whole.cast("string"), kind.precision, "0")
        text = F.when(column < 0, F.concat(F.lit("0"), F.translate(place, "0123456789", "9876543210"))).otherwise(F.concat(F.lit("1"), place))
    elif isinstance(kind, T.StringType):
        text = F.concat(F.hex(column.cast("binary")), F.lit("!"))
    else:
        raise TypeError(f"no sortable text for {kind.simpleString()}")
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


def newest_rows(rows: DataFrame, keys: Sequence[str], room: str, order: Sequence[str], take: Callable[[DataFrame], DataFrame],
                stage: Callable[[DataFrame], DataFrame] = staged) -> list[DataFrame]:
    """Partial sums over the largest `room` rows of each group by `order` (NULLs last), as frames to be added up.

    `room` is a column, the same for all rows of a group. `take` folds rows into sums per group, 64-bit integers. Rows
    alike in all order columns count as ordered by a hash of the whole row; of rows alike in every column any will do,
    so these are not told apart: their sums are taken in proportion, which is exact.
    """
    keys = list(keys)
    columns = [c for c in rows.columns if c != room]
    text = [sortable(F.col(c), rows.schema[c].dataType) for c in order]
    whole = F.lpad(F.hex(F.xxhash64(*columns)), 16, "0")
    now = stage(rows.withColumn("_key", F.concat(*text, whole)))
    done = []
    while True:
        span = now.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(room).alias("_room"), F.min("_key").alias("_lo"),
                                      F.max("_key").alias("_hi"))
        differ = F.filter(F.sequence(F.lit(1), F.least(F.length("_lo"), F.length("_hi"))),
                          lambda i: F.substr("_lo", i, F.lit(1)) != F.substr("_hi", i, F.lit(1)))
        span = stage(span.withColumn("_at", F.get(differ, F.lit(0))))
        done.append(take(now.join(span.where("_n <= _room").select(*keys), keys, "left_semi").select(*columns)))
        alike = span.where("_n > _room AND _at IS NULL").select(*keys, "_n", "_room")
        same = take(now.join(alike.select(*keys), keys, "left_semi").select(*columns)).join(alike, keys)
        done.append(same.select(*keys, *[F.call_function("div", F.col(c) * F.col("_room"), F.col("_n")).alias(c)
                                         for c in same.columns if c not in [*keys, "_n", "_room"]]))
        open_ = span.where("_n > _room AND _at IS NOT NULL").select(*keys, "_room", "_at")
        if open_.isEmpty():
            return done
        cut = now.drop(room).join(open_, keys).withColumn("_digit", F.substr("_key", "_at", F.lit(DIGITS)))
        counts = cut.groupBy(*keys, "_digit").agg(F.count("*").alias("_n"), F.max("_room").alias("_room"))
        above = Window.partitionBy(*keys).orderBy(F.desc("_digit")).rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(above), F.lit(0))).where("_before < _room").select(
            *keys, "_digit", (F.col("_room") - F.col("_before")).alias("_left"), "_n")
        kept = stage(cut.drop("_room", "_at").join(placed, [*keys, "_digit"]).select(*columns, "_key", "_left", "_n"))
        done.append(take(kept.where("_n <= _left").select(*columns)))
        now = kept.where("_n > _left").select(*columns, F.col("_left").alias(room), "_key")
