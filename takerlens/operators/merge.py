"""Keyed writes as DataFrame transformations.

Each returns the table's next contents (or the action per row); nothing is
collected and both sides meet in one shuffle on the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by `order`.

    `max_by` combines before the shuffle, so copies of a hot key collapse where
    they are read.
    """
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return picked.select(*keys, "_last.*").select(*rows.columns)


def _full(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = target.withColumn("_old", F.lit(True)).alias("t")
    s = source.withColumn("_new", F.lit(True)).alias("s")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    return t.join(s, cond, "full_outer")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, order: Sequence[str] | None = None,
           defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Target after inserting new keys and overwriting the columns of known ones.

    `update_cols` limits what a known key may change (empty: insert only).
    Columns the source lacks survive on known keys and take `defaults` on new
    ones. A NULL in the source does overwrite. `order` resolves repeated keys in
    the source; without it they must be unique.
    """
    defaults = defaults or {}
    ordinal = [c for c in (order or []) if c not in target.columns]
    if order:
        source = last_wins(source, keys, order).drop(*ordinal)
    written = [c for c in source.columns if c not in keys]
    update = written if update_cols is None else list(update_cols)
    if not update:
        return insert_only(target, source, keys, defaults)
    out = []
    for c in target.columns:
        if c in keys:
            value = F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c in update:
            value = F.when(F.col("s._new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        elif c in written:
            value = F.when(F.col("t._old"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        else:
            value = F.when(F.col("t._old"), F.col(f"t.{c}")).otherwise(defaults.get(c, F.lit(None)))
        out.append(value.alias(c))
    return _full(target, source, keys).select(*out)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Target plus the source rows whose key it lacks."""
    defaults = defaults or {}
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    cols = [F.col(c) if c in source.columns else defaults.get(c, F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns]
    return target.unionByName(fresh.select(*cols))


def changed(compare: Sequence[str], touch_col: str | None, touch_interval: str) -> Column:
    """Any compared column differs, or the row was last touched too long ago."""
    cond = F.lit(False)
    for c in compare:
        cond = cond | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    if touch_col:
        old, new = F.col(f"t.{touch_col}"), F.col(f"s.{touch_col}")
        cond = cond | old.isNull() | F.coalesce(old < new - F.expr(f"INTERVAL {touch_interval}"), F.lit(False))
    return cond


def _compared(source: DataFrame, keys, compare, touch_col) -> list[str]:
    written = [c for c in source.columns if c not in keys]
    if compare is None:
        compare = [c for c in written if c != touch_col]
    missing = [c for c in compare if c not in written]
    if missing:
        raise ValueError(f"compared columns are not written: {missing}")
    if not compare and not touch_col:
        raise ValueError("nothing decides whether a row changed")
    return list(compare)


def upsert_actions(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   compare: Sequence[str] | None = None, touch_col: str | None = None,
                   touch_interval: str = "1 DAY", order: Sequence[str] | None = None) -> DataFrame:
    """Source rows (one per key) with `action`: insert, update or unchanged."""
    if order:
        ordinal = [c for c in order if c not in target.columns]
        source = last_wins(source, keys, order).drop(*ordinal)
    compare = _compared(source, keys, compare, touch_col)
    needed = list(dict.fromkeys([*keys, *compare, *([touch_col] if touch_col else [])]))
    t = target.select(*needed).withColumn("_old", F.lit(True)).alias("t")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    action = (F.when(F.col("t._old").isNull(), "insert")
              .when(changed(compare, touch_col, touch_interval), "update")
              .otherwise("unchanged"))
    return source.alias("s").join(t, cond, "left").select("s.*", action.alias("action"))


def upsert_changed(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Target with only inserted or really changed rows rewritten."""
    defaults = options.pop("defaults", None)
    actions = upsert_actions(target, source, keys, **options)
    return upsert(target, actions.where(F.col("action") != "unchanged").drop("action"), keys, defaults=defaults)


def write_counts() -> list[Column]:
    """seen, inserted, updated, unchanged as aggregates over `upsert_actions`."""
    def n(name: str) -> Column:
        return F.count_if(F.col("action") == name)

    return [F.count(F.lit(1)).alias("seen"), n("insert").alias("inserted"), n("update").alias("updated"),
            n("unchanged").alias("unchanged")]


def write_stats(actions: DataFrame) -> DataFrame:
    """One row: seen, inserted, updated, unchanged."""
    return actions.agg(*write_counts())
