"""Market -> event -> series linkage.

A market names only its event. The series comes from the events table, never
from the shape of a ticker; a market whose event is not known yet is kept and
linked later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takerlens.functions.values import present


def event_series(events: DataFrame) -> DataFrame:
    """event_ticker -> series_ticker, known links only (event_ticker is the key)."""
    return events.where(F.col("series_ticker").isNotNull()).select("event_ticker", "series_ticker")


def link_series(markets: DataFrame, events: DataFrame) -> DataFrame:
    """Markets with `series_ticker`, NULL where the event is unknown.

    A left lookup on a unique key: Catalyst broadcasts the dimension while its
    size allows and otherwise AQE splits the partitions of hot events.
    """
    bare = markets.drop("series_ticker")
    return bare.join(event_series(events), "event_ticker", "left").select(*bare.columns, "series_ticker")


def link_counts() -> list[Column]:
    """markets, unmapped as aggregates over linked rows."""
    return [F.count(F.lit(1)).alias("markets"), F.count_if(F.col("series_ticker").isNull()).alias("unmapped")]


def link_report(linked: DataFrame) -> DataFrame:
    return linked.agg(*link_counts())


def repair_links(terminal: DataFrame, events: DataFrame) -> DataFrame:
    """Fill missing links from events that arrived since; `repaired` marks them."""
    known = event_series(events).withColumnRenamed("series_ticker", "_series")
    joined = terminal.join(known, "event_ticker", "left")
    fixed = F.col("series_ticker").isNull() & F.col("_series").isNotNull()
    cols = [F.coalesce("series_ticker", "_series").alias(c) if c == "series_ticker" else F.col(c)
            for c in terminal.columns]
    return joined.select(*cols, fixed.alias("repaired"))


def missing_events(wanted: DataFrame, events: DataFrame) -> DataFrame:
    """Worklist of event keys nobody has stored yet, in key order."""
    keys = wanted.where(present(F.col("event_ticker"))).select("event_ticker").distinct()
    return keys.join(events.select("event_ticker"), "event_ticker", "left_anti").orderBy("event_ticker")
