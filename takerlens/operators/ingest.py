"""Settled markets from the recent window and from the archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.operators.filters import in_window_or_undated, settled_between, settled_ingest
from takerlens.operators.linkage import event_series, link_series
from takerlens.operators.merge import last_wins


def recent_window(markets: DataFrame, events: DataFrame, low, high=None,
                  minimum_volume: float | None = None) -> DataFrame:
    """Settled inside the range and linked. The range reaches the scan as a pushed filter."""
    rows = settled_ingest(markets, minimum_volume).where(settled_between(low, high))
    return link_series(rows, events)


def archive_window(archive: DataFrame, events: DataFrame, scope: DataFrame, since) -> DataFrame:
    """Archived markets of the walked series, undated rows kept.

    `archive` names the series whose walk returned the row (`walked_series`); it
    stands in where the event is unknown.
    """
    rows = settled_ingest(archive).where(in_window_or_undated(since))
    walked = scope.select(F.col("series_ticker").alias("walked_series"))
    rows = rows.join(walked, "walked_series", "left_semi").drop("series_ticker")
    linked = rows.join(event_series(events), "event_ticker", "left")
    cols = [c for c in rows.columns if c != "walked_series"]
    return linked.select(*cols, F.coalesce("series_ticker", "walked_series").alias("series_ticker"))


def two_sources(archived: DataFrame, recent: DataFrame) -> DataFrame:
    """Both walks in writing order, one row per market: the recent walk wins."""
    both = archived.withColumn("source_rank", F.lit(1)).unionByName(recent.withColumn("source_rank", F.lit(2)))
    return last_wins(both, ["ticker"], ["source_rank"])
