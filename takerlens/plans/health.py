"""Freshness and volume reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.functions.values import hours, seconds_between
from takerlens.operators.snapshots import latest_snapshot


def ingest_health(snapshots: DataFrame, terminal: DataFrame, stats: DataFrame, as_of) -> DataFrame:
    """One row: last run and its age, rows in the window, last-day ingest, unlinked markets.

    Each table is reduced to its own one-row summary, read as scalars.
    """
    now = F.lit(as_of)
    day_ago = now - hours(24)
    snaps = snapshots.agg(F.max("run_ts").alias("last"))
    markets = terminal.agg(F.struct(F.max("ingested_at").alias("last"),
                                    F.count_if(F.col("ingested_at") > day_ago).alias("recent"),
                                    F.count_if(F.col("series_ticker").isNull()).alias("unlinked")).alias("m"))
    tapes = stats.agg(F.count_if(F.col("computed_at") > day_ago).alias("n"))
    window = latest_snapshot(snapshots, as_of).agg(F.count("*").alias("n"))
    row = snaps.select(F.col("last").alias("last_snapshot_run"),
                       F.round(seconds_between(now, F.col("last")) / 3600, 1).alias("snapshot_age_hours"))
    m = markets.scalar()
    return row.select("*", window.scalar().alias("markets_in_latest_window"),
                      m["last"].alias("last_terminal_ingest"), m["recent"].alias("terminal_last_24h"),
                      tapes.scalar().alias("tapes_last_24h"), m["unlinked"].alias("unlinked_terminal"))


def volume_share(settled: DataFrame) -> DataFrame:
    """How much of the settled population trades at all."""
    volume = F.coalesce(F.col("volume"), F.lit(0))
    return settled.agg(
        F.count("*").alias("settled"), F.count_if(volume == 0).alias("zero_volume"),
        F.count_if(volume >= 1).alias("volume_1_up"), F.count_if(volume >= 100).alias("volume_100_up"),
        F.count_distinct("event_ticker").alias("events"))
