"""Age-based removal of snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAYS = 30


def expired(as_of, days: float = DAYS, column: str = "run_ts") -> Column:
    return F.col(column) < F.lit(as_of) - F.expr(f"INTERVAL {round(days * 86400)} SECONDS")


def kept(snapshots: DataFrame, as_of, days: float = DAYS) -> DataFrame:
    return snapshots.where(~expired(as_of, days))


def prune_report(snapshots: DataFrame, as_of, days: float = DAYS) -> DataFrame:
    """One row: rows before, removed and kept."""
    gone = F.count_if(expired(as_of, days))
    return snapshots.agg(F.count("*").alias("before"), gone.alias("removed"), (F.count("*") - gone).alias("kept"))
