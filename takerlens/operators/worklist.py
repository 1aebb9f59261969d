"""What a run still has to do: scopes and resumable worklists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.functions.rules import RECURRING
from takerlens.operators.filters import category_not_in, settled_between, volume_at_least


def unfinished(markets: DataFrame, stats: DataFrame) -> DataFrame:
    """Markets without a stats row yet."""
    return markets.join(stats.select("ticker"), "ticker", "left_anti")


def in_scope(rows: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows of the series in `scope`; an empty scope keeps nothing."""
    return rows.join(scope.select("series_ticker"), "series_ticker", "left_semi")


def recurring_scope(series: DataFrame) -> DataFrame:
    """Series with a published cadence; `custom` says nothing and stays out."""
    return series.where(F.coalesce(F.col("frequency"), F.lit("")).isin(RECURRING)) \
                 .select("series_ticker").orderBy("series_ticker")


def explicit_scope(series: DataFrame, tickers: list[str]) -> DataFrame:
    """A hand-written list of series, cleaned of blanks and repeats."""
    names = sorted({t.strip() for t in tickers if t.strip()})
    return series.where(F.col("series_ticker").isin(names)).select("series_ticker").orderBy("series_ticker")


def pending_worklist(terminal: DataFrame, series: DataFrame, stats: DataFrame, since,
                     minimum_volume: float = 0, scope: DataFrame | None = None,
                     exclude_categories: list[str] | None = None) -> DataFrame:
    """Settled, in-scope markets not folded yet, smallest volume first; `minimum_volume` leaves out less traded ones."""
    rows = terminal.where(settled_between(since, None) & volume_at_least(minimum_volume))
    if scope is not None:
        rows = in_scope(rows, scope)
    rows = unfinished(rows, stats)
    if exclude_categories:
        rows = rows.join(series.select("series_ticker", "category"), "series_ticker", "left") \
                   .where(category_not_in(exclude_categories))
    return rows.select("ticker", "result", "series_ticker", "volume").orderBy(F.col("volume").asc_nulls_first())
