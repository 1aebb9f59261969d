"""Row predicates shared by ingest and the screens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takerlens.functions.values import present

# Payload statuses of a settled market, and of one no longer open.
TERMINAL = ["settled", "finalized"]
CLOSED = ["closed", "settled", "finalized"]
BINARY = ["yes", "no"]


def is_terminal(status: str = "status") -> Column:
    return F.col(status).isin(TERMINAL)


def not_closed(status: str = "status") -> Column:
    """NULL statuses do not pass."""
    return ~F.col(status).isin(CLOSED)


def is_binary(result: str = "result") -> Column:
    return F.col(result).isin(BINARY)


def not_combo(collection: str = "mve_collection_ticker") -> Column:
    """Single-question markets only."""
    return F.coalesce(F.col(collection), F.lit("")) == ""


def has_key(*keys: str) -> Column:
    cond = F.lit(True)
    for key in keys:
        cond = cond & present(F.col(key))
    return cond


def volume_at_least(minimum: float, volume: str = "volume") -> Column:
    """A missing volume counts as zero."""
    return F.coalesce(F.col(volume), F.lit(0)) >= F.lit(minimum)


def settled_between(low, high, column: str = "settlement_ts") -> Column:
    """Inclusive settlement range; either end may be open (None)."""
    cond = F.lit(True)
    if low is not None:
        cond = cond & (F.col(column) >= low)
    if high is not None:
        cond = cond & (F.col(column) <= high)
    return cond


def in_window_or_undated(since, settled: str = "settlement_ts", closed: str = "close_time") -> Column:
    """Settled (else closed) since then; rows with neither time are kept."""
    moment = F.coalesce(F.col(settled), F.col(closed))
    return moment.isNull() | (moment >= since)


def category_not_in(excluded: list[str], category: str = "category") -> Column:
    names = [c.strip().lower() for c in excluded if c.strip()]
    if not names:
        return F.lit(True)
    return ~F.lower(F.coalesce(F.col(category), F.lit(""))).isin(names)


def starts_with_any(prefixes: list[str], column: str = "series_ticker") -> Column:
    cond = F.lit(False)
    for prefix in prefixes:
        cond = cond | F.col(column).startswith(prefix)
    return cond


def settled_ingest(markets: DataFrame, minimum_volume: float | None = None) -> DataFrame:
    """Settled, keyed, single-question markets, optionally above a volume gate."""
    kept = markets.where(is_terminal() & has_key("ticker"))
    if "mve_collection_ticker" in markets.columns:
        kept = kept.where(not_combo())
    if minimum_volume is not None:
        kept = kept.where(volume_at_least(minimum_volume))
    return kept
