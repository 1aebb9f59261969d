"""What takers made or lost per series. Negative means they lost to makers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.functions import trades as fill
from takerlens.functions.values import ratio
from takerlens.operators.filters import is_binary
from takerlens.operators.tape import with_fee_multiplier

STATS = ["contracts", "taker_gross_pnl_cents", "taker_fee_est_cents", "truncated"]


def taker_bleed(terminal: DataFrame, stats: DataFrame) -> DataFrame:
    """Counts, contracts and cents per contract of yes/no markets, whole tapes only."""
    return bleed_of(terminal.select("ticker", "series_ticker", "result")
                    .join(stats.select("ticker", *STATS), "ticker"))


def fees_again(stats: DataFrame, linked: DataFrame, series: DataFrame) -> DataFrame:
    """ticker, taker_fee_est_cents of markets linked since they were folded, from the fee base kept with their stats."""
    known = linked.select("ticker", "result", "series_ticker")
    rows = with_fee_multiplier(stats.select("ticker", "fee_base").join(known, "ticker"), series)
    return rows.select("ticker", F.when(is_binary(), fill.fee_cents(F.col("fee_base"), F.col("fee_multiplier")))
                       .alias("taker_fee_est_cents"))


def bleed_of(scored: DataFrame) -> DataFrame:
    """The same over stats that still carry their market's result and series.

    Unlinked markets form a NULL group of their own.
    """
    whole = ~F.col("truncated")
    pnl, fee = F.col("taker_gross_pnl_cents"), F.coalesce("taker_fee_est_cents", F.lit(0))
    contracts = F.sum(F.when(whole, F.col("contracts")))
    return scored.where(is_binary()).groupBy("series_ticker").agg(
        F.count_if(whole).alias("n_settled"), F.count_if(~whole).alias("n_truncated"),
        contracts.alias("contracts"),
        ratio(F.sum(F.when(whole, pnl)), contracts).alias("gross_bleed_cents_per_ct"),
        ratio(F.sum(F.when(whole, pnl - fee)), contracts).alias("feeadj_bleed_cents_per_ct"))


def bleed_exclusions(terminal: DataFrame, stats: DataFrame) -> DataFrame:
    """Markets the bleed leaves out, counted. NULL results are shown apart."""
    return (terminal.select("ticker", "series_ticker", "result")
            .join(stats.select("ticker", "truncated"), "ticker", "left")
            .groupBy("series_ticker").agg(
                F.count_if(~is_binary()).alias("n_non_binary_result"),
                F.count_if("truncated").alias("n_truncated"),
                F.count_if(F.col("result").isNull()).alias("n_null_result")))
