"""Per-series activity from the newest state of every open market."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.functions.values import ratio
from takerlens.operators.quantile import grouped_median


def series_activity(series: DataFrame, latest: DataFrame) -> DataFrame:
    """Breadth, volumes and spreads of each series with an open market.

    `latest` has one row per market, so counting rows counts markets. Spread is
    taken over markets that trade: the quotes of dead strikes are not prices.
    """
    rows = latest.join(series.select("series_ticker"), "series_ticker", "left_semi") \
                 .select("series_ticker", "run_ts", "volume_24h",
                         (F.col("yes_ask") - F.col("yes_bid")).alias("spread"))
    live = F.col("volume_24h") > 0
    base = rows.groupBy("series_ticker").agg(
        F.count("*").alias("open_markets"), F.count_if(live).alias("live_markets"),
        F.sum("volume_24h").alias("sum_vol24h_latest"), F.max("volume_24h").alias("_top"),
        F.max("run_ts").alias("as_of"))
    # Both medians in one pass: one row per measured value.
    measured = rows.select("series_ticker", F.explode(F.array(
        F.struct(F.lit("volume").alias("metric"), F.col("volume_24h").cast("decimal(20,6)").alias("value")),
        F.struct(F.lit("spread").alias("metric"), F.when(live, F.col("spread")).cast("decimal(20,6)").alias("value")),
    )).alias("m")).select("series_ticker", "m.metric", "m.value")
    medians = grouped_median(measured, ["series_ticker", "metric"], "value").groupBy("series_ticker").agg(
        F.max(F.when(F.col("metric") == "volume", F.col("median"))).alias("med_mkt_vol24h"),
        F.max(F.when(F.col("metric") == "spread", F.col("median"))).alias("med_spread_dollars"))
    return base.join(medians, "series_ticker", "left").select(
        "series_ticker", "open_markets", "live_markets",
        F.round(F.col("live_markets").cast("decimal(20,0)") / F.col("open_markets").cast("decimal(20,0)"), 3)
         .cast("decimal(6,3)").alias("breadth"),
        "med_mkt_vol24h", "sum_vol24h_latest",
        ratio(F.col("_top"), F.col("sum_vol24h_latest")).alias("top_market_share"),
        "med_spread_dollars", (F.col("med_spread_dollars") * 100).alias("med_spread_cents"), "as_of")
