"""Data-quality jobs: payload expectations, reconciliation, explanations, known answers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takerlens.functions import trades as fill
from takerlens.functions.values import present
from takerlens.operators.filters import TERMINAL, is_binary


def series_checks() -> dict[str, Column]:
    return {"series_key": ~present(F.col("series_ticker")), "series_frequency": ~present(F.col("frequency"))}


def event_checks() -> dict[str, Column]:
    return {"event_key": ~present(F.col("event_ticker")), "event_series": ~present(F.col("series_ticker"))}


def snapshot_checks() -> dict[str, Column]:
    ask = F.col("yes_ask")
    return {"snapshot_price_range": F.coalesce(~ask.between(0, 1), F.lit(False)),
            "snapshot_volume": F.col("volume").isNull()}


def settled_checks() -> dict[str, Column]:
    return {"settled_status": ~F.coalesce(F.col("status").isin(TERMINAL), F.lit(False)),
            "settled_time": F.col("settlement_ts").isNull(),
            "settled_combo": F.coalesce("mve_collection_ticker", F.lit("")) != ""}


def trade_checks() -> dict[str, Column]:
    return {"trade_side": ~F.coalesce(fill.side_of(F.col("taker_side")).isin("yes", "no"), F.lit(False)),
            "trade_count": F.col("count_fp").isNull(),
            "trade_block": F.coalesce("is_block_trade", F.lit(False))}


def expectations(tables: list[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """check, n, violations, ok: every table is scanned once for all its checks."""
    report = None
    for rows, checks in tables:
        counted = rows.agg(F.count("*").alias("n"), *[F.count_if(bad).alias(name) for name, bad in checks.items()])
        part = counted.unpivot(["n"], list(checks), "check", "violations")
        report = part if report is None else report.unionByName(part)
    return report.select("check", "n", "violations", ((F.col("violations") == 0) & (F.col("n") > 0)).alias("ok"))


def independent_totals(trades: DataFrame, markets: DataFrame) -> DataFrame:
    """Profit, contracts and fee in decimal cents per price level, not from tape sums.

    Deliberately another route: sizes are added up per market, side and price
    (which also shrinks a hot tape before the join), the price is in cents when
    it is subtracted from the payoff, and the fee is 7 * p * (1 - p) per contract.
    """
    p = F.coalesce(F.col("yes_price_dollars"), 1 - F.col("no_price_dollars")).cast(fill.UNIT_PRICE)
    levels = (trades.where(~F.coalesce("is_block_trade", F.lit(False)))
              .groupBy("ticker", fill.side_of(F.col("taker_side")).alias("side"), p.alias("p"))
              .agg(F.sum(F.coalesce("count_fp", F.lit(0)).cast(fill.SIZE)).cast("decimal(16,2)").alias("n")))
    t = levels.join(markets.where(is_binary()).select("ticker", "result", "fee_multiplier"), "ticker")
    price, n = F.col("p"), F.col("n")
    paid = F.when(F.col("side") == "yes", price * 100).otherwise((1 - price) * 100)
    worth = F.when(F.col("side") == F.col("result"), 100).otherwise(0)
    per_contract = (F.lit(7).cast("decimal(1,0)") * price * (1 - price)).cast("decimal(14,12)")
    mult = F.coalesce("fee_multiplier", F.lit(1)).cast(fill.MULTIPLIER)
    fee = (per_contract * n).cast("decimal(28,14)") * mult
    return t.groupBy("ticker").agg(F.sum(((worth - paid) * n).cast("decimal(28,8)")).alias("pnl_cents"),
                                   F.sum(n).alias("contracts"), F.sum(fee.cast("decimal(38,18)")).alias("fee_cents"))


def reconcile(stats: DataFrame, independent: DataFrame, reported: DataFrame) -> DataFrame:
    """Stats against the second computation, with the reported volume beside the tape's contracts."""
    s = stats.where(is_binary()).select("ticker", F.col("taker_gross_pnl_cents").alias("stats_pnl_cents"),
                                        F.col("contracts").alias("stats_contracts"),
                                        F.col("taker_fee_est_cents").alias("stats_fee_cents"))
    i = independent.select("ticker", F.col("pnl_cents").alias("check_pnl_cents"),
                           F.col("contracts").alias("check_contracts"), F.col("fee_cents").alias("check_fee_cents"))
    zero = F.lit(0)
    joined = s.join(i, "ticker", "full_outer").join(reported.select("ticker", "volume"), "ticker", "left")
    same = F.lit(True)
    for name in ("pnl_cents", "contracts", "fee_cents"):
        # A market without trades has no second computation: that is zero. A NULL beside a number is a mismatch.
        same = same & F.col(f"stats_{name}").eqNullSafe(F.coalesce(f"check_{name}", zero))
    return joined.select("ticker", "stats_pnl_cents", "check_pnl_cents", "stats_contracts", "check_contracts",
                         "stats_fee_cents", "check_fee_cents", F.col("volume").alias("reported_volume"),
                         same.alias("matches"))


def reconciliation_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(F.count("*").alias("markets"), F.count_if(~F.col("matches")).alias("mismatches"))


def explain_trades(trades: DataFrame, markets: DataFrame, most: int | None = None) -> DataFrame:
    """Fill-by-fill arithmetic of yes/no markets; `most` leaves only tapes of at most so many trades."""
    screen = trades.where(~F.coalesce("is_block_trade", F.lit(False))).withColumn("taker_side", fill.side_of(F.col("taker_side")))
    yes, no = F.col("yes_price_dollars"), F.col("no_price_dollars")
    price = F.when(F.col("taker_side") == "yes", fill.yes_price(yes, no)).otherwise(fill.no_price(yes, no))
    per = F.when(F.col("taker_side") == F.col("result"), 100).otherwise(0) - price * 100
    wanted = markets.where(is_binary()).select("ticker", "result")
    if most is not None:
        small = screen.groupBy("ticker").agg(F.count("*").alias("_n")).where(F.col("_n") <= most)
        wanted = wanted.join(small, "ticker", "left_semi")
    return (screen.join(wanted, "ticker")
            .select("ticker", "taker_side", "result", F.col("count_fp").alias("contracts"), price.alias("price_dollars"),
                    per.alias("cents_per_contract"),
                    fill.pnl_cents(F.col("taker_side"), yes, no, F.col("count_fp"), F.col("result")).alias("pnl_cents")))


def handcheck_markets(settled: DataFrame, low: float = 20, high: float = 4000) -> DataFrame:
    """Yes/no markets, by key, whose volume lies strictly between the bounds."""
    volume = F.col("volume")
    return settled.where(is_binary() & (volume > low) & (volume < high)).orderBy("ticker")


def known_answers(tags: DataFrame, expected: DataFrame) -> DataFrame:
    """(series_ticker, field, expected) against the tags; a series not listed fails."""
    fields = ["settlement_source_type", "benchmark", "recurrence", "scrape_difficulty"]
    got = tags.select("series_ticker", *fields).unpivot(["series_ticker"], fields, "field", "got")
    return (expected.join(got, ["series_ticker", "field"], "left")
            .select("series_ticker", "field", "expected", "got",
                    F.coalesce(F.col("got") == F.col("expected"), F.lit(False)).alias("ok")))


def source_coverage(tags: DataFrame) -> DataFrame:
    return tags.groupBy("settlement_source_type").agg(F.count("*").alias("n"))


def coverage_floor(tags: DataFrame, floor: int = 1500) -> DataFrame:
    """Do the two sources the screen depends on still resolve?"""
    usable = F.count_if(F.col("settlement_source_type").isin("scrapable_numeric_feed", "official_report"))
    return tags.agg(usable.alias("usable"), (usable >= floor).alias("ok"))
