"""Trade tapes folded into one row per market.

The fold is split so that trades never meet the markets table row by row: all a
market's profit and fee need is a handful of sums over its tape that do not
depend on the result or the fee multiplier. Those sums combine before the
shuffle (a market holding a third of all trades costs one row per task), and
the join with markets then runs on one row per tape.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from takerlens.functions import trades as fill
from takerlens.operators.filters import is_binary
from takerlens.operators.radix import newest_rows
from takerlens.session import staged

Stage = Callable[[DataFrame], DataFrame]

PAGE_SIZE = 1000

# The mergeable sums of a tape, all 64-bit: sizes in hundredths of a contract,
# prices in millionths of a dollar, so nothing is rounded and the fold stays in
# primitive arithmetic. The fee term p * (1 - p) * size is kept in two parts (above and
# below 2**20), which leaves every sum room for 92 billion contracts per tape;
# beyond that ANSI arithmetic fails instead of wrapping.
SUMS = ["trades", "yes_size", "no_size", "size", "yes_paid", "no_paid", "fee_high", "fee_low",
        "block_trades", "bad_side", "no_price"]
FEE_SPLIT = 20


def _fills(trades: DataFrame, use_outcome_side: bool = False) -> DataFrame:
    """Trades with the integer terms the sums need; block trades carry a flag only."""
    outcome = F.col("taker_outcome_side") if use_outcome_side else None
    terms = trades.select(
        "*", fill.side_of(F.col("taker_side"), outcome).alias("_side"),
        F.expr("cast(coalesce(count_fp, 0) * 100 AS bigint) AS _n"),
        F.expr("cast(coalesce(yes_price_dollars, 1 - no_price_dollars) * 1000000 AS bigint) AS _yes"),
        F.expr("coalesce(is_block_trade, false) AS _block"))
    return terms.select(
        "*", F.expr("CASE WHEN no_price_dollars IS NULL THEN 1000000 - _yes "
                    "ELSE cast(no_price_dollars * 1000000 AS bigint) END AS _no"),
        F.expr("_yes * (1000000 - _yes) AS _pq"))


def tape_sums(trades: DataFrame, keys: Sequence[str], use_outcome_side: bool = False) -> DataFrame:
    """The sums of every tape; block trades are counted and left out.

    Works on a stream as well as on a table.
    """
    def total(cond: str, value: str, name: str) -> Column:
        return F.expr(f"coalesce(sum(CASE WHEN {cond} THEN {value} END), 0) AS {name}")

    screen, yes, no = "NOT _block", "NOT _block AND _side = 'yes'", "NOT _block AND _side = 'no'"
    return _fills(trades, use_outcome_side).groupBy(*keys).agg(
        F.expr(f"count_if({screen}) AS trades"),
        total(yes, "_n", "yes_size"), total(no, "_n", "no_size"), total(screen, "_n", "size"),
        total(yes, "_yes * _n", "yes_paid"), total(no, "_no * _n", "no_paid"),
        total(screen, f"shiftright(_pq, {FEE_SPLIT}) * _n", "fee_high"),
        total(screen, f"(_pq & {(1 << FEE_SPLIT) - 1}) * _n", "fee_low"),
        F.expr("count_if(_block) AS block_trades"),
        F.expr(f"count_if({screen} AND NOT coalesce(_side IN ('yes', 'no'), false)) AS bad_side"),
        F.expr(f"count_if({screen} AND _yes IS NULL) AS no_price"),
    )


def exact(sums: DataFrame) -> DataFrame:
    """The sums as decimals: contracts, dollars paid and p * (1 - p) * size; missing tapes are zero."""
    two, eight = "cast(coalesce({0}, 0) * 0.01BD AS decimal(22,2))", "cast(coalesce({0}, 0) * 0.00000001BD AS decimal(30,8))"
    # 14 places in two steps of 7, because one product would not fit 38 digits.
    units = f"cast(cast(coalesce(fee_high, 0) AS decimal(20,0)) * {1 << FEE_SPLIT} + coalesce(fee_low, 0) AS decimal(25,0))"
    base = f"cast(cast({units} * 0.0000001BD AS decimal(25,7)) * 0.0000001BD AS decimal(28,14))"
    columns = {"yes_contracts": two.format("yes_size"), "no_contracts": two.format("no_size"),
               "contracts": two.format("size"), "yes_notional": eight.format("yes_paid"),
               "no_notional": eight.format("no_paid"), "fee_base": base}
    columns |= {c: f"coalesce({c}, 0)" for c in ("trades", "block_trades", "bad_side", "no_price")}
    kept = [c for c in sums.columns if c not in SUMS]
    return sums.selectExpr(*kept, *[f"{e} AS {c}" for c, e in columns.items()])


def merge_sums(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up partial sums of the same tape."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def capped_sums(trades: DataFrame, keys: Sequence[str], page_size: int = PAGE_SIZE, page_cap: int = 50,
                tie_break: Sequence[str] = (), bucket: str = "hour", stage: Stage | None = None) -> DataFrame:
    """Sums over the newest `page_size * page_cap` screen trades of every tape.

    No tape is sorted. Sums per (tape, hour) show, added up newest first, which
    hours lie inside the cap and the one hour where it is reached; in that hour
    the newest trades are selected digit by digit of their time and tie-break
    (`radix.newest_rows`), so a million trades of one second are no group of one task.

    `stage` (write it to the shared folder and read it back) makes the hourly sums
    a table, so that they are computed once, and each round of the selection.
    """
    keys, cap = list(keys), page_size * page_cap
    stage = stage or staged
    # Keyless trades belong to no tape.
    keyed = trades.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    hour = F.coalesce(F.date_trunc(bucket, F.col("created_time")).cast("timestamp"), F.lit("1900-01-01").cast("timestamp"))
    hourly = keyed.withColumn("_hour", hour)
    newest_first = (Window.partitionBy(*keys).orderBy(F.col("_hour").desc())
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = stage(tape_sums(hourly, [*keys, "_hour"]).withColumn("_through", F.sum("trades").over(newest_first)))
    # Hours beyond the cap keep their block count: block trades take no page.
    whole = placed.select(*keys, *[
        F.expr(c if c == "block_trades" else f"CASE WHEN _through <= {cap} THEN {c} ELSE 0 END AS {c}") for c in SUMS])
    before = F.col("_through") - F.col("trades")
    edge = placed.where((before < cap) & (F.col("_through") > cap)).select(
        *keys, "_hour", (F.lit(cap) - before).alias("_room"))
    screen = hourly.where(~F.coalesce(F.col("is_block_trade"), F.lit(False)))
    near = screen.join(edge, [*keys, "_hour"]).select(*trades.columns, "_room")
    newest = newest_rows(near, keys, "_room", ["created_time", *tie_break], lambda rows: tape_sums(rows, keys), stage)
    return merge_sums(reduce(DataFrame.unionByName, [whole, *newest]), keys)


def prefer_live(sums: DataFrame, key: str = "ticker", origin: str = "origin", live: str = "live") -> DataFrame:
    """One tape per market: the live one unless it holds no screen trade, else the archived one.

    `origin` tells which was taken. The other tape adds nothing, not even block counts.
    """
    both = sums.groupBy(key).agg(*[
        F.expr(f"sum(CASE WHEN {origin} {test} '{live}' THEN {c} ELSE 0 END) AS {side}_{c}")
        for c in SUMS for side, test in (("l", "="), ("a", "<>"))])
    picked = [F.expr(f"CASE WHEN l_trades > 0 THEN l_{c} ELSE a_{c} END AS {c}") for c in SUMS]
    return both.select(key, F.expr(f"CASE WHEN l_trades > 0 THEN '{live}' ELSE 'archive' END AS {origin}"), *picked)


def score(markets: DataFrame, sums: DataFrame, page_size: int = PAGE_SIZE,
          page_cap: int | None = None, strict: bool = True, fee_base: bool = False) -> DataFrame:
    """Stats row of every market from its tape sums, zeros when it never traded.

    `markets` has ticker, result and optionally fee_multiplier. Profit and fee
    are NULL unless the result is yes or no. With `strict`, a trade without a
    price, or one of a yes/no market without a side, is an error. `fee_base`
    keeps the fee before its multiplier, so that it can be scored again.
    """
    joined = exact(markets.join(sums, "ticker", "left"))
    multiplier = F.col("fee_multiplier") if "fee_multiplier" in markets.columns else F.lit(1)
    fee = F.when(is_binary(), fill.fee_cents(F.col("fee_base"), multiplier))
    trades = "trades"
    if strict:
        trades = """CASE WHEN no_price > 0 THEN raise_error(concat('trade without a price in ', ticker))
            WHEN result IN ('yes', 'no') AND bad_side > 0
            THEN raise_error(concat('trade without a taker side in ', ticker)) ELSE trades END"""
    pages = f"cast(ceil(trades / {page_size}) AS bigint)"
    won = "CASE result WHEN 'yes' THEN yes_contracts WHEN 'no' THEN no_contracts END"
    vwap = "cast({0}_notional * 100 / nullif({0}_contracts, 0) AS decimal(18,10)) AS taker_{0}_vwap_cents"
    return joined.select(
        *markets.columns,
        F.expr(f"cast({trades} AS bigint) AS trades"), "contracts",
        F.col("yes_contracts").alias("taker_yes_contracts"), F.expr(vwap.format("yes")),
        F.col("no_contracts").alias("taker_no_contracts"), F.expr(vwap.format("no")),
        F.expr(f"cast(({won} - yes_notional - no_notional) * 100 AS decimal(34,8)) AS taker_gross_pnl_cents"),
        fee.alias("taker_fee_est_cents"), F.col("block_trades").alias("block_trades_skipped"),
        F.expr(f"{pages} AS pages_read"),
        F.expr("false AS truncated" if page_cap is None else f"{pages} >= {page_cap} AS truncated"),
        *(["fee_base"] if fee_base else []),
    )


def with_fee_multiplier(markets: DataFrame, series: DataFrame) -> DataFrame:
    """Attach the series' published multiplier; an unknown series leaves it NULL (counts as 1)."""
    fees = series.select("series_ticker", F.col("fee_multiplier").cast(fill.MULTIPLIER).alias("fee_multiplier"))
    return markets.join(fees, "series_ticker", "left")


def taker_stats(markets: DataFrame, trades: DataFrame, series: DataFrame | None = None,
                page_size: int = PAGE_SIZE, page_cap: int | None = None,
                tie_break: Sequence[str] = ("trade_id",), fallback: bool = False,
                strict: bool = True, stage: Stage | None = None, fee_base: bool = False) -> DataFrame:
    """Fold every market's whole tape; a `page_cap` keeps the newest pages only, for who asks for it.

    `fallback` picks the archived tape where the live one is empty.
    """
    keys = ["ticker", "origin"] if fallback else ["ticker"]
    sums = (tape_sums(trades, keys) if page_cap is None
            else capped_sums(trades, keys, page_size, page_cap, tie_break, stage=stage))
    if fallback:
        sums = prefer_live(sums).drop("origin")
    wanted = markets.select("ticker", "result", *(["series_ticker"] if "series_ticker" in markets.columns else []))
    if series is not None:
        wanted = with_fee_multiplier(wanted, series)
    return score(wanted, sums, page_size, page_cap, strict, fee_base)
