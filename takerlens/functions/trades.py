"""One fill: its two prices, the taker's settlement profit and the fee estimate.

A fill has a taker and a maker whose profits cancel, so only the taker's term is
counted, on the outcome the taker bought.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_PRICE = "decimal(7,6)"
SIZE = "decimal(12,2)"
MULTIPLIER = "decimal(6,4)"
# Fixed value: the exchange's quadratic fee is 0.07 dollars = 7 cents times
# p * (1 - p) per contract.
FEE_CENTS = 7


def side_of(trade_side: Column, outcome_side: Column | None = None) -> Column:
    """Outcome the taker bought, lower case; the newer field can stand in."""
    side = F.lower(trade_side)
    return side if outcome_side is None else F.coalesce(side, F.lower(outcome_side))


def yes_price(yes: Column, no: Column) -> Column:
    """A missing side is one minus the other."""
    return F.coalesce(yes, F.lit(1) - no).cast(UNIT_PRICE)


def no_price(yes: Column, no: Column) -> Column:
    return F.coalesce(no, F.lit(1) - yes).cast(UNIT_PRICE)


def size_of(count: Column) -> Column:
    return F.coalesce(count, F.lit(0)).cast(SIZE)


def pnl_cents(side: Column, yes: Column, no: Column, count: Column, result: Column) -> Column:
    """(payoff - price paid) * 100 * size for one fill of a yes/no market."""
    price = F.when(side == "yes", yes_price(yes, no)).when(side == "no", no_price(yes, no))
    price = price.otherwise(F.raise_error(F.concat(F.lit("taker side is "), F.coalesce(side, F.lit("missing")))).cast(UNIT_PRICE))
    payoff = F.when(side == result, F.lit(1)).otherwise(F.lit(0)).cast(UNIT_PRICE)
    return (payoff - price) * F.lit(100) * size_of(count)


def fee_cents(base: Column, multiplier: Column) -> Column:
    """A missing multiplier counts as 1; 0 means the series charges nothing.

    The widths keep all 18 decimal places: 28+6+1 = 35 digits before the 7.
    """
    mult = F.coalesce(multiplier, F.lit(1)).cast(MULTIPLIER)
    return base.cast("decimal(28,14)") * mult * F.lit(FEE_CENTS).cast("decimal(1,0)")
