"""The ranked screen, its funnel and the ground-truth check."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takerlens.operators.filters import starts_with_any

COLUMNS = [
    "series_ticker", "title", "category", "frequency", "settlement_source_type", "benchmark", "recurrence",
    "scrape_difficulty", "open_markets", "live_markets", "breadth", "top_market_share", "sum_vol24h_latest",
    "med_spread_cents", "n_settled", "contracts", "gross_bleed_cents_per_ct", "feeadj_bleed_cents_per_ct",
    "fee_type", "fee_multiplier",
]
SCREENABLE = ["scrapable_numeric_feed", "official_report"]
MAKER_FEES = "quadratic_with_maker_fees"


@dataclass(frozen=True)
class Thresholds:
    """Starting values of the screen: daily contracts band, ladder breadth, history."""

    volume_low: float = 1000
    volume_high: float = 100_000
    breadth: float = 0.34
    n_settled: int = 20


def _recurring() -> Column:
    return F.col("recurrence") == "recurring"


def _unmarked() -> Column:
    return _recurring() & (F.col("benchmark") == "none")


def _scrapable() -> Column:
    return _unmarked() & F.col("settlement_source_type").isin(SCREENABLE)


def _no_maker_fees() -> Column:
    return F.coalesce("fee_type", F.lit("")) != MAKER_FEES


def _in_band(t: Thresholds) -> Column:
    return F.coalesce("sum_vol24h_latest", F.lit(0)).between(t.volume_low, t.volume_high)


def _broad(t: Thresholds) -> Column:
    return F.coalesce("breadth", F.lit(0)) >= F.lit(str(t.breadth)).cast("decimal(20,15)")


def _settled(t: Thresholds) -> Column:
    return F.coalesce("n_settled", F.lit(0)) >= t.n_settled


def candidates(series: DataFrame, tags: DataFrame, activity: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Series passing everything but the bleed half: the scope of a backfill."""
    tagged = tags.select("series_ticker", "settlement_source_type", "benchmark", "recurrence").where(_scrapable())
    busy = activity.select("series_ticker", "sum_vol24h_latest", "breadth")
    return (series.where(_no_maker_fees()).select("series_ticker").join(tagged, "series_ticker")
            .join(busy, "series_ticker", "left").where(_in_band(limits) & _broad(limits))
            .select("series_ticker").orderBy("series_ticker"))


def screen(series: DataFrame, tags: DataFrame, activity: DataFrame, bleed: DataFrame,
           limits: Thresholds = Thresholds()) -> DataFrame:
    """Series worth a passive seat, the most negative fee-adjusted bleed first."""
    judged = tags.select("series_ticker", "settlement_source_type", "benchmark", "recurrence", "scrape_difficulty")
    return (series.where(_no_maker_fees()).join(judged.where(_scrapable()), "series_ticker")
            .join(activity.drop("as_of"), "series_ticker", "left").where(_in_band(limits) & _broad(limits))
            .join(bleed, "series_ticker", "left").where(_settled(limits))
            .select(*COLUMNS).orderBy(F.col("feeadj_bleed_cents_per_ct").asc_nulls_last()))


def screen_funnel(series: DataFrame, tags: DataFrame, activity: DataFrame, bleed: DataFrame,
                  limits: Thresholds = Thresholds()) -> DataFrame:
    """How many series are left after each filter, in one row.

    The first six counts nest; the volume, ladder and history counts are over
    all series. Every input is read once: the four tables are stacked, folded to
    one row per series, and counted.
    """
    inputs = {
        "s": series.select("series_ticker", "fee_type"),
        "t": tags.select("series_ticker", "settlement_source_type", "benchmark", "recurrence"),
        "a": activity.select("series_ticker", "sum_vol24h_latest", "breadth"),
        "b": bleed.select("series_ticker", "n_settled"),
    }
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True),
                     [df.withColumn(f"in_{k}", F.lit(True)) for k, df in inputs.items()])
    rest = [c for c in stacked.columns if c != "series_ticker"]
    row = stacked.groupBy("series_ticker").agg(*[F.max(c).alias(c) for c in rest])
    s, t, a, b = (F.coalesce(f"in_{k}", F.lit(False)) for k in inputs)
    free = t & s & _scrapable() & _no_maker_fees()
    band, alive, enough = a & _in_band(limits), a & _in_band(limits) & _broad(limits), b & _settled(limits)
    passes = free & _in_band(limits) & _broad(limits) & _settled(limits)
    counts = {
        "series_total": s, "classified": t, "recurring": t & _recurring(), "no_benchmark": t & _unmarked(),
        "scrapable": t & _scrapable(), "no_maker_fees": free, "in_volume_band": band, "ladder_alive": alive,
        "enough_settled": enough, "passes_all": passes,
    }
    return row.agg(*[F.count_if(c).alias(name) for name, c in counts.items()])


def ground_truth(series: DataFrame, tags: DataFrame, prefixes: list[str],
                 category: str = "Climate and Weather") -> DataFrame:
    """Series known to belong on the screen and whether their tags say so (NULL: untagged).

    The prefixes alone also match unrelated names, hence the category.
    """
    judged = tags.select("series_ticker", "settlement_source_type", "benchmark", "recurrence")
    passes = ((F.col("settlement_source_type") == "scrapable_numeric_feed")
              & (F.col("benchmark") == "none") & (F.col("recurrence") == "recurring"))
    return (series.where(starts_with_any(prefixes) & (F.col("category") == category))
            .select("series_ticker", "title", "frequency").join(judged, "series_ticker", "left")
            .withColumn("passes", passes))


def ground_truth_report(truth: DataFrame, allowed_residuals: int = 1) -> DataFrame:
    passed = F.count_if("passes")
    return truth.agg(F.count("*").alias("n"), passed.alias("n_passing"),
                     (F.count("*") - passed <= allowed_residuals).alias("ok"))
