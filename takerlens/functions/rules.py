"""Series classification rules as column expressions.

Everything is a function of the category, the frequency, the settlement links
and the number of events seen, so a tag can be audited from its row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: rule version, source groups, levels, cadences -------------
RULES_VERSION = "rules:v3"
NUMERIC = [
    "weather.gov", "noaa.gov", "weather.com", "cfbenchmarks.com", "fred.stlouisfed.org",
    "tradingeconomics.com", "coinmarketcap.com", "coingecko.com", "eia.gov", "charts.youtube.com",
    "netflix.com", "kworb.net", "spotify.com", "billboard.com", "luminatedata.com", "lmarena.ai",
]
OFFICIAL = [
    "bls.gov", "bea.gov", "census.gov", "treasury.gov", "federalreserve.gov", "nber.org", "cdc.gov",
    "usda.gov", "dot.gov", "bts.gov", "faa.gov", "sec.gov", "irs.gov", "whitehouse.gov",
]
MARKET = [
    "cmegroup.com", "nasdaq.com", "nyse.com", "tradingview.com", "marketwatch.com", "coinbase.com",
    "binance.com", "kraken.com", "theice.com", "ice.com", "pyth.com", "pythdata.app",
]
SUBJECTIVE = [
    "oscars.org", "theamas.com", "nobelprize.org", "emmys.com", "grammy.com", "rottentomatoes.com",
    "metacritic.com", "time.com",
]
DIFFICULTY = {
    "low": ["weather.gov", "weather.com", "cfbenchmarks.com", "fred.stlouisfed.org", "coinmarketcap.com",
            "coingecko.com", "charts.youtube.com", "netflix.com", "kworb.net", "lmarena.ai"],
    "medium": ["noaa.gov", "tradingeconomics.com", "bls.gov", "bea.gov", "census.gov", "eia.gov",
               "federalreserve.gov", "bts.gov", "spotify.com", "billboard.com", "cdc.gov"],
    "high": ["nber.org", "luminatedata.com"],
}
NO_BENCHMARK = ["weather.gov", "noaa.gov", "weather.com"]
CRYPTO = ["cfbenchmarks.com", "coinmarketcap.com", "coingecko.com"]
RATES = ["federalreserve.gov", "nber.org"]
RECURRING = ["fifteen_min", "hourly", "daily", "weekly", "monthly", "quarterly", "annual"]
EVENT_FLOOR = 6
GROUPS = {"numeric": NUMERIC, "official": OFFICIAL, "market": MARKET, "subjective": SUBJECTIVE,
          "no_benchmark": NO_BENCHMARK, "crypto": CRYPTO, "rates": RATES}
LEVELS = ["low", "medium", "high"]
# ---------------------------------------------------------------------------

# Whether the links of a series hit a group, by its name in GROUPS.
Hit = Callable[[str], Column]
_EDGE_SPACE = r"^\s+|\s+$"
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"


def source_urls(sources: Column) -> Column:
    """Trimmed, non-blank links of array<struct<name,url>>, order kept."""
    links = F.transform(sources, lambda s: F.regexp_replace(F.coalesce(s["url"], F.lit("")), _EDGE_SPACE, ""))
    return F.coalesce(F.filter(links, lambda u: u != ""), F.array().cast("array<string>"))


def host(url: Column) -> Column:
    """Lower-case authority without any `www.`; '' for a link without `//`."""
    return F.replace(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit("www."), F.lit(""))


def hosts(sources: Column) -> Column:
    """Distinct hosts in alphabetical order."""
    return F.array_sort(F.array_distinct(F.transform(source_urls(sources), host)))


def in_group(name: Column, group: list[str]) -> Column:
    """The host is a domain of the group or lies below one."""
    return name.rlike(r"(?:^|\.)(?:" + "|".join(re.escape(d) for d in group) + r")\z")


def hits(names: Column, group: list[str]) -> Column:
    return F.exists(names, lambda h: in_group(h, group))


def settlement_source_type(names: Column) -> Column:
    return source_type_of(lambda group: hits(names, GROUPS[group]))


def source_type_of(hit: Hit) -> Column:
    return (F.when(hit("numeric"), "scrapable_numeric_feed")
            .when(hit("official"), "official_report")
            .when(hit("market"), "market_price")
            .when(hit("subjective"), "committee_or_subjective")
            .otherwise("unknown"))


def benchmark(names: Column, category: Column) -> Column:
    """struct(benchmark, benchmark_name): is there a sharp outside price?"""
    return benchmark_of(lambda group: hits(names, GROUPS[group]), category, F.size(names) == 0)


def benchmark_of(hit: Hit, category: Column, no_hosts: Column) -> Column:
    """The same, told which groups the settlement links hit.

    Evidence in the settlement links comes before the category, whose label is
    less reliable. With nothing at all to go by the answer is `unknown`.
    """
    cat = F.coalesce(category, F.lit(""))

    def answer(kind: str, name: str | None = None) -> Column:
        return F.struct(F.lit(kind).alias("benchmark"), F.lit(name).cast("string").alias("benchmark_name"))

    return (F.when(hit("no_benchmark"), answer("none"))
            .when(hit("market"), answer("cme_or_rates", "exchange / oracle price feed"))
            .when(cat == "Sports", answer("sportsbook", "retail sportsbooks"))
            .when((cat == "Crypto") | hit("crypto"), answer("spot_crypto", "spot exchanges"))
            .when(cat.isin("Financials", "Commodities"), answer("cme_or_rates", "CME / ICE futures"))
            .when(cat.isin("Politics", "Elections"), answer("other_liquid_market", "Polymarket"))
            .when((cat == "Economics") & hit("rates"), answer("cme_or_rates", "fed funds futures"))
            .when((cat == "") & no_hosts, answer("unknown"))
            .otherwise(answer("none")))


def scrape_difficulty(names: Column) -> Column:
    """Level of the alphabetically first host that has one."""
    def level(h: Column) -> Column:
        expr = F.when(in_group(h, DIFFICULTY["low"]), "low")
        for name in ("medium", "high"):
            expr = expr.when(in_group(h, DIFFICULTY[name]), name)
        return expr

    known = F.filter(F.transform(names, level), lambda x: x.isNotNull())
    return F.coalesce(F.get(known, F.lit(0)), F.lit("unknown"))


def recurrence(frequency: Column, n_events: Column) -> Column:
    """The published cadence, or for `custom` the record of enough events."""
    f = F.lower(F.coalesce(frequency, F.lit("")))
    return (F.when(f == "one_off", "one_off")
            .when(f.isin(RECURRING), "recurring")
            .when((f == "custom") & (F.coalesce(n_events, F.lit(0)) >= EVENT_FLOOR), "recurring")
            .otherwise("unknown"))


def notes(source_type: Column, bench: Column, names: Column, frequency: Column,
          recur: Column, n_events: Column) -> Column:
    """Why the tag says what it says."""
    via = F.when(F.size(names) > 0, F.concat(F.lit(" via "), F.array_join(names, ",")))
    promoted = (recur == "recurring") & (F.lower(frequency) == "custom")
    record = F.when(promoted, F.concat(F.lit(" [recurrence from "), n_events.cast("string"), F.lit(" events]")))
    return F.concat(source_type, F.lit("/"), bench, F.coalesce(via, F.lit("")), F.coalesce(record, F.lit("")))
