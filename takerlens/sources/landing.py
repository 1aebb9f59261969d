"""Landed payload pages to typed rows.

A page is one JSON object: `{"cursor": ..., "<entity>": [ ... ]}`. Items are read
as raw JSON text first, so the whole payload survives next to the parsed columns
and new fields never break a read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takerlens.functions.values import COUNT, PRICE, canonical_json, dec, to_minute, ts
from takerlens.operators.filters import has_key, not_combo

SOURCES = "array<struct<name:string,url:string>>"
SERIES = (f"ticker string, title string, category string, frequency string, tags array<string>, "
          f"settlement_sources {SOURCES}, contract_url string, contract_terms_url string, "
          f"fee_type string, fee_multiplier string")
EVENT = (f"event_ticker string, series_ticker string, title string, category string, "
         f"mutually_exclusive boolean, settlement_sources {SOURCES}, markets array<string>")
MARKET = ("ticker string, event_ticker string, title string, status string, result string, open_time string, "
          "close_time string, settlement_ts string, yes_bid_dollars string, yes_ask_dollars string, "
          "no_bid_dollars string, no_ask_dollars string, last_price_dollars string, liquidity_dollars string, "
          "volume_fp string, volume_24h_fp string, open_interest_fp string, price_level_structure string, "
          "rules_primary string, mve_collection_ticker string")
TRADE = ("trade_id string, ticker string, count_fp string, yes_price_dollars string, no_price_dollars string, "
         "taker_side string, taker_outcome_side string, is_block_trade boolean, created_time string")
PRICE_RANGES = "array<struct<start:string,end:string,step:string>>"


def pages(spark: SparkSession, path: str, entity: str, multi_line: bool = False, stream: bool = False,
          keep: list[str] | None = None) -> DataFrame:
    """`raw` (JSON text) and `arrival` of every item on every page below `path`.

    `arrival` sorts items as they came: file name, place in the file, place on
    the page. It settles repeated keys, the last item wins. `keep` names folder
    columns (`<name>=<value>/`) to carry along.
    """
    keep = keep or []
    reader = (spark.readStream if stream else spark.read).option("multiLine", multi_line)
    schema = ", ".join(["cursor string", f"{entity} array<string>", *[f"{c} string" for c in keep]])
    page = reader.schema(schema).json(path)
    place = page.select("_metadata.file_path", "_metadata.file_block_start",
                        F.monotonically_increasing_id().alias("line"), entity, *keep)
    item = place.select("file_path", "file_block_start", "line", F.posexplode(entity).alias("pos", "raw"), *keep)
    return item.select("raw", F.struct("file_path", "file_block_start", "line", "pos").alias("arrival"), *keep)


def _parsed(raw: DataFrame, schema: str) -> DataFrame:
    # The page reader has checked the syntax; a field of the wrong shape is an error.
    return raw.select("*", F.from_json("raw", schema, {"mode": "FAILFAST"}).alias("p"))


def read_series(raw: DataFrame, now: Column, strict: bool = True) -> DataFrame:
    rows = _parsed(raw, SERIES).select(
        F.col("p.ticker").alias("series_ticker"), "p.title", "p.category", "p.frequency", "p.tags",
        "p.settlement_sources", "p.contract_url", "p.contract_terms_url", "p.fee_type",
        dec(F.col("p.fee_multiplier"), "decimal(6,4)", strict).alias("fee_multiplier"),
        now.alias("last_seen"), canonical_json(F.col("raw")).alias("raw"), "arrival")
    return rows.where(has_key("series_ticker"))


def read_events(raw: DataFrame, now: Column) -> DataFrame:
    rows = _parsed(raw, EVENT).select(
        "p.event_ticker", "p.series_ticker", "p.title", "p.category", "p.mutually_exclusive",
        "p.settlement_sources", now.alias("last_seen"), canonical_json(F.col("raw")).alias("raw"), "arrival")
    return rows.where(has_key("event_ticker"))


def nested_markets(raw_events: DataFrame) -> DataFrame:
    """Raw markets carried inside event payloads."""
    item = _parsed(raw_events, EVENT).select("arrival", F.posexplode("p.markets").alias("nested", "raw"))
    return item.select("raw", F.col("arrival").withField("nested", F.col("nested")).alias("arrival"))


def read_snapshots(raw: DataFrame, run_ts: Column, strict: bool = True) -> DataFrame:
    """Open single-question markets as one run's snapshot rows (unlinked)."""
    def money(name: str) -> Column:
        return dec(F.col(f"p.{name}_dollars"), PRICE, strict).alias(name)

    def count(name: str) -> Column:
        return dec(F.col(f"p.{name}_fp"), COUNT, strict).alias(name)

    kept = _parsed(raw, MARKET).where(not_combo("p.mve_collection_ticker") & has_key("p.ticker"))
    return kept.select(
        "p.ticker", to_minute(run_ts).alias("run_ts"), "p.event_ticker", "p.status", money("yes_bid"),
        money("yes_ask"), money("no_bid"), money("no_ask"), money("last_price"), count("volume"),
        count("volume_24h"), count("open_interest"),
        dec(F.col("p.liquidity_dollars"), "decimal(18,6)", strict).alias("liquidity"),
        "p.price_level_structure", ts(F.col("p.close_time")).alias("close_time"), "arrival")


def read_markets(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Market payloads as terminal rows (unlinked, not yet filtered by status)."""
    carried = [c for c in raw.columns if c not in ("raw", "arrival")]
    return _parsed(raw, MARKET).select(
        "p.ticker", "p.event_ticker", "p.title", "p.status", "p.result", ts(F.col("p.open_time")).alias("open_time"),
        ts(F.col("p.close_time")).alias("close_time"), ts(F.col("p.settlement_ts")).alias("settlement_ts"),
        dec(F.col("p.volume_fp"), COUNT, strict).alias("volume"),
        dec(F.col("p.open_interest_fp"), COUNT, strict).alias("open_interest"),
        "p.price_level_structure", "p.rules_primary", "p.mve_collection_ticker",
        canonical_json(F.col("raw")).alias("raw"), "arrival", *carried)


def price_ranges(raw: DataFrame) -> DataFrame:
    """ticker, start, end, step of every tick-size range of a market payload."""
    parsed = raw.select(F.from_json("raw", f"ticker string, price_ranges {PRICE_RANGES}").alias("p"))
    return parsed.select("p.ticker", F.explode("p.price_ranges").alias("r")).select(
        "ticker", *[dec(F.col(f"r.{c}")).alias(c) for c in ("start", "end", "step")])


def read_trades(raw: DataFrame, origin: str = "live", strict: bool = True) -> DataFrame:
    return _parsed(raw, TRADE).select(
        "p.trade_id", "p.ticker", dec(F.col("p.count_fp"), COUNT, strict).alias("count_fp"),
        dec(F.col("p.yes_price_dollars"), PRICE, strict).alias("yes_price_dollars"),
        dec(F.col("p.no_price_dollars"), PRICE, strict).alias("no_price_dollars"),
        "p.taker_side", "p.taker_outcome_side", "p.is_block_trade",
        ts(F.col("p.created_time")).alias("created_time"), F.lit(origin).alias("origin"), "arrival")


def apart(raw: DataFrame, schema: str, numbers: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Readable items, and those set aside as reason, raw, arrival: their table is a quarantine that can be mended and landed again.

    `numbers` are the text fields that must hold a number if anything, with their types. The reason names the first
    field that does not, or `shape` where the item does not fit the schema.
    """
    parsed = raw.withColumn("p", F.from_json("raw", f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    reason = F.when(F.col("p").isNull() | F.col("p._broken").isNotNull(), F.lit("shape"))
    for name, kind in numbers.items():
        text = F.nullif(F.col(f"p.{name}"), F.lit(""))
        reason = reason.when(text.isNotNull() & text.try_cast(kind).isNull(), F.lit(name))
    told = parsed.withColumn("reason", reason)
    return (told.where("reason IS NULL").select(*raw.columns), told.where("reason IS NOT NULL").select("reason", "raw", "arrival"))


def read_trades_apart(raw: DataFrame, origin: str = "live") -> tuple[DataFrame, DataFrame]:
    """`read_trades` where one malformed number costs its own row and no other."""
    good, bad = apart(raw, TRADE, {"count_fp": COUNT, "yes_price_dollars": PRICE, "no_price_dollars": PRICE})
    return read_trades(good, origin), bad


def read_markets_apart(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    good, bad = apart(raw, MARKET, {"volume_fp": COUNT, "open_interest_fp": COUNT})
    return read_markets(good), bad
