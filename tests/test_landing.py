import json
from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from takerlens.functions.values import canonical_json, cents, dec, to_minute, ts
from takerlens.sources import landing

NOW = datetime(2026, 8, 9, 12, 30, 41)


def market(ticker, event="E1", **kw):
    return {"ticker": ticker, "event_ticker": event, "title": "t", "status": "active", "result": "",
            "close_time": "2026-08-09T02:00:00Z", "yes_bid_dollars": "0.0900", "yes_ask_dollars": "0.1100",
            "volume_fp": "116747.31", "volume_24h_fp": "7.69", "liquidity_dollars": "0.0000",
            "price_level_structure": "linear_cent",
            "price_ranges": [{"start": "0.0000", "end": "1.0000", "step": "0.0100"}], **kw}


def land(folder, entity, *pages, indent=None):
    folder.mkdir(parents=True, exist_ok=True)
    for i, items in enumerate(pages):
        (folder / f"{i:05d}.json").write_text(json.dumps({"cursor": str(i), entity: items}, indent=indent))
    return str(folder)


def test_series(spark, tmp_path):
    path = land(tmp_path / "series", "series", [
        {"ticker": "HIGHTOWN", "title": "Highest temperature", "category": "Climate and Weather", "frequency": "daily",
         "tags": ["Daily temperature"], "settlement_sources": [{"name": "n", "url": "https://forecast.weather.gov/p"}],
         "fee_type": "quadratic", "fee_multiplier": 1, "product_metadata": {"b": 1, "a": {"z": 1, "y": 2}}},
        {"ticker": "", "title": "no key"}, {"title": "no key"}])
    rows = landing.read_series(landing.pages(spark, path, "series"), F.lit(NOW)).collect()
    assert [r.series_ticker for r in rows] == ["HIGHTOWN"]
    r = rows[0]
    assert r.fee_multiplier == 1 and r.tags == ["Daily temperature"] and r.settlement_sources[0].url.endswith("/p")
    assert '"product_metadata":{"a":{"y":2,"z":1},"b":1}' in r.raw


def test_events_with_nested_markets(spark, tmp_path):
    path = land(tmp_path / "events", "events", [
        {"event_ticker": "E1", "series_ticker": "S1", "mutually_exclusive": False, "markets": [market("M1"), market("M2")]},
        {"event_ticker": "E2", "series_ticker": None}, {"title": "no ticker"}])
    raw = landing.pages(spark, path, "events")
    rows = {r.event_ticker: r for r in landing.read_events(raw, F.lit(NOW)).collect()}
    assert set(rows) == {"E1", "E2"} and rows["E1"].mutually_exclusive is False and rows["E2"].series_ticker is None
    nested = landing.read_markets(landing.nested_markets(raw)).collect()
    assert sorted(r.ticker for r in nested) == ["M1", "M2"]


def test_open_markets(spark, tmp_path):
    path = land(tmp_path / "markets", "markets",
                [market("M1", no_bid_dollars="", last_price_dollars=None), market("COMBO", mve_collection_ticker="R"),
                 market("M2", mve_collection_ticker="", close_time="soon"), market("")], indent=2)
    raw = landing.pages(spark, path, "markets", multi_line=True)
    rows = {r.ticker: r for r in landing.read_snapshots(raw, F.lit(NOW)).collect()}
    assert set(rows) == {"M1", "M2"}
    m = rows["M1"]
    assert (m.run_ts, m.yes_bid, m.yes_ask, m.volume) == (NOW.replace(second=0), D("0.09"), D("0.11"), D("116747.31"))
    assert m.no_bid is None and m.last_price is None and m.open_interest is None and m.liquidity == 0
    assert m.close_time == datetime(2026, 8, 9, 2) and rows["M2"].close_time is None
    ticks = landing.price_ranges(raw).where("ticker = 'M1'").first()
    assert (ticks.start, ticks.end, ticks.step) == (D(0), D(1), D("0.01"))


def test_malformed_numbers(spark, tmp_path):
    path = land(tmp_path / "bad", "markets", [market("M1", volume_fp="many")])
    raw = landing.pages(spark, path, "markets")
    with pytest.raises(Exception):
        landing.read_markets(raw).collect()
    assert landing.read_markets(raw, strict=False).first().volume is None


def test_trades_and_arrival(spark, tmp_path):
    t = {"trade_id": "a", "ticker": "M", "count_fp": "249.30", "yes_price_dollars": "0.0200", "no_price_dollars": "0.9800",
         "taker_side": "no", "taker_outcome_side": "no", "is_block_trade": False, "created_time": "2026-08-06T20:33:38.32981Z"}
    path = land(tmp_path / "trades", "trades", [t, {**t, "trade_id": "b"}], [{**t, "trade_id": "c"}])
    rows = landing.read_trades(landing.pages(spark, path, "trades")).orderBy("arrival").collect()
    assert [r.trade_id for r in rows] == ["a", "b", "c"]
    assert rows[0].count_fp == D("249.30") and rows[0].created_time == datetime(2026, 8, 6, 20, 33, 38, 329810)


def test_value_functions(spark):
    row = spark.range(1).select(
        dec(F.lit("0.010000")).alias("a"), dec(F.lit("")).alias("b"), cents(dec(F.lit("0.0125"))).alias("c"),
        ts(F.lit("2026-01-02T03:04:05+02:00")).alias("d"), ts(F.lit("never")).alias("e"), ts(F.lit("")).alias("f"),
        to_minute(F.lit(NOW)).alias("g"), canonical_json(F.lit('{"b": [1, 2], "a": null}')).alias("h"),
        canonical_json(F.lit("not json")).alias("i")).first()
    assert (row.a, row.b, row.c) == (D("0.01"), None, D("1.25"))
    assert (row.d, row.e, row.f) == (datetime(2026, 1, 2, 1, 4, 5), None, None)
    assert row.g == datetime(2026, 8, 9, 12, 30) and row.h == '{"a":null,"b":[1,2]}' and row.i == "not json"
