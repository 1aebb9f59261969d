"""The five jobs end to end over landed pages."""

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from takerlens.plans import jobs
from takerlens.plans.screen import Thresholds
from takerlens.sources import landing
from tests.test_landing import land, market

NOW = datetime(2026, 8, 9, 12, 0, 30)


def settled(ticker, event, hours_ago, result="yes", volume="5", **kw):
    when = (NOW - timedelta(hours=hours_ago)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"ticker": ticker, "event_ticker": event, "status": "finalized", "result": result, "settlement_ts": when,
            "volume_fp": volume, **kw}


def tape(ticker, i, price="0.40", side="yes", **kw):
    return {"trade_id": f"{ticker}{i}", "ticker": ticker, "count_fp": "2.00", "yes_price_dollars": price, "taker_side": side,
            "is_block_trade": False, "created_time": f"2026-08-08T10:00:{i:02d}Z", **kw}


def feed(root, markets, events=None):
    series = [{"ticker": "WX", "title": "w", "category": "Climate and Weather", "frequency": "daily",
               "settlement_sources": [{"name": "n", "url": "https://weather.gov"}], "fee_type": "quadratic", "fee_multiplier": 1},
              {"ticker": "SP", "title": "s", "category": "Sports", "frequency": "weekly", "settlement_sources": [], "fee_multiplier": 0}]
    land(root / "series", "series", series)
    land(root / "events", "events", events or [{"event_ticker": "E1", "series_ticker": "WX", "title": "one"},
                                               {"event_ticker": "E2", "series_ticker": "SP"},
                                               {"event_ticker": "E1", "series_ticker": "WX", "title": "two"}])
    land(root / "markets", "markets", markets)
    return str(root)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    store = jobs.Store(spark, str(root / "store"))
    opened = [market("M1", "E1", volume_24h_fp="1500"), market("M2", "E1", volume_24h_fp="600"), market("M3", "EX"),
              market("C", "E1", mve_collection_ticker="R")]
    first = jobs.snapshot_job(store, feed(root / "land1", opened), NOW)
    return spark, root, store, opened, first


def trades_of(spark, root, name, rows, origin="live"):
    return landing.read_trades(landing.pages(spark, land(root / name, "trades", rows), "trades"), origin)


def test_whole_cycle(world):
    spark, root, store, opened, first = world
    assert first == {"seen": 2, "inserted": 2, "updated": 0, "unchanged": 0, "snapshots": 3, "unmapped": 1, "written": 3}
    assert {r.event_ticker: r.title for r in store.read("events").collect()} == {"E1": "two", "E2": None}
    assert store.cursor("snapshot") == NOW

    # Six hours later only M2 moved; the same minute again changes nothing.
    moved = [opened[0], {**opened[1], "yes_bid_dollars": "0.0800"}, opened[2]]
    later = NOW + timedelta(hours=6)
    second = jobs.snapshot_job(store, feed(root / "land2", moved), later)
    assert (second["unchanged"], second["written"]) == (2, 1)
    assert jobs.snapshot_job(store, feed(root / "land2b", moved), later)["written"] == 1
    assert store.market_snapshots.read().count() == 4
    seen = {r.series_ticker: r for r in store.read("series").collect()}
    assert seen["WX"].first_seen == NOW and seen["WX"].last_seen == later

    # A sweep: one market's event is not known yet, one is below the gate.
    markets = [settled("A", "E1", 3), settled("B", "E1", 4, "no"), settled("L", "E9", 3), settled("Z", "E1", 3, volume="0"),
               settled("OLD", "E1", 500)]
    feed_m = landing.read_markets(landing.pages(spark, land(root / "settled", "markets", markets), "markets"))
    live = trades_of(spark, root, "live", [tape("A", 1), tape("A", 2, side="no"), tape("L", 1)])
    both = live.unionByName(trades_of(spark, root, "hist", [tape("B", 1), tape("A", 9)], "archive"))
    swept = jobs.sweep_job(store, feed_m, both, later)
    assert (swept["markets"], swept["aggregated"], swept["missing_events"]) == (5, 5, 1)
    assert {r.ticker: r.trades for r in store.read("market_taker_stats").collect()} == {"A": 2, "B": 1, "L": 1, "Z": 0, "OLD": 0}
    stats = {r.ticker: r for r in store.read("market_taker_stats").collect()}
    assert (stats["A"].trades, stats["A"].taker_gross_pnl_cents) == (2, D(120) - D(120))
    assert (stats["B"].trades, stats["B"].taker_gross_pnl_cents) == (1, D(-80))
    store.set_cursor("settled_sweep", NOW - timedelta(hours=6), later)  # a replay of the same range
    again = jobs.sweep_job(store, feed_m, both, later + timedelta(minutes=5))
    assert (again["markets"], again["aggregated"]) == (4, 0)
    assert [r[0] for r in store.read("markets_terminal").select("ingested_at").distinct().collect()] == [later]

    # The missing event arrives and the market is linked.
    jobs.snapshot_job(store, feed(root / "land3", moved, [{"event_ticker": "E9", "series_ticker": "WX"}]), later + timedelta(hours=1))
    assert jobs.relink(store) == 1 and jobs.relink(store) == 0
    assert store.read("markets_terminal").where("series_ticker IS NULL").count() == 0

    tally = jobs.classify_job(store, later)
    assert [tuple(r) for r in tally.collect()] == [("scrapable_numeric_feed", "none", "recurring", 1)]
    assert jobs.classify_job(store, later + timedelta(seconds=30), classify_all=True).count() == 1
    assert store.read("series_tags").count() == 2
    assert jobs.classify_job(store, later + timedelta(minutes=1), classify_all=True).count() == 0

    as_of = later + timedelta(hours=1)
    ranked = store.screen(as_of, Thresholds(n_settled=2)).collect()
    assert [(r.series_ticker, r.open_markets, r.n_settled) for r in ranked] == [("WX", 2, 5)]
    assert store.screen(as_of).count() == 0
    funnel = store.funnel(as_of, Thresholds(n_settled=2)).first()
    assert (funnel.series_total, funnel.classified, funnel.scrapable, funnel.passes_all) == (2, 2, 1, 1)

    assert jobs.prune_job(store, later, days=0.1) == {"removed": 3}
    assert store.market_snapshots.read().agg(F.min("run_ts")).first()[0] > NOW


def test_backfill_scopes_both_halves(world):
    spark, root, _, _, _ = world
    store = jobs.Store(spark, str(root / "store2"))
    jobs.snapshot_job(store, feed(root / "land4", [market("M1", "E1")]), NOW)
    land(root / "archive" / "walked_series=WX", "markets", [settled("A", "E1", 24 * 30), settled("X", "EX", 24 * 400)])
    archive = landing.read_markets(landing.pages(spark, str(root / "archive"), "markets", keep=["walked_series"]))
    recent = landing.read_markets(landing.pages(spark, land(root / "recent", "markets", [
        settled("A", "E1", 24 * 30, volume="7"), settled("B", "E2", 24), settled("C", "E1", 24, volume="0")]), "markets"))
    trades = trades_of(spark, root, "t4", [tape("A", 1), tape("A", 2), tape("B", 1)])
    notes = jobs.backfill_job(store, archive, recent, trades, NOW, exclude_categories=["sports"], minimum_volume=1,
                               page_size=1, page_cap=2)
    assert notes == {"aggregated": 1, "truncated": 1, "repaired": 0}
    rows = {r.ticker: r.volume for r in store.read("markets_terminal").collect()}
    assert rows == {"A": 7, "B": 5, "C": 0}
    again = jobs.backfill_job(store, archive, recent, trades, NOW, series=["SP"], minimum_volume=1)
    assert again["aggregated"] == 1 and store.read("market_taker_stats").count() == 2


def test_command_line(world):
    from takerlens.__main__ import run

    spark, root, _, opened, _ = world
    base = ["--store", str(root / "store3"), "--as-of", "2026-08-09T12:00:30+00:00"]
    assert run(spark, [*base, "snapshot", "--landed", feed(root / "land5", opened)])["written"] == 3
    pages = land(root / "m5", "markets", [settled("A", "E1", 3)])
    tapes = land(root / "t5", "trades", [tape("A", 1), tape("A", 1), tape("A", 2)])
    for _ in range(2):
        assert run(spark, [*base, "trades", "--landed", tapes, "--batch", "7"]) == {"trades": 2, "without_id": 0, "without_market": 0}
    assert run(spark, [*base, "sweep", "--markets", pages])["aggregated"] == 1
    assert jobs.Store(spark, base[1]).read("market_taker_stats").first().trades == 2
    assert run(spark, [*base, "classify"]).count() == 1
    assert run(spark, [*base, "screen", "--n-settled", "1", "--out", str(root / "out5")]).count() == 1
    assert spark.read.parquet(str(root / "out5")).count() == 1
    assert run(spark, [*base, "funnel"]).first().series_total == 2
    assert run(spark, [*base, "prune"]) == {"removed": 0}


def test_whole_tapes_unless_a_cap_is_asked_for(world):
    spark, root, _, opened, _ = world
    store = jobs.Store(spark, str(root / "store6"))
    markets = landing.read_markets(landing.pages(spark, land(root / "m6", "markets", [settled("A", "E1", 3)]), "markets"))
    many = spark.range(60_000).selectExpr("concat('t', id) AS trade_id", "'A' AS ticker", "1.00BD AS count_fp",
                                          "0.4BD AS yes_price_dollars", "CAST(NULL AS decimal(10,6)) AS no_price_dollars",
                                          "'yes' AS taker_side", "CAST(NULL AS string) AS taker_outcome_side",
                                          "false AS is_block_trade", "timestamp'2026-08-08 10:00:00' AS created_time",
                                          "'live' AS origin")
    assert jobs.sweep_job(store, markets, many, NOW)["truncated"] == 0
    assert [(r.ticker, r.trades) for r in store.read("market_taker_stats").collect()] == [("A", 60_000)]
    capped = jobs.Store(spark, str(root / "store7"))
    trades = trades_of(spark, root, "t6", [tape("A", i) for i in range(7)] + [tape("B", 1)])
    assert jobs.sweep_job(capped, markets, trades, NOW, page_size=2, page_cap=2)["truncated"] == 1
    assert [(r.ticker, r.trades) for r in capped.read("market_taker_stats").collect()] == [("A", 4)]


def test_trades_count_once_across_batches(world):
    spark, root, *_ = world
    store = jobs.Store(spark, str(root / "store8"))
    a, b, c = (tape("A", i) for i in range(3))
    nameless = {**tape("A", 5), "trade_id": None}
    assert jobs.trades_job(store, land(root / "b1", "trades", [a, b, nameless, nameless]), 1)["without_id"] == 2
    assert jobs.trades_job(store, land(root / "b2", "trades", [b, c]), 2)["trades"] == 2
    assert jobs.trades_job(store, land(root / "b2", "trades", [b, c]), 2)["trades"] == 2
    assert (store.trades.read().count(), store.tape().count()) == (6, 5)
    # Batch 1 lands again without b: batch 2 still has it.
    jobs.trades_job(store, land(root / "b1again", "trades", [a, nameless]), 1)
    assert sorted(str(r.trade_id) for r in store.tape().collect()) == ["A0", "A1", "A2", "None"]
    assert store.tape(spark.createDataFrame([("B",)], "ticker string")).count() == 0


@pytest.mark.parametrize("hours_ago", [3, 0.5])
def test_late_links_are_scored_again(world, hours_ago):
    """The market lies outside the next sweep's range, or is swept again."""
    spark, root, _, opened, _ = world
    store = jobs.Store(spark, str(root / f"store9-{hours_ago}"))
    jobs.snapshot_job(store, feed(root / f"land9-{hours_ago}", opened), NOW)
    markets = landing.read_markets(landing.pages(spark, land(root / f"m9-{hours_ago}", "markets", [settled("L", "E9", hours_ago)]), "markets"))
    trades = trades_of(spark, root, f"t9-{hours_ago}", [tape("L", 1)])
    assert jobs.sweep_job(store, markets, trades, NOW)["missing_events"] == 1
    assert store.read("market_taker_stats").first().taker_fee_est_cents > 0
    jobs.snapshot_job(store, feed(root / f"land9b-{hours_ago}", opened, [{"event_ticker": "E9", "series_ticker": "SP"}]), NOW + timedelta(hours=1))
    assert jobs.sweep_job(store, markets, trades, NOW + timedelta(hours=1))["repaired"] == 1
    assert store.read("market_taker_stats").first().taker_fee_est_cents == 0


def test_shuffles_grow_with_the_input(spark, tmp_path):
    from takerlens.session import size_shuffles
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, spark.range(10)) == int(old)
        assert size_shuffles(spark, spark.range(10_000), partition_bytes=1000) == 80
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
