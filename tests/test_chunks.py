from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from takerlens.operators import chunks, ingest, retention, worklist

SINCE, UNTIL = datetime(2026, 10, 17, 4, 33), datetime(2026, 10, 22, 19)


def test_windows_are_contiguous(spark):
    rows = chunks.plan_chunks(spark, SINCE, UNTIL).orderBy("chunk").collect()
    assert len(rows) == 12 and rows[0].lo == SINCE and rows[-1].hi == UNTIL
    assert all(a.hi == b.lo and a.hi - a.lo == timedelta(hours=12) for a, b in zip(rows, rows[1:]))


def test_empty_range_is_one_window(spark):
    assert [tuple(r) for r in chunks.plan_chunks(spark, UNTIL, UNTIL).collect()] == [(1, UNTIL, UNTIL)]
    with pytest.raises(ValueError):
        chunks.plan_chunks(spark, SINCE, UNTIL, timedelta(0))


def test_sweep_start():
    assert chunks.sweep_start(UNTIL, UNTIL) == UNTIL - timedelta(hours=2)
    assert chunks.sweep_start(None, UNTIL) == UNTIL - timedelta(days=3)
    assert chunks.sweep_start(None, UNTIL, lookback=None) is None and chunks.sweep_start(UNTIL, UNTIL, overlap=None) is None


def test_every_settlement_lies_in_exactly_one_window(spark):
    times = [SINCE, SINCE + timedelta(hours=12), SINCE + timedelta(hours=12, seconds=-1), UNTIL, UNTIL - timedelta(seconds=1),
             UNTIL + timedelta(seconds=1), SINCE - timedelta(seconds=1)]
    df = spark.createDataFrame([(t, v) for t, v in zip(times, [0, 1, 100, None, 5, 9, 9])], "settlement_ts timestamp, volume int")
    got = {r.chunk: (r.settled, r.ingest_eligible, r.tape_eligible)
           for r in chunks.chunk_report(df, SINCE, UNTIL, ingest_minimum=1, tape_minimum=100).collect()}
    assert got == {n: (0, 0, 0) for n in range(1, 13)} | {1: (2, 1, 1), 2: (1, 1, 0), 12: (2, 1, 0)}


MARKET = ("ticker string, event_ticker string, status string, result string, settlement_ts timestamp, "
          "close_time timestamp, volume int, mve_collection_ticker string")


def test_sweep_filters_window_volume_and_done(spark):
    lo, hi = SINCE, SINCE + timedelta(hours=12)
    inside = lo + timedelta(seconds=10)
    df = spark.createDataFrame([
        ("A", "EV1", "finalized", "yes", inside, None, 5, None), ("B", "EV1", "settled", "yes", inside, None, 5, ""),
        ("Z", "EV1", "finalized", "yes", inside, None, 0, None), ("LATE", "EV1", "finalized", "yes", hi + timedelta(seconds=99), None, 5, None),
        ("OPEN", "EV1", "active", "", inside, None, 5, None), ("COMBO", "EV1", "finalized", "yes", inside, None, 5, "R"),
        (None, "EV1", "finalized", "yes", inside, None, 5, None), ("NOV", "EV9", "finalized", "yes", inside, None, None, None)], MARKET)
    events = spark.createDataFrame([("EV1", "SER1")], "event_ticker string, series_ticker string")
    rows = ingest.recent_window(df, events, F.lit(lo), F.lit(hi), minimum_volume=1)
    assert sorted((r.ticker, r.series_ticker) for r in rows.collect()) == [("A", "SER1"), ("B", "SER1")]
    done = spark.createDataFrame([("A",)], "ticker string")
    assert [r.ticker for r in worklist.unfinished(rows, done).collect()] == ["B"]


def test_archive_keeps_undated_rows_and_recent_wins(spark):
    old, new = SINCE - timedelta(days=1), SINCE + timedelta(days=1)
    archive = spark.createDataFrame([
        ("A", "EV1", "finalized", "yes", new, None, 1, None, "W1"), ("B", "EV9", "finalized", "yes", None, None, 1, None, "W1"),
        ("C", "EV1", "finalized", "yes", None, old, 1, None, "W1"), ("D", "EV1", "finalized", "yes", old, new, 1, None, "W1"),
        ("E", "EV1", "finalized", "yes", new, None, 1, None, "OTHER")], MARKET + ", walked_series string")
    events = spark.createDataFrame([("EV1", "SER1")], "event_ticker string, series_ticker string")
    scope = spark.createDataFrame([("W1",)], "series_ticker string")
    rows = ingest.archive_window(archive, events, scope, F.lit(SINCE))
    assert sorted((r.ticker, r.series_ticker) for r in rows.collect()) == [("A", "SER1"), ("B", "W1")]
    recent = rows.where("ticker = 'A'").withColumn("volume", F.lit(9))
    both = {r.ticker: (r.volume, r.source_rank) for r in ingest.two_sources(rows, recent).collect()}
    assert both == {"A": (9, 2), "B": (1, 1)}


def test_worklist_order_scope_and_categories(spark):
    terminal = spark.createDataFrame([("A", "yes", "S", SINCE, 9), ("B", "no", "S", SINCE, 3), ("C", "yes", "T", SINCE, 5), ("D", "yes", None, SINCE, 1),
                                      ("E", "yes", "S", SINCE - timedelta(days=9), 5), ("F", "yes", "S", SINCE, None), ("G", "yes", "S", SINCE, 4)],
                                     "ticker string, result string, series_ticker string, settlement_ts timestamp, volume int")
    series = spark.createDataFrame([("S", None, "daily"), ("T", "Sports", "weekly"), ("U", "x", "custom")],
                                   "series_ticker string, category string, frequency string")
    stats = spark.createDataFrame([("G",)], "ticker string")

    def tickers(**kw):
        return [r.ticker for r in worklist.pending_worklist(terminal, series, stats, F.lit(SINCE), **kw).collect()]

    assert tickers(minimum_volume=1) == ["D", "B", "C", "A"] and tickers() == ["F", "D", "B", "C", "A"]
    assert tickers(exclude_categories=[" SPORTS "]) == ["F", "D", "B", "A"]
    assert tickers(scope=series.where("series_ticker = 'T'")) == ["C"] and tickers(scope=series.limit(0)) == []
    assert [r.series_ticker for r in worklist.recurring_scope(series).collect()] == ["S", "T"]
    assert [r.series_ticker for r in worklist.explicit_scope(series, [" U", "S", "S", "", "Q"]).collect()] == ["S", "U"]


def test_retention_keeps_the_edge(spark):
    df = spark.createDataFrame([(UNTIL - timedelta(days=30),), (UNTIL - timedelta(days=30, seconds=1),), (UNTIL,)], "run_ts timestamp")
    assert tuple(retention.prune_report(df, UNTIL).first()) == (3, 1, 2)
    assert retention.kept(df, UNTIL).count() == 2
