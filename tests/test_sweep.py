"""Sweeps by settlement window: commits, resumption, late landings, pruning by day."""

import os
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from takerlens.operators import chunks, merge
from takerlens.plans import jobs
from takerlens.sources.tables import DatedTable
from tests.test_jobs import NOW, settled, tape, trades_of
from tests.test_landing import land


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sweeps")
    markets = [settled(f"M{i:02d}", "E1", 20 * i + 1, volume=str(i)) for i in range(4)] + [settled("UNDATED", "E1", 5, settlement_ts=None)]
    trades = trades_of(spark, root, "trades", [tape(f"M{i:02d}", k) for i in range(4) for k in range(i)])
    return spark, root, markets, trades


DAY_LONG = {"chunk": timedelta(days=1), "overlap": timedelta(0)}


def new_store(spark, root, name):
    store = jobs.Store(spark, str(root / name))
    store.tables["series"].upsert(spark.createDataFrame([("WX", D(1))], "series_ticker string, fee_multiplier decimal(6,4)"))
    learn(store, "E1")
    return store


def learn(store, event):
    store.tables["events"].upsert(store.spark.createDataFrame([(event, "WX")], "event_ticker string, series_ticker string"))


def content(store):
    stats = {r.ticker: (r.trades, r.taker_gross_pnl_cents, r.taker_fee_est_cents) for r in store.read("market_taker_stats").collect()}
    return stats, {r.ticker: (r.series_ticker, r.volume) for r in store.read("markets_terminal").collect()}


def test_a_stopped_run_resumes_after_its_last_window(world):
    spark, root, markets, trades = world
    pages = land(root / "m1", "markets", markets)
    whole, parts = new_store(spark, root, "whole"), new_store(spark, root, "parts")
    for store in (whole, parts):
        assert jobs.settled_job(store, pages, 1) == {"markets": 5, "undated": 1}
    one = jobs.sweep_job(whole, None, trades, NOW, **DAY_LONG)
    assert (one["markets"], one["windows"], whole.cursor("settled_sweep")) == (4, 3, NOW)
    first = jobs.sweep_job(parts, None, trades, NOW, stop_after=2, **DAY_LONG)
    done = {(r.lo, r.hi) for r in parts.sweep_windows.read().collect()}
    assert first["windows"] == 2 and parts.cursor("settled_sweep") == max(hi for _, hi in done) < NOW
    assert min(lo for lo, _ in done) == NOW.replace(second=30) - timedelta(hours=61)
    second = jobs.sweep_job(parts, None, trades, NOW, **DAY_LONG)
    assert second["windows"] == 1 and first["markets"] + second["markets"] == 4
    windows = sorted((r.lo, r.hi, r.markets) for r in parts.sweep_windows.read().collect())
    assert windows == sorted((r.lo, r.hi, r.markets) for r in whole.sweep_windows.read().collect())
    assert content(parts) == content(whole)


def test_a_window_that_fails_is_done_again(world, monkeypatch):
    """The rows are written, the cursor is not: the next run repeats the window and nothing else. Then a market lands late."""
    spark, root, markets, trades = world
    store = new_store(spark, root, "fails")
    jobs.settled_job(store, land(root / "m2", "markets", markets[:3]), 1)
    real, calls = jobs._commit_window, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(*args)

    monkeypatch.setattr(jobs, "_commit_window", breaks)
    with pytest.raises(RuntimeError):
        jobs.sweep_job(store, None, trades, NOW, **DAY_LONG)
    assert store.cursor("settled_sweep") == calls[0][2].replace(tzinfo=None)
    monkeypatch.setattr(jobs, "_commit_window", real)
    rest = jobs.sweep_job(store, None, trades, NOW, **DAY_LONG)
    assert rest["windows"] == 1 and sorted(content(store)[0]) == ["M00", "M01", "M02"]
    jobs.settled_job(store, land(root / "m3", "markets", [markets[3]]), 2)  # settled before all that was swept
    late = jobs.sweep_job(store, None, trades, NOW, **DAY_LONG)
    assert (late["markets"], late["aggregated"], store.cursor("settled_sweep")) == (1, 1, NOW)
    assert content(store)[0]["M03"][0] == 3 and jobs.sweep_job(store, None, trades, NOW, **DAY_LONG)["markets"] == 0


def test_landed_files_are_swept_once(world):
    spark, root, markets, trades = world
    store = new_store(spark, root, "files")

    def sweep():
        return jobs.sweep_landed(store, f"{store.path}/landed", NOW, trades, chunk=timedelta(days=9))

    assert sweep()["markets"] == 0
    jobs.settled_job(store, land(root / "m4", "markets", markets[:2]), 1)
    assert sweep()["markets"] == 2
    jobs.settled_job(store, land(root / "m5", "markets", [markets[3]]), 2)
    late = sweep()
    assert (late["markets"], late["aggregated"], sweep()["markets"]) == (1, 1, 0)
    assert {k: v[0] for k, v in content(store)[0].items()} == {"M00": 0, "M01": 1, "M03": 3}


def test_missing_events_are_kept_as_a_worklist(world):
    spark, root, _, trades = world
    store = new_store(spark, root, "missing")
    assert jobs.sweep_job(store, None, None, NOW) == {"markets": 0, "aggregated": 0, "truncated": 0, "windows": 0,
                                                      "missing_events": 0, "repaired": 0}
    jobs.settled_job(store, land(root / "m6", "markets", [settled("A", "E9", 3), settled("B", "E8", 3), settled("C", "E1", 3)]), 1)
    assert jobs.sweep_job(store, None, trades, NOW)["missing_events"] == 2
    assert [r.event_ticker for r in store.wanted_events.read().orderBy("event_ticker").collect()] == ["E8", "E9"]
    learn(store, "E9")
    after = jobs.sweep_job(store, None, trades, NOW + timedelta(hours=4))
    assert (after["repaired"], after["missing_events"]) == (1, 1)


def test_busy_windows(spark):
    low = datetime(2026, 1, 1)
    rows = [(low + timedelta(hours=h),) for h in (0, 11.5, 12, 40, 48, -1, -30)] + [(None,), (low + timedelta(hours=49),)]
    df = spark.createDataFrame(rows, "settlement_ts timestamp_ntz")
    until = low + timedelta(hours=48)
    got = chunks.busy_chunks(df, low, until)
    hours = [((lo - low) / timedelta(hours=1), (hi - low) / timedelta(hours=1)) for lo, hi in got]
    assert hours == [(-36, -24), (-12, 0), (0, 12), (12, 24), (36, 48)]
    inside = [df.where(chunks.in_chunk(lo, hi, until, "timestamp_ntz")).count() for lo, hi in got]
    assert inside == [1, 1, 2, 1, 2]


# --- tables by day -----------------------------------------------------------

SCHEMA = "ticker string, settlement_ts timestamp, v int, first string"
DAY = datetime(2026, 3, 1, 10)


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), "ticker string, settlement_ts timestamp, v int")


def test_dated_table_moves_keys_and_touches_only_its_days(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"), SCHEMA, ["ticker"])
    assert table.read().count() == 0 and table.between(DAY).count() == 0
    table.upsert(rows_of(spark, ("a", DAY, 1), ("b", DAY, 2), ("c", DAY + timedelta(days=1), 3), ("d", DAY + timedelta(days=5), 4),
                         ("n", None, 5)), defaults={"first": F.lit("one")})

    def folders():
        return {p: sorted(os.listdir(tmp_path / "t" / p)) for p in os.listdir(tmp_path / "t") if p.startswith("settled_day=")}

    before = folders()
    assert len(before) == 4
    # c moves to another day and is alone on its old one; n gets a day.
    table.upsert(rows_of(spark, ("c", DAY + timedelta(days=2), 9), ("n", DAY, 6)), defaults={"first": F.lit("two")})
    after = folders()
    assert after[f"settled_day={(DAY - datetime(1970, 1, 1)).days + 5}"] == before[f"settled_day={(DAY - datetime(1970, 1, 1)).days + 5}"]
    assert len(after) == 3
    got = sorted((r.ticker, r.settlement_ts, r.v, r.first) for r in table.read().collect())
    assert got == [("a", DAY, 1, "one"), ("b", DAY, 2, "one"), ("c", DAY + timedelta(days=2), 9, "one"),
                   ("d", DAY + timedelta(days=5), 4, "one"), ("n", DAY, 6, "one")]
    table.upsert(rows_of(spark))
    assert table.read().count() == 5


def files_read(df):
    """Files and partitions that the scans of a finished query opened."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        metrics = node.metrics()
        if metrics.contains("numPartitions") and "Scan" in node.nodeName():
            found.append(metrics.apply("numPartitions").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found, plan.toString()


def test_ranges_and_worklists_open_their_days_only(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"), SCHEMA, ["ticker"])
    table.upsert(rows_of(spark, *((f"m{i}", DAY + timedelta(days=i), i) for i in range(40))))
    parts, plan = files_read(table.between(DAY + timedelta(days=3), DAY + timedelta(days=5, hours=-1)))
    assert parts == [3] and "PartitionFilters: [isnotnull(settled_day" in plan
    # The days come from another table, known at run time only.
    spark.createDataFrame([(i, "open" if i % 10 == 0 else "done", (DAY - datetime(1970, 1, 1)).days + i) for i in range(40)],
                          "window int, state string, settled_day int").write.parquet(str(tmp_path / "w"))
    wanted = spark.read.parquet(str(tmp_path / "w")).where("state = 'open'")
    picked = table.on_days(wanted)
    parts, plan = files_read(picked)
    assert "dynamicpruning" in plan.lower() and max(parts) == 4
    assert sorted(r.ticker for r in picked.collect()) == ["m0", "m10", "m20", "m30"]


def test_write_counts_are_taken_while_writing(spark):
    rows = spark.range(1000).selectExpr("id AS event_ticker", "CASE WHEN id % 3 = 0 THEN 'insert' ELSE 'unchanged' END AS action")
    out, counts = jobs._counted(rows.repartition(7), *merge.write_counts())
    assert counts == merge.write_stats(out).first().asDict() == {"seen": 1000, "inserted": 334, "updated": 0, "unchanged": 666}
