import random
import statistics
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from takerlens.operators import snapshots
from takerlens.operators.quantile import grouped_median
from takerlens.plans import activity, health
from takerlens.plans.screen import Thresholds, screen, screen_funnel

T0 = datetime(2026, 11, 20)
SCHEMA = "ticker string, run_ts timestamp, status string, v int"


def at(hours):
    return T0 + timedelta(hours=hours)


def frame(spark, rows):
    return spark.createDataFrame([(t, at(h), s, v) for t, h, s, v in rows], SCHEMA)


def keys(df):
    return sorted((r.ticker, int((r.run_ts - T0).total_seconds() // 3600)) for r in df.collect())


def test_latest_drops_closed_rows_before_the_pick(spark):
    df = frame(spark, [("A", 1, "active", 1), ("A", 2, "closed", 2), ("B", 0, "active", 1), ("B", 3, "active", 2),
                       ("C", 3, None, 1), ("D", -22, "active", 1), ("D", -21, "settled", 1)])
    got = {r.ticker: r.v for r in snapshots.latest_snapshot(df, at(3)).collect()}
    assert got == {"A": 1, "B": 2}
    assert {r.ticker for r in snapshots.latest_snapshot(df, at(1.5)).collect()} == {"A", "B", "D"}


def test_one_run_skips_equal_recent_rows(spark):
    stored = frame(spark, [("A", 0, "x", 1), ("B", 0, "x", 1), ("C", -6, "x", 1), ("D", -7, "x", 2), ("D", 0, "x", 1), ("F", 6, "x", 3)])
    run = frame(spark, [("A", 6, "x", 1), ("B", 6, "x", 2), ("C", 6, "x", 1), ("D", 6, "x", 2), ("E", 6, None, None), ("F", 6, "x", 4)])
    # C is exactly 12 h old, so it is refreshed; F replaces the same key.
    assert keys(snapshots.skip_unchanged(run, stored, 12)) == [("B", 6), ("C", 6), ("D", 6), ("E", 6), ("F", 6)]
    assert keys(snapshots.skip_unchanged(run, None, 12)) == [(t, 6) for t in "ABCDEF"]


def test_duplicate_rows_of_one_run_count_once(spark):
    run = frame(spark, [("A", 0, "x", 1), ("B", 0, "x", 1), ("B", 0, "x", 2), ("C", 0, "x", 1)]).withColumn("n", F.monotonically_increasing_id())
    stored = frame(spark, [("A", -1, "x", 1)])
    out = snapshots.skip_unchanged(run, stored, 12, ["n"])
    assert {r.ticker: r.v for r in out.collect()} == {"B": 2, "C": 1}


def replay(rows, stored, window):
    """Row-by-row rule: compare with the newest row written inside the window."""
    table = {(t, h): (s, v) for t, h, s, v in stored}
    out = []
    for t, h, s, v in sorted(rows, key=lambda r: r[1]):
        near = [k for k in table if k[0] == t and h - window < k[1] < h]
        if near and table[max(near, key=lambda k: k[1])] == (s, v):
            continue
        table[(t, h)] = (s, v)
        out.append((t, h))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_replay_of_many_runs_equals_the_row_by_row_rule(spark, seed):
    rng = random.Random(seed)
    def make(lo, hi, step):
        return [(t, h, rng.choice(["x", "x", None]), rng.choice([1, 1, 1, 2])) for t in ("HOT", "A", "B")
                for h in range(lo, hi, step) if t == "HOT" or rng.random() < 0.4]
    stored, rows = make(-40, 0, 5), make(0, 60, 2)
    assert keys(snapshots.skip_unchanged(frame(spark, rows), frame(spark, stored), 12)) == replay(rows, stored, 12)


def test_prior_state_is_bounded(spark):
    df = frame(spark, [("A", 0, "x", 1), ("A", 5, "y", 2), ("A", 17, "z", 3), ("B", 1, "x", 1)])
    got = {(r.ticker, r.v): r.prior_v for r in snapshots.prior_state(df, 12, ["run_ts"], ["v"]).collect()}
    assert got == {("A", 1): None, ("A", 2): 1, ("A", 3): None, ("B", 1): None}


@pytest.mark.parametrize("seed", range(3))
def test_median_is_exact_for_skewed_groups(spark, seed):
    rng = random.Random(seed)
    values = {"hot": [D(rng.choice([0, 0, 0, rng.randint(-500, 10 ** rng.randint(1, 12))])) / 100 for _ in range(3000)],
              "even": [D("0.01"), D("0.02")], "one": [D(-7)], "neg": [D(-3), D(-1), D(-2), D("-0.5")]}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v decimal(20,6)")
    got = {r.g: r.median for r in grouped_median(df, ["g"], "v").collect()}
    assert got == {g: pytest.approx(float(statistics.median(vs)), rel=1e-15) for g, vs in values.items()}


def market(t, series, vol, bid, ask):
    return (t, series, T0, None if vol is None else D(vol), D(bid), D(ask))


def test_activity_and_screen(spark):
    latest = spark.createDataFrame(
        [market("a", "S", "900", "0.10", "0.14"), market("b", "S", "300", "0.50", "0.52"), market("c", "S", "0", "0.01", "0.99"),
         market("d", "T", "0", "0.1", "0.2"), market("e", "U", "2000", "0.1", "0.2"), market("f", None, "5", "0.1", "0.2")],
        "ticker string, series_ticker string, run_ts timestamp, volume_24h decimal(18,2), yes_bid decimal(10,6), yes_ask decimal(10,6)")
    series = spark.createDataFrame([("S", "quadratic"), ("T", None), ("U", "quadratic_with_maker_fees"), ("V", None)],
                                   "series_ticker string, fee_type string") \
        .selectExpr("*", "'t' AS title", "'c' AS category", "'daily' AS frequency", "1 AS fee_multiplier")
    act = activity.series_activity(series, latest)
    rows = {r.series_ticker: r for r in act.collect()}
    s, t = rows["S"], rows["T"]
    assert set(rows) == {"S", "T", "U"}
    assert (s.open_markets, s.live_markets, s.breadth, s.med_mkt_vol24h, s.sum_vol24h_latest) == (3, 2, D("0.667"), 300.0, D(1200))
    assert s.top_market_share == 0.75 and s.med_spread_dollars == pytest.approx(0.03) and s.as_of == T0
    assert (t.live_markets, t.breadth, t.top_market_share, t.med_spread_cents) == (0, D(0), None, None)

    tags = spark.createDataFrame([(x, "official_report", "none", "recurring", "low") for x in "STUV"],
                                 "series_ticker string, settlement_source_type string, benchmark string, recurrence string, scrape_difficulty string")
    bleed = spark.createDataFrame([("S", 20, D(5), -1.0, -2.0), ("T", 30, D(5), -1.0, None), (None, 99, D(1), 0.0, 0.0)],
                                  "series_ticker string, n_settled bigint, contracts decimal(22,2), gross_bleed_cents_per_ct double, feeadj_bleed_cents_per_ct double")
    assert [r.series_ticker for r in screen(series, tags, act, bleed).collect()] == ["S"]
    loose = Thresholds(volume_low=0, breadth=0, n_settled=0)
    assert [r.series_ticker for r in screen(series, tags, act, bleed, loose).collect()][0] == "S"
    assert len(screen(series, tags, act, bleed, loose).columns) == 20
    f = screen_funnel(series, tags, act, bleed).first()
    assert tuple(f) == (4, 4, 4, 4, 4, 3, 2, 2, 3, 1)


def test_one_third_of_a_ladder_is_not_enough(spark):
    assert not spark.range(1).select(F.lit(D("0.333")) >= F.lit("0.34").cast("decimal(6,3)")).first()[0]


def test_health(spark):
    snaps = frame(spark, [("A", 0, "active", 1), ("B", -30, "active", 1)])
    terminal = spark.createDataFrame([("M", None, at(-1)), ("N", "S", at(-40))], "ticker string, series_ticker string, ingested_at timestamp")
    stats = spark.createDataFrame([("M", at(-24))], "ticker string, computed_at timestamp")
    r = health.ingest_health(snaps, terminal, stats, at(1.5)).first()
    assert (r.last_snapshot_run, r.snapshot_age_hours, r.markets_in_latest_window) == (T0, 1.5, 1)
    assert (r.last_terminal_ingest, r.terminal_last_24h, r.tapes_last_24h, r.unlinked_terminal) == (at(-1), 1, 0, 1)
