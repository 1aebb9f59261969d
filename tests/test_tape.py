import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from takerlens.operators import radix, tape
from takerlens.plans import bleed, quality

TRADES = ("trade_id string, ticker string, yes_price_dollars decimal(10,6), no_price_dollars decimal(10,6), "
          "count_fp decimal(18,2), taker_side string, is_block_trade boolean, created_time timestamp, origin string")
T0 = datetime(2026, 8, 6, 20, 33)


def trade(i, ticker="M", yes=None, no=None, n="1.00", side="yes", block=False, minute=0, origin="live"):
    dec = lambda x: None if x is None else D(x)
    return (f"t{i:05d}", ticker, dec(yes), dec(no), dec(n), side, block, T0 + timedelta(minutes=minute), origin)


def stats(spark, trades, markets, **kw):
    m = spark.createDataFrame(markets, "ticker string, result string, fee_multiplier decimal(6,4)")
    sums = kw.pop("sums", None)
    t = spark.createDataFrame(trades, TRADES)
    options = {"page_cap": None, **kw}
    if options["page_cap"] is None:
        s = tape.tape_sums(t, ["ticker"])
    else:
        s = tape.capped_sums(t, ["ticker"], options["page_size"], options["page_cap"], ["trade_id"])
    return {r.ticker: r for r in tape.score(m, sums or s, **options).collect()}


def test_hand_checked_tape(spark):
    rows = [trade(1, yes="0.01", no="0.99", n="30.00", side="no"), trade(2, yes="0.01", no="0.99", n="1.00", side="no"),
            trade(3, yes="0.01", no="0.99", n="300.00", side="no"), trade(4, yes="0.02", no="0.98", n="249.30", side="no"),
            trade(5, yes="0.02", no="0.98", n="4.82", side="no")]
    r = stats(spark, rows, [("M", "no", None)])["M"]
    assert r.taker_gross_pnl_cents == D("839.24") and r.taker_fee_est_cents == D("57.803564")
    assert r.contracts == D("585.12") and r.taker_yes_vwap_cents is None and r.trades == 5
    assert r.taker_no_vwap_cents == (D(331) * 99 + D("254.12") * 98).quantize(D("0.01")) / D("585.12") \
        or abs(r.taker_no_vwap_cents - (D(331) * 99 + D("254.12") * 98) / D("585.12")) < D("1e-9")


def test_sub_cent_prices_stay_exact(spark):
    rows = [trade(1, yes="0.123456", n="7.77"), trade(2, yes="0.999999", n="0.01", side="no")]
    r = stats(spark, rows, [("M", "yes", D("0.5"))])["M"]
    pnl = (1 - D("0.123456")) * 100 * D("7.77") + (0 - (1 - D("0.999999"))) * 100 * D("0.01")
    fee = sum(7 * p * (1 - p) * n for p, n in ((D("0.123456"), D("7.77")), (D("0.999999"), D("0.01")))) / 2
    assert r.taker_gross_pnl_cents == pnl and r.taker_fee_est_cents == fee


def test_large_tape_does_not_overflow(spark):
    rows = [trade(i, yes="0.5", n="999999999.99") for i in range(40)]
    r = stats(spark, rows, [("M", "yes", None)])["M"]
    assert r.contracts == D("999999999.99") * 40
    assert r.taker_fee_est_cents == 7 * D("0.25") * D("999999999.99") * 40


def test_missing_price_is_derived_and_none_is_an_error(spark):
    r = stats(spark, [trade(1, yes="0.40"), trade(2, no="0.60")], [("M", "yes", None)])["M"]
    assert r.taker_gross_pnl_cents == D(120)
    with pytest.raises(Exception, match="without a price"):
        stats(spark, [trade(1)], [("M", "yes", None)])


def test_results_other_than_yes_no_claim_nothing(spark):
    markets = [("M", "", None), ("N", None, None), ("P", "YES", None)]
    rows = [trade(1, "M", yes="0.4", side="odd"), trade(2, "N", yes="0.4"), trade(3, "P", yes="0.4")]
    for r in stats(spark, rows, markets).values():
        assert r.taker_gross_pnl_cents is None and r.taker_fee_est_cents is None and r.trades == 1 and r.contracts == 1


def test_bad_side_is_an_error_for_a_binary_market(spark):
    with pytest.raises(Exception, match="taker side"):
        stats(spark, [trade(1, yes="0.4", side="bid")], [("M", "yes", None)])
    assert stats(spark, [trade(1, yes="0.4", side="YES")], [("M", "yes", None)])["M"].taker_yes_contracts == 1


def test_multiplier_zero_is_free_and_missing_is_one(spark):
    rows = [trade(1, "A", yes="0.5"), trade(2, "B", yes="0.5")]
    got = stats(spark, rows, [("A", "yes", D(0)), ("B", "yes", None)])
    assert got["A"].taker_fee_est_cents == 0 and got["B"].taker_fee_est_cents == D("1.75")


def test_untraded_market_still_has_a_row_and_blocks_are_counted(spark):
    got = stats(spark, [trade(1, "B", yes="0.5", block=True)], [("A", "no", None), ("B", "no", None)])
    assert got["A"].trades == 0 and got["A"].taker_gross_pnl_cents == 0 and got["A"].pages_read == 0
    assert got["B"].trades == 0 and got["B"].block_trades_skipped == 1 and not got["B"].truncated


def test_taker_and_maker_cancel(spark):
    """The maker holds the other side at the other price, so swapping sides flips the sign."""
    rows = [trade(1, "A", yes="0.3", n="5"), trade(2, "B", yes="0.3", n="5", side="no")]
    got = stats(spark, rows, [("A", "yes", None), ("B", "yes", None)])
    assert got["A"].taker_gross_pnl_cents + got["B"].taker_gross_pnl_cents == 0


def test_tape_ending_at_the_cap_is_truncated(spark):
    rows = [trade(i, "A", yes="0.5", minute=i) for i in range(6)] + [trade(i, "B", yes="0.5", minute=i) for i in range(4)]
    got = stats(spark, rows, [("A", "yes", None), ("B", "yes", None)], page_size=2, page_cap=3)
    assert (got["A"].truncated, got["A"].pages_read, got["B"].truncated, got["B"].pages_read) == (True, 3, False, 2)


@pytest.mark.parametrize("digits", [1, 4])
def test_capped_fold_equals_sorting_the_tape(spark, monkeypatch, digits):
    """One market holds most trades, many in one minute; few characters a round force several rounds."""
    monkeypatch.setattr(radix, "DIGITS", digits)
    rng = random.Random(5)
    rows = [trade(i, rng.choice(["HOT", "HOT", "HOT", "A", "B"]), yes=f"0.{rng.randint(1, 99):02d}",
                  n=f"{rng.randint(1, 500) / 100:.2f}", side=rng.choice(["yes", "no"]), block=rng.random() < 0.1,
                  minute=rng.choice([0, 0, 0, 1, 61, 200, 5000])) for i in range(400)]
    got = stats(spark, rows, [(m, "yes", None) for m in ("HOT", "A", "B")], page_size=10, page_cap=5)
    for m in ("HOT", "A", "B"):
        mine = sorted((r for r in rows if r[1] == m and not r[6]), key=lambda r: (r[7], r[0]), reverse=True)[:50]
        pnl = sum((int(r[5] == "yes") - (r[2] if r[5] == "yes" else 1 - r[2])) * 100 * r[4] for r in mine)
        assert (got[m].trades, got[m].taker_gross_pnl_cents) == (len(mine), pnl)
        assert got[m].pages_read == -(-len(mine) // 10) and got[m].truncated == (len(mine) > 40)
        assert got[m].block_trades_skipped == sum(r[1] == m and r[6] for r in rows)


def test_fallback_takes_the_whole_archived_tape(spark):
    rows = [trade(1, "A", yes="0.5", origin="live"), trade(2, "A", yes="0.5", origin="archive"),
            trade(3, "B", yes="0.5", block=True, origin="live"), trade(4, "B", yes="0.5", n="3", origin="archive"),
            trade(5, "C", yes="0.5", block=True, origin="live")]
    sums = tape.prefer_live(tape.tape_sums(spark.createDataFrame(rows, TRADES), ["ticker", "origin"]))
    got = {r.ticker: (r.origin, r.size, r.block_trades) for r in sums.collect()}
    assert got == {"A": ("live", 100, 0), "B": ("archive", 300, 0), "C": ("archive", 0, 0)}


def test_bleed_and_exclusions(spark):
    terminal = spark.createDataFrame([("A", "S", "yes"), ("B", "S", "no"), ("C", "S", "scalar"), ("D", None, "yes"),
                                      ("E", "S", None), ("F", "Z", "yes")], "ticker string, series_ticker string, result string")
    s = spark.createDataFrame(
        [("A", D(10), D(-50), D(5), False), ("B", D(90), D(9), None, True), ("C", D(1), None, None, False),
         ("D", D(0), D(0), D(0), False), ("E", D(1), None, None, False)],
        "ticker string, contracts decimal(22,2), taker_gross_pnl_cents decimal(34,8), taker_fee_est_cents decimal(38,18), truncated boolean")
    got = {r.series_ticker: r for r in bleed.taker_bleed(terminal, s).collect()}
    assert set(got) == {"S", None}
    assert (got["S"].n_settled, got["S"].n_truncated, got["S"].contracts) == (1, 1, D(10))
    assert (got["S"].gross_bleed_cents_per_ct, got["S"].feeadj_bleed_cents_per_ct) == (-5.0, -5.5)
    assert got[None].gross_bleed_cents_per_ct is None
    ex = {r.series_ticker: r for r in bleed.bleed_exclusions(terminal, s).collect()}
    assert (ex["S"].n_non_binary_result, ex["S"].n_truncated, ex["S"].n_null_result) == (1, 1, 1)


def test_reconciliation_finds_a_wrong_row(spark):
    t = spark.createDataFrame([trade(1, "A", yes="0.25", n="2"), trade(2, "B", no="0.25", n="2", side="no")], TRADES)
    m = spark.createDataFrame([("A", "yes", None), ("B", "yes", None)], "ticker string, result string, fee_multiplier decimal(6,4)")
    good = tape.score(m, tape.tape_sums(t, ["ticker"]), page_cap=None)
    wrong = good.withColumn("taker_gross_pnl_cents", F.expr("taker_gross_pnl_cents + if(ticker = 'B', 1, 0)"))
    volumes = spark.createDataFrame([("A", D(2))], "ticker string, volume decimal(18,2)")
    check = quality.independent_totals(t, m)
    assert quality.reconciliation_summary(quality.reconcile(good, check, volumes)).first().mismatches == 0
    bad = quality.reconcile(wrong, check, volumes).where("NOT matches").collect()
    assert [r.ticker for r in bad] == ["B"]


def test_outcome_side_can_stand_in(spark):
    t = spark.createDataFrame([trade(1, yes="0.4", side=None)], TRADES).withColumn("taker_outcome_side", F.lit("no"))
    row = tape.tape_sums(t, ["ticker"], use_outcome_side=True).first()
    assert (row.no_size, row.bad_side) == (100, 0)
