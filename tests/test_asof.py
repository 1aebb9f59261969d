"""As-of join of two tables, radix selection, doubled clock pointers and the domain join, against brute force."""

import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from takerlens.functions import rules
from takerlens.operators import domains, radix, snapshots, tape
from takerlens.operators.asof import asof_join
from tests.test_tape import TRADES, trade

T0 = datetime(2026, 5, 1)


@pytest.mark.parametrize("buckets", [1, 5])
@pytest.mark.parametrize("strict", [True, False])
def test_asof_equals_a_search(spark, buckets, strict):
    rng = random.Random(buckets)
    key = lambda: rng.choice(["HOT"] * 5 + ["A", "B", None])
    when = lambda: rng.choice([None] + [T0 + timedelta(minutes=rng.randint(0, 4000)) for _ in range(30)])
    left = [(key(), when(), i) for i in range(300)] + [("HOT", T0, 1)] * 2
    right = [(key(), when(), i, rng.choice(["x", None])) for i in range(200)]
    window = timedelta(hours=3)
    got = asof_join(spark.createDataFrame(left, "ticker string, at timestamp, n int"),
                    spark.createDataFrame(right, "ticker string, seen timestamp, m int, state string"),
                    ["ticker"], "at", "seen", window, ["m", "state"], order=["m"], strict=strict, buckets=buckets)

    def expected(row):
        near = [r for r in right if r[0] == row[0] and None not in (row[0], row[1], r[1]) and row[1] - r[1] < window
                and (r[1] < row[1] if strict else r[1] <= row[1])]
        best = max(near, key=lambda r: (r[1], r[2]), default=None)
        return (*row, *((best[1], best[2], best[3]) if best else (None, None, None)))

    assert got.columns == ["ticker", "at", "n", "prior_seen", "prior_m", "prior_state"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, map(expected, left)))
    with pytest.raises(ValueError):
        asof_join(got, got, ["ticker"], "at", "at", timedelta(0), [])


def test_asof_leaves_no_task_with_a_whole_market(spark):
    """One market of 400,000 runs: its buckets spread over all tasks."""
    runs = spark.range(400_000).selectExpr("'HOT' AS ticker", "timestamp'2026-01-01' + make_dt_interval(0, 0, 0, id) AS run_ts", "id")
    out = asof_join(runs.where("id % 2 = 0"), runs.where("id % 2 = 1"), ["ticker"], "run_ts", "run_ts", timedelta(hours=1), ["id"])
    sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 200_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k0#" in plan and "_bucket#" in plan.split("Window")[1]
    assert out.where("id > 0 AND prior_id <> id - 1").count() == 0


def test_radix_takes_the_newest_of_equal_times(spark):
    """A tape of 300,000 trades of one second, cut by its ids; no window over trades."""
    rows = spark.range(300_000).selectExpr(
        "concat('trade-', lpad(cast(id AS string), 9, '0')) AS trade_id", "if(id % 10 = 0, 'B', 'HOT') AS ticker", "0.4BD AS yes_price_dollars",
        "CAST(NULL AS decimal(10,6)) AS no_price_dollars", "CAST(1 + id % 7 AS decimal(18,2)) AS count_fp", "'yes' AS taker_side",
        "false AS is_block_trade", "timestamp'2026-08-08 10:00:00' AS created_time", "'live' AS origin")
    out = tape.capped_sums(rows, ["ticker"], 1000, 50, ["trade_id"])
    got = {r.ticker: (r.trades, r.size) for r in out.collect()}
    hot = [i for i in range(300_000) if i % 10][-50_000:]
    assert got == {"HOT": (50_000, 100 * sum(1 + i % 7 for i in hot)),
                   "B": (30_000, 100 * sum(1 + i % 7 for i in range(0, 300_000, 10)))}


def test_radix_ties_and_repeated_rows(spark):
    rows = [trade(7, "A", yes="0.5", n="2.00")] * 9 + [trade(8, "A", yes="0.5", n="1.00")] * 3 + [trade(9, "B", yes="0.5")] * 2
    out = tape.capped_sums(spark.createDataFrame(rows, TRADES), ["ticker"], 1, 5, ["trade_id"])
    assert {r.ticker: (r.trades, r.size) for r in out.collect()} == {"A": (5, 3 * 100 + 2 * 200), "B": (2, 200)}
    # Alike in all that orders them, but not alike: some five of them, always the same.
    odd = spark.createDataFrame([trade(7, "A", yes="0.5", n=f"{i}.00") for i in range(1, 9)], TRADES)
    picks = {tuple(r) for _ in range(2) for r in tape.capped_sums(odd.repartition(3), ["ticker"], 1, 5, ["trade_id"]).collect()}
    assert len(picks) == 1 and next(iter(picks))[1] == 5


@pytest.mark.parametrize("kind, values", [
    ("bigint", [0, 1, -1, 2**62, -2**63, 2**63 - 1, 15, 16]), ("int", [5, -7, 0]), ("boolean", [True, False]),
    ("decimal(10,6)", [D("0"), D("-0.000001"), D("0.4"), D("9999.999999"), D("-9999.5"), D("10")]), ("decimal(18,2)", [D("1.5"), D("-3"), D("0.01")]),
    ("string", ["", "a", "ab", "b", "A", "é", "a!", "aa"]), ("timestamp", [T0, datetime(1960, 1, 1), T0 + timedelta(microseconds=1)]),
    ("date", [T0.date(), datetime(1950, 2, 2).date()])])
def test_sortable_text_sorts_like_the_values(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], f"v {kind}")
    got = [r.v for r in df.withColumn("k", radix.sortable(F.col("v"), df.schema["v"].dataType)).orderBy("k").collect()]
    assert got == [None, *sorted(values, key=lambda v: v.encode() if isinstance(v, str) else v)]


def walked(runs, window):
    """Run by run: what is written."""
    last, out = None, []
    for at, pinned in runs:
        second = at.replace(microsecond=0)  # the clock has whole seconds
        if not pinned and (last is None or second - last >= window):
            out.append(at)
            last = second
        elif pinned:
            last = second
    return out


def test_doubled_pointers_equal_the_walk(spark):
    rng = random.Random(4)
    rows, expected = [], []
    for k in range(40):
        times = sorted(rng.sample(range(500), rng.choice([1, 2, 5, 60])))
        runs = [(T0 + timedelta(seconds=600 * t + rng.choice([0, 0, 0.5])), rng.random() < 0.15) for t in times]
        rows += [(f"m{k}", at, pinned) for at, pinned in runs]
        expected += [(f"m{k}", at) for at in walked(runs, timedelta(hours=4))]
    df = spark.createDataFrame(rows, "ticker string, run_ts timestamp_ntz, _pinned boolean").repartition(3)
    got = snapshots.due_runs(df, ["ticker"], 4 * 3600)
    whole = {(t, at.replace(microsecond=0)) for t, at in expected}
    assert {(r.ticker, r.run_ts.replace(microsecond=0)) for r in got.collect()} == whole and got.count() == len(expected)
    assert snapshots.due_runs(df, ["ticker"], 0).count() == sum(not p for *_, p in rows)


def test_a_stretch_of_a_hundred_thousand_runs(spark):
    runs = spark.range(100_000).selectExpr("'M' AS ticker", "timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, id) AS run_ts", "false AS _pinned")
    got = sorted(r.run_ts for r in snapshots.due_runs(runs, ["ticker"], 12 * 3600).collect())
    assert got == [datetime(2020, 1, 1) + timedelta(hours=12 * i) for i in range(139)]


def test_domain_join_equals_the_pattern(spark):
    rng = random.Random(2)
    label = lambda: rng.choice(["a", "b", "c", "gov", "org"])
    hosts = sorted({".".join(label() for _ in range(rng.randint(1, 5))) for _ in range(200)} | {"", "a..b", ".", "a.b."})
    lists = {"one": ["gov", "a.b", "c.org"], "two": ["b", "a.b.c.org"], "none": ["zz.zz"]}
    got = {r.host: list(r.labels) for r in domains.labels_of(
        spark.createDataFrame([(h,) for h in hosts] * 2 + [(None,)], "host string"), domains.domain_table(spark, lists)).collect()}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    flags = df.select("host", *[rules.in_group(F.col("host"), names).alias(g) for g, names in lists.items()]).collect()
    assert got == {r.host: found for r in flags if (found := sorted(g for g in lists if r[g]))}
    assert domains.labels_of(df, domains.domain_table(spark, lists).limit(0)).count() == 0


def test_many_links_get_the_tags_of_the_rules(spark):
    rng = random.Random(3)
    known = [d for names in [*rules.GROUPS.values(), *rules.DIFFICULTY.values()] for d in names] + ["x.com", "a.b.gov"]
    rows = []
    for i in range(120):
        links = [{"name": "n", "url": f"https://{rng.choice(['www.', 'x.', ''])}{rng.choice(known)}/p"} for _ in range(rng.choice([0, 1, 2, 6]))]
        rows.append((f"S{i}", rng.choice(["Sports", "Crypto", "Economics", "Politics", "", None, "Financials", "Other"]),
                     rng.choice(["custom", "daily", "one_off", None]), rng.choice([None, 3, 8]), links))
    schema = "series_ticker string, category string, frequency string, n_events bigint, settlement_sources array<struct<name:string,url:string>>"
    series = spark.createDataFrame(rows, schema)
    lists = domains.domain_table(spark, {**rules.GROUPS, **rules.DIFFICULTY})
    got = domains.classify_links(series.drop("settlement_sources"), domains.host_links(series), lists)
    names = rules.hosts(F.col("settlement_sources"))
    b = rules.benchmark(names, F.col("category"))
    want = series.select("series_ticker", F.size(names).cast("bigint").alias("n_hosts"), rules.settlement_source_type(names), b["benchmark"],
                         b["benchmark_name"], rules.recurrence(F.col("frequency"), F.col("n_events")), rules.scrape_difficulty(names))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_stored_state_is_the_newest_before(spark):
    stored = [(m, T0 + timedelta(hours=h), s) for m, h, s in (("A", 0, "x"), ("A", 5, "y"), ("A", 20, "z"), ("B", 1, "q"))]
    new = [("A", T0 + timedelta(hours=h), h) for h in (5, 6, 17, 18, 21)] + [("B", T0 + timedelta(hours=1), 1), ("C", T0, 0)]
    got = snapshots.stored_state(spark.createDataFrame(new, "ticker string, run_ts timestamp, n int"),
                                 spark.createDataFrame(stored, "ticker string, run_ts timestamp, status string"), 12, ["status"])
    assert {(r.ticker, r.n): r.prior_status for r in got.collect()} == {
        ("A", 5): "x", ("A", 6): "y", ("A", 17): None, ("A", 18): None, ("A", 21): "z", ("B", 1): None, ("C", 0): None}
