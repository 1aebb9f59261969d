"""What must not grow with the input: a task's share, and the work a write repeats."""

import glob
import os
from datetime import datetime, timedelta
from decimal import Decimal as D

from pyspark.sql import functions as F

from takerlens import catalog
from takerlens.plans import jobs
from takerlens.sources import tables
from takerlens.sources.projection import LAYOUT

DAY = datetime(1995, 1, 1)


def write_tables(spark, folder, markets=400, lines=4):
    """Markets with `lines` trades each, in several files."""
    def put(name, rows):
        spark.createDataFrame(rows, LAYOUT[name]).repartition(4).write.parquet(f"{folder}/{name}.parquet")

    put("nation", [(k, f"N{k}", 0) for k in range(10)])
    put("customer", [(k, f"C{k}", k % 10, 1.0, "x") for k in range(1, 20)])
    put("orders", [(k, k % 19 + 1, "FO"[k % 2], DAY + timedelta(days=k * 5 % 2400)) for k in range(1, markets + 1)])
    put("lineitem", [(k, k, 1, n, float(k % 50 + n), 0.05, 0.02, "A", "O", DAY + timedelta(days=n))
                     for k in range(1, markets + 1) for n in range(1, lines + 1)])
    return str(folder)


def watched(monkeypatch):
    """The scratch folders a query makes."""
    made, real = [], catalog.scratch_dir
    monkeypatch.setattr(catalog, "scratch_dir", lambda spark, prefix: made.append(real(spark, prefix)) or made[-1])
    return made


def test_settled_markets_land_from_many_tasks(spark, tmp_path, monkeypatch):
    folder, made = write_tables(spark, tmp_path / "t"), watched(monkeypatch)
    monkeypatch.setattr(catalog.Tables, "terminal", lambda self, volume=False: self.markets(volume).repartition(3))
    rows = catalog.queries()["stream_chunk_counts"](spark, folder).collect()
    assert sum(r.settled for r in rows) == 390  # one in 40 has no settlement time
    assert len(glob.glob(f"{made[0]}/in/*.parquet")) == 6


def test_pages_land_compressed(spark, tmp_path, monkeypatch):
    folder, made = write_tables(spark, tmp_path / "t"), watched(monkeypatch)
    rows = catalog.queries()["json_ingest_trades"](spark, folder).collect()
    assert len(rows) == 400 and sum(r.trades + r.block_trades for r in rows) == 1600
    files = glob.glob(f"{made[0]}/trades/part-*")
    assert files and sum(map(os.path.getsize, files)) < 1600 * 100  # an item has about 200 characters


def test_running_tapes_land_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    folder, made = write_tables(spark, tmp_path / "t"), watched(monkeypatch)
    size = sum(os.path.getsize(f) for f in glob.glob(f"{folder}/lineitem.parquet/*.parquet"))
    monkeypatch.setattr(catalog, "FILE_BYTES", size // 8)
    rows = catalog.queries()["stream_running_tapes"](spark, folder).collect()
    assert len(rows) == 400 and sum(r.trades + r.block_trades for r in rows) == 1600
    assert len(glob.glob(f"{made[0]}/in/*.parquet")) >= 12
    assert len(glob.glob(f"{made[0]}/checkpoint/commits/[0-9]*")) == 4  # two triggers a run at any size


def test_given_markets_are_read_once_a_sweep(spark, tmp_path):
    """A later sweep looks for new and for late markets in one stored copy of what it was given."""
    store = jobs.Store(spark, str(tmp_path / "store"), days=30)
    store.tables["events"].upsert(spark.createDataFrame([("E", "S")], "event_ticker string, series_ticker string"))
    read = spark.sparkContext.accumulator(0)

    def feed(*rows):
        def seen(row):
            read.add(1)
            return row

        wide = "ticker string, event_ticker string, status string, result string, settlement_ts timestamp, volume decimal(18,2), arrival int"
        return spark.createDataFrame(spark.sparkContext.parallelize([(t, "E", "settled", "yes", at, D(1), 0) for t, at in rows], 1).map(seen), wide)

    day = lambda k: DAY + timedelta(days=k)
    trades = spark.createDataFrame([], jobs.TRADES).drop("trade_date")
    sweep = dict(now=day(400), chunk=timedelta(days=200), overlap=timedelta(0))
    first = feed(("A", day(10)), ("B", day(210)))
    assert jobs.sweep_job(store, first, trades, stop_after=1, **sweep)["markets"] == 1
    read.value = 0
    assert jobs.sweep_job(store, feed(("A", day(10)), ("B", day(210)), ("LATE", day(20))), trades, **sweep)["markets"] == 2
    assert read.value == 3
    assert sorted(r.ticker for r in store.read("markets_terminal").collect()) == ["A", "B", "LATE"]


SCHEMA = "ticker string, settlement_ts timestamp, n int, first string"


def test_new_days_are_written_without_a_merge(spark, tmp_path, monkeypatch):
    """Keys that nobody knows: days without a folder are not staged, the others are merged, and all rows are there."""
    table = tables.DatedTable(spark, str(tmp_path / "t"), SCHEMA, ["ticker"])
    staged, real = [], tables.scratch_dir
    monkeypatch.setattr(tables, "scratch_dir", lambda spark, prefix: staged.append(real(spark, prefix)) or staged[-1])

    def put(label, *rows):
        table.upsert(spark.createDataFrame(rows, "ticker string, settlement_ts timestamp, n int"), defaults={"first": F.lit(label)})
        return {r.ticker: (r.settlement_ts, r.n, r.first) for r in table.read().collect()}

    day = lambda k: DAY + timedelta(days=k)
    one = put("one", ("a", day(0), 1), ("b", day(1), 2), ("u", None, 3))
    assert staged == [] and one == {"a": (day(0), 1, "one"), "b": (day(1), 2, "one"), "u": (None, 3, "one")}
    two = put("two", ("c", day(1), 4), ("d", day(2), 5))  # a day that is there, and a new one
    assert len(staged) == 1 and two == one | {"c": (day(1), 4, "two"), "d": (day(2), 5, "two")}
    three = put("three", ("a", day(7), 6), ("e", day(8), 7))  # a known key moves to a new day and keeps what was not given
    assert three == two | {"a": (day(7), 6, "one"), "e": (day(8), 7, "three")}
    table.upsert(table.read().where("ticker = 'b'").selectExpr("'z' AS ticker", "settlement_ts + INTERVAL 20 DAYS AS settlement_ts", "n"))
    assert table.read().count() == 7  # rows made from the table itself


def test_landed_markets_are_stored_by_day_only(spark, tmp_path, monkeypatch):
    """A sweep of landed files writes their rows once, by settlement day, before it takes the windows."""
    store, staged, real = jobs.Store(spark, str(tmp_path / "store"), days=30), [], jobs._staged
    store.tables["events"].upsert(spark.createDataFrame([("E", "S")], "event_ticker string, series_ticker string"))
    given = spark.createDataFrame([("A", "E", "settled", "yes", DAY, D(1), 0)],
                                  "ticker string, event_ticker string, status string, result string, settlement_ts timestamp, volume decimal(18,2), settled_day int")
    fields = spark.createDataFrame([], jobs.SETTLED).schema
    store.settled.write(given.select(*[F.col(f.name) if f.name in given.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in fields]), 0)
    monkeypatch.setattr(jobs, "_staged", lambda rows: staged.append(rows.columns) or real(rows))
    trades = spark.createDataFrame([], jobs.TRADES).drop("trade_date")
    assert jobs.sweep_landed(store, f"{store.path}/landed", DAY + timedelta(days=9), trades)["markets"] == 1
    assert [r.series_ticker for r in store.read("markets_terminal").collect()] == ["S"]
    assert staged and not any("arrival" in columns for columns in staged)
