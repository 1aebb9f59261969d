import random
from datetime import datetime, timedelta
from decimal import Decimal as D

from pyspark.sql import functions as F

from takerlens.operators import snapshots, tape
from takerlens.sources.tables import BatchLog, SnapshotTable
from takerlens.streaming import flows
from tests.test_tape import TRADES, trade

T0 = datetime(2026, 11, 20)
STATES = "ticker string, run_ts timestamp, arrival bigint, status string"


def as_stream(spark, df, folder, parts):
    """Write each part as one file and stream one file per batch, in that order."""
    for part in parts:
        spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_folded_stream_equals_the_batch_fold(spark, tmp_path):
    rng = random.Random(1)
    rows = [trade(i, rng.choice("AAAB"), yes=f"0.{rng.randint(10, 99)}", side=rng.choice(["yes", "no"]), block=rng.random() < .1)
            for i in range(90)]
    df = spark.createDataFrame(rows, TRADES)
    stream = as_stream(spark, df, tmp_path / "in", [rows[:30], rows[30:60], rows[60:]])
    log = BatchLog(spark, str(tmp_path / "log"), flows.sums_schema("ticker string"))
    query = flows.fold_tapes(stream, log, str(tmp_path / "cp"))
    assert query.lastProgress["batchId"] == 2
    want = sorted(map(tuple, tape.tape_sums(df, ["ticker"]).collect()))
    assert sorted(map(tuple, flows.folded(log).collect())) == want
    # A batch written twice is still counted once.
    log.write(tape.tape_sums(df.limit(0).unionByName(spark.createDataFrame(rows[60:], TRADES)), ["ticker"]), 2)
    total = flows.folded(log).agg(F.sum("trades"), F.sum("block_trades")).first()
    assert sum(total) == 90
    # Nothing new: the next run adds nothing.
    flows.fold_tapes(stream, log, str(tmp_path / "cp"))
    assert sum(flows.folded(log).agg(F.sum("trades"), F.sum("block_trades")).first()) == 90


def test_running_totals_in_update_mode(spark, tmp_path):
    rows = [trade(i, "A", yes="0.5") for i in range(4)]
    stream = as_stream(spark, spark.createDataFrame(rows, TRADES), tmp_path / "in", [rows[:2], rows[2:]])
    query = flows.running_sums(stream).writeStream.outputMode("update").format("memory").queryName("running") \
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.trades for r in spark.table("running").orderBy("trades").collect()] == [2, 4]


def test_kept_totals_survive_triggers_restarts_and_compaction(spark, tmp_path):
    rng = random.Random(8)
    rows = [trade(i, rng.choice("AAAB"), yes=f"0.{rng.randint(10, 99)}", block=rng.random() < .1) for i in range(120)]
    df = spark.createDataFrame(rows, TRADES)
    log = BatchLog(spark, str(tmp_path / "log"), flows.sums_schema("ticker string"))
    for lo in (0, 60):
        stream = as_stream(spark, df, tmp_path / "in", [rows[lo + i:lo + i + 20] for i in (0, 20, 40)])
        flows.total_tapes(stream, log, str(tmp_path / "cp"), compact_every=2)
        assert len(log.batches()) == 1 and log.read().count() == log.read().select("ticker").distinct().count()
    want = sorted(map(tuple, tape.tape_sums(df, ["ticker"]).collect()))
    assert sorted(map(tuple, log.read().drop("batch_id").collect())) == want
    # A compaction that stopped before the older batches were gone, and a write that stopped before its last step.
    log.write(tape.tape_sums(df.limit(3), ["ticker"]), 1)
    assert sorted(map(tuple, log.latest(["ticker"]).drop("batch_id").collect())) == want
    log.compact(["ticker"], log.batches()[-1])
    assert log.batches() == [5]
    (tmp_path / "log" / "batch_id=5").rename(tmp_path / "log" / "_writing-5")
    (tmp_path / "log" / "_writing-5" / "_SUCCESS").touch()
    assert sorted(map(tuple, log.read().drop("batch_id").collect())) == want


def test_windows_are_recounted_however_late(spark, tmp_path):
    schema = "ticker string, settlement_ts timestamp, volume decimal(18,2)"
    at = lambda h: T0 + timedelta(hours=h)
    log = BatchLog(spark, str(tmp_path / "log"), f"{schema}, chunk bigint", ["chunk"])
    counts = BatchLog(spark, str(tmp_path / "counts"), "chunk bigint, settled bigint, ingest_eligible bigint, tape_eligible bigint")
    batches = [[("A", at(1), D(5)), ("B", at(40), D(0)), ("U", None, D(1))], [("LATE", at(2), D(500)), ("C", at(-3), D(1))],
               [("B", at(1), D(7)), ("A", at(1), D(0))]]
    empty = spark.createDataFrame(batches[0], schema).limit(0)
    for rows in batches:
        stream = as_stream(spark, empty, tmp_path / "in", [rows])
        flows.chunk_counts(stream, log, counts, str(tmp_path / "cp"), T0, timedelta(hours=12), 1, 100)
    got = {r.chunk: (r.settled, r.ingest_eligible, r.tape_eligible) for r in counts.latest(["chunk"]).collect()}
    assert got == {1: (3, 2, 1), 4: (0, 0, 0), 0: (1, 1, 0)}


def test_settled_markets_last_write_wins(spark, tmp_path):
    schema = "ticker string, status string, result string, volume int, n int"
    rows = [("A", "finalized", "yes", 5, 1), ("B", "active", "", 5, 2), ("A", "finalized", "no", 5, 3), ("C", "settled", "no", 0, 4)]
    stream = as_stream(spark, spark.createDataFrame(rows, schema), tmp_path / "in", [rows[:2], rows[2:]])
    log = BatchLog(spark, str(tmp_path / "log"), schema)
    flows.ingest_settled(stream, log, str(tmp_path / "cp"), ["n"], minimum_volume=1)
    assert [(r.ticker, r.result) for r in log.latest(["ticker"], ["n"]).collect()] == [("A", "no")]


def test_snapshot_stream_equals_one_replay(spark, tmp_path):
    rng = random.Random(3)
    rows = [(t, T0 + timedelta(hours=h), h, rng.choice(["x", "x", "y"])) for h in range(0, 60, 3) for t in "AB"]
    df = spark.createDataFrame(rows, STATES)
    stream = as_stream(spark, df, tmp_path / "in", [rows[i:i + 10] for i in range(0, 40, 10)])
    table = SnapshotTable(spark, str(tmp_path / "table"), "ticker string, run_ts timestamp, status string")
    flows.append_snapshots(stream, table, str(tmp_path / "cp"), str(tmp_path / "staging"), 12, ["run_ts", "arrival"])
    want = snapshots.skip_unchanged(df, None, 12, ["run_ts", "arrival"]).select("ticker", "run_ts", "status")
    got = table.read().select("ticker", "run_ts", "status")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() < len(rows)
    # The window read opens only the folders it needs.
    plan = table.since(T0 + timedelta(hours=50))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run_minute" in plan
    assert len(table.prune(T0 + timedelta(hours=30))) > 0
    assert table.read().agg(F.min("run_ts")).first()[0] >= T0 + timedelta(hours=30)


def test_scratch_folder_needs_a_shared_place(spark):
    from takerlens.session import scratch_dir
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b
