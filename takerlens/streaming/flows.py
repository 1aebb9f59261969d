"""Structured Streaming flows.

Each flow writes through `foreachBatch` under the batch id or the row's own key,
so a batch that runs again after a failure leaves the same table. The offsets
live in the checkpoint; no cursor row is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from takerlens.operators.chunks import CHUNK
from takerlens.operators.filters import settled_ingest
from takerlens.operators.merge import last_wins
from takerlens.operators.snapshots import skip_unchanged
from takerlens.operators.tape import SUMS, merge_sums, tape_sums
from takerlens.sources.tables import BatchLog, SnapshotTable


def file_stream(spark: SparkSession, folder: str, name: str, schema: str,
                files_per_batch: int | None = None) -> DataFrame:
    """Parquet files matching `name` in a folder as a stream, each file once."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _run(stream: DataFrame, sink, checkpoint: str, once: bool, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
    if once:
        query.awaitTermination()
    return query


def sums_schema(keys: str = "ticker bigint") -> str:
    return ", ".join([keys, *[f"{c} bigint" for c in SUMS]])


def fold_tapes(trades: DataFrame, log: BatchLog, checkpoint: str, keys: Sequence[str] = ("ticker",),
               once: bool = True) -> StreamingQuery:
    """Append each micro-batch's tape sums; their total is the tape so far.

    Sums of parts add up, so no state is held between batches and a batch costs
    its own trades only.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        log.write(tape_sums(batch, list(keys)), batch_id)

    return _run(trades, sink, checkpoint, once)


def folded(log: BatchLog, keys: Sequence[str] = ("ticker",)) -> DataFrame:
    return merge_sums(log.read().drop("batch_id"), list(keys))


def total_tapes(trades: DataFrame, log: BatchLog, checkpoint: str, keys: Sequence[str] = ("ticker",), compact_every: int = 10,
                once: bool = True) -> StreamingQuery:
    """The fold with kept state: each trigger appends the new totals of the tapes it touched.

    `log.latest(keys)` are the tapes so far. Every `compact_every` triggers, and at the end of a run that ends, the batches that are
    committed are folded into one row a tape, so the log does not grow with the number of triggers. State has
    one row of sums a tape and never expires.
    """
    keys = list(keys)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch_id % compact_every == 0:
            log.compact(keys, batch_id - 1)  # this batch may run again, those before it may not
        log.write(batch, batch_id)

    query = _run(running_sums(trades, keys), sink, checkpoint, once, "update")
    if once and log.batches():
        log.compact(keys, log.batches()[-1])
    return query


def running_sums(trades: DataFrame, keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """The same fold as a stateful aggregate, for update-mode sinks that want totals at once."""
    return tape_sums(trades, list(keys))


def ingest_settled(markets: DataFrame, log: BatchLog, checkpoint: str, order: Sequence[str],
                   minimum_volume: float | None = None, once: bool = True) -> StreamingQuery:
    """Append settled markets; `log.latest(["ticker"])` is the table, the last write wins."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        log.write(last_wins(settled_ingest(batch, minimum_volume), ["ticker"], order), batch_id)

    return _run(markets, sink, checkpoint, once)


def chunk_counts(settled: DataFrame, log: BatchLog, counts: BatchLog, checkpoint: str, since: datetime,
                 chunk: timedelta = CHUNK, ingest_minimum: float = 0, tape_minimum: float = 0, once: bool = True) -> StreamingQuery:
    """Counts per settlement window, however late a market lands or moves to another window.

    There is no watermark: a batch recounts the windows its markets are in now or were in before, and only
    these folders of `log` (partitioned by chunk) are read for it. `counts.latest(["chunk"])` is the report; windows are half-open from `since`.
    """
    width = int(chunk.total_seconds()) * 1_000_000
    volume = F.coalesce(F.col("volume"), F.lit(0))

    def sink(batch: DataFrame, batch_id: int) -> None:
        kind = dict(batch.dtypes)["settlement_ts"]
        start = F.lit(since.isoformat(sep=" ")).cast(kind) if kind == "timestamp_ntz" else F.lit(since)
        at = F.unix_micros(F.col("settlement_ts").cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
        rows = batch.where("settlement_ts IS NOT NULL").select(
            "ticker", "settlement_ts", "volume", (F.floor(at / width) + 1).cast("bigint").alias("chunk"))
        log.write(last_wins(rows, ["ticker"], ["settlement_ts"]), batch_id)
        held = log.read()
        fresh = held.where(F.col("batch_id") == batch_id).select("ticker")
        touched = [r[0] for r in held.join(fresh, "ticker", "left_semi").select("chunk").distinct().collect()]
        known = last_wins(held.where(F.col("chunk").isin(touched)), ["ticker"], ["batch_id"])
        found = known.groupBy("chunk").agg(F.count("*").alias("settled"), F.count_if(volume >= ingest_minimum).alias("ingest_eligible"),
                                           F.count_if(volume >= tape_minimum).alias("tape_eligible"))
        every = batch.sparkSession.createDataFrame([(c,) for c in touched], "chunk bigint")
        counts.write(every.join(found, "chunk", "left").na.fill(0), batch_id)

    return _run(settled, sink, checkpoint, once)


def append_snapshots(snapshots: DataFrame, table: SnapshotTable, checkpoint: str, staging: str,
                     window_hours: float = 12, order: Sequence[str] = ("run_ts",),
                     once: bool = True) -> StreamingQuery:
    """Append snapshot runs, leaving out markets whose state has not changed."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        first = batch.select(F.min("run_ts")).first()[0]
        if first is None:
            return
        low = F.lit(first) - F.make_dt_interval(secs=F.lit(round(window_hours * 3600)).cast("decimal(18,6)"))
        stored = table.since(low).drop("run_minute")
        written = skip_unchanged(batch, stored, window_hours, order)
        table.append(written.drop(*[c for c in order if c != "run_ts"]), f"{staging}/{batch_id}")

    return _run(snapshots, sink, checkpoint, once)
