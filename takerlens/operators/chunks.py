"""Settlement-time windows of a sweep."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takerlens.functions.values import seconds_between

CHUNK = timedelta(hours=12)
OVERLAP = timedelta(hours=2)
FIRST_LOOKBACK = timedelta(days=3)


def sweep_start(cursor: datetime | None, now: datetime, lookback: timedelta | None = FIRST_LOOKBACK,
                overlap: timedelta | None = OVERLAP) -> datetime | None:
    """Where a sweep resumes: `overlap` before the stored cursor, else `lookback` back; None: from the first market."""
    if cursor is None:
        return None if lookback is None else now - lookback
    return None if overlap is None else cursor - overlap


def _moment(moment: datetime, kind: str) -> Column:
    """A literal of a time column's type; a naive time is the column's own where that has no zone."""
    return F.lit(moment.isoformat(sep=" ")).cast(kind) if kind == "timestamp_ntz" else F.lit(moment)


def plan_chunks(spark: SparkSession, since: datetime, until: datetime, chunk: timedelta = CHUNK,
                kind: str = "timestamp") -> DataFrame:
    """chunk, lo, hi: consecutive windows from `since`, the last one short.

    An empty range still gives one (empty) window.
    """
    width = int(chunk.total_seconds())
    if width <= 0:
        raise ValueError("chunk must be positive")
    n = max(1, -(-int((until - since).total_seconds()) // width))
    first, last = _moment(since, kind), _moment(until, kind)
    lo = first + F.make_dt_interval(secs=(F.col("id") * width).cast("decimal(18,6)"))
    hi = F.least(last, lo + F.make_dt_interval(secs=F.lit(width).cast("decimal(18,6)")))
    return spark.range(n).select((F.col("id") + 1).alias("chunk"), lo.alias("lo"),
                                 F.when(lo < last, hi).otherwise(last).alias("hi"))


def chunk_of(moment: Column, since: Column, until: Column, chunk: timedelta = CHUNK) -> Column:
    """1-based window number: half-open windows, the last one closed at `until`."""
    width = int(chunk.total_seconds())
    index = F.floor(seconds_between(moment, since) / width)
    final = F.greatest(F.ceil(seconds_between(until, since) / width) - 1, F.lit(0))
    return (F.least(index, final) + 1).cast("bigint")


def chunk_report(settled: DataFrame, since: datetime | None = None, until: datetime | None = None,
                 chunk: timedelta = CHUNK, ingest_minimum: float = 0, tape_minimum: float = 0) -> DataFrame:
    """Every window with its bounds: settled markets, those at or above the ingest gate and the tape gate.

    Empty windows are there with zeros. The range is the data's own where it is not given.
    """
    kind = dict(settled.dtypes)["settlement_ts"]
    if since is None or until is None:
        first, last = settled.agg(F.min("settlement_ts"), F.max("settlement_ts")).first()
        since, until = since or first, until or last
        if since is None or until is None:
            since = until = datetime(1970, 1, 1)
    low, high = _moment(since, kind), _moment(until, kind)
    inside = settled.where((F.col("settlement_ts") >= low) & (F.col("settlement_ts") <= high))
    volume = F.coalesce(F.col("volume"), F.lit(0))
    counted = inside.groupBy(chunk_of(F.col("settlement_ts"), low, high, chunk).alias("chunk")).agg(
        F.count("*").alias("settled"), F.count_if(volume >= ingest_minimum).alias("ingest_eligible"),
        F.count_if(volume >= tape_minimum).alias("tape_eligible"))
    planned = plan_chunks(settled.sparkSession, since, until, chunk, kind)
    return planned.join(counted, "chunk", "left").select(
        "chunk", "lo", "hi", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("settled", "ingest_eligible", "tape_eligible")])


def busy_chunks(settled: DataFrame, since: datetime, until: datetime, chunk: timedelta = CHUNK) -> list[tuple[datetime, datetime]]:
    """The windows that hold rows, oldest first; rows from before `since` fall in windows that continue backwards.

    Windows are half-open, the one that ends at `until` holds it too. One window number each reaches the driver.
    """
    width = int(chunk.total_seconds())
    if width <= 0:
        raise ValueError("chunk must be positive")
    last = max(0, -(-int((until - since).total_seconds()) // width) - 1)
    kind = dict(settled.dtypes)["settlement_ts"]
    moved = F.unix_micros(F.col("settlement_ts").cast("timestamp")) - F.unix_micros(_moment(since, kind).cast("timestamp"))
    number = F.least(F.floor(moved / (width * 1_000_000)), F.lit(last))
    found = settled.where(F.col("settlement_ts") <= _moment(until, kind)).select(number.alias("k")).distinct().collect()
    return [(since + k * chunk, min(since + (k + 1) * chunk, until)) for k in sorted(r["k"] for r in found)]


def in_chunk(low: datetime, high: datetime, until: datetime, kind: str = "timestamp") -> Column:
    """Rows of a window: half-open, but closed where it ends the range."""
    at = F.col("settlement_ts")
    upper = at <= _moment(high, kind) if high >= until else at < _moment(high, kind)
    return (at >= _moment(low, kind)) & upper
