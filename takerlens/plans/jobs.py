"""The batch jobs over landed pages and a folder of tables.

Job metadata (counts, cursors, days) is the only thing that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from takerlens.operators import chunks, filters, ingest, linkage, merge, retention, snapshots, tape, worklist
from takerlens.plans import activity, bleed, classify, screen
from takerlens.plans.screen import Thresholds
from takerlens.session import cleared_scratch, scratch_dir, size_shuffles
from takerlens.session import staged as _staged
from takerlens.sources import landing
from takerlens.sources.tables import BatchLog, DatedTable, KeyedTable, SnapshotTable

SCHEMAS = {
    "series": ("series_ticker string, title string, category string, frequency string, tags array<string>, "
               f"settlement_sources {landing.SOURCES}, contract_url string, contract_terms_url string, "
               "fee_type string, fee_multiplier decimal(6,4), first_seen timestamp, last_seen timestamp, raw string",
               ["series_ticker"]),
    "events": ("event_ticker string, series_ticker string, title string, category string, "
               f"mutually_exclusive boolean, settlement_sources {landing.SOURCES}, last_seen timestamp, raw string",
               ["event_ticker"]),
    "job_state": ("job_name string, cursor_ts timestamp, cursor_text string, updated_at timestamp, "
                  "notes map<string,string>", ["job_name"]),
    "series_tags": ("series_ticker string, settlement_source_type string, benchmark string, benchmark_name string, "
                    "recurrence string, scrape_difficulty string, source_urls array<string>, notes string, "
                    "model string, classified_at timestamp, reviewed boolean", ["series_ticker"]),
}
# Partitioned by settlement day: a window's job opens and overwrites its own days.
DATED = {
    "markets_terminal": ("ticker string, series_ticker string, event_ticker string, title string, status string, "
                         "result string, open_time timestamp, close_time timestamp, settlement_ts timestamp, "
                         "volume decimal(18,2), open_interest decimal(18,2), price_level_structure string, "
                         "rules_primary string, raw string, ingested_at timestamp", ["ticker"]),
    "market_taker_stats": ("ticker string, trades bigint, contracts decimal(22,2), taker_yes_contracts decimal(22,2), "
                           "taker_yes_vwap_cents decimal(18,10), taker_no_contracts decimal(22,2), "
                           "taker_no_vwap_cents decimal(18,10), taker_gross_pnl_cents decimal(34,8), "
                           "taker_fee_est_cents decimal(38,18), block_trades_skipped bigint, pages_read bigint, "
                           "truncated boolean, fee_base decimal(28,14), settlement_ts timestamp, computed_at timestamp", ["ticker"]),
}
SNAPSHOTS = ("ticker string, run_ts timestamp, series_ticker string, event_ticker string, status string, "
             "yes_bid decimal(10,6), yes_ask decimal(10,6), no_bid decimal(10,6), no_ask decimal(10,6), "
             "last_price decimal(10,6), volume decimal(18,2), volume_24h decimal(18,2), open_interest decimal(18,2), "
             "liquidity decimal(18,6), price_level_structure string, close_time timestamp")
TRADES = ("trade_id string, ticker string, count_fp decimal(18,2), yes_price_dollars decimal(10,6), "
          "no_price_dollars decimal(10,6), taker_side string, taker_outcome_side string, is_block_trade boolean, "
          "created_time timestamp, origin string, trade_date date")
SETTLED = ("ticker string, event_ticker string, title string, status string, result string, open_time timestamp, "
           "close_time timestamp, settlement_ts timestamp, volume decimal(18,2), open_interest decimal(18,2), "
           "price_level_structure string, rules_primary string, mve_collection_ticker string, raw string, "
           "arrival struct<file_path:string,file_block_start:bigint,line:bigint,pos:int>, settled_day int")
WINDOWS = ("lo timestamp, hi timestamp, run_started timestamp, committed_at timestamp, markets bigint, aggregated bigint, "
           "truncated bigint")
EVENT_COMPARE = ["series_ticker", "title", "category", "mutually_exclusive", "settlement_sources", "raw"]


@dataclass
class Store:
    """The tables below one folder; settled markets and their stats have a folder per `days` days of settlement."""

    spark: SparkSession
    path: str
    days: int = 1
    tables: dict[str, KeyedTable | DatedTable] = field(init=False)
    market_snapshots: SnapshotTable = field(init=False)
    trades: BatchLog = field(init=False)
    settled: BatchLog = field(init=False)
    wanted_events: BatchLog = field(init=False)
    sweep_windows: BatchLog = field(init=False)

    def __post_init__(self) -> None:
        self.tables = {name: KeyedTable(self.spark, f"{self.path}/{name}", schema, keys)
                       for name, (schema, keys) in SCHEMAS.items()}
        self.tables |= {name: DatedTable(self.spark, f"{self.path}/{name}", schema, keys, days=self.days)
                        for name, (schema, keys) in DATED.items()}
        self.market_snapshots = SnapshotTable(self.spark, f"{self.path}/market_snapshots", SNAPSHOTS)
        self.trades = BatchLog(self.spark, f"{self.path}/trades", TRADES, ["origin", "trade_date"])
        self.settled = BatchLog(self.spark, f"{self.path}/settled", SETTLED, ["settled_day"])
        self.wanted_events = BatchLog(self.spark, f"{self.path}/wanted_events", "event_ticker string")
        self.sweep_windows = BatchLog(self.spark, f"{self.path}/sweep_windows", WINDOWS)

    def read(self, name: str) -> DataFrame:
        return self.tables[name].read()

    def cursor(self, job: str) -> datetime | None:
        row = self.read("job_state").where(F.col("job_name") == job).select("cursor_ts").first()
        return row[0] if row else None

    def set_cursor(self, job: str, cursor: datetime | None, now: datetime, **notes) -> None:
        text = {k: str(v) for k, v in notes.items()}
        row = self.spark.createDataFrame([(job, cursor, None, now, text)], SCHEMAS["job_state"][0])
        self.tables["job_state"].upsert(row)

    def tape(self, markets: DataFrame | None = None) -> DataFrame:
        """The kept trades (of `markets`), each once however many batches hold it.

        Batches stay as they landed. Copies of a trade lie on the same day, so only days that several batches
        hold are looked at; the others are read as they are. Days are told apart by the folder listing.
        """
        rows = self.trades.read()
        if markets is not None:
            # Catalyst sends a small worklist to the scan and splits hot tapes where the join is shuffled.
            rows = rows.join(markets.select("ticker"), "ticker", "left_semi")
        held: dict[str, set[str]] = {}
        for folder in self.trades.partitions():
            held.setdefault(folder["trade_date"], set()).add(folder["batch_id"])
        shared = sorted(day for day, batches in held.items() if len(batches) > 1)
        if not shared:
            return rows
        day = F.coalesce(F.col("trade_date").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        again = distinct_trades(rows.where(day.isin(shared)).withColumn("arrival", F.col("batch_id")))
        return rows.where(~day.isin(shared)).unionByName(again)

    def activity(self, as_of) -> DataFrame:
        recent = self.market_snapshots.since(as_of - timedelta(hours=24))
        latest = snapshots.latest_snapshot(recent.drop("run_minute"), as_of)
        return activity.series_activity(self.read("series"), latest)

    def bleed(self) -> DataFrame:
        return bleed.taker_bleed(self.read("markets_terminal"), self.read("market_taker_stats"))

    def screen(self, as_of, limits: Thresholds = Thresholds()) -> DataFrame:
        return screen.screen(self.read("series"), self.read("series_tags"), self.activity(as_of), self.bleed(), limits)

    def funnel(self, as_of, limits: Thresholds = Thresholds()) -> DataFrame:
        return screen.screen_funnel(self.read("series"), self.read("series_tags"), self.activity(as_of),
                                    self.bleed(), limits)


def utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _one(df: DataFrame) -> dict:
    return df.first().asDict()


def _counted(rows: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
    """Rows staged, and aggregates over them taken while they were written: no second scan.

    The metrics stand last in the plan, so a task that runs again counts once.
    """
    seen = Observation()
    return _staged(rows.observe(seen, *metrics)), dict(seen.get)


def _clearing(job: Callable) -> Callable:
    """The job's staged tables go when it ends; its result is plain values."""
    @wraps(job)
    def run(store: Store, *args, **kw):
        with cleared_scratch(store.spark):
            return job(store, *args, **kw)

    return run


@_clearing
def snapshot_job(store: Store, landed: str, now: datetime, refresh_hours: float = 12,
                 multi_line: bool = False) -> dict:
    """Series, changed events, then a snapshot run of every open market."""
    spark, now = store.spark, utc(now)
    moment = F.lit(now)
    series = landing.read_series(landing.pages(spark, f"{landed}/series", "series", multi_line), moment)
    series = _staged(merge.last_wins(series, ["series_ticker"], ["arrival"]).drop("arrival"))
    store.tables["series"].upsert(series, defaults={"first_seen": moment})

    events = landing.read_events(landing.pages(spark, f"{landed}/events", "events", multi_line), moment)
    stored = store.read("events")
    actions, counts = _counted(merge.upsert_actions(stored, events, ["event_ticker"], EVENT_COMPARE, "last_seen", order=["arrival"]),
                               *merge.write_counts())
    if counts["inserted"] or counts["updated"]:
        fresh = actions.where(F.col("action") != "unchanged").drop("action")
        store.tables["events"].upsert(fresh)

    markets = landing.read_snapshots(landing.pages(spark, f"{landed}/markets", "markets", multi_line), moment)
    linked = merge.last_wins(linkage.link_series(markets, store.read("events")), snapshots.KEY, ["arrival"]).drop("arrival")
    linked, report = _counted(linked, *linkage.link_counts())
    rows = linked
    if refresh_hours > 0:
        recent = store.market_snapshots.since(now - timedelta(hours=refresh_hours)).drop("run_minute")
        rows = snapshots.skip_unchanged(linked, recent, refresh_hours)
    written = store.market_snapshots.append(rows, scratch_dir(spark, "snapshots"))
    notes = {**counts, "snapshots": report["markets"], "unmapped": report["unmapped"], "written": written}
    store.set_cursor("snapshot", now, now, **notes)
    return notes


def _fold(store: Store, todo: DataFrame, trades: DataFrame | None, now: datetime, page_size: int, page_cap: int | None) -> dict:
    """Fold the tapes of `todo` into the stats table; how many, and how many hit the cap."""
    spark = store.spark
    todo = _staged(todo.select("ticker", "result", "series_ticker", "settlement_ts"))
    wanted = store.tape(todo) if trades is None else trades.join(todo.select("ticker"), "ticker", "left_semi")
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(spark, wanted)
    try:
        stats = tape.taker_stats(todo.drop("settlement_ts"), wanted, store.read("series"), page_size, page_cap, fallback=True,
                                 stage=_staged, fee_base=True).drop("result", "series_ticker", "fee_multiplier")
        stats, counts = _counted(stats.join(todo.select("ticker", "settlement_ts"), "ticker"),
                                 F.count(F.lit(1)).alias("aggregated"), F.count_if("truncated").alias("truncated"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    store.tables["market_taker_stats"].upsert(stats, defaults={"computed_at": F.lit(now)})
    return counts


@_clearing
def trades_job(store: Store, landed: str, batch: int, origin: str = "live", multi_line: bool = False) -> dict:
    """Keep landed trades as Parquet by origin and day, ordered by market inside a file.

    Landing a batch again replaces it, so tapes can be folded any number of times
    without reading JSON. A batch is kept as it landed, also where another one
    holds the same trades: `Store.tape` reads each once. Trades without an id
    cannot be told apart: each is kept, and counted. Those without a market
    belong to no tape and are counted too.
    """
    rows = landing.read_trades(landing.pages(store.spark, landed, "trades", multi_line), origin)
    rows = distinct_trades(rows).withColumn("trade_date", F.to_date("created_time"))
    spread = rows.hint("rebalance", "origin", "trade_date").sortWithinPartitions("origin", "trade_date", "ticker")
    seen = Observation()
    store.trades.write(spread.observe(seen, F.count(F.lit(1)).alias("trades"), F.count_if(F.col("trade_id").isNull()).alias("without_id"),
                                      F.count_if(F.col("ticker").isNull()).alias("without_market")), batch)
    return dict(seen.get)


@_clearing
def settled_job(store: Store, landed: str, batch: int, multi_line: bool = False) -> dict:
    """Keep landed market payloads as Parquet by settlement day, parsed once for all sweeps.

    Landing a batch again replaces it. Markets without a settlement time share a folder.
    """
    rows = landing.read_markets(landing.pages(store.spark, landed, "markets", multi_line))
    seen = Observation()
    rows = rows.withColumn("settled_day", _terminal(store).day_of(F.col("settlement_ts"))).hint("rebalance", "settled_day")
    store.settled.write(rows.observe(seen, F.count(F.lit(1)).alias("markets"),
                                     F.count_if(F.col("settlement_ts").isNull()).alias("undated")), batch)
    return dict(seen.get)


def _terminal(store: Store) -> DatedTable:
    return store.tables["markets_terminal"]


def distinct_trades(rows: DataFrame) -> DataFrame:
    """One row per (trade_id, origin), the last to arrive; trades without an id all stay."""
    named = merge.last_wins(rows.where("trade_id IS NOT NULL"), ["trade_id", "origin"], ["arrival"])
    return named.unionByName(rows.where("trade_id IS NULL")).drop("arrival")


def _store_settled(store: Store, rows: DataFrame, now: datetime, order: list[str]) -> tuple[DataFrame, dict]:
    """Upsert settled markets; the first ingest time of a market stays. Returns the rows and their number."""
    batch, counts = _counted(merge.last_wins(rows, ["ticker"], order).drop("mve_collection_ticker", *order),
                             F.count(F.lit(1)).alias("markets"))
    _terminal(store).upsert(batch, defaults={"ingested_at": F.lit(now)})
    return batch, counts


def landed_markets(store: Store, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """The kept payloads, of a range of settlement times if given: only the folders of its days are opened."""
    rows, day = store.settled.read(), F.col("settled_day")
    if since is not None:
        rows = rows.where(day >= _terminal(store).day_of(F.lit(since)))
    if until is not None:
        rows = rows.where(day <= _terminal(store).day_of(F.lit(until)))
    # A later batch counts as a later arrival.
    return rows.withColumn("arrival", F.struct("batch_id", "arrival")).drop("settled_day", "batch_id")


@_clearing
def sweep_job(store: Store, markets: DataFrame | None, trades: DataFrame | None, now: datetime, minimum_volume: float = 0,
              tape_minimum: float = 0, page_size: int = tape.PAGE_SIZE, page_cap: int | None = None,
              lookback: timedelta | None = None, overlap: timedelta | None = chunks.OVERLAP,
              chunk: timedelta = chunks.CHUNK, stop_after: int | None = None) -> dict:
    """Settled markets since the cursor and the tapes not folded yet, one settlement window after the other.

    A window's rows are written first and its cursor last; rows are keyed, so a window that stopped halfway is done again
    with the same outcome, and a run that stopped resumes after its last whole window. Windows without landed
    rows cost nothing. A first sweep takes all landed markets unless `lookback` bounds it; later ones take what settled
    since the cursor less `overlap` (None: everything), and whatever landed late: any market the terminal table lacks.
    `markets` and `trades` default to the store's own. `stop_after` ends after so many windows.
    """
    now = utc(now)
    cursor = store.cursor("settled_sweep")
    since = chunks.sweep_start(cursor and utc(cursor), now, lookback, overlap)
    repaired = relink(store)
    rows = _to_sweep(store, markets, since, now, minimum_volume, late=cursor is not None)
    counts = sweep_rows(store, rows, trades, now, since, tape_minimum, page_size, page_cap, chunk, stop_after,
                        cursor=utc(cursor) if cursor else None)
    if counts.pop("whole"):
        store.set_cursor("settled_sweep", now, now, **counts, repaired=repaired, since=since)
    return {**counts, "repaired": repaired}


def _to_sweep(store: Store, markets: DataFrame | None, since: datetime | None, now: datetime, minimum_volume: float,
              late: bool) -> DataFrame:
    """Settled markets of the range, and older ones that no sweep has stored."""
    events, both = store.read("events"), late and since is not None
    # Markets that are given may be costly to make: both halves read them from one stored table.
    given = _staged(ingest.recent_window(markets, events, None, F.lit(now), minimum_volume)) if both and markets is not None else None

    def settled(low: datetime | None, high: datetime) -> DataFrame:
        if given is not None:
            return given.where(filters.settled_between(None if low is None else F.lit(low), F.lit(high)))
        rows = landed_markets(store, low, high) if markets is None else markets
        return ingest.recent_window(rows, events, None if low is None else F.lit(low), F.lit(high), minimum_volume)

    rows = settled(since, now)
    if both:
        older = settled(None, since).where(F.col("settlement_ts") < F.lit(since))
        rows = rows.unionByName(worklist.unfinished(older, store.read("markets_terminal")))
    return rows


def sweep_rows(store: Store, rows: DataFrame, trades: DataFrame | None, now: datetime, since: datetime | None = None,
               tape_minimum: float = 0, page_size: int = tape.PAGE_SIZE, page_cap: int | None = None,
               chunk: timedelta = chunks.CHUNK, stop_after: int | None = None, cursor: datetime | None = None) -> dict:
    """Sweep linked settled markets window by window; each window ends with its commit.

    Rows are staged by settlement day first, so a window reads the folders of its own days only.
    """
    path = scratch_dir(store.spark, "sweep")
    rows = rows.withColumn("settled_day", _terminal(store).day_of(F.col("settlement_ts")))
    rows.hint("rebalance", "settled_day").write.partitionBy("settled_day").parquet(path)
    rows = store.spark.read.schema(rows.schema).parquet(path)
    if since is None:
        first = rows.agg(F.min("settlement_ts")).first()[0]
        since = now if first is None else min(utc(first), now)
    windows = chunks.busy_chunks(rows, since, now, chunk)
    total = {"markets": 0, "aggregated": 0, "truncated": 0, "windows": 0}
    for lo, hi in windows[:stop_after]:
        day, at = F.col("settled_day"), _terminal(store).day_of
        inside = rows.where((day >= at(F.lit(lo))) & (day <= at(F.lit(hi))) & chunks.in_chunk(lo, hi, now)).drop("settled_day")
        batch, counts = _store_settled(store, inside, now, ["arrival"])
        todo = worklist.unfinished(batch.where(F.coalesce("volume", F.lit(0)) >= tape_minimum), store.read("market_taker_stats"))
        counts |= _fold(store, todo, trades, now, page_size, page_cap)
        cursor = hi if cursor is None else max(cursor, hi)
        _commit_window(store, lo, hi, now, cursor, counts)
        total = {k: v + counts.get(k, k == "windows") for k, v in total.items()}
    return {**total, "missing_events": want_events(store), "whole": len(windows[:stop_after]) == len(windows)}


def want_events(store: Store) -> int:
    """Store the keys of events that settled markets name and nobody has landed, for whoever fetches them."""
    bare = store.read("markets_terminal").where(F.col("series_ticker").isNull())
    seen = Observation()
    wanted = linkage.missing_events(bare, store.read("events")).observe(seen, F.count(F.lit(1)).alias("n"))
    store.wanted_events.write(wanted, 0)
    return seen.get["n"]


@_clearing
def sweep_landed(store: Store, checkpoint: str, now: datetime, trades: DataFrame | None = None, files_per_batch: int | None = None,
                 minimum_volume: float = 0, tape_minimum: float = 0, chunk: timedelta = chunks.CHUNK) -> dict:
    """Sweep what `settled_job` has landed since the last call: files are the high-water mark, not times.

    The stream's checkpoint knows which files of the landed table were taken, so a market that lands a week after it settled
    is swept once, with its window, and nothing is looked at twice. A batch that stopped is taken again as it was.
    """
    now, total = utc(now), {"markets": 0, "aggregated": 0, "truncated": 0, "windows": 0}
    source = store.spark.readStream.schema(f"{SETTLED}, batch_id bigint")
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    if not store.settled.batches():
        return total

    def sink(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("arrival", F.struct("batch_id", "arrival")).drop("settled_day", "batch_id")
        kept = ingest.recent_window(rows, store.read("events"), None, F.lit(now), minimum_volume)
        cursor = store.cursor("settled_sweep")
        counts = sweep_rows(store, kept, trades, now, None, tape_minimum, chunk=chunk, cursor=utc(cursor) if cursor else None)
        for k in total:
            total[k] += counts[k]

    query = (source.parquet(store.settled.path).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return total


def _commit_window(store: Store, lo: datetime, hi: datetime, now: datetime, cursor: datetime, counts: dict) -> None:
    """The window's report, then the cursor: the one write that makes the window done."""
    row = (lo, hi, now, datetime.now(timezone.utc), *(int(counts[c]) for c in ("markets", "aggregated", "truncated")))
    store.sweep_windows.write(store.spark.createDataFrame([row], WINDOWS).coalesce(1), int(lo.timestamp()))
    store.set_cursor("settled_sweep", cursor, now, **counts, chunk_from=lo.isoformat(), run_started=now.isoformat())


def relink(store: Store) -> int:
    """Fill missing series links and score the linked tapes' fees again; only these markets are written.

    Fees go first: a run that stops in between finds the links still missing and does both again.
    """
    missing = store.read("markets_terminal").where(F.col("series_ticker").isNull())
    fixed, counts = _counted(linkage.repair_links(missing, store.read("events")).where("repaired").drop("repaired"),
                             F.count(F.lit(1)).alias("repaired"))
    if counts["repaired"]:
        stats = store.read("market_taker_stats")
        again = _staged(bleed.fees_again(stats, fixed, store.read("series")).join(stats.select("ticker", "settlement_ts"), "ticker"))
        store.tables["market_taker_stats"].upsert(again, update_cols=["taker_fee_est_cents"])
        _terminal(store).upsert(fixed)
    return counts["repaired"]


@_clearing
def backfill_job(store: Store, archive: DataFrame | None, recent: DataFrame, trades: DataFrame | None, now: datetime,
                 days: int = 180, series: list[str] | None = None, from_screen: bool = False,
                 exclude_categories: list[str] | None = None, minimum_volume: float = 0,
                 page_size: int = tape.PAGE_SIZE, page_cap: int | None = None,
                 limits: Thresholds = Thresholds()) -> dict:
    """Archive and recent walks into the terminal table, then the pending tapes in scope."""
    now = utc(now)
    since = F.lit(now - timedelta(days=days))
    known = store.read("series")
    if series:
        scope = worklist.explicit_scope(known, series)
    elif from_screen:
        scope = screen.candidates(known, store.read("series_tags"), store.activity(now), limits)
    else:
        scope = worklist.recurring_scope(known)
    events = store.read("events")
    rows = ingest.recent_window(recent, events, since).withColumn("source_rank", F.lit(2))
    if archive is not None:
        walked = ingest.archive_window(archive, events, scope, since).withColumn("source_rank", F.lit(1))
        rows = walked.unionByName(rows)
    repaired = relink(store)
    _store_settled(store, rows, now, ["source_rank", "arrival"])
    terminal = _terminal(store).between(now - timedelta(days=days))
    todo = worklist.pending_worklist(terminal, known, store.read("market_taker_stats"), since,
                                     minimum_volume, scope, exclude_categories)
    todo = todo.join(terminal.select("ticker", "settlement_ts"), "ticker")
    notes = {**_fold(store, todo, trades, now, page_size, page_cap), "repaired": repaired}
    store.set_cursor("backfill", now, now, **notes, complete=True)
    return notes


def classify_job(store: Store, now: datetime, classify_all: bool = False, recheck: bool = False,
                 limit: int | None = None) -> DataFrame:
    """Tag what needs a tag and return the tally of the new tags."""
    terminal = None if classify_all else store.read("markets_terminal")
    rows = classify.candidates(store.read("series"), store.read("events"), store.read("series_tags"),
                               terminal, recheck, limit=limit)
    tags = _staged(classify.classify(rows))
    store.tables["series_tags"].upsert(tags, defaults={"classified_at": F.lit(utc(now))})
    return classify.tag_tally(tags)


@_clearing
def prune_job(store: Store, now: datetime, days: float = retention.DAYS) -> dict:
    """Drop snapshot runs older than the retention window."""
    cut = utc(now) - timedelta(days=days)
    gone = F.count_if(F.col("run_ts") < F.lit(cut)).alias("removed")
    doomed = F.col("run_minute") <= F.lit(int(cut.timestamp()) // 60)
    removed = _one(store.market_snapshots.read().where(doomed).agg(gone))["removed"]
    store.market_snapshots.prune(cut.replace(second=0, microsecond=0) + timedelta(minutes=1) if cut.second or cut.microsecond else cut)
    return {"removed": removed}
