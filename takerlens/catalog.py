"""Every query by name, over the projected test tables.

Thresholds are scaled to the tables (`LIMITS`, `PAGES`); the operators keep the
production defaults.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from takerlens.functions import rules
from takerlens.functions.values import hours
from takerlens.operators import chunks, domains, filters, ingest, linkage, merge, retention, snapshots, tape, worklist
from takerlens.plans import activity, bleed, classify, health, jobs, quality, screen
from takerlens.session import pieces, scratch_dir
from takerlens.sources import landing
from takerlens.sources.projection import TRADE_ORDER, Tables
from takerlens.sources.tables import BatchLog, DatedTable, KeyedTable, SnapshotTable
from takerlens.streaming import flows

LIMITS = screen.Thresholds(volume_low=50, volume_high=1000, breadth=0.34, n_settled=20)
PAGES = {"page_size": 2, "page_cap": 3}
ARRIVAL = ["run_ts", "arrival"]
FILE_BYTES = 64 << 20

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _QUERIES[fn.__name__.rstrip("_")] = lambda spark, folder: plain(fn(Tables(spark, folder)))
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every engine prints alike; exactness ends here."""
    def show(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        return c.alias(f.name)

    return df.select(*[show(f) for f in df.schema.fields])


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _tags(t: Tables) -> DataFrame:
    return classify.classify(classify.with_event_counts(t.series(), t.events()))


def _latest(t: Tables) -> DataFrame:
    return snapshots.latest_snapshot(t.snapshots(), order=ARRIVAL)


def _activity(t: Tables) -> DataFrame:
    return activity.series_activity(t.series(), _latest(t))


def _capped_stats(t: Tables) -> DataFrame:
    return tape.taker_stats(t.terminal(), t.trades(), t.series(), tie_break=TRADE_ORDER, **PAGES)


def _whole_stats(t: Tables) -> DataFrame:
    return tape.taker_stats(t.terminal(), t.trades(), t.series())


def _bleed(t: Tables) -> DataFrame:
    return bleed.bleed_of(_whole_stats(t))


# --- bleed ------------------------------------------------------------------

@query
def taker_bleed(t: Tables) -> DataFrame:
    return _bleed(t)


@query
def taker_stats(t: Tables) -> DataFrame:
    return _whole_stats(t).drop("result", "taker_yes_vwap_cents", "taker_no_vwap_cents", "fee_multiplier")


@query
def taker_vwap(t: Tables) -> DataFrame:
    return _whole_stats(t).select("ticker", "taker_yes_vwap_cents", "taker_no_vwap_cents")


@query
def tape_page_cap(t: Tables) -> DataFrame:
    return _capped_stats(t).select("ticker", "trades", "contracts", "taker_gross_pnl_cents", "taker_fee_est_cents",
                                   "block_trades_skipped", "pages_read", "truncated")


@query
def tape_fallback(t: Tables) -> DataFrame:
    stats = tape.taker_stats(t.terminal(), t.trades(), t.series(), fallback=True)
    return stats.select("ticker", "trades", "contracts", "taker_gross_pnl_cents", "block_trades_skipped",
                        "pages_read", "truncated")


@query
def trades_overlap(t: Tables) -> DataFrame:
    """Two landed batches that share trades: each trade is folded once."""
    rows = t.trades().withColumn("trade_id", F.concat_ws("-", "ticker", *TRADE_ORDER))
    first = rows.where(F.col("created_time") < _moment("1997-01-01")).withColumn("batch", F.lit(1))
    second = rows.where(~F.coalesce(F.col("created_time") < _moment("1994-01-01"), F.lit(False))).withColumn("batch", F.lit(2))
    known = merge.last_wins(first.unionByName(second), ["trade_id"], ["batch"]).drop("batch")
    return tape.exact(tape.tape_sums(known, ["ticker"])).select("ticker", "trades", "contracts", "block_trades")


@query
def late_link_fees(t: Tables) -> DataFrame:
    """Fees of markets folded before their event was known, scored again once it is."""
    early = linkage.link_series(t.terminal().drop("series_ticker"), t.early_events())
    stored = tape.taker_stats(early, t.trades(), t.series(), fee_base=True).drop("fee_multiplier")
    fixed = linkage.repair_links(early, t.events()).where("repaired")
    again = bleed.fees_again(stored, fixed, t.series())
    return merge.upsert(stored.select("ticker", "taker_fee_est_cents"), again, ["ticker"])


@query
def bleed_exclusions(t: Tables) -> DataFrame:
    return bleed.bleed_exclusions(t.terminal(), _whole_stats(t))


# --- activity ---------------------------------------------------------------

@query
def latest_snapshot(t: Tables) -> DataFrame:
    return _latest(t)


@query
def series_activity(t: Tables) -> DataFrame:
    return _activity(t)


# --- classification ---------------------------------------------------------

@query
def classify_series(t: Tables) -> DataFrame:
    return _tags(t)


@query
def classify_candidates(t: Tables) -> DataFrame:
    """Tags on file: some by older rules, some reviewed by a person, some missing."""
    k = F.col("n_nationkey")
    tags = t.raw("nation").where(F.col("n_regionkey") != 0).select(
        F.concat(F.lit("S"), k).alias("series_ticker"),
        F.when(F.col("n_regionkey") == 1, "rules:v2").otherwise(rules.RULES_VERSION).alias("model"),
        (F.col("n_regionkey") == 2).alias("reviewed"))
    return classify.candidates(t.series(), t.events(), tags, t.terminal()).drop("settlement_sources")


@query
def classify_recheck(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    tags = t.raw("nation").select(F.concat(F.lit("S"), k).alias("series_ticker"),
                                  F.lit(rules.RULES_VERSION).alias("model"),
                                  (F.col("n_regionkey") == 2).alias("reviewed"))
    return classify.candidates(t.series(), t.events(), tags, None, recheck=True).select("series_ticker", "n_events")


@query
def tag_tally(t: Tables) -> DataFrame:
    return classify.tag_tally(_tags(t))


@query
def events_per_series(t: Tables) -> DataFrame:
    return classify.with_event_counts(t.series(), t.events()).select("series_ticker", "n_events")


@query
def page_host_match(t: Tables) -> DataFrame:
    """The host rules on real page links."""
    name = rules.host(F.col("url"))
    return t.raw("pages").select("page_id", name.alias("host"), rules.in_group(name, ["example.org"]).alias("is_org"),
                                 rules.in_group(name, ["example.com", "example.net"]).alias("is_com_or_net"))


def _page_domains(t: Tables) -> DataFrame:
    """A dimension of domains taken from the pages: sites by their top domains, and single hosts."""
    name = rules.host(F.col("url"))
    pages = t.raw("pages").select("page_id", name.alias("domain"))
    tops = pages.select(F.substring_index("domain", ".", -2).alias("domain")).distinct().select(
        F.when(F.col("domain") == "example.org", "numeric").when(F.col("domain") == "example.net", "official").otherwise("market").alias("label"),
        "domain")
    single = pages.groupBy("domain").agg(F.min("page_id").alias("first"))
    return tops.unionByName(single.where("first % 3 = 0").select(F.lit("no_benchmark").alias("label"), "domain")) \
               .unionByName(single.where("first % 5 < 2").select(F.when(F.col("first") % 5 == 0, "low").otherwise("high").alias("label"), "domain"))


@query
def page_domain_labels(t: Tables) -> DataFrame:
    """Hosts against a table of domains, as a join."""
    hosts = t.raw("pages").select(rules.host(F.col("url")).alias("host"))
    return domains.labels_of(hosts, _page_domains(t))


@query
def classify_many_links(t: Tables) -> DataFrame:
    """Series that settle by many pages each: every nation's share of the pages."""
    links = t.raw("pages").select(F.concat(F.lit("S"), F.col("page_id") % 30).alias("series_ticker"), rules.host(F.col("url")).alias("host")).distinct()
    series = classify.with_event_counts(t.series(), t.events())
    return domains.classify_links(series, links, _page_domains(t))


# --- screen and diagnostics -------------------------------------------------

@query
def screen_(t: Tables) -> DataFrame:
    return screen.screen(t.series(), _tags(t), _activity(t), _bleed(t), LIMITS)


@query
def screen_candidates(t: Tables) -> DataFrame:
    return screen.candidates(t.series(), _tags(t), _activity(t), LIMITS)


@query
def screen_funnel(t: Tables) -> DataFrame:
    return screen.screen_funnel(t.series(), _tags(t), _activity(t), _bleed(t), LIMITS)


@query
def ground_truth(t: Tables) -> DataFrame:
    tags = _tags(t).join(t.raw("nation").where(F.col("n_regionkey") != 3)
                         .select(F.concat(F.lit("S"), "n_nationkey").alias("series_ticker")), "series_ticker", "left_semi")
    truth = screen.ground_truth(t.series(), tags, ["S1", "S2", "S5"])
    return truth.withColumn("passes", F.col("passes").cast("string"))


@query
def ground_truth_report(t: Tables) -> DataFrame:
    return screen.ground_truth_report(screen.ground_truth(t.series(), _tags(t), ["S1", "S2", "S5"]))


@query
def ingest_health(t: Tables) -> DataFrame:
    stamped = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("ticker") % 720).cast("int"))
    snaps = t.snapshots()
    stats = t.trades().select("ticker").distinct().withColumn("computed_at", stamped)
    as_of = snapshots.newest(snaps, "run_ts") + hours(1.5)
    return health.ingest_health(snaps, t.terminal().withColumn("ingested_at", stamped), stats, as_of)


@query
def volume_share(t: Tables) -> DataFrame:
    return health.volume_share(t.terminal(volume=True))


# --- linkage ----------------------------------------------------------------

@query
def link_markets(t: Tables) -> DataFrame:
    return linkage.link_series(t.markets(), t.events()).select("ticker", "event_ticker", "series_ticker")


@query
def link_report(t: Tables) -> DataFrame:
    return linkage.link_report(linkage.link_series(t.markets(), t.events()))


@query
def repair_links(t: Tables) -> DataFrame:
    early = linkage.link_series(t.markets(), t.early_events())
    return linkage.repair_links(early, t.events()).select("ticker", "series_ticker", "repaired")


@query
def missing_events(t: Tables) -> DataFrame:
    return linkage.missing_events(t.markets(), t.early_events())


# --- keyed writes -----------------------------------------------------------

def _earlier(t: Tables) -> DataFrame:
    """Markets stored by an earlier run, with the volume known then and a first-seen time."""
    return (t.markets().where(F.coalesce(F.col("close_time") < _moment("1999-07-01"), F.lit(True)))
            .select("ticker", "status", "result", F.lit(0).cast("decimal(18,2)").alias("volume"),
                    F.col("close_time").alias("first_seen")))


def _later(t: Tables) -> DataFrame:
    return t.markets(volume=True).where(F.col("close_time") >= _moment("1998-01-01")) \
            .select("ticker", "result", "volume")


@query
def upsert_merge(t: Tables) -> DataFrame:
    """Written columns are overwritten (NULL volumes too); status and first_seen survive."""
    return merge.upsert(_earlier(t), _later(t), ["ticker"], defaults={"first_seen": _moment("2002-01-01")})


@query
def upsert_some_columns(t: Tables) -> DataFrame:
    return merge.upsert(_earlier(t), _later(t), ["ticker"], update_cols=["volume"])


@query
def insert_only(t: Tables) -> DataFrame:
    return merge.upsert(_earlier(t), _later(t), ["ticker"], update_cols=[])


def _event_actions(t: Tables) -> DataFrame:
    """Stored events of known customers, some since renamed, some last seen long ago or never."""
    now = _moment("2024-01-03")
    e = t.raw("customer")
    stored = e.where(F.col("c_acctbal") >= -500).select(
        F.col("c_custkey").alias("event_ticker"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lower("c_name")).otherwise(F.col("c_name")).alias("title"),
        F.when(F.col("c_nationkey") == 3, None).otherwise(
            now - F.make_dt_interval(hours=F.col("c_nationkey") + 12)).alias("last_seen"))
    incoming = e.select(F.col("c_custkey").alias("event_ticker"), F.col("c_name").alias("title"), now.alias("last_seen"))
    return merge.upsert_actions(stored, incoming, ["event_ticker"], ["title"], "last_seen")


@query
def upsert_changed(t: Tables) -> DataFrame:
    return _event_actions(t).select("event_ticker", "action")


@query
def upsert_changed_stats(t: Tables) -> DataFrame:
    return merge.write_stats(_event_actions(t))


@query
def dedupe_last_wins(t: Tables) -> DataFrame:
    return merge.last_wins(t.trades().select("ticker", "trade_no", "created_time", "part_no", "supp_no", "count_fp"),
                           ["ticker", "trade_no"], ["created_time", "part_no", "supp_no", "count_fp"])


# --- snapshots --------------------------------------------------------------

@query
def snapshot_skip_unchanged(t: Tables) -> DataFrame:
    """All hourly runs replayed with a 12 h refresh: the rows that get written."""
    return snapshots.skip_unchanged(t.states(), None, 12, ARRIVAL, ["series_ticker", "status"]) \
                    .select("ticker", "run_ts", "status")


@query
def snapshot_append(t: Tables) -> DataFrame:
    """One more run, in which every market is back in its last open state."""
    stored = merge.last_wins(t.states(), ["ticker", "run_ts"], ["arrival"])
    open_state = merge.last_wins(t.states().where(filters.not_closed()), ["ticker"], ARRIVAL)
    run = open_state.withColumn("run_ts", snapshots.newest(stored, "run_ts") + hours(1))
    return snapshots.skip_unchanged(run, stored, 12, ARRIVAL, ["series_ticker", "status"]) \
                    .select("ticker", "run_ts", "status")


@query
def snapshot_prior_state(t: Tables) -> DataFrame:
    return snapshots.prior_state(t.states(), 12, ["arrival"], ["status"]) \
                    .select("ticker", "run_ts", "status", "prior_run_ts", "prior_status")


@query
def asof_stored_state(t: Tables) -> DataFrame:
    """Every second state against the others as the stored table: the newest one within 12 h before it."""
    states = t.states()
    incoming, stored = states.where("arrival % 2 = 1"), states.where("arrival % 2 = 0")
    return snapshots.stored_state(incoming, stored, 12, ["arrival", "status"], ["arrival"], buckets=4).select(
        "ticker", "run_ts", "arrival", "status", "prior_run_ts", "prior_arrival", "prior_status")


@query
def retention_delete(t: Tables) -> DataFrame:
    """Daily runs kept as folders, those older than ten days deleted: what is left."""
    rows = merge.last_wins(t.states("day").select("ticker", "run_ts", "arrival", "status"), ["ticker", "run_ts"], ["arrival"])
    base = scratch_dir(t.spark, "retention")
    table = SnapshotTable(t.spark, f"{base}/table", "ticker bigint, run_ts timestamp_ntz, arrival bigint, status string")
    table.append(rows, f"{base}/staging")
    last = table.read().agg(F.max("run_ts")).first()[0]
    if last is not None:
        table.prune(last - timedelta(days=10))
    return table.read().select("ticker", "run_ts", "arrival", "status")


@query
def retention_prune(t: Tables) -> DataFrame:
    snaps = t.snapshots()
    return retention.prune_report(snaps, snapshots.newest(snaps, "run_ts"), days=10)


# --- worklists and ingest ---------------------------------------------------

def _old_stats(t: Tables) -> DataFrame:
    """Markets folded by an earlier run: those traded before 1996."""
    return t.trades().where(F.col("created_time") < _moment("1996-01-01")).select("ticker").distinct()


@query
def pending_worklist(t: Tables) -> DataFrame:
    return worklist.pending_worklist(t.terminal(volume=True), t.series(), _old_stats(t), _moment("1995-06-01"), 20,
                                     worklist.recurring_scope(t.series()), ["sports"])


@query
def resume_todo(t: Tables) -> DataFrame:
    return worklist.unfinished(t.terminal(), _old_stats(t)).select("ticker", "series_ticker")


@query
def recurring_scope(t: Tables) -> DataFrame:
    return worklist.recurring_scope(t.series())


def _archive(t: Tables) -> DataFrame:
    """Archived markets with the series whose walk returned them."""
    walked = t.raw("customer").select(F.col("c_custkey").alias("event_ticker"),
                                      F.concat(F.lit("S"), "c_nationkey").alias("walked_series"))
    return t.markets().where(F.coalesce("close_time", _moment("1995-01-01")) < _moment("1999-07-01")) \
            .join(walked, "event_ticker").withColumn("volume", F.lit(0).cast("decimal(18,2)"))


@query
def archive_window(t: Tables) -> DataFrame:
    scope = worklist.recurring_scope(t.series())
    return ingest.archive_window(_archive(t), t.events(), scope, _moment("1996-01-01")) \
                 .select("ticker", "series_ticker", "settlement_ts")


@query
def ingest_two_source(t: Tables) -> DataFrame:
    scope = worklist.recurring_scope(t.series())
    archived = ingest.archive_window(_archive(t), t.events(), scope, _moment("1996-01-01"))
    recent = ingest.recent_window(t.markets(volume=True), t.events(), _moment("1998-01-01"))
    return ingest.two_sources(archived, recent).select("ticker", "series_ticker", "volume", "source_rank")


@query
def sweep_chunk_report(t: Tables) -> DataFrame:
    return chunks.chunk_report(t.terminal(volume=True), ingest_minimum=1, tape_minimum=100)


def _text(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("string") for c in names})


def _store(t: Tables) -> jobs.Store:
    """A store that knows the series and events."""
    store = jobs.Store(t.spark, scratch_dir(t.spark, "store"), days=180)
    store.tables["series"].upsert(t.series())
    store.tables["events"].upsert(_text(t.events(), "event_ticker"))
    return store


def _feed(t: Tables) -> DataFrame:
    """Settled markets as they land."""
    at = {c: F.col(c).cast("timestamp") for c in ("settlement_ts", "close_time")}
    return _text(t.markets(volume=True), "ticker", "event_ticker").withColumns(at).withColumn("arrival", F.lit(0))


def _live(t: Tables) -> DataFrame:
    return _text(t.trades(), "ticker").withColumn("origin", F.lit("live"))


SWEPT = datetime(2002, 6, 1)


def _stopped_and_resumed(t: Tables) -> jobs.Store:
    """Four-year windows; a first run ends after one of them, a second one goes on."""
    store, years = _store(t), timedelta(days=1460)
    for windows in (1, None):
        jobs.sweep_job(store, _feed(t), _live(t), SWEPT, chunk=years, overlap=timedelta(0), stop_after=windows)
    return store


@query
def sweep_resumed(t: Tables) -> DataFrame:
    """What a sweep that stopped between windows leaves: every market once, every tape folded."""
    store = _stopped_and_resumed(t)
    stats = store.read("market_taker_stats").select("ticker", "trades", "contracts", "taker_gross_pnl_cents", "taker_fee_est_cents")
    return store.read("markets_terminal").select("ticker", "series_ticker", "settlement_ts").join(stats, "ticker", "left")


@query
def sweep_commits(t: Tables) -> DataFrame:
    """The windows committed by both runs, each once, with the markets of each."""
    return _stopped_and_resumed(t).sweep_windows.read().select("lo", "hi", "markets", "aggregated")


@query
def sweep_late_markets(t: Tables) -> DataFrame:
    """Markets that land in two batches, the second one out of order, swept by landed files: each is swept once."""
    store = _store(t)
    feed = _feed(t).withColumn("arrival", F.struct(F.lit("f").alias("file_path"), F.lit(0).cast("bigint").alias("file_block_start"),
                                                   F.lit(0).cast("bigint").alias("line"), F.lit(0).alias("pos")))
    feed = feed.withColumn("settled_day", store.tables["markets_terminal"].day_of(F.col("settlement_ts")))
    feed = feed.select(*[F.col(f.name) if f.name in feed.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in T.StructType.fromDDL(jobs.SETTLED).fields])
    late, counts = F.col("ticker").cast("bigint") % 5 == 0, []
    for batch, rows in enumerate((feed.where(~late), feed.where(late))):
        store.settled.write(rows.hint("rebalance", "settled_day"), batch)
        swept = jobs.sweep_landed(store, f"{store.path}/landed", SWEPT, _live(t), chunk=timedelta(days=3650))
        counts.append(F.lit(swept["markets"]).cast("bigint"))
    return store.read("markets_terminal").select(
        F.count("*").alias("markets"), F.count_distinct("ticker").alias("tickers"), counts[0].alias("first"), counts[1].alias("second"),
        F.sum("volume").alias("volume"))


@query
def settled_days(t: Tables) -> DataFrame:
    """Markets kept by settlement month (30 days): those of busy months, read from these folders alone."""
    schema = "ticker bigint, series_ticker string, settlement_ts timestamp_ntz, volume decimal(18,2)"
    table = DatedTable(t.spark, scratch_dir(t.spark, "settled_days"), schema, ["ticker"], days=30)
    table.upsert(t.terminal(volume=True).select("ticker", "series_ticker", "settlement_ts", "volume"))
    busy = table.read().withColumn("settled_day", table.day_of(F.col("settlement_ts"))).groupBy("settled_day").agg(F.sum("volume").alias("traded"))
    return table.on_days(busy.where("traded % 2 >= 1")).select("ticker", "series_ticker", "settlement_ts")


@query
def keyed_sink(t: Tables) -> DataFrame:
    """The keyed table itself after two upserts."""
    table = KeyedTable(t.spark, scratch_dir(t.spark, "keyed"), "ticker bigint, status string, result string, volume decimal(18,2), "
                       "first_seen timestamp_ntz", ["ticker"], parts=8)
    table.upsert(_earlier(t))
    table.upsert(_later(t), defaults={"first_seen": _moment("2002-01-01")})
    return table.read()


# --- quality ----------------------------------------------------------------

@query
def dq_expectations(t: Tables) -> DataFrame:
    snaps = t.snapshots().withColumn("volume", F.col("volume_24h"))
    return quality.expectations([
        (t.series(), quality.series_checks()), (t.events(), quality.event_checks()),
        (snaps, quality.snapshot_checks()), (t.markets(), quality.settled_checks()),
        (t.trades(), quality.trade_checks())])


def _reconciled(t: Tables) -> DataFrame:
    markets = tape.with_fee_multiplier(t.terminal(), t.series())
    return quality.reconcile(_whole_stats(t), quality.independent_totals(t.trades(), markets), t.volumes())


@query
def pnl_reconciliation(t: Tables) -> DataFrame:
    return _reconciled(t)


@query
def reconciliation_summary(t: Tables) -> DataFrame:
    return quality.reconciliation_summary(_reconciled(t))


@query
def reconciliation_finds_errors(t: Tables) -> DataFrame:
    """Stats that are a cent off in every 97th market: as many mismatches."""
    off = F.when(F.col("ticker") % 97 == 1, F.col("taker_gross_pnl_cents") + 1).otherwise(F.col("taker_gross_pnl_cents"))
    markets = tape.with_fee_multiplier(t.terminal(), t.series())
    return quality.reconciliation_summary(quality.reconcile(
        _whole_stats(t).withColumn("taker_gross_pnl_cents", off), quality.independent_totals(t.trades(), markets), t.volumes()))


@query
def trade_explain(t: Tables) -> DataFrame:
    return quality.explain_trades(t.trades(), t.terminal())


@query
def handcheck_markets(t: Tables) -> DataFrame:
    return quality.handcheck_markets(t.terminal(volume=True)).select("ticker", "result", "volume")


@query
def rule_known_answers(t: Tables) -> DataFrame:
    """Expected recurrence of every nation's series, and of one that is not listed."""
    k = F.col("n_nationkey")
    listed = t.raw("nation").select(
        F.concat(F.lit("S"), k).alias("series_ticker"), F.lit("recurrence").alias("field"),
        F.when(k % 8 == 1, "one_off").otherwise("recurring").alias("expected"))
    absent = t.raw("region").select(F.concat(F.lit("R"), "r_regionkey").alias("series_ticker"),
                                    F.lit("benchmark").alias("field"), F.lit("none").alias("expected"))
    return quality.known_answers(_tags(t), listed.unionByName(absent))


@query
def source_coverage(t: Tables) -> DataFrame:
    return quality.source_coverage(_tags(t))


@query
def coverage_floor(t: Tables) -> DataFrame:
    return quality.coverage_floor(_tags(t), floor=10)


# --- streams: the result after the last batch --------------------------------

@query
def stream_taker_stats(t: Tables) -> DataFrame:
    """Tapes folded by a stream of trades, then scored."""
    base = scratch_dir(t.spark, "tapes")
    log = BatchLog(t.spark, f"{base}/log", flows.sums_schema())
    flows.fold_tapes(t.trade_stream(), log, f"{base}/checkpoint")
    markets = tape.with_fee_multiplier(t.terminal(), t.series()).select("ticker", "result", "fee_multiplier")
    return tape.score(markets, flows.folded(log)).select(
        "ticker", "trades", "contracts", "taker_gross_pnl_cents", "taker_fee_est_cents", "block_trades_skipped")


@query
def stream_running_tapes(t: Tables) -> DataFrame:
    """Tapes folded with kept state over several triggers and a restart; the log is one row a tape at the end."""
    base = scratch_dir(t.spark, "running")
    rows, folder = t.trades(), f"{base}/in"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    log = BatchLog(t.spark, f"{base}/log", flows.sums_schema())
    files = pieces(rows, piece_bytes=FILE_BYTES, least=2)
    for k in range(2):
        # A tape's trades are spread over both runs and all files; a run takes its files in two triggers.
        rows.where(F.col("trade_no") % 2 == k).repartition(files).write.mode("append").parquet(folder)
        stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", -(-files // 2)).parquet(folder)
        flows.total_tapes(stream, log, f"{base}/checkpoint", compact_every=2)
    sums = log.read().drop("batch_id")
    return tape.exact(sums).select("ticker", "trades", "contracts", "yes_notional", "no_notional", "block_trades")


@query
def stream_chunk_counts(t: Tables) -> DataFrame:
    """Windows of 30 days recounted as markets land, newest first, so that most land late."""
    base = scratch_dir(t.spark, "chunks")
    rows = t.terminal(volume=True).select("ticker", "settlement_ts", "volume")
    schema = "ticker bigint, settlement_ts timestamp_ntz, volume decimal(18,2)"
    log = BatchLog(t.spark, f"{base}/log", f"{schema}, chunk bigint", ["chunk"])
    counts = BatchLog(t.spark, f"{base}/counts", "chunk bigint, settled bigint, ingest_eligible bigint, tape_eligible bigint")
    for later in (True, False):
        rows.where((F.col("ticker") % 2 == 0) == later).write.mode("append").parquet(f"{base}/in")
        stream = t.spark.readStream.schema(schema).parquet(f"{base}/in")
        flows.chunk_counts(stream, log, counts, f"{base}/checkpoint", datetime(1992, 1, 1), timedelta(days=30), 1, 100)
    return counts.latest(["chunk"]).drop("batch_id")


@query
def stream_settled_ingest(t: Tables) -> DataFrame:
    base = scratch_dir(t.spark, "settled")
    stream = t.market_stream()
    log = BatchLog(t.spark, f"{base}/log", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema))
    flows.ingest_settled(stream, log, f"{base}/checkpoint", ["close_time"])
    rows = log.latest(["ticker"], ["close_time"]).drop("batch_id")
    return linkage.link_series(rows, t.events()).select("ticker", "event_ticker", "series_ticker", "status", "result")


@query
def stream_snapshots(t: Tables) -> DataFrame:
    """Daily runs appended by a stream with a 60 h refresh."""
    base = scratch_dir(t.spark, "snapshots")
    table = SnapshotTable(t.spark, f"{base}/table", "ticker bigint, run_ts timestamp_ntz, status string")
    flows.append_snapshots(t.state_stream(), table, f"{base}/checkpoint", f"{base}/staging", 60, ARRIVAL)
    return table.read().select("ticker", "run_ts", "status")


# --- landed payload pages ----------------------------------------------------

def _land(rows: DataFrame, entity: str, key: str, path: str, per_page: int = 500) -> None:
    """Write rows as payload pages: page objects of at most `per_page` items or so."""
    fields = F.to_json(F.struct(*rows.columns))
    n_pages = F.lit(max(1, rows.count() // per_page))
    paged = rows.select(F.pmod(F.xxhash64(key), n_pages).alias("page"), fields.alias("item")) \
                .groupBy("page").agg(F.array_join(F.collect_list("item"), ",").alias("items"))
    paged.select(F.concat(F.lit('{"cursor":"'), F.col("page"), F.lit(f'","{entity}":['), "items", F.lit("]}"))) \
         .write.option("compression", "gzip").text(path)


@query
def json_ingest_series(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "pages") + "/series"
    wire = t.series().withColumnRenamed("series_ticker", "ticker")
    _land(wire, "series", "ticker", path)
    rows = landing.read_series(landing.pages(t.spark, path, "series"), F.lit("2024-01-01").cast("timestamp"))
    return rows.select("series_ticker", "title", "category", "frequency", "fee_type", "fee_multiplier",
                       F.array_join(rules.source_urls(F.col("settlement_sources")), ",").alias("urls"))


@query
def json_ingest_events(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "pages") + "/events"
    _land(t.events(), "events", "event_ticker", path)
    rows = landing.read_events(landing.pages(t.spark, path, "events"), F.lit("2024-01-01").cast("timestamp"))
    return rows.select("event_ticker", "series_ticker", "title", "category", "mutually_exclusive", "raw")


@query
def json_ingest_markets(t: Tables) -> DataFrame:
    """Settled markets written as payloads (decimals as text) and read back, combos dropped."""
    path = scratch_dir(t.spark, "pages") + "/markets"
    m = t.markets(volume=True)
    rfc = F.date_format("settlement_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    wire = m.select(F.col("ticker").cast("string").alias("ticker"), F.col("event_ticker").cast("string").alias("event_ticker"),
                    "status", "result", rfc.alias("settlement_ts"), F.coalesce(F.col("volume").cast("string"), F.lit("")).alias("volume_fp"),
                    "mve_collection_ticker")
    _land(wire, "markets", "ticker", path)
    rows = landing.read_markets(landing.pages(t.spark, path, "markets"))
    return filters.settled_ingest(rows).select("ticker", "event_ticker", "status", "result", "settlement_ts", "volume")


@query
def json_ingest_snapshots(t: Tables) -> DataFrame:
    """Quotes written as open-market payloads and read back as one run."""
    path = scratch_dir(t.spark, "pages") + "/open"
    s = t.snapshots()
    wire = s.select(F.concat(F.lit("M"), "arrival").alias("ticker"), F.col("event_ticker").cast("string").alias("event_ticker"), "status",
                    F.col("yes_bid").cast("string").alias("yes_bid_dollars"),
                    F.col("yes_ask").cast("string").alias("yes_ask_dollars"),
                    F.col("volume_24h").cast("string").alias("volume_24h_fp"), "price_level_structure")
    _land(wire, "markets", "ticker", path)
    rows = landing.read_snapshots(landing.pages(t.spark, path, "markets"), F.lit("2024-01-31 00:00:41").cast("timestamp"))
    return rows.select("ticker", "event_ticker", "status", "yes_bid", "yes_ask", "no_bid", "volume_24h",
                       "price_level_structure")


@query
def json_nested_markets(t: Tables) -> DataFrame:
    """Events that carry their markets, and the tick sizes of these."""
    path = scratch_dir(t.spark, "pages") + "/nested"
    cents = (F.col("ticker") % 9 + 1).cast("decimal(6,0)") * F.lit(Decimal("0.01"))
    tick = F.struct(F.lit("0").alias("start"), F.lit("1").alias("end"), cents.cast("string").alias("step"))
    item = F.struct(F.concat(F.lit("M"), "ticker").alias("ticker"), F.col("event_ticker").cast("string").alias("event_ticker"), "status", "result",
                    F.array(tick).alias("price_ranges"))
    wire = t.markets().groupBy("event_ticker").agg(F.collect_list(item).alias("markets"))
    _land(_text(wire, "event_ticker"), "events", "event_ticker", path)
    raw = landing.nested_markets(landing.pages(t.spark, path, "events"))
    ticks = landing.price_ranges(raw)
    return landing.read_markets(raw).select("ticker", "event_ticker", "status", "result").join(ticks, "ticker")


@query
def json_lenient_trades(t: Tables) -> DataFrame:
    """Trades of which some carry a malformed number: these lie apart with a reason, the others are folded."""
    path = scratch_dir(t.spark, "pages") + "/lenient"
    rows = t.trades()
    odd = F.when(F.col("supp_no") % 11 == 0, F.concat(F.col("count_fp").cast("string"), F.lit("x"))).otherwise(F.col("count_fp").cast("string"))
    price = F.when(F.col("part_no") % 13 == 0, F.lit("free")).otherwise(F.col("yes_price_dollars").cast("string"))
    wire = rows.select(F.concat_ws("-", "ticker", *TRADE_ORDER).alias("trade_id"), F.col("ticker").cast("string").alias("ticker"),
                       odd.alias("count_fp"), price.alias("yes_price_dollars"), F.col("no_price_dollars").cast("string").alias("no_price_dollars"),
                       "taker_side", "is_block_trade")
    _land(wire, "trades", "trade_id", path)
    good, apart = landing.read_trades_apart(landing.pages(t.spark, path, "trades"))
    counted = apart.groupBy("reason").agg(F.count("*").alias("n"))
    folded = good.select(F.lit("read").alias("reason"), F.lit(1).alias("one")).groupBy("reason").agg(F.count("one").alias("n"))
    return counted.unionByName(folded)


@query
def outcome_side(t: Tables) -> DataFrame:
    """Trades that name the outcome in the newer field where the older one is missing."""
    rows = t.trades().withColumn("taker_outcome_side", F.when(F.col("trade_no") % 2 == 0, F.col("taker_side")))
    rows = rows.withColumn("taker_side", F.when(F.col("trade_no") % 2 == 1, F.col("taker_side")))
    return tape.exact(tape.tape_sums(rows, ["ticker"], use_outcome_side=True)).select("ticker", "trades", "yes_contracts", "no_contracts", "bad_side")


@query
def json_ingest_trades(t: Tables) -> DataFrame:
    """The tape written as payload pages, read back and folded."""
    path = scratch_dir(t.spark, "pages") + "/trades"
    rows = t.trades()
    wire = rows.select(F.concat_ws("-", "ticker", *TRADE_ORDER).alias("trade_id"), F.col("ticker").cast("string").alias("ticker"),
                       F.col("count_fp").cast("string").alias("count_fp"),
                       F.col("yes_price_dollars").cast("string").alias("yes_price_dollars"),
                       F.col("no_price_dollars").cast("string").alias("no_price_dollars"),
                       "taker_side", "is_block_trade",
                       F.date_format("created_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_time"))
    _land(wire, "trades", "trade_id", path)
    read = landing.read_trades(landing.pages(t.spark, path, "trades"))
    return tape.exact(tape.tape_sums(read, ["ticker"])).select("ticker", "trades", "contracts", "yes_notional", "no_notional", "block_trades")
