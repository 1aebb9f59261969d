"""spark-submit entry: `python -m takerlens <job> --store DIR [...]`."""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from takerlens.plans import jobs
from takerlens.plans.screen import Thresholds
from takerlens.session import build_session
from takerlens.sources import landing


def _markets(spark: SparkSession, path: str) -> DataFrame:
    return landing.read_markets(landing.pages(spark, path, "markets"))


def _archive(spark: SparkSession, path: str) -> DataFrame:
    """Archive pages lie in one folder per walked series: `walked_series=<ticker>/`."""
    return landing.read_markets(landing.pages(spark, path, "markets", keep=["walked_series"]))


def _trades(spark: SparkSession, live: str | None, archived: str | None) -> DataFrame | None:
    """Landed pages, or None for the trades kept in the store."""
    if not live:
        return None
    rows = landing.read_trades(landing.pages(spark, live, "trades"), "live")
    if archived:
        rows = rows.unionByName(landing.read_trades(landing.pages(spark, archived, "trades"), "archive"))
    return jobs.distinct_trades(rows)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="takerlens")
    top.add_argument("--store", required=True, help="folder of the tables")
    top.add_argument("--as-of", help="run time, ISO 8601 (default: now)")
    sub = top.add_subparsers(dest="job", required=True)
    p = sub.add_parser("snapshot", help="series, events and one run of open markets")
    p.add_argument("--landed", required=True)
    p.add_argument("--refresh-hours", type=float, default=12)
    p = sub.add_parser("trades", help="keep landed trades as Parquet")
    p.add_argument("--landed", required=True)
    p.add_argument("--batch", type=int, required=True)
    p.add_argument("--origin", choices=["live", "archive"], default="live")
    p = sub.add_parser("settled", help="keep landed market payloads as Parquet by settlement day")
    p.add_argument("--landed", required=True)
    p.add_argument("--batch", type=int, required=True)
    p = sub.add_parser("sweep", help="settled markets since the cursor and their tapes, window by window")
    p.add_argument("--markets", help="landed pages (default: those kept by `settled`)")
    p.add_argument("--trades", help="landed pages (default: the store's trades)")
    p.add_argument("--archived-trades")
    p.add_argument("--minimum-volume", type=float, default=0)
    p.add_argument("--page-cap", type=int, default=None, help="newest pages of a tape (default: whole tapes)")
    p.add_argument("--lookback-days", type=float, help="how far a first sweep looks back (default: all landed markets)")
    p.add_argument("--chunk-hours", type=float, default=12, help="settlement time in one commit")
    p.add_argument("--stop-after", type=int, help="end after so many windows; the next sweep goes on from there")
    p = sub.add_parser("backfill", help="archive and recent markets, then the pending tapes in scope")
    p.add_argument("--archive")
    p.add_argument("--markets", required=True)
    p.add_argument("--trades", help="landed pages (default: the store's trades)")
    p.add_argument("--archived-trades")
    p.add_argument("--days", type=int, default=180)
    p.add_argument("--series", default="")
    p.add_argument("--from-screen", action="store_true")
    p.add_argument("--exclude-categories", default="")
    p.add_argument("--minimum-volume", type=float, default=0)
    p.add_argument("--page-cap", type=int, default=None, help="newest pages of a tape (default: whole tapes)")
    p = sub.add_parser("classify", help="tag series")
    p.add_argument("--all", action="store_true")
    p.add_argument("--recheck", action="store_true")
    p.add_argument("--limit", type=int)
    p = sub.add_parser("prune", help="drop old snapshot runs")
    p.add_argument("--days", type=float, default=30)
    for name in ("screen", "funnel"):
        p = sub.add_parser(name)
        p.add_argument("--volume-low", type=float, default=1000)
        p.add_argument("--volume-high", type=float, default=100_000)
        p.add_argument("--breadth", type=float, default=0.34)
        p.add_argument("--n-settled", type=int, default=20)
        p.add_argument("--out", help="write the result as Parquet instead of printing the first rows")
    return top


def run(spark: SparkSession, argv: list[str]) -> dict | DataFrame:
    a = parser().parse_args(argv)
    now = jobs.utc(datetime.fromisoformat(a.as_of)) if a.as_of else datetime.now(timezone.utc)
    store = jobs.Store(spark, a.store.rstrip("/"))

    def words(text: str) -> list[str]:
        return [w for w in text.split(",") if w.strip()]

    if a.job == "snapshot":
        return jobs.snapshot_job(store, a.landed.rstrip("/"), now, a.refresh_hours)
    if a.job == "trades":
        return jobs.trades_job(store, a.landed, a.batch, a.origin)
    if a.job == "settled":
        return jobs.settled_job(store, a.landed, a.batch)
    if a.job == "sweep":
        return jobs.sweep_job(store, _markets(spark, a.markets) if a.markets else None,
                              _trades(spark, a.trades, a.archived_trades), now, a.minimum_volume, page_cap=a.page_cap,
                              lookback=None if a.lookback_days is None else timedelta(days=a.lookback_days),
                              chunk=timedelta(hours=a.chunk_hours), stop_after=a.stop_after)
    if a.job == "backfill":
        return jobs.backfill_job(store, _archive(spark, a.archive) if a.archive else None, _markets(spark, a.markets),
                                 _trades(spark, a.trades, a.archived_trades), now, a.days, words(a.series), a.from_screen,
                                 words(a.exclude_categories), a.minimum_volume, page_cap=a.page_cap)
    if a.job == "classify":
        return jobs.classify_job(store, now, a.all, a.recheck, a.limit)
    if a.job == "prune":
        return jobs.prune_job(store, now, a.days)
    limits = Thresholds(a.volume_low, a.volume_high, a.breadth, a.n_settled)
    result = store.screen(now, limits) if a.job == "screen" else store.funnel(now, limits)
    if a.out:
        result.write.mode("overwrite").parquet(a.out)
    return result


def main() -> None:
    import sys

    result = run(build_session(), sys.argv[1:])
    result.show(50, truncate=False) if isinstance(result, DataFrame) else print(result)


if __name__ == "__main__":
    main()
