"""The star-schema test tables seen as series, events, markets, trades and snapshots.

Keys stay the integers of the tables. Every projection is a plain select over a
whole table, so filters and pruning reach the Parquet scan.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takerlens.operators.ingest import recent_window
from takerlens.operators.linkage import link_series
from takerlens.streaming.flows import file_stream

CATEGORIES = ["Climate and Weather", "Economics", "Entertainment", "Sports", "Crypto"]
FREQUENCIES = ["custom", "one_off", "annual", "monthly", "weekly", "daily", "hourly", "fifteen_min"]
LINKS = ["https://forecast.weather.gov/x", "https://www.bls.gov/x", "https://www.cmegroup.com/x",
         "https://www.oscars.org/x", "https://wpc.ncep.noaa.gov/x", "https://www.wsj.com/x"]
LIVE_SINCE = "1998-01-01"
# The table layouts, so opening one starts no job to infer its columns.
LAYOUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "pages": "page_id bigint, url string, html string",
}
# Everything that can order two trades of one market created at the same time.
TRADE_ORDER = ["trade_no", "part_no", "supp_no", "yes_cents", "taker_side", "count_fp"]


def _pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


class Tables:
    """Projected tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(LAYOUT[name]).parquet(f"{self.folder}/{name}.parquet")

    def series(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.raw("nation").select(
            F.concat(F.lit("S"), k).alias("series_ticker"), F.col("n_name").alias("title"),
            _pick(CATEGORIES, k).alias("category"), _pick(FREQUENCIES, k).alias("frequency"),
            F.array(F.struct(F.lit("source").alias("name"), _pick(LINKS, k).alias("url"))).alias("settlement_sources"),
            F.when(k % 10 == 9, "quadratic_with_maker_fees").otherwise("quadratic").alias("fee_type"),
            F.when(k % 7 == 0, 0).otherwise(1).cast("decimal(6,4)").alias("fee_multiplier"))

    def events(self) -> DataFrame:
        known = F.when(F.col("c_custkey") % 97 != 0, F.concat(F.lit("S"), F.col("c_nationkey")))
        return self.raw("customer").select(
            F.col("c_custkey").alias("event_ticker"), known.alias("series_ticker"), F.col("c_name").alias("title"),
            F.col("c_mktsegment").alias("category"), (F.col("c_acctbal") >= 0).alias("mutually_exclusive"))

    def early_events(self) -> DataFrame:
        """The events already stored when the first markets settle."""
        return self.events().where("mutually_exclusive")

    def volumes(self) -> DataFrame:
        return self.raw("lineitem").groupBy(F.col("l_orderkey").alias("ticker")).agg(
            F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(18,2)").alias("volume"))

    def markets(self, volume: bool = False) -> DataFrame:
        k = F.col("o_orderkey")
        rows = self.raw("orders").select(
            k.alias("ticker"), F.col("o_custkey").alias("event_ticker"),
            F.when(k % 10 == 9, "closed").when(k % 10 == 8, "settled").otherwise("finalized").alias("status"),
            F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no").otherwise("").alias("result"),
            F.when(k % 40 != 3, F.col("o_orderdate")).alias("settlement_ts"),
            F.when(k % 80 != 3, F.col("o_orderdate")).alias("close_time"),
            F.when(k % 50 == 0, "combo").alias("mve_collection_ticker"))
        return rows.join(self.volumes(), "ticker", "left") if volume else rows

    def terminal(self, volume: bool = False) -> DataFrame:
        """Settled single-question markets linked to their series."""
        return recent_window(self.markets(volume), self.events(), None)

    def trades(self) -> DataFrame:
        yes_cents = (1 + F.round(F.col("l_discount") * 100) * 8 + F.round(F.col("l_tax") * 100)).cast("int")
        yes = (yes_cents.cast("decimal(6,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,6)")
        line = F.col("l_linenumber")
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("ticker"), line.alias("trade_no"), F.col("l_partkey").alias("part_no"),
            F.col("l_suppkey").alias("supp_no"), yes_cents.alias("yes_cents"),
            F.when(line % 3 != 0, yes).alias("yes_price_dollars"),
            F.when(line % 3 != 1, 1 - yes).cast("decimal(10,6)").alias("no_price_dollars"),
            F.col("l_quantity").cast("decimal(18,2)").alias("count_fp"),
            F.when(F.col("l_linestatus") == "O", "yes").otherwise("no").alias("taker_side"),
            ((F.col("l_returnflag") == "A") & (F.col("l_quantity") >= 45)).alias("is_block_trade"),
            F.col("l_shipdate").alias("created_time"),
            F.when(F.col("l_shipdate") >= F.lit(LIVE_SINCE).cast("timestamp_ntz"), "live").otherwise("archive").alias("origin"))

    def quotes(self, unit: str = "minute") -> DataFrame:
        """Quotes of open markets; `arrival` orders rows of one market and run."""
        cents = (F.col("event_id") % 60).cast("decimal(6,0)")
        width = (F.col("event_id") % 7 + 1).cast("decimal(6,0)")
        hundredth = F.lit(Decimal("0.01"))
        return self.raw("events").select(
            F.col("user_id").alias("ticker"), F.date_trunc(unit, F.col("ts")).cast("timestamp_ntz").alias("run_ts"),
            F.col("event_id").alias("arrival"), F.col("user_id").alias("event_ticker"),
            F.when(F.col("event_type") == "error", "closed").when(F.col("event_type") == "signup", "settled")
             .otherwise("active").alias("status"),
            (cents * hundredth).cast("decimal(10,6)").alias("yes_bid"),
            ((cents + width) * hundredth).cast("decimal(10,6)").alias("yes_ask"),
            F.greatest(F.col("value") - 20, F.lit(0.0)).cast("decimal(18,2)").alias("volume_24h"),
            F.col("event_type").alias("price_level_structure"))

    def snapshots(self, unit: str = "minute") -> DataFrame:
        """Quotes linked to their series."""
        return link_series(self.quotes(unit), self.events())

    def states(self, unit: str = "hour") -> DataFrame:
        """Coarse market states per run, often the same as the run before."""
        return self.snapshots(unit).select("ticker", "run_ts", "arrival", "series_ticker", "status")

    # The same projections over streams of the table files.

    def _streaming(self) -> "Tables":
        return _StreamTables(self.spark, self.folder)

    def trade_stream(self) -> DataFrame:
        return self._streaming().trades()

    def market_stream(self) -> DataFrame:
        return self._streaming().markets()

    def state_stream(self) -> DataFrame:
        """Daily market states without the series link (it is looked up per batch or later)."""
        return self._streaming().quotes("day").select("ticker", "run_ts", "arrival", "status")


class _StreamTables(Tables):
    def raw(self, name: str) -> DataFrame:
        return file_stream(self.spark, self.folder, f"{name}.parquet", LAYOUT[name])
