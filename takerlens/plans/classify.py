"""Series tags: who needs one, what the rules say, and how the result reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takerlens.functions import rules

FIELDS = ["settlement_source_type", "benchmark", "recurrence"]


def events_per_series(events: DataFrame) -> DataFrame:
    return events.where(F.col("series_ticker").isNotNull()) \
                 .groupBy("series_ticker").agg(F.count("*").alias("n_events"))


def with_event_counts(series: DataFrame, events: DataFrame) -> DataFrame:
    """Series with `n_events`, 0 when it has produced none."""
    return series.join(events_per_series(events), "series_ticker", "left") \
                 .withColumn("n_events", F.coalesce("n_events", F.lit(0)))


def candidates(series: DataFrame, events: DataFrame, tags: DataFrame, terminal: DataFrame | None,
               recheck: bool = False, version: str = rules.RULES_VERSION, limit: int | None = None) -> DataFrame:
    """Series needing a tag: untagged, or unreviewed and written by other rules.

    `terminal` (None: classify all) restricts to series with settled markets;
    `recheck` takes every unreviewed tag again. A reviewed tag is a person's
    decision and never comes back.
    """
    t = tags.select("series_ticker", F.lit(True).alias("_tagged"), F.col("reviewed").alias("_reviewed"),
                    F.col("model").alias("_model"))
    open_tag = ~F.coalesce("_reviewed", F.lit(False))
    stale = open_tag if recheck else open_tag & (F.coalesce("_model", F.lit("")) != version)
    rows = series.where(F.coalesce("frequency", F.lit("")) != "one_off")
    if terminal is not None:
        rows = rows.join(terminal.select("series_ticker"), "series_ticker", "left_semi")
    rows = rows.join(t, "series_ticker", "left").where(F.col("_tagged").isNull() | stale)
    out = with_event_counts(rows, events).select(
        "series_ticker", "title", "category", "frequency", "settlement_sources", "n_events").orderBy("series_ticker")
    return out if limit is None else out.limit(limit)


def classify(series: DataFrame) -> DataFrame:
    """One tag row per series (needs settlement_sources, category, frequency, n_events)."""
    base = series.select("series_ticker", "category", "frequency", "n_events",
                         rules.hosts(F.col("settlement_sources")).alias("_hosts"),
                         rules.source_urls(F.col("settlement_sources")).alias("source_urls"))
    judged = base.select("*", rules.settlement_source_type(F.col("_hosts")).alias("settlement_source_type"),
                         rules.benchmark(F.col("_hosts"), F.col("category")).alias("_b"),
                         rules.recurrence(F.col("frequency"), F.col("n_events")).alias("recurrence"),
                         rules.scrape_difficulty(F.col("_hosts")).alias("scrape_difficulty"))
    note = rules.notes(F.col("settlement_source_type"), F.col("_b.benchmark"), F.col("_hosts"),
                       F.col("frequency"), F.col("recurrence"), F.col("n_events"))
    return judged.select("series_ticker", "settlement_source_type", "_b.benchmark", "_b.benchmark_name",
                         "recurrence", "scrape_difficulty", "source_urls", note.alias("notes"),
                         F.lit(rules.RULES_VERSION).alias("model"), F.lit(False).alias("reviewed"))


def tag_tally(tags: DataFrame) -> DataFrame:
    """All combinations of source, benchmark and recurrence, the most common first."""
    return tags.groupBy(*FIELDS).agg(F.count("*").alias("n")) \
               .orderBy(F.desc("n"), *FIELDS)
