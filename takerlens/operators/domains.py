"""Hosts against lists of domains as a hash join on host suffixes.

A host belongs to a domain if it equals it or lies below it. Instead of one pattern over every listed domain, a host is
taken apart into the domains above it, and these meet the list by equality. Lists of any length work, and a host costs
as many rows as the deepest listed domain has labels.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takerlens.functions import rules


def domain_table(spark: SparkSession, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """label, domain for lists given in code."""
    return spark.createDataFrame([(g, d) for g, names in groups.items() for d in names], "label string, domain string")


def labels_of(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """host, labels: for each distinct `host` the sorted labels of the domains it is in; hosts in none are not there."""
    depth = domains.select(F.max(F.size(F.split("domain", r"\."))).alias("n")).scalar()
    parts = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.least(F.size("_parts"), "_depth")), lambda k: F.array_join(F.slice("_parts", -k, k), "."))
    known = hosts.select("host").where("host <> ''").distinct().select("host", parts.alias("_parts"), F.coalesce(depth, F.lit(1)).alias("_depth"))
    pairs = known.select("host", F.explode(above).alias("domain")).join(domains.select("label", "domain"), "domain")
    return pairs.groupBy("host").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def host_links(series: DataFrame) -> DataFrame:
    """series_ticker, host: the distinct hosts of each series' settlement links, one row each."""
    each = series.select("series_ticker", F.explode(rules.source_urls(F.col("settlement_sources"))).alias("url"))
    return each.select("series_ticker", rules.host(F.col("url")).alias("host")).distinct()


def classify_links(series: DataFrame, links: DataFrame, domains: DataFrame) -> DataFrame:
    """The tags of each series from its links, however many it has: no list of hosts is ever gathered.

    `series` has series_ticker, category, frequency and n_events, `links` series_ticker and host, `domains` label and
    domain with the labels of `rules.GROUPS` and the levels of `rules.LEVELS`. Per series there is one row of at
    most as many labels as there are lists.
    """
    labelled = links.join(labels_of(links, domains), "host", "left")
    level = F.coalesce(*[F.when(F.array_contains("labels", name), F.lit(name)) for name in rules.LEVELS])
    each = labelled.select("series_ticker", "host", level.alias("level"), F.explode_outer("labels").alias("label"))
    of_series = each.groupBy("series_ticker").agg(
        F.collect_set("label").alias("labels"), F.count_distinct("host").alias("n_hosts"),
        F.min(F.when(F.col("level").isNotNull(), F.struct("host", "level"))).alias("first"))
    rows = series.join(of_series, "series_ticker", "left").withColumn("n_hosts", F.coalesce("n_hosts", F.lit(0)))

    def hit(group: str) -> Column:
        return F.coalesce(F.array_contains("labels", group), F.lit(False))

    bench = rules.benchmark_of(hit, F.col("category"), F.col("n_hosts") == 0)
    return rows.select(
        "series_ticker", "n_hosts", rules.source_type_of(hit).alias("settlement_source_type"), bench.alias("b"),
        rules.recurrence(F.col("frequency"), F.col("n_events")).alias("recurrence"),
        F.coalesce("first.level", F.lit("unknown")).alias("scrape_difficulty")).select(
        "series_ticker", "n_hosts", "settlement_source_type", "b.benchmark", "b.benchmark_name", "recurrence", "scrape_difficulty")
