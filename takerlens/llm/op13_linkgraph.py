"""URL filters with verdicts that spread over the link graph.

A rule names a host (and so all its subdomains) and how the path begins; the longest rule that fits a url judges it. Urls
without a rule are judged by their host. A host is a seed of trust by the share of its urls that rules allow, and a seed
of distrust by the share that they block. Personalised PageRank carries trust from a page's host to the hosts it links to;
on the reversed graph it carries distrust from a host to those that link to it. A host is blocked where its distrust
reaches a threshold and exceeds its trust.

Everything is DataFrame work: urls and links are folded to hosts before they meet anything, rules join on host suffixes
(no more of them than the longest rule has labels), a round is one join on the flows between hosts and one sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takerlens.llm.staging import staged, with_package

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DAMPING, ROUNDS, STILL = 0.85, 20, 1e-12
# Distrust that blocks a host, as a part of what a host starts with whose urls are all blocked.
LEAST = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What follows the two slashes in an href or src attribute; relative links stay on their host and are no edges.
LINK = r"""[ \t\n\f\r"'](?:[Hh][Rr][Ee][Ff]|[Ss][Rr][Cc])[ \t\n\f\r]*=[ \t\n\f\r]*["']?[ \t\n\f\r]*""" \
       r"""(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^"' \t\n\f\r<>]*)"""


def host_of(rest: Column) -> Column:
    """The host at the start of what follows a url's two slashes."""
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty for NULL and where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def rule_table(rules: DataFrame) -> DataFrame:
    """host, path, size, rule, verdict for rules like `example.net/en/`."""
    host = F.translate(F.regexp_extract("rule", "^[^/]*", 0), _UPPER, _LOWER)
    return rules.select(host.alias("host"), F.regexp_extract("rule", "^[^/]*(.*)$", 1).alias("path"),
                        F.length("rule").alias("size"), "rule", "verdict").where("host <> ''")


def fitting(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host, fits: for each of the distinct `hosts` the rules on it or a domain above it, if there are any."""
    rules = rule_table(rules)
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(deepest, 1)))),
                        lambda k: F.array_join(F.slice("labels", -k, k), "."))
    suffixes = hosts.where("host <> ''").withColumn("labels", labels).select("host", F.explode(above).alias("suffix"))
    found = F.struct("size", F.length("suffix").alias("host_size"), "verdict", "path", "rule")
    return suffixes.join(rules.withColumnRenamed("host", "suffix"), "suffix").groupBy("host").agg(
        F.collect_list(found).alias("fits"))


def longest(path: Column, fits: Column) -> Column:
    """The longest rule of `fits` whose path the url's begins with; of equally long ones that with the longer host, then block."""
    return F.array_max(F.filter(fits, lambda rule: F.startswith(path, rule["path"])))


def links(pages: DataFrame) -> DataFrame:
    """source, host, path, n: how many pages of host `source` link to a url; the pages' own urls have no source."""
    found = pages.select(host_of(after_scheme(F.col("url"))).alias("source"),
                         F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"),
                         path_of(after_scheme(F.col("url"))).alias("path"))
    own = F.array(F.struct(F.lit(None).cast("string").alias("source"), F.col("source").alias("host"), F.col("path")))
    to = F.transform("to", lambda rest: F.struct(F.col("source"), host_of(rest).alias("host"), path_of(rest).alias("path")))
    return found.select(F.explode(F.concat(own, to)).alias("x")).select("x.*").where("host <> ''").groupBy(
        "source", "host", "path").agg(F.count("*").alias("n"))


def seeds(urls: DataFrame, fits: DataFrame) -> DataFrame:
    """kind, host, seed: the share of a host's urls that rules allow (trust) and block (distrust), where it is not 0."""
    judged = urls.join(fits, "host").withColumn("verdict", longest(F.col("path"), F.col("fits"))["verdict"])
    share = judged.groupBy("host").agg(F.sum("n").alias("n"), *(
        F.coalesce(F.sum(F.when(F.col("verdict") == v, F.col("n"))), F.lit(0)).alias(v) for v in ("allow", "block")))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), (F.col(v) / F.col("n")).alias("seed"))
                      for k, v in (("trust", "allow"), ("distrust", "block"))))
    return share.select("host", F.explode(kinds).alias("x")).select("x.kind", "host", "x.seed").where("seed > 0")


def flows(urls: DataFrame) -> DataFrame:
    """kind, source, target, part: what part of a host's score another host gets, by the links between them."""
    edges = urls.where("source <> '' AND source <> host").groupBy("source", "host").agg(F.sum("n").alias("n"))
    ways = F.array(F.struct(F.lit("trust").alias("kind"), F.col("source"), F.col("host").alias("target"), F.col("n")),
                   F.struct(F.lit("distrust").alias("kind"), F.col("host").alias("source"), F.col("source").alias("target"),
                            F.col("n")))
    both = edges.select(F.explode(ways).alias("x")).select("x.*")
    total = both.groupBy("kind", "source").agg(F.sum("n").alias("total"))
    return both.join(total, ["kind", "source"]).select("kind", "source", "target", (F.col("n") / F.col("total")).alias("part"))


def propagated(seed: DataFrame, flow: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """kind, host, score after `rounds` rounds, or fewer once nothing moves: score = (1 - damping) seed + damping inflow.

    Scores are not scaled to a sum of 1, so more seeds elsewhere change nothing for a host. A host without links keeps
    what it gets. Each round is stored; one number a round reaches the driver.
    """
    start = F.lit(1 - damping) * F.col("seed")
    flow = staged(flow, "flows")
    now = staged(seed.unionByName(flow.select("kind", F.col("target").alias("host"), F.lit(0.0).alias("seed")))
                 .groupBy("kind", "host").agg(F.max("seed").alias("seed")).withColumn("score", start), "scores")
    if flow.isEmpty():
        return now.select("kind", "host", "score")
    for _ in range(rounds):
        sent = flow.join(now.select("kind", F.col("host").alias("source"), "score"), ["kind", "source"])
        inflow = sent.groupBy("kind", F.col("target").alias("host")).agg(F.sum(F.col("part") * F.col("score")).alias("inflow"))
        score = start + F.lit(damping) * F.coalesce("inflow", F.lit(0.0))
        new = staged(now.join(inflow, ["kind", "host"], "left").select(
            "kind", "host", "seed", score.alias("score"), F.abs(score - F.col("score")).alias("moved")), "scores")
        moved = new.agg(F.max("moved")).first()[0] or 0.0
        now = new.drop("moved")
        if moved <= STILL:
            break
    return now.select("kind", "host", "score")


def judge(pages: DataFrame, rules: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, least: float = LEAST) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for each row of `pages` (page_id, url, html).

    Repeated rows and ids are judged one by one, each counted as a page; NULL ids stay; NULL urls and urls without `://` have
    an empty host and path, no rule, and are allowed; NULL html has no links; other columns are not read; no pages give no
    rows. Hosts keep ports and user names, as they stand before the first `/`, `?` or `#`. Scores are rounded to nine
    digits. `rules` (rule, verdict allow or block) may be empty: then all is allowed.
    """
    urls = staged(links(pages), "urls")
    fits = staged(fitting(urls.select("host").distinct(), rules), "fits")
    scores = propagated(seeds(urls, fits), flows(urls), damping, rounds)
    of_host = scores.groupBy("host").agg(*(
        F.round(F.sum(F.when(F.col("kind") == k, F.col("score"))), 9).alias(k) for k in ("trust", "distrust")))
    rest = after_scheme(F.col("url"))
    told = (pages.select("page_id", host_of(rest).alias("host"), path_of(rest).alias("path"))
            .join(fits, "host", "left").join(of_host, "host", "left")
            .withColumn("found", longest(F.col("path"), F.col("fits")))
            .withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust")}))
    bad = (F.col("distrust") >= F.lit(round(least * (1 - damping), 9))) & (F.col("distrust") > F.col("trust"))
    return told.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                       F.coalesce("found.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                       "trust", "distrust")


def op13_link_graph_filter(spark, sf_dir: str) -> DataFrame:
    rules = with_package(spark).createDataFrame(list(RULES), "rule string, verdict string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


_QUOTED = LINK.replace("'", "''")
OP13_SQL = f"""
WITH RECURSIVE rules(rule, verdict) AS (VALUES {", ".join(map(str, RULES))}),
parsed_rules AS (SELECT rule, verdict, regexp_extract(rule, '^[^/]*') AS rule_host, regexp_extract(rule, '^[^/]*(.*)$', 1) AS rule_path
  FROM rules),
own AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
judged_pages AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM own),
pointed AS (SELECT host AS source, unnest(list_distinct(regexp_extract_all(coalesce(html, ''), '{_QUOTED}', 1))) AS rest FROM judged_pages),
urls AS (SELECT NULL::VARCHAR AS source, host, path FROM judged_pages WHERE host <> ''
  UNION ALL SELECT source, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)
  FROM pointed WHERE regexp_extract(rest, '^[^/?#]*') <> ''),
distinct_urls AS (SELECT DISTINCT host, path FROM urls UNION SELECT host, path FROM judged_pages),
fitting AS (SELECT host, path, max_by(rule, (length(rule), length(rule_host), verdict)) AS rule,
  max_by(verdict, (length(rule), length(rule_host), verdict)) AS verdict
  FROM distinct_urls JOIN parsed_rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path),
shares AS (SELECT host, count(*) FILTER (verdict = 'allow') / count(*)::DOUBLE AS trust,
  count(*) FILTER (verdict = 'block') / count(*)::DOUBLE AS distrust FROM urls LEFT JOIN fitting USING (host, path) GROUP BY host),
edges AS (SELECT source, host, count(*) AS n FROM urls WHERE source <> '' AND source <> host GROUP BY ALL),
flows AS (SELECT 'trust' AS kind, source, host AS target, n / sum(n) OVER (PARTITION BY source)::DOUBLE AS part FROM edges
  UNION ALL SELECT 'distrust', host, source, n / sum(n) OVER (PARTITION BY host)::DOUBLE FROM edges),
nodes AS (SELECT 'trust' AS kind, host, trust AS seed FROM shares UNION ALL SELECT 'distrust', host, distrust FROM shares
  UNION ALL SELECT 'trust', source, 0 FROM edges UNION ALL SELECT 'distrust', source, 0 FROM edges),
seeds AS (SELECT kind, host, max(seed) AS seed FROM nodes GROUP BY ALL),
steps(round, kind, host, seed, score) AS (
  SELECT 0, kind, host, seed, {1 - DAMPING!r}::DOUBLE * seed FROM seeds
  UNION ALL SELECT s.round + 1, s.kind, s.host, s.seed, {1 - DAMPING!r}::DOUBLE * s.seed + {DAMPING}::DOUBLE * coalesce(sum(f.part * i.score), 0)
  FROM steps s LEFT JOIN flows f ON f.kind = s.kind AND f.target = s.host LEFT JOIN steps i ON i.kind = f.kind AND i.host = f.source
  WHERE s.round < {ROUNDS} GROUP BY s.round, s.kind, s.host, s.seed),
scores AS (SELECT host, round(max(score) FILTER (kind = 'trust'), 9) AS trust, round(max(score) FILTER (kind = 'distrust'), 9) AS distrust
  FROM steps WHERE round = {ROUNDS} GROUP BY host)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN coalesce(distrust, 0) >= {round(LEAST * (1 - DAMPING), 9)}
    AND coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0)::DOUBLE AS trust, coalesce(distrust, 0)::DOUBLE AS distrust
FROM judged_pages LEFT JOIN fitting USING (host, path) LEFT JOIN scores USING (host)"""
