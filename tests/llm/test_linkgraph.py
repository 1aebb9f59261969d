"""Rules and propagated verdicts against SQL and a plain power iteration."""

import random

import duckdb
import pytest

from takerlens.llm import op13_linkgraph as op
from tests.compare import compare
from tests.llm.conftest import FOLDER, needs_tables


@pytest.fixture(scope="module")
def write(spark, tmp_path_factory):
    def pages(rows):
        folder = str(tmp_path_factory.mktemp("pages"))
        spark.createDataFrame([(*r, "h", "v", 1) for r in rows], "page_id long, url string, html string, host string, verdict string, n int") \
             .repartition(3).write.parquet(f"{folder}/pages.parquet")
        return folder

    return pages


def sql_over(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    return con


def random_pages(n, seed):
    rng = random.Random(seed)
    hosts = [f"h{i}.{d}" for i in range(12) for d in ("example.net", "a.com", "example.com", "b.org")] + ["Net", "ORG", "x.net:80", "u@example.net"]

    def url():
        return rng.choice(["http://", "https://", "HTTP://", "//", ""]) + rng.choice(hosts) + rng.choice(
            ["", "/", "/en/a", "/de/x?y", "/fr/#z", "?/en/", "#", "/EN/a", "//en/"])

    def html():
        return " ".join(f"<a class=x {rng.choice(['href', 'HREF ', 'src'])}={rng.choice(['', chr(34), chr(39) + ' '])}{url()}>"
                        for _ in range(rng.randint(0, 5)))

    odd = [None, "", "no scheme", "x://y://z/", "://", "a://?b", "http:///path"]
    return [(rng.choice([i, i, i, None, 1]), rng.choice(odd) if i % 9 == 0 else url(), None if i % 11 == 0 else html()) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_sql_on_random_pages(spark, write, seed):
    folder = write(random_pages(250, seed))
    got = op.op13_link_graph_filter(spark, folder)
    assert got.where("rule IS NULL AND verdict = 'block'").count() > 0
    assert compare(got, sql_over(folder), op.OP13_SQL) is None


def test_trust_and_distrust_spread(spark, write):
    """bad.net is blocked by rule; spam links only to it, fan to it and to good hosts, far only to spam; good is linked by a trusted page."""
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">' for h in hosts)
    pages = [(1, "http://bad.net/x", ""), (2, "http://spam.com/", link("bad.net")), (3, "http://far.com/", link("spam.com") * 3),
             (4, "http://fan.com/", link("ok1.com", "ok2.com", "bad.net")), (5, "http://x.org/fr/1", link("good.com", "mixed.com")),
             (6, "http://good.com/1", link("good.com")), (7, "http://mixed.com/1", link("spam.com")), (8, "http://alone.com/", None),
             (9, "http://ok1.com/", "")]
    got = {r.page_id: r for r in op.op13_link_graph_filter(spark, write(pages)).collect()}
    assert {i: r.verdict for i, r in got.items()} == {
        1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow"}
    # bad.net is linked by two hosts, so each takes half of its distrust; a host all of whose kind links to it alone is blocked.
    seed = 1 - op.DAMPING
    assert got[2].distrust == pytest.approx(seed * op.DAMPING / 2, abs=1e-9) and got[6].trust == pytest.approx(seed * op.DAMPING / 2, abs=1e-9)
    only = [(1, "http://bad.net/x", ""), (2, "http://spam.com/", link("bad.net", "bad.net")), (3, "http://far.com/", link("spam.com"))]
    got = {r.page_id: (r.verdict, r.distrust) for r in op.op13_link_graph_filter(spark, write(only)).collect()}
    assert got[2] == ("block", round(seed * op.DAMPING, 9)) and got[3] == ("block", round(seed * op.DAMPING ** 2, 9))


def test_scores_equal_power_iteration(spark):
    rng = random.Random(5)
    nodes = [f"n{i}" for i in range(30)]
    edges = {(a, b): rng.randint(1, 4) for _ in range(120) if (a := rng.choice(nodes)) != (b := rng.choice(nodes))}
    seeds = {n: rng.random() for n in rng.sample(nodes, 6)}
    urls = spark.createDataFrame([(a, b, "/", n) for (a, b), n in edges.items()], "source string, host string, path string, n long")
    seed = spark.createDataFrame([(k, h, s) for k in ("trust", "distrust") for h, s in seeds.items()], "kind string, host string, seed double")
    got = {(r.kind, r.host): r.score for r in op.propagated(seed, op.flows(urls), rounds=30).collect()}
    for kind in ("trust", "distrust"):
        way = edges if kind == "trust" else {(b, a): n for (a, b), n in edges.items()}
        out = {n: sum(w for (a, _), w in way.items() if a == n) for n in nodes}
        score = {n: 0.15 * seeds.get(n, 0) for n in nodes}
        for _ in range(30):
            score = {n: 0.15 * seeds.get(n, 0) + 0.85 * sum(score[a] * w / out[a] for (a, b), w in way.items() if b == n) for n in nodes}
        for n in nodes:
            assert got.get((kind, n), 0) == pytest.approx(score[n], abs=1e-12)


def test_rules_hosts_and_paths(spark, write):
    urls = ["http://Example.NET/en/x?q#f", "http://example.net/de/", "http://www.example.net/en", "http://example.com/de/a", "http://m.example.com/de",
            "http://org/fr/", "http://notorg/fr/", "http://a.org/fr/x", "http://a.org/FR/x", "http://net", "http://net?/", "http://net/", None, "ftp:/x"]
    rows = op.op13_link_graph_filter(spark, write([(i, u, None) for i, u in enumerate(urls)])).orderBy("page_id").collect()
    assert [r.rule for r in rows] == ["example.net/en/", "net/", "net/", "example.com/de/", None, "org/fr/", None, "org/fr/", None, None,
                                      None, "net/", None, None]
    assert (rows[0].host, rows[0].path) == ("example.net", "/en/x") and (rows[12].host, rows[12].path, rows[12].verdict) == ("", "", "allow")
    assert (rows[9].host, rows[9].path) == ("net", "")


def test_nothing_and_no_rules(spark, write):
    pages = spark.read.parquet(write(random_pages(30, 4)) + "/pages.parquet")
    rules = spark.createDataFrame([], "rule string, verdict string")
    assert op.judge(pages, rules).where("verdict <> 'allow' OR rule IS NOT NULL").count() == 0
    assert op.judge(pages.limit(0), rules).count() == 0
    tie = spark.createDataFrame([("a.com/", "allow"), ("a.com/", "block"), ("h1.a.com/en/", "allow"), ("", "block")], "rule string, verdict string")
    long = spark.createDataFrame([(1, "http://" + "a." * 50_000 + "com/", "<a href=//" + "b." * 50_000 + "com/>")], "page_id long, url string, html string")
    assert [r.verdict for r in op.judge(long.unionByName(long), tie).collect()] == ["block", "block"]


@needs_tables
def test_registered_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    assert compare(op.op13_link_graph_filter(spark, FOLDER), con, op.OP13_SQL) is None
