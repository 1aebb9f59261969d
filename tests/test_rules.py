import pytest

from takerlens.plans import classify, quality, screen

SCHEMA = ("series_ticker string, title string, category string, frequency string, "
          "settlement_sources array<struct<name:string,url:string>>, n_events bigint")


def tag(spark, category=None, frequency=None, urls=(), n_events=0):
    sources = None if urls is None else [("x", u) for u in urls]
    return classify.classify(spark.createDataFrame([("S", "t", category, frequency, sources, n_events)], SCHEMA)).first()


@pytest.mark.parametrize("category, urls, source_type, benchmark, difficulty", [
    ("Climate and Weather", ["https://forecast.weather.gov/a"], "scrapable_numeric_feed", "none", "low"),
    ("World", ["https://WWW.Weather.gov"], "scrapable_numeric_feed", "none", "low"),
    ("Climate and Weather", ["https://wpc.ncep.noaa.gov/x"], "scrapable_numeric_feed", "none", "medium"),
    ("Crypto", ["https://www.cfbenchmarks.com/x"], "scrapable_numeric_feed", "spot_crypto", "low"),
    ("World", ["https://coingecko.com"], "scrapable_numeric_feed", "spot_crypto", "low"),
    ("Sports", ["https://espn.com"], "unknown", "sportsbook", "unknown"),
    ("Sports", ["https://www.cmegroup.com"], "market_price", "cme_or_rates", "unknown"),
    ("Economics", ["https://www.bls.gov"], "official_report", "none", "medium"),
    ("Economics", ["https://www.nber.org"], "official_report", "cme_or_rates", "high"),
    ("Commodities", [], "unknown", "cme_or_rates", "unknown"),
    ("Elections", ["https://apnews.com"], "unknown", "other_liquid_market", "unknown"),
    ("Entertainment", ["https://www.oscars.org"], "committee_or_subjective", "none", "unknown"),
    ("Entertainment", ["https://www.billboard.com/charts"], "scrapable_numeric_feed", "none", "medium"),
    (None, [], "unknown", "unknown", "unknown"),
    (None, None, "unknown", "unknown", "unknown"),
    (None, ["weather.gov/no-scheme"], "unknown", "none", "unknown"),
    ("X", ["https://notweather.gov"], "unknown", "none", "unknown"),
    ("X", ["https://weather.gov.evil.com"], "unknown", "none", "unknown"),
    ("X", ["  //eia.gov/q?u=//bls.gov "], "scrapable_numeric_feed", "none", "medium"),
    ("X", ["https://zz.nber.org", "https://bls.gov"], "official_report", "none", "medium"),
])
def test_sources_and_benchmark(spark, category, urls, source_type, benchmark, difficulty):
    r = tag(spark, category, "daily", urls)
    assert (r.settlement_source_type, r.benchmark, r.scrape_difficulty) == (source_type, benchmark, difficulty)


@pytest.mark.parametrize("frequency, n_events, expected", [
    ("one_off", 50, "one_off"), ("Daily", 0, "recurring"), ("quarterly", 0, "recurring"), ("custom", 5, "unknown"),
    ("custom", 6, "recurring"), ("custom", None, "unknown"), (None, 9, "unknown"), ("fortnightly", 9, "unknown"),
])
def test_recurrence(spark, frequency, n_events, expected):
    assert tag(spark, "X", frequency, [], n_events).recurrence == expected


def test_notes_and_links(spark):
    r = tag(spark, "World", "custom", [" https://b.com/1 ", "", "https://a.com:8080", "https://www.c.com", "https://d.com"], 7)
    assert r.source_urls == ["https://b.com/1", "https://a.com:8080", "https://www.c.com", "https://d.com"]
    assert r.notes == "unknown/none via a.com:8080,b.com,c.com,d.com [recurrence from 7 events]"
    assert (r.model, r.reviewed, r.benchmark_name) == ("rules:v3", False, None)
    long = tag(spark, "World", "daily", [f"https://{'x' * 90}{i}.com" for i in range(3)])
    assert long.notes == "unknown/none via " + ",".join(f"{'x' * 90}{i}.com" for i in range(3))


def test_candidates_respect_people_and_versions(spark):
    series = spark.createDataFrame([(s, s, "X", f, [], 0) for s, f in
                                    [("A", "daily"), ("B", "daily"), ("C", None), ("D", "one_off"), ("E", "custom")]], SCHEMA).drop("n_events")
    events = spark.createDataFrame([("e1", "A"), ("e2", "A"), ("e3", None)], "event_ticker string, series_ticker string")
    tags = spark.createDataFrame([("A", "rules:v2", False), ("B", "rules:v3", False), ("E", "rules:v1", True)],
                                 "series_ticker string, model string, reviewed boolean")
    terminal = spark.createDataFrame([("A",), ("B",)], "series_ticker string")

    def names(*args, **kw):
        return [r.series_ticker for r in classify.candidates(series, events, tags, *args, **kw).collect()]

    assert names(None) == ["A", "C"] and names(terminal) == ["A"]
    assert names(None, recheck=True) == ["A", "B", "C"] and names(None, recheck=True, limit=2) == ["A", "B"]
    assert classify.candidates(series, events, tags, terminal).first().n_events == 2


def test_ground_truth_is_three_valued(spark):
    series = spark.createDataFrame([("HIGHX", "Climate and Weather"), ("HIGHY", "Climate and Weather"), ("HIGHZ", "Politics"),
                                    ("LOWQ", "Climate and Weather")], "series_ticker string, category string") \
        .selectExpr("*", "'t' AS title", "'daily' AS frequency")
    tags = spark.createDataFrame([("HIGHX", "scrapable_numeric_feed", "none", "recurring"), ("LOWQ", "unknown", None, "recurring")],
                                 "series_ticker string, settlement_source_type string, benchmark string, recurrence string")
    truth = screen.ground_truth(series, tags, ["HIGH", "LOW"])
    assert {r.series_ticker: r.passes for r in truth.collect()} == {"HIGHX": True, "HIGHY": None, "LOWQ": False}
    assert screen.ground_truth_report(truth).first().ok is False
    assert screen.ground_truth_report(truth, 2).first().ok is True


def test_known_answers_and_coverage(spark):
    tags = spark.createDataFrame([("A", "official_report", "none", "recurring", "low")],
                                 "series_ticker string, settlement_source_type string, benchmark string, recurrence string, scrape_difficulty string")
    expected = spark.createDataFrame([("A", "benchmark", "none"), ("A", "recurrence", "unknown"), ("Q", "benchmark", "none")],
                                     "series_ticker string, field string, expected string")
    got = {(r.series_ticker, r.field): r.ok for r in quality.known_answers(tags, expected).collect()}
    assert got == {("A", "benchmark"): True, ("A", "recurrence"): False, ("Q", "benchmark"): False}
    assert quality.coverage_floor(tags, 1).first().ok and not quality.coverage_floor(tags).first().ok
