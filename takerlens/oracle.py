"""The SQL each query must match, written on its own for DuckDB.

Shared CTEs project the tables; the formulas are deliberately not those of the
Spark plans (whole-tape ranking instead of hour sums, per-fill profit, built-in
quantiles, recursion instead of stretches).
"""

from __future__ import annotations

from takerlens.functions import rules

CTES = {
    "px_series": """
        SELECT 'S' || n_nationkey AS series_ticker, n_name AS title,
               CASE n_nationkey % 5 WHEN 0 THEN 'Climate and Weather' WHEN 1 THEN 'Economics'
                    WHEN 2 THEN 'Entertainment' WHEN 3 THEN 'Sports' ELSE 'Crypto' END AS category,
               CASE n_nationkey % 8 WHEN 0 THEN 'custom' WHEN 1 THEN 'one_off' WHEN 2 THEN 'annual'
                    WHEN 3 THEN 'monthly' WHEN 4 THEN 'weekly' WHEN 5 THEN 'daily' WHEN 6 THEN 'hourly'
                    ELSE 'fifteen_min' END AS frequency,
               CASE n_nationkey % 6 WHEN 0 THEN 'https://forecast.weather.gov/x' WHEN 1 THEN 'https://www.bls.gov/x'
                    WHEN 2 THEN 'https://www.cmegroup.com/x' WHEN 3 THEN 'https://www.oscars.org/x'
                    WHEN 4 THEN 'https://wpc.ncep.noaa.gov/x' ELSE 'https://www.wsj.com/x' END AS url,
               CASE WHEN n_nationkey % 10 = 9 THEN 'quadratic_with_maker_fees' ELSE 'quadratic' END AS fee_type,
               CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE 1 END AS fee_multiplier
        FROM nation""",
    "px_events": """
        SELECT c_custkey AS event_ticker,
               CASE WHEN c_custkey % 97 <> 0 THEN 'S' || c_nationkey END AS series_ticker,
               c_name AS title, c_mktsegment AS category, c_acctbal >= 0 AS mutually_exclusive
        FROM customer""",
    "px_volumes": """
        SELECT l_orderkey AS ticker, SUM(CAST(l_quantity AS DECIMAL(12,2))) AS volume FROM lineitem GROUP BY 1""",
    "px_markets": """
        SELECT o_orderkey AS ticker, o_custkey AS event_ticker,
               CASE o_orderkey % 10 WHEN 9 THEN 'closed' WHEN 8 THEN 'settled' ELSE 'finalized' END AS status,
               CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' ELSE '' END AS result,
               CASE WHEN o_orderkey % 40 <> 3 THEN o_orderdate END AS settlement_ts,
               CASE WHEN o_orderkey % 80 <> 3 THEN o_orderdate END AS close_time,
               o_orderkey % 50 = 0 AS combo, v.volume
        FROM orders LEFT JOIN px_volumes v ON v.ticker = o_orderkey""",
    "px_terminal": """
        SELECT m.*, e.series_ticker FROM px_markets m LEFT JOIN px_events e USING (event_ticker)
        WHERE m.status IN ('settled', 'finalized') AND NOT m.combo""",
    "px_trades": """
        SELECT l_orderkey AS ticker, l_linenumber AS trade_no, l_partkey AS part_no, l_suppkey AS supp_no,
               CAST(1 + round(l_discount * 100) * 8 + round(l_tax * 100) AS INTEGER) AS yes_cents,
               CAST(l_quantity AS DECIMAL(12,2)) AS n,
               CASE l_linestatus WHEN 'O' THEN 'yes' ELSE 'no' END AS side,
               l_returnflag = 'A' AND l_quantity >= 45 AS block, l_shipdate AS created,
               CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN 'live' ELSE 'archive' END AS origin
        FROM lineitem""",
    "px_snapshots": """
        SELECT ev.user_id AS ticker, date_trunc('minute', ev.ts) AS run_ts, ev.event_id AS arrival,
               ev.user_id AS event_ticker, e.series_ticker,
               CASE ev.event_type WHEN 'error' THEN 'closed' WHEN 'signup' THEN 'settled' ELSE 'active' END AS status,
               ev.event_id % 60 AS bid_cents, ev.event_id % 60 + ev.event_id % 7 + 1 AS ask_cents,
               CAST(greatest(ev.value - 20, 0) AS DECIMAL(18,2)) AS volume_24h, ev.event_type AS price_level_structure
        FROM events ev LEFT JOIN px_events e ON e.event_ticker = ev.user_id""",
    # fill: profit in cents if the market settled as it did, fee in cents at multiplier 1.
    "fills": """
        SELECT t.*, m.result, m.series_ticker,
               CASE WHEN m.result IN ('yes', 'no') THEN
                 (CASE WHEN side = m.result THEN 100 ELSE 0 END
                  - CASE side WHEN 'yes' THEN yes_cents ELSE 100 - yes_cents END) * n END AS pnl,
               yes_cents * (100 - yes_cents) * n AS fee_base
        FROM px_terminal m JOIN px_trades t USING (ticker)""",
    # pages: newest first, two trades a page, three pages.
    "paged": """
        SELECT *, (row_number() OVER (PARTITION BY ticker ORDER BY created DESC, trade_no DESC, part_no DESC,
                   supp_no DESC, yes_cents DESC, side DESC, n DESC) - 1) // 2 AS page
        FROM fills WHERE NOT block""",
    "mult": "SELECT series_ticker, fee_multiplier FROM px_series",
    "capped": """
        SELECT m.ticker, m.series_ticker, m.result, coalesce(k.trades, 0) AS trades,
               coalesce(k.contracts, 0) AS contracts,
               CASE WHEN m.result IN ('yes', 'no') THEN coalesce(k.pnl, 0) END AS pnl,
               CASE WHEN m.result IN ('yes', 'no')
                    THEN coalesce(k.fee_base, 0) * 7 * coalesce(x.fee_multiplier, 1) END AS fee_e4,
               coalesce(b.blocks, 0) AS blocks, coalesce(k.pages, 0) AS pages, coalesce(k.pages, 0) >= 3 AS truncated
        FROM px_terminal m
        LEFT JOIN (SELECT ticker, count(*) AS trades, sum(n) AS contracts, sum(pnl) AS pnl, sum(fee_base) AS fee_base,
                          max(page) + 1 AS pages FROM paged WHERE page < 3 GROUP BY 1) k USING (ticker)
        LEFT JOIN (SELECT ticker, count(*) AS blocks FROM fills WHERE block GROUP BY 1) b USING (ticker)
        LEFT JOIN mult x ON x.series_ticker = m.series_ticker""",
    "whole": """
        SELECT m.ticker, m.series_ticker, m.result, count(f.ticker) FILTER (NOT f.block) AS trades,
               coalesce(sum(f.n) FILTER (NOT f.block), 0) AS contracts,
               coalesce(sum(f.n) FILTER (NOT f.block AND side = 'yes'), 0) AS yes_n,
               coalesce(sum(f.n) FILTER (NOT f.block AND side = 'no'), 0) AS no_n,
               sum(f.n * yes_cents) FILTER (NOT f.block AND side = 'yes') AS yes_notional,
               sum(f.n * (100 - yes_cents)) FILTER (NOT f.block AND side = 'no') AS no_notional,
               CASE WHEN m.result IN ('yes', 'no') THEN coalesce(sum(f.pnl) FILTER (NOT f.block), 0) END AS pnl,
               CASE WHEN m.result IN ('yes', 'no') THEN coalesce(sum(f.fee_base) FILTER (NOT f.block), 0) * 7
                    * coalesce(any_value(x.fee_multiplier), 1) END AS fee_e4,
               count(f.ticker) FILTER (f.block) AS blocks
        FROM px_terminal m LEFT JOIN fills f USING (ticker)
        LEFT JOIN mult x ON x.series_ticker = m.series_ticker GROUP BY 1, 2, 3""",
    "bleed": """
        SELECT series_ticker, count(*) AS n_settled, CAST(0 AS BIGINT) AS n_truncated,
               CAST(sum(contracts) AS DOUBLE) AS contracts,
               CAST(sum(pnl) AS DOUBLE)
                 / nullif(CAST(sum(contracts) AS DOUBLE), 0) AS gross,
               CAST(sum(pnl * 10000 - coalesce(fee_e4, 0)) AS DOUBLE) / 10000
                 / nullif(CAST(sum(contracts) AS DOUBLE), 0) AS feeadj
        FROM whole WHERE result IN ('yes', 'no') GROUP BY 1""",
    "latest": """
        SELECT * FROM px_snapshots
        WHERE run_ts > (SELECT max(run_ts) FROM px_snapshots) - INTERVAL 24 HOUR
          AND status NOT IN ('closed', 'settled', 'finalized')
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY run_ts DESC, arrival DESC) = 1""",
    "act": """
        SELECT s.series_ticker, count(DISTINCT l.ticker) AS open_markets,
               count(DISTINCT l.ticker) FILTER (l.volume_24h > 0) AS live_markets,
               round(CAST(count(DISTINCT l.ticker) FILTER (l.volume_24h > 0) AS DOUBLE)
                     / count(DISTINCT l.ticker), 3) AS breadth,
               quantile_cont(CAST(l.volume_24h AS DOUBLE), 0.5) AS med_volume,
               CAST(sum(l.volume_24h) AS DOUBLE) AS sum_volume,
               CAST(max(l.volume_24h) AS DOUBLE) / nullif(CAST(sum(l.volume_24h) AS DOUBLE), 0) AS top_share,
               quantile_cont(CAST(l.ask_cents - l.bid_cents AS DOUBLE), 0.5) FILTER (l.volume_24h > 0) AS med_spread,
               max(l.run_ts) AS as_of
        FROM px_series s JOIN latest l USING (series_ticker) GROUP BY 1""",
    "n_ev": """
        SELECT s.series_ticker, (SELECT count(*) FROM px_events e WHERE e.series_ticker = s.series_ticker) AS n_events
        FROM px_series s""",
    "tags": """
        SELECT s.series_ticker, s.title, s.category, s.frequency, s.fee_type, s.fee_multiplier, n.n_events, s.url,
               CASE n_key % 6 WHEN 0 THEN 'scrapable_numeric_feed' WHEN 1 THEN 'official_report'
                    WHEN 2 THEN 'market_price' WHEN 3 THEN 'committee_or_subjective'
                    WHEN 4 THEN 'scrapable_numeric_feed' ELSE 'unknown' END AS settlement_source_type,
               CASE WHEN n_key % 6 IN (0, 4) THEN 'none' WHEN n_key % 6 = 2 THEN 'cme_or_rates'
                    WHEN category = 'Sports' THEN 'sportsbook' WHEN category = 'Crypto' THEN 'spot_crypto'
                    ELSE 'none' END AS benchmark,
               CASE WHEN n_key % 6 IN (0, 4) THEN NULL WHEN n_key % 6 = 2 THEN 'exchange / oracle price feed'
                    WHEN category = 'Sports' THEN 'retail sportsbooks' WHEN category = 'Crypto' THEN 'spot exchanges'
                    END AS benchmark_name,
               CASE WHEN frequency = 'one_off' THEN 'one_off' WHEN frequency <> 'custom' THEN 'recurring'
                    WHEN n.n_events >= 6 THEN 'recurring' ELSE 'unknown' END AS recurrence,
               CASE n_key % 6 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 4 THEN 'medium' ELSE 'unknown' END AS scrape_difficulty,
               replace(regexp_extract(s.url, '//([^/]*)', 1), 'www.', '') AS host
        FROM (SELECT *, CAST(substr(series_ticker, 2) AS INTEGER) AS n_key FROM px_series) s JOIN n_ev n USING (series_ticker)""",
    "old_stats": "SELECT DISTINCT ticker FROM px_trades WHERE created < TIMESTAMP '1996-01-01'",
    "scope": """
        SELECT series_ticker FROM px_series WHERE frequency IN ('fifteen_min', 'hourly', 'daily', 'weekly', 'monthly',
                                                                'quarterly', 'annual')""",
    "arch": """
        SELECT m.ticker, coalesce(e.series_ticker, 'S' || c.c_nationkey) AS series_ticker, m.settlement_ts
        FROM px_markets m JOIN customer c ON c.c_custkey = m.event_ticker
        LEFT JOIN px_events e ON e.event_ticker = m.event_ticker
        WHERE m.status IN ('settled', 'finalized') AND NOT m.combo
          AND coalesce(m.close_time, TIMESTAMP '1995-01-01') < TIMESTAMP '1999-07-01'
          AND (coalesce(m.settlement_ts, m.close_time) >= TIMESTAMP '1996-01-01'
               OR coalesce(m.settlement_ts, m.close_time) IS NULL)
          AND 'S' || c.c_nationkey IN (SELECT series_ticker FROM scope)""",
    "states": """
        SELECT ticker, date_trunc('hour', run_ts) AS run_ts, max_by(series_ticker, arrival) AS series_ticker,
               max_by(status, arrival) AS status
        FROM px_snapshots GROUP BY 1, 2""",
    "days": """
        SELECT ticker, date_trunc('day', run_ts) AS run_ts, NULL AS series_ticker, max_by(status, arrival) AS status
        FROM px_snapshots GROUP BY 1, 2""",
    "actions": """
        SELECT c.c_custkey AS event_ticker,
               CASE WHEN c.c_acctbal < -500 THEN 'insert'
                    WHEN c.c_mktsegment = 'BUILDING' AND lower(c.c_name) <> c.c_name THEN 'update'
                    WHEN c.c_nationkey = 3 OR c.c_nationkey + 12 > 24 THEN 'update' ELSE 'unchanged' END AS action
        FROM customer c""",
}

_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {1}"


def _ts(column: str, name: str | None = None) -> str:
    return _TS.format(column, name or column.split(".")[-1])


def _six(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


def _with(names: str, body: str, recursive: str = "") -> str:
    """Prefix the CTEs a statement needs, in definition order, with what they need."""
    wanted = set(names.split())
    while True:
        more = {n for n in CTES for w in wanted if n != w and n in _words(CTES[w])} - wanted
        if not more:
            break
        wanted |= more
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in wanted]
    if recursive:
        return "WITH RECURSIVE " + ", ".join(parts + [recursive]) + " " + body
    return "WITH " + ", ".join(parts) + " " + body


def _words(sql: str) -> set[str]:
    return set(sql.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())


SCREENABLE = ("recurrence = 'recurring' AND benchmark = 'none' "
              "AND settlement_source_type IN ('scrapable_numeric_feed', 'official_report')")
FEES = "fee_type <> 'quadratic_with_maker_fees'"
BAND = "coalesce(a.sum_volume, 0) BETWEEN 50 AND 1000"
EARLIER = "SELECT ticker, status, result, close_time FROM px_markets WHERE coalesce(close_time < TIMESTAMP '1999-07-01', true)"
LATER = "SELECT ticker, result, volume FROM px_markets WHERE close_time >= TIMESTAMP '1998-01-01'"
REPLAY = """
    walk AS (
        SELECT s.ticker, s.run_ts, s.status, s.series_ticker FROM states s
        WHERE s.run_ts = (SELECT min(run_ts) FROM states x WHERE x.ticker = s.ticker)
        UNION ALL
        SELECT ticker, run_ts, status, series_ticker FROM (
            SELECT n.ticker, n.run_ts, n.status, n.series_ticker,
                   row_number() OVER (PARTITION BY n.ticker ORDER BY n.run_ts) AS k
            FROM walk w JOIN states n ON n.ticker = w.ticker AND n.run_ts > w.run_ts
            WHERE n.run_ts >= w.run_ts + INTERVAL 12 HOUR OR n.status IS DISTINCT FROM w.status
               OR n.series_ticker IS DISTINCT FROM w.series_ticker) WHERE k = 1)"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["taker_bleed"] = _with("bleed", f"""
        SELECT series_ticker, n_settled, n_truncated, {_six('contracts', 'contracts')},
               {_six('gross', 'gross_bleed_cents_per_ct')}, {_six('feeadj', 'feeadj_bleed_cents_per_ct')} FROM bleed""")
    sql["taker_stats"] = _with("whole", f"""
        SELECT ticker, series_ticker, trades, {_six('contracts', 'contracts')}, {_six('yes_n', 'taker_yes_contracts')},
               {_six('no_n', 'taker_no_contracts')}, {_six('pnl', 'taker_gross_pnl_cents')},
               {_six('CAST(fee_e4 AS DOUBLE) / 10000', 'taker_fee_est_cents')}, blocks AS block_trades_skipped,
               CAST(ceil(trades / 1000) AS BIGINT) AS pages_read, false AS truncated FROM whole""")
    sql["taker_vwap"] = _with("whole", f"""
        SELECT ticker, {_six('CAST(yes_notional AS DOUBLE) / nullif(CAST(yes_n AS DOUBLE), 0)', 'taker_yes_vwap_cents')},
               {_six('CAST(no_notional AS DOUBLE) / nullif(CAST(no_n AS DOUBLE), 0)', 'taker_no_vwap_cents')} FROM whole""")
    sql["tape_page_cap"] = _with("capped", f"""
        SELECT ticker, trades, {_six('contracts', 'contracts')}, {_six('pnl', 'taker_gross_pnl_cents')},
               {_six('CAST(fee_e4 AS DOUBLE) / 10000', 'taker_fee_est_cents')}, blocks AS block_trades_skipped,
               CAST(pages AS BIGINT) AS pages_read, truncated FROM capped""")
    sql["tape_fallback"] = _with("fills", f"""
        , live AS (SELECT DISTINCT ticker FROM fills WHERE origin = 'live' AND NOT block),
        chosen AS (SELECT f.* FROM fills f LEFT JOIN live l USING (ticker)
                   WHERE (origin = 'live' AND l.ticker IS NOT NULL) OR (origin = 'archive' AND l.ticker IS NULL)),
        kept AS (SELECT ticker, count(*) FILTER (NOT block) AS trades, sum(n) FILTER (NOT block) AS contracts,
                        sum(pnl) FILTER (NOT block) AS pnl, count(*) FILTER (block) AS blocks FROM chosen GROUP BY 1)
        SELECT m.ticker, coalesce(trades, 0) AS trades, {_six('coalesce(contracts, 0)', 'contracts')},
               {_six("CASE WHEN m.result IN ('yes', 'no') THEN coalesce(pnl, 0) END", 'taker_gross_pnl_cents')},
               coalesce(blocks, 0) AS block_trades_skipped, CAST(ceil(coalesce(trades, 0) / 1000) AS BIGINT) AS pages_read,
               false AS truncated
        FROM px_terminal m LEFT JOIN kept USING (ticker)""")
    sql["bleed_exclusions"] = _with("whole", """
        SELECT series_ticker, count(*) FILTER (result NOT IN ('yes', 'no')) AS n_non_binary_result,
               CAST(0 AS BIGINT) AS n_truncated, count(*) FILTER (result IS NULL) AS n_null_result
        FROM whole GROUP BY 1""")
    sql["latest_snapshot"] = _with("latest", f"""
        SELECT ticker, {_ts('run_ts')}, arrival, event_ticker, status, {_six('bid_cents / 100', 'yes_bid')},
               {_six('ask_cents / 100', 'yes_ask')}, {_six('volume_24h', 'volume_24h')}, price_level_structure,
               series_ticker FROM latest""")
    sql["series_activity"] = _with("act", f"""
        SELECT series_ticker, open_markets, live_markets, breadth, {_six('med_volume', 'med_mkt_vol24h')},
               {_six('sum_volume', 'sum_vol24h_latest')}, {_six('top_share', 'top_market_share')},
               {_six('med_spread / 100', 'med_spread_dollars')}, {_six('med_spread', 'med_spread_cents')}, {_ts('as_of')}
        FROM act""")
    tag_cols = "series_ticker, settlement_source_type, benchmark, benchmark_name, recurrence, scrape_difficulty"
    sql["classify_series"] = _with("tags", f"""
        SELECT {tag_cols}, url AS source_urls,
               settlement_source_type || '/' || benchmark || ' via ' || host
               || CASE WHEN frequency = 'custom' AND recurrence = 'recurring'
                       THEN ' [recurrence from ' || n_events || ' events]' ELSE '' END AS notes,
               '{rules.RULES_VERSION}' AS model, false AS reviewed FROM tags""")
    sql["classify_candidates"] = _with("n_ev px_terminal", """
        SELECT s.series_ticker, s.title, s.category, s.frequency, n_events
        FROM px_series s JOIN n_ev USING (series_ticker) JOIN nation ON 'S' || n_nationkey = s.series_ticker
        WHERE s.frequency <> 'one_off' AND n_regionkey IN (0, 1)
          AND EXISTS (SELECT 1 FROM px_terminal t WHERE t.series_ticker = s.series_ticker)""")
    sql["classify_recheck"] = _with("n_ev", """
        SELECT s.series_ticker, n_events
        FROM px_series s JOIN n_ev USING (series_ticker) JOIN nation ON 'S' || n_nationkey = s.series_ticker
        WHERE s.frequency <> 'one_off' AND n_regionkey <> 2""")
    sql["tag_tally"] = _with("tags", """
        SELECT settlement_source_type, benchmark, recurrence, count(*) AS n FROM tags GROUP BY 1, 2, 3
        ORDER BY n DESC, 1, 2, 3""")
    sql["events_per_series"] = _with("n_ev", "SELECT series_ticker, n_events FROM n_ev")
    sql["page_host_match"] = """
        WITH h AS (SELECT page_id, replace(lower(split_part(split_part(split_part(split_part(url, '//', 2), '/', 1),
                          '?', 1), '#', 1)), 'www.', '') AS host FROM pages)
        SELECT page_id, host, host = 'example.org' OR host LIKE '%.example.org' AS is_org,
               host IN ('example.com', 'example.net') OR host LIKE '%.example.com' OR host LIKE '%.example.net' AS is_com_or_net
        FROM h"""
    sql["screen"] = _with("tags act bleed", f"""
        SELECT t.series_ticker, title, category, frequency, settlement_source_type, benchmark, recurrence,
               scrape_difficulty, open_markets, live_markets, breadth, {_six('top_share', 'top_market_share')},
               {_six('sum_volume', 'sum_vol24h_latest')}, {_six('med_spread', 'med_spread_cents')}, n_settled,
               {_six('contracts', 'contracts')}, {_six('gross', 'gross_bleed_cents_per_ct')},
               {_six('feeadj', 'feeadj_bleed_cents_per_ct')}, fee_type, {_six('fee_multiplier', 'fee_multiplier')}
        FROM tags t LEFT JOIN act a USING (series_ticker) LEFT JOIN bleed b USING (series_ticker)
        WHERE {SCREENABLE} AND {FEES} AND {BAND} AND coalesce(a.breadth, 0) >= 0.34 AND coalesce(b.n_settled, 0) >= 20
        ORDER BY feeadj ASC NULLS LAST""")
    sql["screen_candidates"] = _with("tags act", f"""
        SELECT t.series_ticker FROM tags t LEFT JOIN act a USING (series_ticker)
        WHERE {SCREENABLE} AND {FEES} AND {BAND} AND coalesce(a.breadth, 0) >= 0.34""")
    sql["screen_funnel"] = _with("tags act bleed", f"""
        SELECT (SELECT count(*) FROM px_series) AS series_total, (SELECT count(*) FROM tags) AS classified,
               (SELECT count(*) FROM tags WHERE recurrence = 'recurring') AS recurring,
               (SELECT count(*) FROM tags WHERE recurrence = 'recurring' AND benchmark = 'none') AS no_benchmark,
               (SELECT count(*) FROM tags WHERE {SCREENABLE}) AS scrapable,
               (SELECT count(*) FROM tags WHERE {SCREENABLE} AND {FEES}) AS no_maker_fees,
               (SELECT count(*) FROM act a WHERE {BAND}) AS in_volume_band,
               (SELECT count(*) FROM act a WHERE {BAND} AND breadth >= 0.34) AS ladder_alive,
               (SELECT count(*) FROM bleed WHERE n_settled >= 20) AS enough_settled,
               (SELECT count(*) FROM tags LEFT JOIN act a USING (series_ticker) LEFT JOIN bleed b USING (series_ticker)
                 WHERE {SCREENABLE} AND {FEES} AND {BAND} AND coalesce(a.breadth, 0) >= 0.34
                   AND coalesce(b.n_settled, 0) >= 20) AS passes_all""")
    sql["ground_truth"] = _with("tags", """
        SELECT s.series_ticker, s.title, s.frequency, t.settlement_source_type, t.benchmark, t.recurrence,
               CAST(t.settlement_source_type = 'scrapable_numeric_feed' AND t.benchmark = 'none'
                    AND t.recurrence = 'recurring' AS VARCHAR) AS passes
        FROM px_series s LEFT JOIN (SELECT tags.* FROM tags JOIN nation ON 'S' || n_nationkey = series_ticker
                                    WHERE n_regionkey <> 3) t USING (series_ticker)
        WHERE (s.series_ticker LIKE 'S1%' OR s.series_ticker LIKE 'S2%' OR s.series_ticker LIKE 'S5%')
          AND s.category = 'Climate and Weather'""")
    sql["ground_truth_report"] = _with("tags", """
        SELECT count(*) AS n, count(*) FILTER (ok) AS n_passing, count(*) FILTER (NOT ok) <= 1 AS ok
        FROM (SELECT settlement_source_type = 'scrapable_numeric_feed' AND benchmark = 'none'
                     AND recurrence = 'recurring' AS ok FROM tags
              WHERE left(series_ticker, 2) IN ('S1', 'S2', 'S5') AND category = 'Climate and Weather')""")
    sql["coverage_floor"] = _with("tags", """
        SELECT count(*) AS usable, count(*) >= 10 AS ok FROM tags
        WHERE settlement_source_type IN ('scrapable_numeric_feed', 'official_report')""")
    stamp = "TIMESTAMP '2024-01-01' + CAST(ticker % 720 AS INTEGER) * INTERVAL 1 HOUR"
    sql["ingest_health"] = _with("px_snapshots px_terminal px_trades", f"""
        , clock AS (SELECT max(run_ts) + INTERVAL 90 MINUTE AS now FROM px_snapshots),
        win AS (SELECT DISTINCT ticker FROM px_snapshots, clock WHERE run_ts > now - INTERVAL 24 HOUR
                AND status NOT IN ('closed', 'settled', 'finalized')),
        term AS (SELECT series_ticker, {stamp} AS ingested_at FROM px_terminal),
        st AS (SELECT {stamp} AS computed_at FROM (SELECT DISTINCT ticker FROM px_trades))
        SELECT strftime((SELECT max(run_ts) FROM px_snapshots), '%Y-%m-%d %H:%M:%S') AS last_snapshot_run,
               round(CAST(epoch(now) - epoch((SELECT max(run_ts) FROM px_snapshots)) AS DOUBLE) / 3600, 1) AS snapshot_age_hours,
               (SELECT count(*) FROM win) AS markets_in_latest_window,
               strftime((SELECT max(ingested_at) FROM term), '%Y-%m-%d %H:%M:%S') AS last_terminal_ingest,
               (SELECT count(*) FROM term, clock c WHERE ingested_at > c.now - INTERVAL 24 HOUR) AS terminal_last_24h,
               (SELECT count(*) FROM st, clock c WHERE computed_at > c.now - INTERVAL 24 HOUR) AS tapes_last_24h,
               (SELECT count(*) FROM term WHERE series_ticker IS NULL) AS unlinked_terminal
        FROM clock""")
    sql["volume_share"] = _with("px_terminal", """
        SELECT count(*) AS settled, count(*) FILTER (coalesce(volume, 0) = 0) AS zero_volume,
               count(*) FILTER (volume >= 1) AS volume_1_up, count(*) FILTER (volume >= 100) AS volume_100_up,
               count(DISTINCT event_ticker) AS events FROM px_terminal""")
    sql["link_markets"] = _with("px_markets px_events", """
        SELECT m.ticker, m.event_ticker, e.series_ticker FROM px_markets m LEFT JOIN px_events e USING (event_ticker)""")
    sql["link_report"] = _with("px_markets px_events", """
        SELECT count(*) AS markets, count(*) FILTER (e.series_ticker IS NULL) AS unmapped
        FROM px_markets m LEFT JOIN px_events e USING (event_ticker)""")
    sql["repair_links"] = _with("px_markets px_events", """
        SELECT m.ticker, e.series_ticker, e.series_ticker IS NOT NULL AND NOT e.mutually_exclusive AS repaired
        FROM px_markets m LEFT JOIN px_events e USING (event_ticker)""")
    sql["missing_events"] = _with("px_markets px_events", """
        SELECT DISTINCT event_ticker FROM px_markets
        WHERE event_ticker NOT IN (SELECT event_ticker FROM px_events WHERE mutually_exclusive)
        ORDER BY event_ticker""")
    sql["upsert_merge"] = _with("px_markets", f"""
        SELECT coalesce(a.ticker, b.ticker) AS ticker, a.status,
               CASE WHEN b.ticker IS NULL THEN a.result ELSE b.result END AS result,
               {_six('CASE WHEN b.ticker IS NULL THEN 0 ELSE b.volume END', 'volume')},
               {_ts("CASE WHEN a.ticker IS NULL THEN TIMESTAMP '2002-01-01' ELSE a.close_time END", 'first_seen')}
        FROM ({EARLIER}) a FULL JOIN ({LATER}) b ON a.ticker = b.ticker""")
    sql["upsert_some_columns"] = _with("px_markets", f"""
        SELECT coalesce(a.ticker, b.ticker) AS ticker, a.status,
               CASE WHEN a.ticker IS NULL THEN b.result ELSE a.result END AS result,
               {_six('CASE WHEN b.ticker IS NULL THEN 0 ELSE b.volume END', 'volume')}, {_ts('a.close_time', 'first_seen')}
        FROM ({EARLIER}) a FULL JOIN ({LATER}) b ON a.ticker = b.ticker""")
    sql["insert_only"] = _with("px_markets", f"""
        SELECT ticker, status, result, CAST(0 AS DOUBLE) AS volume, {_ts('close_time', 'first_seen')} FROM ({EARLIER})
        UNION ALL
        SELECT ticker, NULL, result, {_six('volume', 'volume')}, NULL FROM ({LATER})
        WHERE ticker NOT IN (SELECT ticker FROM ({EARLIER}))""")
    sql["upsert_changed"] = _with("actions", "SELECT event_ticker, action FROM actions")
    sql["upsert_changed_stats"] = _with("actions", """
        SELECT count(*) AS seen, count(*) FILTER (action = 'insert') AS inserted,
               count(*) FILTER (action = 'update') AS updated, count(*) FILTER (action = 'unchanged') AS unchanged
        FROM actions""")
    sql["dedupe_last_wins"] = _with("px_trades", f"""
        SELECT ticker, CAST(trade_no AS BIGINT) AS trade_no, {_ts('created', 'created_time')}, part_no, supp_no,
               {_six('n', 'count_fp')}
        FROM px_trades QUALIFY row_number() OVER (PARTITION BY ticker, trade_no
             ORDER BY created DESC, part_no DESC, supp_no DESC, n DESC) = 1""")
    sql["snapshot_skip_unchanged"] = _with("states", f"SELECT ticker, {_ts('run_ts')}, status FROM walk", REPLAY)
    daily = REPLAY.replace("OR n.series_ticker IS DISTINCT FROM w.series_ticker", "").replace("12 HOUR", "60 HOUR")
    sql["stream_snapshots"] = _with("days", f"SELECT ticker, {_ts('run_ts')}, status FROM walk",
                                    daily.replace("states", "days"))
    sql["snapshot_append"] = _with("states", f"""
        , run AS (SELECT ticker, (SELECT max(run_ts) FROM states) + INTERVAL 1 HOUR AS run_ts,
                         max_by(status, (run_ts, arrival)) AS status
                  FROM (SELECT ticker, date_trunc('hour', run_ts) AS run_ts, arrival, status FROM px_snapshots)
                  WHERE status = 'active' GROUP BY 1),
        last AS (SELECT ticker, max(run_ts) AS run_ts, max_by(status, run_ts) AS status FROM states GROUP BY 1)
        SELECT r.ticker, {_ts('r.run_ts')}, r.status FROM run r LEFT JOIN last l USING (ticker)
        WHERE NOT coalesce(l.run_ts > r.run_ts - INTERVAL 12 HOUR AND l.status = r.status, false)""")
    sql["snapshot_prior_state"] = _with("states", f"""
        SELECT s.ticker, {_ts('s.run_ts', 'run_ts')}, s.status, {_ts('p.run_ts', 'prior_run_ts')}, p.status AS prior_status
        FROM states s ASOF LEFT JOIN states q ON q.ticker = s.ticker AND q.run_ts < s.run_ts
        LEFT JOIN states p ON p.ticker = q.ticker AND p.run_ts = q.run_ts AND q.run_ts > s.run_ts - INTERVAL 12 HOUR""")
    sql["asof_stored_state"] = _with("px_snapshots", f"""
        , st AS (SELECT ticker, date_trunc('hour', run_ts) AS run_ts, arrival, status FROM px_snapshots),
        stored AS (SELECT ticker, run_ts, max(arrival) AS arrival, max_by(status, arrival) AS status FROM st WHERE arrival % 2 = 0 GROUP BY 1, 2),
        found AS (SELECT l.*, (SELECT max(r.run_ts) FROM stored r WHERE r.ticker = l.ticker AND r.run_ts < l.run_ts
                               AND r.run_ts > l.run_ts - INTERVAL 12 HOUR) AS at_run FROM st l WHERE arrival % 2 = 1)
        SELECT f.ticker, {_ts('f.run_ts', 'run_ts')}, f.arrival, f.status, {_ts('s.run_ts', 'prior_run_ts')}, s.arrival AS prior_arrival,
               s.status AS prior_status
        FROM found f LEFT JOIN stored s ON s.ticker = f.ticker AND s.run_ts = f.at_run""")
    sql["retention_delete"] = _with("px_snapshots", f"""
        , st AS (SELECT ticker, date_trunc('day', run_ts) AS run_ts, max(arrival) AS arrival, max_by(status, arrival) AS status
                 FROM px_snapshots GROUP BY 1, 2)
        SELECT ticker, {_ts('run_ts')}, arrival, status FROM st
        WHERE run_ts >= (SELECT max(run_ts) FROM st) - INTERVAL 10 DAY""")
    sql["retention_prune"] = _with("px_snapshots", """
        SELECT count(*) AS before, count(*) FILTER (run_ts < m - INTERVAL 10 DAY) AS removed,
               count(*) FILTER (run_ts >= m - INTERVAL 10 DAY) AS kept
        FROM px_snapshots, (SELECT max(run_ts) AS m FROM px_snapshots)""")
    sql["pending_worklist"] = _with("px_terminal old_stats scope", f"""
        SELECT t.ticker, t.result, t.series_ticker, {_six('t.volume', 'volume')}
        FROM px_terminal t LEFT JOIN px_series s USING (series_ticker)
        WHERE t.settlement_ts >= TIMESTAMP '1995-06-01' AND coalesce(t.volume, 0) >= 20
          AND t.series_ticker IN (SELECT series_ticker FROM scope)
          AND t.ticker NOT IN (SELECT ticker FROM old_stats) AND lower(s.category) <> 'sports'""")
    sql["resume_todo"] = _with("px_terminal old_stats", """
        SELECT ticker, series_ticker FROM px_terminal WHERE ticker NOT IN (SELECT ticker FROM old_stats)""")
    sql["recurring_scope"] = _with("scope", "SELECT series_ticker FROM scope")
    sql["archive_window"] = _with("arch", f"SELECT ticker, series_ticker, {_ts('settlement_ts')} FROM arch")
    sql["ingest_two_source"] = _with("arch px_terminal", f"""
        , rec AS (SELECT * FROM px_terminal WHERE settlement_ts >= TIMESTAMP '1998-01-01')
        SELECT ticker, series_ticker, {_six('volume', 'volume')}, CAST(2 AS BIGINT) AS source_rank FROM rec
        UNION ALL
        SELECT ticker, series_ticker, CAST(0 AS DOUBLE), CAST(1 AS BIGINT) FROM arch
        WHERE ticker NOT IN (SELECT ticker FROM rec)""")
    sql["sweep_chunk_report"] = _with("px_terminal", f"""
        , ends AS (SELECT min(settlement_ts) AS first, max(settlement_ts) AS last FROM px_terminal),
        starts AS (SELECT unnest(generate_series(first, last, INTERVAL 12 HOUR)) AS lo, first, last FROM ends),
        w AS (SELECT row_number() OVER (ORDER BY lo) AS chunk, lo, least(lo + INTERVAL 12 HOUR, last) AS hi,
                     lo + INTERVAL 12 HOUR >= last AS final FROM starts WHERE lo < last OR first = last)
        SELECT chunk, {_ts('w.lo', 'lo')}, {_ts('w.hi', 'hi')}, count(t.ticker) AS settled,
               count(*) FILTER (t.ticker IS NOT NULL AND coalesce(volume, 0) >= 1) AS ingest_eligible,
               count(*) FILTER (t.ticker IS NOT NULL AND coalesce(volume, 0) >= 100) AS tape_eligible
        FROM w LEFT JOIN px_terminal t ON settlement_ts >= w.lo AND (settlement_ts < w.hi OR (final AND settlement_ts <= w.hi))
        GROUP BY chunk, w.lo, w.hi""")
    sql["sweep_resumed"] = _with("whole px_terminal", f"""
        SELECT CAST(w.ticker AS VARCHAR) AS ticker, w.series_ticker, {_ts('m.settlement_ts', 'settlement_ts')}, trades, {_six('contracts', 'contracts')},
               {_six('pnl', 'taker_gross_pnl_cents')}, {_six('CAST(fee_e4 AS DOUBLE) / 10000', 'taker_fee_est_cents')}
        FROM whole w JOIN px_terminal m ON m.ticker = w.ticker WHERE m.settlement_ts IS NOT NULL""")
    sql["sweep_commits"] = _with("px_terminal", f"""
        , first AS (SELECT min(settlement_ts) AS t FROM px_terminal),
        one AS (SELECT t + k * INTERVAL 1460 DAY AS lo, t + (k + 1) * INTERVAL 1460 DAY AS hi FROM first, range(1) AS r(k)),
        two AS (SELECT max(hi) + k * INTERVAL 1460 DAY AS lo, least(max(hi) + (k + 1) * INTERVAL 1460 DAY, TIMESTAMP '2002-06-01') AS hi
                FROM one, range(10) AS r(k) GROUP BY k),
        w AS (SELECT * FROM one UNION ALL SELECT * FROM two WHERE lo < TIMESTAMP '2002-06-01')
        SELECT {_ts('lo')}, {_ts('hi')}, count(*) AS markets, count(*) AS aggregated
        FROM w JOIN px_terminal ON settlement_ts >= lo AND settlement_ts < hi GROUP BY lo, hi""")
    sql["sweep_late_markets"] = _with("px_terminal", f"""
        SELECT count(*) AS markets, count(*) AS tickers, count(*) FILTER (ticker % 5 <> 0) AS first, count(*) FILTER (ticker % 5 = 0) AS second,
               {_six('sum(volume)', 'volume')} FROM px_terminal WHERE settlement_ts IS NOT NULL""")
    sql["settled_days"] = _with("px_terminal", f"""
        , m AS (SELECT *, coalesce(datediff('day', DATE '1970-01-01', CAST(settlement_ts AS DATE)) // 30, -1000000) AS month FROM px_terminal)
        SELECT ticker, series_ticker, {_ts('settlement_ts')} FROM m
        WHERE month IN (SELECT month FROM m GROUP BY 1 HAVING sum(volume) % 2 >= 1)""")
    sql["keyed_sink"] = sql["upsert_merge"]
    page_domains = """
        WITH h AS (SELECT page_id, replace(lower(regexp_extract(url, '//([^/?#]*)', 1)), 'www.', '') AS host FROM pages),
        single AS (SELECT host AS domain, min(page_id) AS first FROM h GROUP BY 1),
        dims AS (SELECT DISTINCT CASE WHEN host LIKE '%example.org' THEN 'numeric' WHEN host LIKE '%example.net' THEN 'official' ELSE 'market' END AS label,
                        regexp_extract(host, '[^.]*[.][^.]*$') AS domain FROM h
                 UNION ALL SELECT 'no_benchmark', domain FROM single WHERE first % 3 = 0
                 UNION ALL SELECT CASE WHEN first % 5 = 0 THEN 'low' ELSE 'high' END, domain FROM single WHERE first % 5 < 2),
        found AS (SELECT host, label FROM (SELECT DISTINCT host FROM h) JOIN dims ON host = domain OR ends_with(host, '.' || domain))"""
    sql["page_domain_labels"] = page_domains + """
        SELECT host, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY 1"""
    hit = "coalesce(bool_or(f.label = '{0}'), false)"
    more = _with("n_ev", "")[len("WITH "):]
    sql["classify_many_links"] = page_domains + f""", {more.strip()},
        level AS (SELECT host, min(CASE label WHEN 'low' THEN 1 WHEN 'high' THEN 2 END) AS level FROM found GROUP BY 1),
        links AS (SELECT DISTINCT 'S' || page_id % 30 AS series_ticker, host FROM h),
        hits AS (SELECT l.series_ticker, count(DISTINCT l.host) AS n_hosts, {hit.format('numeric')} AS num, {hit.format('official')} AS off,
                        {hit.format('market')} AS mar, {hit.format('no_benchmark')} AS nob,
                        min_by(v.level, l.host) FILTER (v.level IS NOT NULL) AS level
                 FROM links l LEFT JOIN found f USING (host) LEFT JOIN level v USING (host) GROUP BY 1)
        SELECT s.series_ticker, coalesce(n_hosts, 0) AS n_hosts,
               CASE WHEN num THEN 'scrapable_numeric_feed' WHEN off THEN 'official_report' WHEN mar THEN 'market_price' ELSE 'unknown' END AS settlement_source_type,
               CASE WHEN nob THEN 'none' WHEN mar THEN 'cme_or_rates' WHEN category = 'Sports' THEN 'sportsbook'
                    WHEN category = 'Crypto' THEN 'spot_crypto' ELSE 'none' END AS benchmark,
               CASE WHEN nob THEN NULL WHEN mar THEN 'exchange / oracle price feed' WHEN category = 'Sports' THEN 'retail sportsbooks'
                    WHEN category = 'Crypto' THEN 'spot exchanges' END AS benchmark_name,
               CASE WHEN frequency = 'one_off' THEN 'one_off' WHEN frequency <> 'custom' OR n_events >= 6 THEN 'recurring' ELSE 'unknown' END AS recurrence,
               CASE level WHEN 1 THEN 'low' WHEN 2 THEN 'high' ELSE 'unknown' END AS scrape_difficulty
        FROM px_series s JOIN n_ev USING (series_ticker) LEFT JOIN hits USING (series_ticker)"""
    checks = [
        ("series_key", "px_series", "series_ticker IS NULL OR series_ticker = ''"),
        ("series_frequency", "px_series", "frequency IS NULL OR frequency = ''"),
        ("event_key", "px_events", "event_ticker IS NULL"), ("event_series", "px_events", "series_ticker IS NULL"),
        ("snapshot_price_range", "px_snapshots", "ask_cents NOT BETWEEN 0 AND 100"),
        ("snapshot_volume", "px_snapshots", "volume_24h IS NULL"),
        ("settled_status", "px_markets", "status NOT IN ('settled', 'finalized')"),
        ("settled_time", "px_markets", "settlement_ts IS NULL"), ("settled_combo", "px_markets", "combo"),
        ("trade_side", "px_trades", "side NOT IN ('yes', 'no')"), ("trade_count", "px_trades", "n IS NULL"),
        ("trade_block", "px_trades", "block"),
    ]
    sql["dq_expectations"] = _with("px_series px_events px_snapshots px_markets px_trades", " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", count(*) AS n, count(*) FILTER ({bad}) AS violations, "
        f"count(*) FILTER ({bad}) = 0 AS ok FROM {table}" for c, table, bad in checks))
    sql["pnl_reconciliation"] = _with("whole", f"""
        SELECT w.ticker, {_six('pnl', 'stats_pnl_cents')}, CASE WHEN trades > 0 THEN round(CAST(pnl AS DOUBLE), 6) END AS check_pnl_cents,
               {_six('contracts', 'stats_contracts')}, CASE WHEN trades > 0 THEN round(CAST(contracts AS DOUBLE), 6) END AS check_contracts,
               {_six('CAST(fee_e4 AS DOUBLE) / 10000', 'stats_fee_cents')},
               CASE WHEN trades > 0 THEN round(CAST(fee_e4 AS DOUBLE) / 10000, 6) END AS check_fee_cents,
               {_six('v.volume', 'reported_volume')}, true AS matches
        FROM whole w LEFT JOIN px_volumes v ON v.ticker = w.ticker WHERE result IN ('yes', 'no')""")
    sql["reconciliation_summary"] = _with("px_terminal", """
        SELECT count(*) AS markets, CAST(0 AS BIGINT) AS mismatches FROM px_terminal WHERE result IN ('yes', 'no')""")
    sql["reconciliation_finds_errors"] = _with("px_terminal", """
        SELECT count(*) AS markets, count(*) FILTER (ticker % 97 = 1) AS mismatches
        FROM px_terminal WHERE result IN ('yes', 'no')""")
    sql["trades_overlap"] = _with("px_trades", f"""
        SELECT ticker, count(*) FILTER (NOT block) AS trades, {_six('coalesce(sum(n) FILTER (NOT block), 0)', 'contracts')},
               count(*) FILTER (block) AS block_trades
        FROM px_trades GROUP BY 1""")
    sql["late_link_fees"] = _with("whole", f"""
        SELECT ticker, {_six('CAST(fee_e4 AS DOUBLE) / 10000', 'taker_fee_est_cents')} FROM whole""")
    sql["trade_explain"] = _with("fills", f"""
        SELECT ticker, side AS taker_side, result, {_six('n', 'contracts')},
               {_six("(CASE side WHEN 'yes' THEN yes_cents ELSE 100 - yes_cents END) / 100", 'price_dollars')},
               {_six("CASE WHEN side = result THEN 100 ELSE 0 END - CASE side WHEN 'yes' THEN yes_cents ELSE 100 - yes_cents END", 'cents_per_contract')},
               {_six('pnl', 'pnl_cents')}
        FROM fills WHERE NOT block AND result IN ('yes', 'no')""")
    sql["handcheck_markets"] = _with("px_terminal", f"""
        SELECT ticker, result, {_six('volume', 'volume')} FROM px_terminal
        WHERE result IN ('yes', 'no') AND volume > 20 AND volume < 4000 ORDER BY ticker""")
    sql["rule_known_answers"] = _with("tags", """
        SELECT series_ticker, 'recurrence' AS field,
               CASE WHEN CAST(substr(series_ticker, 2) AS INTEGER) % 8 = 1 THEN 'one_off' ELSE 'recurring' END AS expected,
               recurrence AS got,
               recurrence = CASE WHEN CAST(substr(series_ticker, 2) AS INTEGER) % 8 = 1 THEN 'one_off' ELSE 'recurring' END AS ok
        FROM tags UNION ALL SELECT 'R' || r_regionkey, 'benchmark', 'none', NULL, false FROM region""")
    sql["source_coverage"] = _with("tags", "SELECT settlement_source_type, count(*) AS n FROM tags GROUP BY 1")
    sql["stream_taker_stats"] = _with("whole", f"""
        SELECT ticker, trades, {_six('contracts', 'contracts')}, {_six('pnl', 'taker_gross_pnl_cents')},
               {_six('CAST(fee_e4 AS DOUBLE) / 10000', 'taker_fee_est_cents')}, blocks AS block_trades_skipped FROM whole""")
    tapes = f"""count(*) FILTER (NOT block) AS trades, {_six('coalesce(sum(n) FILTER (NOT block), 0)', 'contracts')},
               {_six("coalesce(sum(n * yes_cents) FILTER (NOT block AND side = 'yes'), 0) / 100", 'yes_notional')},
               {_six("coalesce(sum(n * (100 - yes_cents)) FILTER (NOT block AND side = 'no'), 0) / 100", 'no_notional')},
               count(*) FILTER (block) AS block_trades"""
    sql["stream_running_tapes"] = _with("px_trades", f"SELECT ticker, {tapes} FROM px_trades GROUP BY 1")
    sql["outcome_side"] = _with("px_trades", f"""
        SELECT ticker, count(*) FILTER (NOT block) AS trades, {_six("coalesce(sum(n) FILTER (NOT block AND side = 'yes'), 0)", 'yes_contracts')},
               {_six("coalesce(sum(n) FILTER (NOT block AND side = 'no'), 0)", 'no_contracts')}, CAST(0 AS BIGINT) AS bad_side FROM px_trades GROUP BY 1""")
    sql["stream_chunk_counts"] = _with("px_terminal", """
        SELECT datediff('day', DATE '1992-01-01', CAST(settlement_ts AS DATE)) // 30 + 1 AS chunk, count(*) AS settled,
               count(*) FILTER (coalesce(volume, 0) >= 1) AS ingest_eligible, count(*) FILTER (coalesce(volume, 0) >= 100) AS tape_eligible
        FROM px_terminal WHERE settlement_ts IS NOT NULL GROUP BY 1""")
    sql["json_nested_markets"] = _with("px_markets", """
        SELECT 'M' || ticker AS ticker, CAST(event_ticker AS VARCHAR) AS event_ticker, status, result, CAST(0 AS DOUBLE) AS "start",
               CAST(1 AS DOUBLE) AS "end", round((ticker % 9 + 1) / 100, 6) AS step FROM px_markets""")
    sql["json_lenient_trades"] = _with("px_trades", """
        SELECT reason, count(*) AS n FROM (SELECT CASE WHEN supp_no % 11 = 0 THEN 'count_fp' WHEN part_no % 13 = 0 THEN 'yes_price_dollars'
                                                       ELSE 'read' END AS reason FROM px_trades) GROUP BY 1""")
    sql["stream_settled_ingest"] = _with("px_terminal", """
        SELECT ticker, event_ticker, series_ticker, status, result FROM px_terminal""")
    sql["json_ingest_series"] = _with("px_series", f"""
        SELECT series_ticker, title, category, frequency, fee_type, {_six('fee_multiplier', 'fee_multiplier')}, url AS urls
        FROM px_series""")
    sql["json_ingest_events"] = _with("px_events", """
        SELECT CAST(event_ticker AS VARCHAR) AS event_ticker, series_ticker, title, category, mutually_exclusive,
               '{"category":"' || category || '","event_ticker":' || event_ticker || ',"mutually_exclusive":'
               || mutually_exclusive || CASE WHEN series_ticker IS NULL THEN '' ELSE ',"series_ticker":"' || series_ticker || '"' END
               || ',"title":"' || title || '"}' AS raw
        FROM px_events""")
    sql["json_ingest_markets"] = _with("px_terminal", f"""
        SELECT CAST(ticker AS VARCHAR) AS ticker, CAST(event_ticker AS VARCHAR) AS event_ticker, status, result,
               {_ts('settlement_ts')}, {_six('volume', 'volume')} FROM px_terminal""")
    sql["json_ingest_snapshots"] = _with("px_snapshots", f"""
        SELECT 'M' || arrival AS ticker, CAST(event_ticker AS VARCHAR) AS event_ticker, status,
               {_six('bid_cents / 100', 'yes_bid')}, {_six('ask_cents / 100', 'yes_ask')}, CAST(NULL AS DOUBLE) AS no_bid,
               {_six('volume_24h', 'volume_24h')}, price_level_structure FROM px_snapshots""")
    sql["json_ingest_trades"] = _with("px_trades", f"""
        SELECT CAST(ticker AS VARCHAR) AS ticker, count(*) FILTER (NOT block) AS trades,
               {_six('coalesce(sum(n) FILTER (NOT block), 0)', 'contracts')},
               {_six("coalesce(sum(n * yes_cents) FILTER (NOT block AND side = 'yes'), 0) / 100", 'yes_notional')},
               {_six("coalesce(sum(n * (100 - yes_cents)) FILTER (NOT block AND side = 'no'), 0) / 100", 'no_notional')},
               count(*) FILTER (block) AS block_trades
        FROM px_trades GROUP BY 1""")
    return sql
