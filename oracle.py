"""Equivalent SQL (DuckDB dialect) of the registered queries, on the test tables.

Written independently of the Spark plans: plain window frames, plain joins,
``count(distinct)`` and BETWEEN joins, composed from common table expressions.
"""

from __future__ import annotations

SLICE = "DATE '1997-01-01' AND DATE '1998-06-30'"

# Relations in dependency order; a query takes those it needs.
RELATIONS = {
    "prices": """
        SELECT s_name AS symbol,
               CAST(l_shipdate AS DATE) AS trade_date,
               min(100 + l_extendedprice / 20011) AS open,
               max(100 + l_extendedprice / 20011) AS high,
               min(100 + l_extendedprice / 20011) AS low,
               100 + CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
                     / count(*) / 2001100 AS close,
               100 + CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
                     / count(*) / 2001100 AS adj_close,
               CAST(sum(l_quantity) AS BIGINT) AS volume,
               s_suppkey % 8 = 5 AS is_etf
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY s_name, s_suppkey, CAST(l_shipdate AS DATE)""",
    "returns": """
        SELECT *, CASE WHEN prev_close > 0 THEN (close - prev_close) / prev_close END
                  AS daily_return
        FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS prev_close
              FROM prices)""",
    "metrics": """
        SELECT *,
               avg(close) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS moving_avg_30,
               avg(close) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS moving_avg_60,
               stddev_samp(daily_return)
                   OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS volatility_30,
               max(high) OVER (w ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS week52_high,
               min(low) OVER (w ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS week52_low
        FROM returns
        WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)""",
    "raw_meta": """
        SELECT CASE WHEN s_suppkey % 10 = 9 THEN '  ' ELSE ' ' || s_name || ' ' END AS symbol,
               s_name || ' ' || n_name || suffix AS security_name,
               substr(r_name, 1, 1) AS listing_exchange,
               CASE r_name WHEN 'AFRICA' THEN 'Q ' WHEN 'AMERICA' THEN 'G ' WHEN 'ASIA' THEN 'S '
                           WHEN 'EUROPE' THEN 'N ' WHEN 'MIDDLE EAST' THEN 'A ' END AS category,
               s_suppkey % 8 = 5 AS is_etf,
               s_suppkey % 3 <> 0 AS nasdaq_traded,
               s_acctbal > 9000 AS is_test_issue,
               CASE WHEN s_acctbal < 0 THEN 'D' ELSE 'N' END AS financial_status,
               s_name AS other_symbol
        FROM supplier
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        JOIN (VALUES ('', 1), (' Z', 7)) AS copies(suffix, every) ON s_suppkey % every = 0""",
    "staged_meta": """
        SELECT trim(symbol) AS symbol,
               trim(security_name) AS security_name,
               listing_exchange,
               trim(category) AS market_category_code,
               financial_status,
               other_symbol AS cqs_symbol,
               other_symbol AS nasdaq_symbol,
               is_etf, nasdaq_traded, is_test_issue,
               false AS is_nextshares,
               CAST(100 AS DOUBLE) AS round_lot_size,
               CASE trim(category)
                   WHEN 'Q' THEN 'NASDAQ Global Select Market'
                   WHEN 'G' THEN 'NASDAQ Global Market'
                   WHEN 'S' THEN 'NASDAQ Capital Market'
                   WHEN 'N' THEN 'NYSE'
                   WHEN 'A' THEN 'NYSE American'
                   ELSE 'Other' END AS market_category
        FROM raw_meta WHERE trim(symbol) <> ''""",
    "dim": """
        SELECT symbol, security_name, listing_exchange, market_category_code, market_category,
               financial_status, is_etf, nasdaq_traded, is_test_issue, round_lot_size
        FROM staged_meta
        QUALIFY row_number() OVER (
            PARTITION BY symbol
            ORDER BY security_name NULLS FIRST, market_category_code NULLS FIRST,
                     listing_exchange NULLS FIRST) = 1""",
    "price_meta": """
        SELECT symbol, security_name, listing_exchange, market_category_code,
               CASE WHEN is_etf THEN 'Y' ELSE 'N' END AS etf_flag,
               CASE market_category_code WHEN 'A' THEN 'Other' ELSE market_category END
                   AS market_category
        FROM dim""",
    "enriched": """
        SELECT symbol, trade_date, open, high, low, close, adj_close, volume, is_etf,
               daily_return, moving_avg_30, moving_avg_60, volatility_30,
               week52_high, week52_low,
               security_name, listing_exchange, market_category_code, etf_flag, market_category
        FROM metrics LEFT JOIN price_meta USING (symbol)""",
    "fact": """
        SELECT trade_date, symbol, open, high, low, close, adj_close, volume,
               daily_return, moving_avg_30, moving_avg_60, volatility_30,
               week52_high, week52_low, market_category, market_category_code, is_etf
        FROM enriched
        WHERE close > 0 AND trade_date IS NOT NULL AND symbol <> ''""",
    "sector": """
        SELECT CAST(date_trunc('month', trade_date) AS DATE) AS trade_month,
               market_category,
               round(avg(daily_return), 6) AS avg_daily_return,
               round(avg(volatility_30), 6) AS avg_volatility,
               round(avg(close), 4) AS avg_close,
               CAST(sum(volume) AS BIGINT) AS total_volume,
               count(DISTINCT symbol) AS ticker_count
        FROM fact
        WHERE market_category <> '' AND daily_return IS NOT NULL
        GROUP BY ALL""",
    "ticker_month": """
        SELECT CAST(date_trunc('month', trade_date) AS DATE) AS trade_month,
               symbol, avg(daily_return) AS mean_return
        FROM fact WHERE daily_return IS NOT NULL GROUP BY ALL""",
    "gainer": """
        SELECT * FROM ticker_month
        QUALIFY row_number() OVER (
            PARTITION BY trade_month ORDER BY round(mean_return, 12) DESC, symbol) = 1""",
    "loser": """
        SELECT * FROM ticker_month
        QUALIFY row_number() OVER (
            PARTITION BY trade_month ORDER BY round(mean_return, 12), symbol) = 1""",
    "market": """
        SELECT m.*, g.symbol AS top_gainer_symbol, l.symbol AS top_loser_symbol
        FROM (SELECT CAST(date_trunc('month', trade_date) AS DATE) AS trade_month,
                     round(avg(close), 4) AS avg_close,
                     CAST(sum(volume) AS BIGINT) AS total_volume,
                     round(avg(daily_return), 6) AS avg_daily_return,
                     round(avg(volatility_30), 6) AS avg_volatility,
                     count(DISTINCT symbol) AS active_ticker_count
              FROM fact GROUP BY ALL) AS m
        LEFT JOIN gainer AS g USING (trade_month)
        LEFT JOIN loser AS l USING (trade_month)""",
    "yearly": """
        SELECT year(trade_date) AS trade_year,
               market_category,
               round(avg(daily_return), 6) AS avg_daily_return,
               round(avg(volatility_30), 6) AS avg_volatility,
               CAST(sum(volume) AS BIGINT) AS total_volume,
               count(DISTINCT symbol) AS ticker_count,
               round(pow(1 + avg(daily_return), 252) - 1, 4) AS approx_annual_return
        FROM fact
        WHERE market_category <> '' AND daily_return IS NOT NULL
        GROUP BY ALL""",
    "dirty": """
        SELECT p.symbol, trade_date, open, CASE WHEN kind <> 9 THEN high END AS high, low, close,
               adj_close, CASE WHEN kind <> 10 THEN volume END AS volume, is_etf
        FROM (SELECT *, (date_diff('day', DATE '1990-01-01', trade_date) * 31
                         + CAST(right(symbol, 9) AS INTEGER)) % 40 AS kind FROM prices) AS p
        JOIN (VALUES (1), (2)) AS copies(n) ON n = 1 OR kind = 11
        WHERE kind > 8""",
    "leaping": """
        SELECT * EXCLUDE (close, number),
               CASE WHEN CAST(right(symbol, 9) AS INTEGER) % 4 = 2 AND number % 2 = 0
                    THEN close * 100 ELSE close END AS close
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS number
              FROM prices)
        WHERE CAST(right(symbol, 9) AS INTEGER) % 3 <> 0 OR number <= 100""",
    "leap_returns": """
        SELECT symbol, trade_date, volume, (close - before) / before AS daily_return
        FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS before
              FROM leaping)
        WHERE before > 0""",
    "leap_ranking": """
        SELECT * EXCLUDE (growth),
               CASE WHEN isfinite(growth) THEN round(growth - 1, 4) END AS approx_total_return
        FROM (SELECT *, CASE WHEN trading_days * ln(1 + avg_daily_return) < 709
                             THEN pow(1 + avg_daily_return, trading_days) END AS growth
              FROM (SELECT f.symbol, d.security_name, d.market_category,
                           count(DISTINCT f.trade_date) AS trading_days,
                           round(avg(f.daily_return), 6) AS avg_daily_return,
                           CAST(sum(f.volume) AS BIGINT) AS total_volume,
                           min(f.trade_date) AS first_trade_date,
                           max(f.trade_date) AS last_trade_date
                    FROM leap_returns AS f JOIN dim AS d ON f.symbol = d.symbol
                    WHERE NOT d.is_etf
                    GROUP BY f.symbol, d.security_name, d.market_category)
              WHERE trading_days >= 252)""",
    "ranking": """
        SELECT symbol, security_name, market_category, trading_days, avg_daily_return,
               avg_volatility, total_volume, first_trade_date, last_trade_date,
               CASE WHEN isfinite(growth) THEN round(growth - 1, 4) END AS approx_total_return
        FROM (SELECT *, pow(1 + avg_daily_return, trading_days) AS growth
              FROM (SELECT f.symbol, d.security_name, d.market_category,
                           count(DISTINCT f.trade_date) AS trading_days,
                           round(avg(f.daily_return), 6) AS avg_daily_return,
                           round(avg(f.volatility_30), 6) AS avg_volatility,
                           CAST(sum(f.volume) AS BIGINT) AS total_volume,
                           min(f.trade_date) AS first_trade_date,
                           max(f.trade_date) AS last_trade_date
                    FROM fact AS f JOIN dim AS d ON f.symbol = d.symbol
                    WHERE f.daily_return IS NOT NULL AND NOT d.is_etf
                    GROUP BY f.symbol, d.security_name, d.market_category)
              WHERE trading_days >= 252)""",
}

# --- fixed values: named periods --------------------------------------------------------
TEST_EVENTS = """(VALUES
    ('E50', DATE '1950-01-01', DATE '1950-12-31'),
    ('E95', DATE '1995-06-01', DATE '1995-08-31'),
    ('E97', DATE '1997-01-01', DATE '1997-12-31'),
    ('E97b', DATE '1997-07-01', DATE '1998-03-31'),
    ('E00', DATE '2000-03-01', DATE '2002-10-31'))"""

MARKET_EVENTS = """(VALUES
    ('Black Monday (1987)', DATE '1987-09-01', DATE '1987-12-31'),
    ('Dot-com Crash (2000–2002)', DATE '2000-03-01', DATE '2002-10-31'),
    ('Financial Crisis (2007–09)', DATE '2007-10-01', DATE '2009-03-31'),
    ('COVID Crash (2020)', DATE '2020-01-20', DATE '2020-04-01'))"""

_KIND = "(date_diff('day', DATE '1990-01-01', trade_date) * 31 + CAST(right(symbol, 9) AS INTEGER)) % 40"

RELATIONS["violating"] = f"""
        SELECT symbol, trade_date, kind, CASE WHEN kind NOT IN (0, 1) THEN close END AS close,
               CASE WHEN kind NOT IN (1, 2) THEN volume END AS volume,
               CASE WHEN kind = 3 THEN 'Pink ' || symbol ELSE market_category END AS market_category
        FROM (SELECT *, {_KIND} AS kind FROM fact)
        JOIN (VALUES (1), (2)) AS copies(n) ON n = 1 OR kind = 4"""


def _violations() -> str:
    def part(table: str, column: str, rule: str, severity: str, value: str, source: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS check_name, '{severity}' AS severity,"
            f" key, CAST({value} AS VARCHAR) AS value FROM {source}"
        )

    day = "'symbol=' || symbol || ',trade_date=' || trade_date"
    fact = "fact_daily_prices"
    rows = f"(SELECT *, {day} AS key FROM violating) WHERE"
    parts = [
        part(fact, "close", "not_null", "error", "NULL", f"{rows} close IS NULL"),
        part(fact, "volume", "not_null", "error", "NULL", f"{rows} volume IS NULL"),
        part(fact, "market_category", "accepted_values", "warn", "market_category", f"{rows} kind = 3"),
        part(fact, "symbol, trade_date", "unique", "warn", "n", f"(SELECT {day} AS key, count(*) AS n FROM violating"
             " GROUP BY symbol, trade_date HAVING count(*) > 1)"),
        part(fact, "symbol", "relationships", "warn", "symbol", f"{rows} symbol NOT IN (SELECT symbol FROM dim)"),
        part("stg_symbols_meta", "symbol", "unique", "error", "n",
             "(SELECT 'symbol=' || symbol AS key, count(*) AS n FROM staged_meta GROUP BY symbol HAVING count(*) > 1)"),
    ]
    return " UNION ALL ".join(parts)


def _events(values: str) -> str:
    return f"""
        SELECT e.event_name, e.a AS period_start, e.b AS period_end,
               round(avg(f.daily_return), 6) AS avg_daily_return,
               round(avg(f.volatility_30), 6) AS avg_volatility,
               CAST(sum(f.volume) AS BIGINT) AS total_volume,
               count(DISTINCT f.symbol) AS affected_tickers,
               date_diff('day', e.a, e.b) AS event_duration_days
        FROM {values} AS e(event_name, a, b)
        JOIN fact AS f ON f.trade_date BETWEEN e.a AND e.b
        WHERE f.daily_return IS NOT NULL
        GROUP BY e.event_name, e.a, e.b"""


RELATIONS["events_mart"] = _events(TEST_EVENTS)


def _sql(body: str) -> str:
    """The query with all relations above in front; unused ones cost nothing."""
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in RELATIONS.items())
    return f"WITH {ctes}\n{body}"


_ROUNDED_METRICS = """
    daily_return, round(moving_avg_30, 6) AS moving_avg_30,
    round(moving_avg_60, 6) AS moving_avg_60, round(volatility_30, 9) AS volatility_30,
    week52_high, week52_low"""

_ENRICHED = f"""
    symbol, trade_date, open, high, low, close, adj_close, volume, {_ROUNDED_METRICS},
    security_name, listing_exchange, market_category, market_category_code, etf_flag, is_etf"""

_FACT = f"""
    trade_date, symbol, open, high, low, close, adj_close, volume, {_ROUNDED_METRICS},
    market_category, market_category_code, is_etf"""


def _leaders(order: str) -> str:
    return f"""
        SELECT symbol, coalesce(security_name, symbol) AS label, market_category,
               avg_daily_return
        FROM ranking ORDER BY avg_daily_return {order}, symbol LIMIT 20"""


def _check(table: str, column: str, rule: str, severity: str, failures: str, name: str) -> str:
    verdict = "fail" if severity == "error" else "warn"
    return f"""
        SELECT '{name}' AS table_name, '{column}' AS column_name, '{rule}' AS check_name,
               '{severity}' AS severity, n AS failures,
               CASE WHEN n > 0 THEN '{verdict}' ELSE 'pass' END AS status
        FROM (SELECT CAST(({failures}) AS BIGINT) AS n)"""


def _quality() -> str:
    relations = {
        "stg_daily_prices": "fact",
        "stg_symbols_meta": "staged_meta",
        "dim_companies": "dim",
        "fact_daily_prices": "fact",
        "agg_sector_performance": "sector",
        "agg_monthly_summary": "market",
        "agg_yearly_performance": "yearly",
        "agg_market_crash_analysis": "events_mart",
        "agg_top_tickers_alltime": "ranking",
    }
    required = {
        "stg_daily_prices": ("symbol", "trade_date", "close"),
        "stg_symbols_meta": ("symbol", "market_category"),
        "dim_companies": ("symbol", "security_name", "market_category"),
        "fact_daily_prices": ("symbol", "trade_date", "close", "volume"),
        "agg_sector_performance": ("trade_month", "market_category", "ticker_count"),
        "agg_monthly_summary": ("trade_month", "avg_close", "total_volume"),
        "agg_yearly_performance": ("trade_year", "market_category", "avg_daily_return"),
        "agg_market_crash_analysis": ("event_name", "avg_volatility"),
        "agg_top_tickers_alltime": ("symbol", "avg_daily_return", "trading_days"),
    }
    distinct = {
        "stg_symbols_meta": "symbol",
        "dim_companies": "symbol",
        "agg_monthly_summary": "trade_month",
        "agg_market_crash_analysis": "event_name",
        "agg_top_tickers_alltime": "symbol",
    }
    parts = [
        _check(
            relations[table], column, "not_null", "error",
            f"SELECT count(*) FROM {relations[table]} WHERE {column} IS NULL", table,
        )
        for table, columns in required.items()
        for column in columns
    ]
    parts += [
        _check(
            relations[table], column, "unique", "error",
            f"SELECT count(*) FROM (SELECT {column} FROM {relations[table]}"
            f" WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)",
            table,
        )
        for table, column in distinct.items()
    ]
    parts.append(
        _check(
            "fact", "symbol, trade_date", "unique", "warn",
            "SELECT count(*) FROM (SELECT symbol FROM fact"
            " GROUP BY symbol, trade_date HAVING count(*) > 1)",
            "fact_daily_prices",
        )
    )
    parts.append(
        _check(
            "fact", "market_category", "accepted_values", "warn",
            "SELECT count(*) FROM fact WHERE market_category NOT IN ("
            "''NASDAQ Global Select Market'', ''NASDAQ Global Market'',"
            " ''NASDAQ Capital Market'', ''NYSE'', ''NYSE American'', ''Other'')".replace(
                "''", "'"
            ),
            "stg_daily_prices",
        )
    )
    parts.append(
        _check(
            "fact", "symbol", "relationships", "warn",
            "SELECT count(*) FROM fact WHERE symbol NOT IN (SELECT symbol FROM dim)",
            "fact_daily_prices",
        )
    )
    return " UNION ALL ".join(parts)


ORACLE = {
    "daily_return": _sql("SELECT symbol, trade_date, close, daily_return FROM metrics"),
    "moving_averages": _sql(
        "SELECT symbol, trade_date, round(moving_avg_30, 6) AS moving_avg_30,"
        " round(moving_avg_60, 6) AS moving_avg_60 FROM metrics"
    ),
    "volatility_30": _sql(
        "SELECT symbol, trade_date, round(volatility_30, 9) AS volatility_30 FROM metrics"
    ),
    "week52_range": _sql("SELECT symbol, trade_date, week52_high, week52_low FROM metrics"),
    "indicators_long_series": _sql(f"SELECT symbol, trade_date, {_ROUNDED_METRICS} FROM metrics"),
    "meta_staged": _sql("SELECT * FROM staged_meta"),
    "meta_staged_no_test_issues": _sql("SELECT * FROM staged_meta WHERE NOT is_test_issue"),
    "price_metadata": _sql("SELECT * FROM price_meta"),
    "dim_companies": _sql("SELECT * FROM dim"),
    "prices_enriched": _sql(f"SELECT {_ENRICHED} FROM enriched"),
    "stg_daily_prices": _sql(
        f"SELECT {_ENRICHED} FROM enriched"
        " WHERE close > 0 AND trade_date IS NOT NULL AND symbol <> ''"
    ),
    "fact_daily_prices": _sql(f"SELECT {_FACT} FROM fact"),
    "agg_sector_performance": _sql("SELECT * FROM sector"),
    "agg_monthly_summary": _sql("SELECT * FROM market"),
    "agg_yearly_performance": _sql("SELECT * FROM yearly"),
    "agg_market_events": _sql("SELECT * FROM events_mart"),
    "agg_market_crash_analysis": _sql(_events(MARKET_EVENTS)),
    "agg_top_tickers": _sql("SELECT * FROM ranking"),
    "events_from_days": _sql("SELECT * FROM events_mart"),
    "many_ranges": _sql(
        _events(
            "(SELECT 'from ' || d, d, d + CAST(n * 7 % 400 AS INTEGER)"
            " FROM (SELECT trade_date AS d, row_number() OVER (ORDER BY trade_date) - 1 AS n"
            " FROM (SELECT DISTINCT trade_date FROM fact WHERE daily_return IS NOT NULL)) WHERE n % 3 = 0)"
        )
    ),
    "years_from_bitmaps": _sql("SELECT * FROM yearly"),
    "top20": _sql(_leaders("DESC")),
    "bottom20": _sql(_leaders("ASC")),
    "dash_volume": _sql("SELECT trade_month, total_volume FROM market ORDER BY trade_month"),
    "dash_return_by_segment": _sql(
        "SELECT market_category, round(avg(avg_daily_return), 9) AS avg_daily_return"
        f" FROM sector WHERE trade_month BETWEEN {SLICE} GROUP BY market_category"
    ),
    "dash_risk_by_segment": _sql(
        "SELECT market_category, round(avg(avg_volatility), 9) AS avg_volatility"
        " FROM sector GROUP BY market_category"
    ),
    "dash_gainers": _sql(
        "SELECT trade_month, top_gainer_symbol, top_loser_symbol FROM market"
    ),
    "dash_gainer_returns": _sql(
        "SELECT trade_month, g.symbol AS top_gainer_symbol,"
        " round(g.mean_return, 6) AS top_gainer_return, l.symbol AS top_loser_symbol,"
        " round(l.mean_return, 6) AS top_loser_return"
        " FROM gainer AS g JOIN loser AS l USING (trade_month)"
    ),
    "dash_segment_years": _sql("SELECT * FROM yearly WHERE trade_year BETWEEN 1996 AND 1999"),
    "dash_events": _sql("SELECT * FROM events_mart"),
    "star_query": _sql(
        "SELECT f.trade_date, f.symbol, d.security_name, d.market_category, f.close,"
        " f.daily_return FROM fact AS f JOIN dim AS d ON f.symbol = d.symbol"
        f" WHERE f.trade_date BETWEEN {SLICE} AND d.market_category = 'NYSE'"
    ),
    "star_reduced": _sql(
        "SELECT f.trade_date, f.symbol, d.security_name, d.market_category, f.close,"
        " f.daily_return FROM fact AS f JOIN dim AS d ON f.symbol = d.symbol"
        f" WHERE f.trade_date BETWEEN {SLICE} AND d.market_category = 'NYSE'"
    ),
    "named_tables": _sql(
        "SELECT d.symbol, d.security_name, count(*) AS days, CAST(sum(f.volume) AS BIGINT) AS volume,"
        " (SELECT count(*) FROM fact) AS all_days FROM fact AS f JOIN dim AS d ON f.symbol = d.symbol"
        " GROUP BY d.symbol, d.security_name"
    ),
    "row_count": _sql("SELECT count(*) AS row_count FROM fact"),
    "run_report": _sql(
        "SELECT count(*) AS total_rows, count(DISTINCT symbol) AS distinct_symbols,"
        " min(trade_date) AS first_date, max(trade_date) AS last_date FROM enriched"
    ),
    "sample_rows": _sql(
        "SELECT trade_date, symbol, close, daily_return,"
        " round(moving_avg_30, 6) AS moving_avg_30, round(volatility_30, 9) AS volatility_30,"
        " week52_high, security_name, market_category"
        " FROM enriched ORDER BY symbol, trade_date LIMIT 5"
    ),
    "dq_report": _sql(_quality()),
    "dq_violations": _sql(_violations()),
    "staged_filter": _sql(f"SELECT {_ENRICHED} FROM enriched WHERE {_KIND} > 6"),
    "mart_orders": _sql(
        "SELECT mart, CAST(row_number() OVER (PARTITION BY mart ORDER BY a, r, b) AS INTEGER) AS place, key FROM ("
        "SELECT 'agg_sector_performance' AS mart, trade_month AS a, 0.0 AS r, market_category AS b,"
        " trade_month || ' ' || market_category AS key FROM sector"
        " UNION ALL SELECT 'agg_monthly_summary', trade_month, 0, '', CAST(trade_month AS VARCHAR) FROM market"
        " UNION ALL SELECT 'agg_yearly_performance', make_date(trade_year, 1, 1), 0, market_category,"
        " trade_year || ' ' || market_category FROM yearly"
        " UNION ALL SELECT 'agg_market_crash_analysis', period_start, 0, event_name, event_name FROM events_mart"
        " UNION ALL SELECT 'agg_top_tickers_alltime', DATE '2000-01-01', -avg_daily_return, symbol, symbol FROM ranking)"
    ),
    "uri_scan": _sql(
        "SELECT symbol, is_etf, count(*) AS price_rows, form FROM prices, (VALUES ('list'), ('braces'), ('folders')) AS f(form)"
        " GROUP BY symbol, is_etf, form"
    ),
    "repeated_days_rollup": _sql(
        _check(
            "t", "symbol, trade_date", "unique", "warn",
            "SELECT count(*) FROM fact WHERE symbol LIKE '%0'", "t",
        )
    ),
    "orphan_symbols": _sql(
        "SELECT symbol, count(*) AS rows FROM prices"
        " WHERE symbol NOT IN (SELECT symbol FROM dim) GROUP BY symbol"
    ),
    "csv_roundtrip": _sql("SELECT * FROM prices"),
    "dirty_files": _sql("SELECT * FROM dirty"),
    "first_files": _sql(
        "SELECT symbol, is_etf, count(*) AS price_rows FROM prices GROUP BY symbol, is_etf"
        " QUALIFY row_number() OVER (PARTITION BY is_etf ORDER BY symbol) <= 3"
    ),
    "metadata_csv": _sql("SELECT * FROM staged_meta"),
    "parquet_by_year": _sql(f"SELECT {_ENRICHED} FROM enriched"),
    "parquet_files_per_year": _sql(f"SELECT {_ENRICHED} FROM enriched"),
    "parquet_pruned_years": _sql(
        f"SELECT {_ENRICHED} FROM enriched WHERE year(trade_date) BETWEEN 1997 AND 1998"
    ),
    "parquet_by_month": _sql(f"SELECT {_FACT} FROM fact"),
    "parquet_pruned_months": _sql(f"SELECT {_FACT} FROM fact WHERE trade_date BETWEEN {SLICE}"),
    "enriched_long_series": _sql(f"SELECT {_ENRICHED} FROM enriched"),
    "ranking_edges": _sql("SELECT * FROM leap_ranking"),
    "ranking_places": _sql(
        "SELECT CAST(row_number() OVER (ORDER BY avg_daily_return DESC, symbol) AS INTEGER) AS place,"
        " symbol FROM ranking QUALIFY place <= 20"
    ),
    "repeated_days": _sql(
        _check(
            "t", "symbol, trade_date", "unique", "warn",
            "SELECT count(*) FROM prices WHERE symbol LIKE '%0'", "t",
        )
    ),
    "job_processed": _sql(f"SELECT {_ENRICHED} FROM enriched"),
    "job_raw_prices": _sql(f"SELECT {_ENRICHED} FROM enriched"),
    "job_companies": _sql("SELECT * FROM dim"),
    "job_fact": _sql(f"SELECT {_FACT} FROM fact"),
    "job_sector": _sql("SELECT * FROM sector"),
    "job_market": _sql("SELECT * FROM market"),
    "job_yearly": _sql("SELECT * FROM yearly"),
    "job_events": _sql("SELECT * FROM events_mart"),
    "job_ranking": _sql("SELECT * FROM ranking"),
    "job_checks": _sql(_quality()),
    "flat_table_sql": _sql(
        "SELECT market_category, is_etf, count(*) AS companies FROM dim"
        " GROUP BY market_category, is_etf"
    ),
    "load_report_bytes": _sql(
        "SELECT 'raw_daily_prices' AS table_name, count(*) AS rows_loaded, true AS bytes_agree FROM enriched"
        " UNION ALL SELECT 'raw_symbols_meta', count(*), true FROM raw_meta"
    ),
    "replaced_table": _sql(
        "SELECT step, symbol, security_name, is_etf FROM dim"
        " JOIN (VALUES ('loaded'), ('failed'), ('replaced'), ('opened before')) AS steps(step)"
        " ON step <> 'replaced' OR NOT is_etf"
    ),
    "partial_reload": _sql(
        "SELECT step, table_name, rows"
        " FROM (SELECT count(*) FILTER (is_etf) AS n_funds, count(*) AS n_all, 'raw_daily_prices' AS table_name FROM enriched"
        " UNION ALL SELECT count(*) FILTER (is_etf), count(*), 'raw_symbols_meta' FROM raw_meta) AS counts"
        " JOIN LATERAL (VALUES ('funds', n_funds), ('prices', CASE table_name WHEN 'raw_daily_prices' THEN n_all ELSE n_funds END),"
        " ('meta', n_all)) AS steps(step, rows) ON true"
    ),
    "load_report": _sql(
        "SELECT 'raw_daily_prices' AS table_name, count(*) AS rows_loaded FROM enriched"
        " UNION ALL SELECT 'raw_symbols_meta', count(*) FROM raw_meta"
    ),
}
