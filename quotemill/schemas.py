"""Schemas and the fixed values that results depend on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# --- fixed values: layout of the raw price files, in file order -------------
PRICE_FILE_COLUMNS = {
    "Date": ("trade_date", T.StringType()),
    "Open": ("open", T.DoubleType()),
    "High": ("high", T.DoubleType()),
    "Low": ("low", T.DoubleType()),
    "Close": ("close", T.DoubleType()),
    "Adj Close": ("adj_close", T.DoubleType()),
    "Volume": ("volume", T.LongType()),
}
PRICE_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
# White space of Unicode at either end.
OUTER_SPACE_PATTERN = r"(?U)^\s+|\s+$"
TICKER_FILE_SUFFIX = ".csv"
ETF_DIRECTORY = "/etfs/"

# --- fixed values: market category labels ------------------------------------
# Labels attached to price rows. The code A is not known here and becomes Other.
PRICE_CATEGORY_LABELS = {
    "Q": "NASDAQ Global Select Market",
    "G": "NASDAQ Global Market",
    "S": "NASDAQ Capital Market",
    "N": "NYSE",
}
# Labels of the company dimension, which also knows the code A.
COMPANY_CATEGORY_LABELS = {
    "Q": "NASDAQ Global Select Market",
    "G": "NASDAQ Global Market",
    "S": "NASDAQ Capital Market",
    "N": "NYSE",
    "A": "NYSE American",
}
OTHER_CATEGORY = "Other"

# --- fixed values: named market events, both ends inclusive -------------------
MARKET_EVENTS = (
    ("Black Monday (1987)", dt.date(1987, 9, 1), dt.date(1987, 12, 31)),
    ("Dot-com Crash (2000–2002)", dt.date(2000, 3, 1), dt.date(2002, 10, 31)),
    ("Financial Crisis (2007–09)", dt.date(2007, 10, 1), dt.date(2009, 3, 31)),
    ("COVID Crash (2020)", dt.date(2020, 1, 20), dt.date(2020, 4, 1)),
)

# --- fixed values: frame lengths, thresholds, rounding --------------------------
SHORT_AVERAGE_ROWS = 30
LONG_AVERAGE_ROWS = 60
VOLATILITY_ROWS = 30
YEAR_ROWS = 252
RETURN_DIGITS = 6
PRICE_DIGITS = 4
LEADERBOARD_SIZE = 20

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_name", T.StringType()),
        T.StructField("event_start", T.DateType()),
        T.StructField("event_end", T.DateType()),
    ]
)

INDICATOR_COLUMNS = (
    "daily_return",
    "moving_avg_30",
    "moving_avg_60",
    "volatility_30",
    "week52_high",
    "week52_low",
)

STAGED_PRICE_COLUMNS = (
    "symbol",
    "trade_date",
    "open",
    "high",
    "low",
    "close",
    "adj_close",
    "volume",
    *INDICATOR_COLUMNS,
    "security_name",
    "listing_exchange",
    "market_category",
    "market_category_code",
    "etf_flag",
    "is_etf",
)

FACT_COLUMNS = (
    "trade_date",
    "symbol",
    "open",
    "high",
    "low",
    "close",
    "adj_close",
    "volume",
    *INDICATOR_COLUMNS,
    "market_category",
    "market_category_code",
    "is_etf",
)

COMPANY_COLUMNS = (
    "symbol",
    "security_name",
    "listing_exchange",
    "market_category_code",
    "market_category",
    "financial_status",
    "is_etf",
    "nasdaq_traded",
    "is_test_issue",
    "round_lot_size",
)

#: What identifies a row of a checked table.
TABLE_KEYS = {
    "stg_daily_prices": ("symbol", "trade_date"),
    "stg_symbols_meta": ("symbol",),
    "dim_companies": ("symbol",),
    "fact_daily_prices": ("symbol", "trade_date"),
    "agg_sector_performance": ("trade_month", "market_category"),
    "agg_monthly_summary": ("trade_month",),
    "agg_yearly_performance": ("trade_year", "market_category"),
    "agg_market_crash_analysis": ("event_name",),
    "agg_top_tickers_alltime": ("symbol",),
}

#: Ranges of symbols that a filter on a clustered table is made of, at most.
SYMBOL_RANGES = 16
