"""Run report over the enriched prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: columns of the sample ------------------------------------------
SAMPLE_COLUMNS = (
    "trade_date", "symbol", "close", "daily_return", "moving_avg_30", "volatility_30",
    "week52_high", "security_name", "market_category",
)


def run_report(prices: DataFrame) -> DataFrame:
    """Row count, distinct symbols and date range, in one pass over two columns.

    Rows are first counted per symbol, where they combine before the shuffle.
    """
    per_symbol = prices.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"),
    )
    return per_symbol.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count("symbol").alias("distinct_symbols"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def sample_rows(prices: DataFrame, size: int = 5) -> DataFrame:
    """The first rows by symbol and date, for a look at the output."""
    return prices.select(*SAMPLE_COLUMNS).orderBy("symbol", "trade_date").limit(size)
