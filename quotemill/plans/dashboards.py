"""Queries of the dashboard panels and other documented questions, over the marts."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.functions.columns import month_of
from quotemill.sources.tables import within_dates


# --- fixed values: order in which each summary table is shown --------------------------
SHOWN_BY = {
    "agg_sector_performance": ["trade_month", "market_category"],
    "agg_monthly_summary": ["trade_month"],
    "agg_yearly_performance": ["trade_year", "market_category"],
    "agg_market_crash_analysis": ["period_start", "event_name"],
    "agg_top_tickers_alltime": ["-avg_daily_return", "symbol"],
}


def in_order(mart: DataFrame, name: str) -> DataFrame:
    """A summary table in its order of display; written tables are unordered."""
    keys = SHOWN_BY[name]
    return mart.orderBy(
        [key.lstrip("-") for key in keys], ascending=[not key.startswith("-") for key in keys]
    )


def _months(mart: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """The date control of a panel: months from ``start`` to ``end``, open if absent."""
    if start is not None:
        mart = mart.where(F.col("trade_month") >= month_of(F.lit(start)))
    if end is not None:
        mart = mart.where(F.col("trade_month") <= F.lit(end))
    return mart


def volume_trend(
    market: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Traded volume of the whole market, month by month."""
    return _months(market, start, end).select("trade_month", "total_volume").orderBy("trade_month")


def _by_segment(segments: DataFrame, metric: str) -> DataFrame:
    """Mean over months, not weighted by the number of ticker-days."""
    return segments.groupBy("market_category").agg(F.avg(metric).alias(metric))


def return_by_segment(
    segments: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    mean = _by_segment(_months(segments, start, end), "avg_daily_return")
    return mean.orderBy(F.desc("avg_daily_return"), "market_category")


def risk_by_segment(
    segments: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    mean = _by_segment(_months(segments, start, end), "avg_volatility")
    return mean.orderBy(F.desc("avg_volatility"), "market_category")


def movers(
    market: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Best and worst ticker per month."""
    columns = ("trade_month", "top_gainer_symbol", "top_loser_symbol")
    return _months(market, start, end).select(*columns).orderBy("trade_month")


def segment_years(
    yearly: DataFrame, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Yearly segments, optionally of some years such as one decade."""
    if first is not None:
        yearly = yearly.where(F.col("trade_year") >= first)
    if last is not None:
        yearly = yearly.where(F.col("trade_year") <= last)
    return in_order(yearly, "agg_yearly_performance")


def event_comparison(events: DataFrame) -> DataFrame:
    return in_order(events, "agg_market_crash_analysis")


def _leaders(ranking: DataFrame, order: Column, size: int) -> DataFrame:
    label = F.coalesce("security_name", "symbol")
    return (
        ranking.select("symbol", label.alias("label"), "market_category", "avg_daily_return")
        .orderBy(order, "symbol")
        .limit(size)
    )


def best_tickers(ranking: DataFrame, size: int = S.LEADERBOARD_SIZE) -> DataFrame:
    return _leaders(ranking, F.desc("avg_daily_return"), size)


def worst_tickers(ranking: DataFrame, size: int = S.LEADERBOARD_SIZE) -> DataFrame:
    return _leaders(ranking, F.asc("avg_daily_return"), size)


def star_slice(
    fact: DataFrame, companies: DataFrame, start: dt.date, end: dt.date, category: str
) -> DataFrame:
    """Prices and returns of one segment in a date range, with company names.

    The segment is an attribute of the dimension, so it cuts the build side; the
    dates cut the scan of the fact.
    """
    days = within_dates(fact, start, end).select("trade_date", "symbol", "close", "daily_return")
    segment = companies.where(F.col("market_category") == category)
    return days.join(
        segment.select("symbol", "security_name", "market_category"), "symbol"
    ).select("trade_date", "symbol", "security_name", "market_category", "close", "daily_return")


def symbol_ranges(companies: DataFrame, chosen: Column, most: int = S.SYMBOL_RANGES) -> list[tuple[str, str]]:
    """Ranges of symbols, at most ``most``, that hold all companies for which ``chosen`` is true.

    The ranges leave out the widest gaps, counted in other companies of the dimension. Only
    their ends reach the driver.
    """
    place = F.row_number().over(Window.orderBy("symbol"))
    ranked = companies.select("symbol", F.coalesce(chosen, F.lit(False)).alias("chosen")).where("symbol IS NOT NULL")
    kept = ranked.withColumn("place", place).where("chosen")
    before = Window.orderBy("place")
    gaps = kept.select(
        "symbol", F.lag("symbol").over(before).alias("previous"), (F.col("place") - F.lag("place").over(before)).alias("gap")
    )
    ends = kept.agg(F.min("symbol"), F.max("symbol")).first()
    if ends[0] is None:
        return []
    cuts = gaps.where("gap > 1").orderBy(F.desc("gap"), "symbol").limit(most - 1).collect()
    starts = sorted([ends[0], *(cut.symbol for cut in cuts)])
    stops = sorted([*(cut.previous for cut in cuts), ends[1]])
    return list(zip(starts, stops, strict=True))


def reduced_star_slice(
    fact: DataFrame, companies: DataFrame, start: dt.date, end: dt.date, category: str
) -> DataFrame:
    """As ``star_slice``, with the scan of the fact cut by symbol before the join.

    The symbols of the segment, as a few ranges, go down to the scan, where the clustering
    of the fact lets Parquet skip row groups. The join still decides.
    """
    ranges = symbol_ranges(companies, F.col("market_category") == category)
    among = reduce(or_, (F.col("symbol").between(a, b) for a, b in ranges), F.lit(False))
    return star_slice(fact.where(among), companies, start, end, category)


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))
