"""Summary tables over the fact and the dimension.

All but the event table take the ticker-month rollup (``ticker_months``). Sorting is
left to the query that shows a table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.functions.columns import (
    compounded,
    compounded_or_null,
    price_digits,
    return_digits,
    year_of,
)
from quotemill.operators.days import tickers_by_year
from quotemill.sources.tables import literal_events

def _mean(total: str, count: str) -> Column:
    """Mean over ticker-days from partial sums; NULL if there are none."""
    return F.try_divide(F.sum(total), F.sum(count))


def _in_a_segment() -> Column:
    return (F.length("market_category") > 0) & (F.col("return_count") > 0)


def segment_by_month(months: DataFrame) -> DataFrame:
    """Market segment by month, over rows with a return.

    The rollup has one row per ticker, month and category, so tickers are counted
    without a distinct.
    """
    return (
        months.where(_in_a_segment())
        .groupBy("trade_month", "market_category")
        .agg(
            return_digits(_mean("return_sum", "return_count")).alias("avg_daily_return"),
            return_digits(_mean("r_volatility_sum", "r_volatility_count")).alias("avg_volatility"),
            price_digits(_mean("r_close_sum", "r_close_count")).alias("avg_close"),
            F.sum("r_volume").alias("total_volume"),
            F.count("symbol").alias("ticker_count"),
        )
    )


def _per_ticker(months: DataFrame) -> DataFrame:
    """The rollup with the categories of a ticker merged, and its mean return."""
    totals = (
        "close_sum", "close_count", "volume", "volatility_sum", "volatility_count",
        "return_sum", "return_count",
    )
    merged = months.groupBy("trade_month", "symbol").agg(
        *(F.sum(name).alias(name) for name in totals)
    )
    return merged.withColumn("mean_return", F.try_divide("return_sum", "return_count"))


def _extremes() -> dict[str, tuple[Column, Column]]:
    """Ticker and mean return of the best and worst ticker of a group.

    Means are compared on 12 digits and then by symbol, so that ties do not depend
    on the order of summation. Tickers without a return have a NULL key, which
    min_by ignores.
    """
    mean = F.round("mean_return", 12)

    def first_by(rank: Column) -> tuple[Column, Column]:
        key = F.when(F.col("mean_return").isNotNull(), F.struct(rank, F.col("symbol")))
        return F.min_by("symbol", key), F.min_by("mean_return", key)

    return {"gainer": first_by(-mean), "loser": first_by(mean)}


def market_by_month(months: DataFrame) -> DataFrame:
    """Whole market by month with the best and the worst ticker.

    Totals cover all rows, the two tickers only rows with a return. Both come from
    one pass over the ticker means, so there is nothing to join.
    """
    extremes = _extremes()
    return (
        _per_ticker(months)
        .groupBy("trade_month")
        .agg(
            price_digits(_mean("close_sum", "close_count")).alias("avg_close"),
            F.sum("volume").alias("total_volume"),
            return_digits(_mean("return_sum", "return_count")).alias("avg_daily_return"),
            return_digits(_mean("volatility_sum", "volatility_count")).alias("avg_volatility"),
            F.count("symbol").alias("active_ticker_count"),
            extremes["gainer"][0].alias("top_gainer_symbol"),
            extremes["loser"][0].alias("top_loser_symbol"),
        )
    )


def monthly_movers(months: DataFrame) -> DataFrame:
    """Best and worst ticker of each month with their mean returns."""
    extremes = _extremes()
    return (
        _per_ticker(months.where(F.col("return_count") > 0))
        .groupBy("trade_month")
        .agg(
            extremes["gainer"][0].alias("top_gainer_symbol"),
            return_digits(extremes["gainer"][1]).alias("top_gainer_return"),
            extremes["loser"][0].alias("top_loser_symbol"),
            return_digits(extremes["loser"][1]).alias("top_loser_return"),
        )
    )


def segment_by_year(months: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """Market segment by year with the annualised mean return.

    With ``numbers`` (``ticker_numbers``) distinct tickers are counted in bitmaps; without,
    by an aggregation that shuffles them.
    """
    mean_return = _mean("return_sum", "return_count")
    if numbers is not None:
        sums = _segment_years(months, mean_return)
        keys = ["trade_year", "market_category"]
        return sums.join(tickers_by_year(months, numbers), keys).select(
            *keys, "avg_daily_return", "avg_volatility", "total_volume", "ticker_count", "approx_annual_return"
        )
    return (
        months.where(_in_a_segment())
        .groupBy(year_of(F.col("trade_month")).alias("trade_year"), "market_category")
        .agg(
            return_digits(mean_return).alias("avg_daily_return"),
            return_digits(_mean("r_volatility_sum", "r_volatility_count")).alias("avg_volatility"),
            F.sum("r_volume").alias("total_volume"),
            F.count_distinct("symbol").alias("ticker_count"),
            compounded(mean_return, F.lit(S.YEAR_ROWS)).alias("approx_annual_return"),
        )
    )


def _segment_years(months: DataFrame, mean_return: Column) -> DataFrame:
    return (
        months.where(_in_a_segment())
        .groupBy(year_of(F.col("trade_month")).alias("trade_year"), "market_category")
        .agg(
            return_digits(mean_return).alias("avg_daily_return"),
            return_digits(_mean("r_volatility_sum", "r_volatility_count")).alias("avg_volatility"),
            F.sum("r_volume").alias("total_volume"),
            compounded(mean_return, F.lit(S.YEAR_ROWS)).alias("approx_annual_return"),
        )
    )


def _ranges(column: Column, events: list, as_month: bool) -> Column:
    """Does ``column`` lie in the range of some event? Ranges that meet are one."""
    spans: list[tuple[dt.date, dt.date]] = []
    for start, end in sorted((start, end) for _, start, end in events):
        start = start.replace(day=1) if as_month else start
        if spans and start <= spans[-1][1] + dt.timedelta(days=1):
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((start, end))
    return reduce(or_, (column.between(F.lit(a), F.lit(b)) for a, b in spans), F.lit(False))


def market_events(
    fact: DataFrame, events: Iterable[tuple[str, dt.date, dt.date]] = S.MARKET_EVENTS
) -> DataFrame:
    """Market behaviour within named date ranges, both ends included.

    A row counts in each event it falls in; an event without rows is absent. The
    range join is an equi-join on the day: each event is listed once per day, so every
    match is one. The ranges also filter the scan, on the month key too where the table
    has one.
    """
    events = [event for event in events if event[1] <= event[2]]
    day = F.col("trade_date")
    rows = fact.where(F.col("daily_return").isNotNull() & _ranges(day, events, as_month=False))
    if "trade_month" in fact.columns:
        rows = rows.where(_ranges(F.col("trade_month"), events, as_month=True))
    days = literal_events(fact.sparkSession, events).withColumn(
        "trade_date", F.explode(F.sequence("event_start", "event_end"))
    )
    return (
        rows.select("trade_date", "symbol", "daily_return", "volatility_30", "volume")
        .join(days, "trade_date")
        .groupBy(
            "event_name",
            F.col("event_start").alias("period_start"),
            F.col("event_end").alias("period_end"),
        )
        .agg(
            return_digits(F.avg("daily_return")).alias("avg_daily_return"),
            return_digits(F.avg("volatility_30")).alias("avg_volatility"),
            F.sum("volume").alias("total_volume"),
            F.count_distinct("symbol").alias("affected_tickers"),
        )
        .withColumn("event_duration_days", F.date_diff("period_end", "period_start").cast("bigint"))
    )


def ticker_ranking(months: DataFrame, companies: DataFrame) -> DataFrame:
    """Lifetime figures of listed non-ETF tickers with a year of returns or more.

    Each ticker is reduced to one row before it meets the dimension, so names are
    neither grouped by nor carried through the large shuffle.
    """
    days = F.bit_count(F.bit_or("r_days"))
    by_month = months.where(F.col("return_count") > 0).groupBy("symbol", "trade_month").agg(
        days.cast("bigint").alias("days"),
        F.sum("return_sum").alias("return_sum"),
        F.sum("return_count").alias("return_count"),
        F.sum("r_volatility_sum").alias("r_volatility_sum"),
        F.sum("r_volatility_count").alias("r_volatility_count"),
        F.sum("r_volume").alias("r_volume"),
        F.min("r_first_date").alias("r_first_date"),
        F.max("r_last_date").alias("r_last_date"),
    )
    lifetime = (
        by_month.groupBy("symbol")
        .agg(
            F.sum("days").alias("trading_days"),
            return_digits(_mean("return_sum", "return_count")).alias("avg_daily_return"),
            return_digits(_mean("r_volatility_sum", "r_volatility_count")).alias("avg_volatility"),
            F.sum("r_volume").alias("total_volume"),
            F.min("r_first_date").alias("first_trade_date"),
            F.max("r_last_date").alias("last_trade_date"),
        )
        .where(F.col("trading_days") >= S.YEAR_ROWS)
    )
    stocks = companies.where(~F.col("is_etf")).select("symbol", "security_name", "market_category")
    return (
        stocks.join(lifetime, "symbol")
        .withColumn(
            "approx_total_return",
            compounded_or_null(F.col("avg_daily_return"), F.col("trading_days")),
        )
    )
