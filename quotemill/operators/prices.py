"""Staging and fact projections of the processed prices, and the monthly rollup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.functions.columns import day_bit, month_of, usable_price

MONTH_DAYS = 31


def stage_prices(processed: DataFrame) -> DataFrame:
    return processed.where(usable_price()).select(*S.STAGED_PRICE_COLUMNS)


def fact_prices(staged: DataFrame) -> DataFrame:
    return staged.select(*S.FACT_COLUMNS)


def ticker_months(fact: DataFrame) -> DataFrame:
    """Mergeable sums and counts per ticker, month and category.

    The marts need nothing finer than a ticker's month, so they all start from
    this rollup: one scan of the fact, combined before the only large shuffle to a
    twentieth of the rows, keyed so that no month, segment or ticker is one group.
    Plain columns cover all rows; ``r_`` columns cover the rows that have a return.
    Distinct days are kept as a bit per day of the month: ``r_days`` those with a return,
    ``days_seen`` and ``days_twice`` those with one row or more and with two or more. The
    pair merges over rows of one ticker and month (``merged_days``), so that repeated days
    are found without a shuffle of the days. A mart that does not use them does not pay for
    their counts.
    """
    has_return = F.col("daily_return").isNotNull()

    def returned(name: str):
        return F.when(has_return, F.col(name))

    day = F.dayofmonth("trade_date")
    counts = [F.count_if(day == number).alias(f"day_{number}") for number in range(1, MONTH_DAYS + 1)]

    def days_with(rows: int) -> Column:
        bits = (
            F.when(F.col(f"day_{number}") >= rows, F.lit(1 << (number - 1))).otherwise(F.lit(0).cast("bigint"))
            for number in range(1, MONTH_DAYS + 1)
        )
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    grouped = (
        fact.withColumn("trade_month", month_of(F.col("trade_date")))
        .groupBy("trade_month", "symbol", "market_category")
        .agg(
            F.sum("close").alias("close_sum"),
            F.count("close").alias("close_count"),
            F.sum("volume").alias("volume"),
            F.sum("volatility_30").alias("volatility_sum"),
            F.count("volatility_30").alias("volatility_count"),
            F.sum("daily_return").alias("return_sum"),
            F.count("daily_return").alias("return_count"),
            F.sum(returned("close")).alias("r_close_sum"),
            F.count(returned("close")).alias("r_close_count"),
            F.sum(returned("volume")).alias("r_volume"),
            F.sum(returned("volatility_30")).alias("r_volatility_sum"),
            F.count(returned("volatility_30")).alias("r_volatility_count"),
            F.bit_or(F.when(has_return, day_bit(F.col("trade_date")))).alias("r_days"),
            F.min(returned("trade_date")).alias("r_first_date"),
            F.max(returned("trade_date")).alias("r_last_date"),
            *counts,
        )
    )
    pair = {"days_seen": days_with(1), "days_twice": days_with(2)}
    return grouped.withColumns(pair).drop(*(f"day_{number}" for number in range(1, MONTH_DAYS + 1)))


def merged_days(months: DataFrame) -> DataFrame:
    """``days_seen`` and ``days_twice`` of every ticker and month, over its categories.

    A day is there twice if some category has it twice, or two categories have it. The
    pairs of a ticker and month are as many as its categories.
    """
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(0).cast("bigint").alias("twice"))

    def merge(held: Column, pair: Column) -> Column:
        both = held["seen"].bitwiseAND(pair["days_seen"])
        return F.struct(
            held["seen"].bitwiseOR(pair["days_seen"]).alias("seen"),
            held["twice"].bitwiseOR(pair["days_twice"]).bitwiseOR(both).alias("twice"),
        )

    pairs = F.collect_list(F.struct("days_seen", "days_twice"))
    return (
        months.groupBy("trade_month", "symbol")
        .agg(F.aggregate(pairs, start, merge).alias("days"))
        .select("trade_month", "symbol", F.col("days.seen").alias("days_seen"), F.col("days.twice").alias("days_twice"))
    )
