"""Rollups by day that answer any number of date ranges, distinct tickers included.

The trading days of the market are numbered. Sums and ticker bitmaps of each day are
merged into blocks of 2, 4, 8, ... days that begin at multiples of their length. A date
range of n trading days is then made up of at most 2 log2(n) blocks, found by arithmetic,
whatever other ranges overlap it; the fact is not read again. Sums over a range are sums
of its own blocks, so nothing cancels, and a value that is not finite touches only the
ranges it lies in.

Tickers are numbered densely, so that a set of them is a bitmap of 4 KiB for each 32,768
tickers. Bitmaps merge from day to block to range, which counts distinct tickers exactly
with one aggregation and no shuffle of tickers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.columns import return_digits, year_of
from quotemill.session import materialize

#: Tickers numbered by one task, a multiple of what one bitmap holds.
_TICKERS_PER_TASK = 8 * 32_768
_SUMS = ("return_sum", "return_count", "volatility_sum", "volatility_count", "volume")


def ticker_numbers(symbols: DataFrame) -> DataFrame:
    """``symbol`` and ``ticker``: a number for each symbol, dense up to gaps between tasks.

    ``symbols`` has distinct symbols, not null. The numbers hold for the written result;
    another call may number otherwise.
    """
    known = materialize(symbols.select("symbol"), "symbols")
    tasks = max(1, -(-known.count() // _TICKERS_PER_TASK))
    return materialize(known.coalesce(tasks).withColumn("ticker", F.monotonically_increasing_id()), "ticker-numbers")


def _numbered(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows with the bitmap that holds their ticker, and its bit there."""
    return rows.join(numbers, "symbol").withColumns(
        {"bucket": F.bitmap_bucket_number("ticker"), "bit": F.bitmap_bit_position("ticker")}
    )


def market_days(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """Sums, counts and tickers of each day, by bitmap, over the rows that have a return."""
    rows = fact.where(F.col("daily_return").isNotNull()).select(
        "symbol", "trade_date", "daily_return", "volatility_30", "volume"
    )
    return (
        _numbered(rows, numbers)
        .groupBy("trade_date", "bucket")
        .agg(
            F.sum("daily_return").alias("return_sum"),
            F.count("daily_return").alias("return_count"),
            F.sum("volatility_30").alias("volatility_sum"),
            F.count("volatility_30").alias("volatility_count"),
            F.sum("volume").alias("volume"),
            F.bitmap_construct_agg("bit").alias("tickers"),
        )
    )


def trading_calendar(days: DataFrame) -> DataFrame:
    """``date`` and ``before``: how many trading days lie before each calendar day.

    From the first trading day to the day after the last one; there are as many rows as
    the calendar has days, so one task orders them.
    """
    trading = days.select(F.col("trade_date").alias("date")).distinct().withColumn("open", F.lit(1))
    ends = trading.agg(F.min("date").alias("first"), F.max("date").alias("last")).where("first IS NOT NULL")
    dates = ends.select(F.explode(F.sequence("first", F.date_add("last", 1))).alias("date"))
    earlier = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return dates.join(trading, "date", "left").select(
        "date", F.coalesce(F.sum("open").over(earlier), F.lit(0)).cast("bigint").alias("before")
    )


def _power(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def _levels(trading_days: int) -> Column:
    """Levels of blocks: a block of level k has 2^k days."""
    return F.sequence(F.lit(0), F.lit(max(0, trading_days - 1).bit_length()))


def day_blocks(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sums and tickers of every block: ``level``, ``block``, ``bucket``.

    ``days`` and ``calendar`` are written tables.
    """
    total = calendar.agg(F.max("before")).first()[0] or 0
    number = calendar.select(F.col("date").alias("trade_date"), "before")
    spread = days.join(number, "trade_date").withColumn("level", F.explode(_levels(total)))
    return (
        spread.withColumn("block", F.call_function("shiftright", F.col("before"), F.col("level")))
        .groupBy("level", "block", "bucket")
        .agg(*(F.sum(name).alias(name) for name in _SUMS), F.bitmap_or_agg("tickers").alias("tickers"))
    )


def _pieces(first: Column, end: Column, total: int) -> Column:
    """(level, block) of the largest blocks within the days from ``first`` up to before ``end``.

    On each level the blocks within the range are consecutive, and all but the outer ones lie
    in a larger one that is within it too.
    """
    def on_level(level: Column) -> Column:
        size = _power(level)
        low = F.call_function("shiftright", first + size - 1, level)
        high = F.call_function("shiftright", end, level) - 1
        left = F.when((low <= high) & ((low % 2 == 1) | (low == high)), low)
        right = F.when((low < high) & (high % 2 == 0), high)
        return F.transform(
            F.array_compact(F.array(left, right)), lambda block: F.struct(level.alias("level"), block.alias("block"))
        )

    return F.flatten(F.transform(_levels(total), on_level))


def range_totals(blocks: DataFrame, calendar: DataFrame, events: DataFrame) -> DataFrame:
    """Market behaviour within named date ranges, both ends included, as ``market_events`` tells it.

    ``events`` has ``event_name``, ``event_start`` and ``event_end``. A range without rows,
    or that ends before it starts, is absent.
    """
    ends = calendar.agg(F.max("before").alias("total"), F.min("date").alias("opens"), F.max("date").alias("closes")).first()
    total = ends.total or 0

    def place(name: str) -> DataFrame:
        """The calendar under the name of one end of a range."""
        return calendar.select(F.col("date").alias(f"{name}_date"), F.col("before").alias(name))

    def within(day: Column) -> Column:
        """The day itself, or the end of the calendar on whose far side it lies."""
        return F.greatest(F.least(day, F.lit(ends.closes)), F.lit(ends.opens))

    placed = (
        events.where("event_start <= event_end")
        .withColumns({"first_date": within(F.col("event_start")), "end_date": within(F.date_add("event_end", 1))})
        .join(place("first"), "first_date")
        .join(place("end"), "end_date")
    )
    key = ["event_name", "event_start", "event_end"]
    pieces = placed.select(*key, F.explode(_pieces(F.col("first"), F.col("end"), total)).alias("piece")).select(
        *key, "piece.level", "piece.block"
    )
    merged = (
        pieces.join(blocks, ["level", "block"])
        .groupBy(*key, "bucket")
        .agg(*(F.sum(name).alias(name) for name in _SUMS), F.bitmap_count(F.bitmap_or_agg("tickers")).alias("tickers"))
    )
    return (
        merged.groupBy(*key)
        .agg(
            return_digits(F.try_divide(F.sum("return_sum"), F.sum("return_count"))).alias("avg_daily_return"),
            return_digits(F.try_divide(F.sum("volatility_sum"), F.sum("volatility_count"))).alias("avg_volatility"),
            F.sum("volume").alias("total_volume"),
            F.sum("tickers").alias("affected_tickers"),
        )
        .select(
            "event_name",
            F.col("event_start").alias("period_start"),
            F.col("event_end").alias("period_end"),
            "avg_daily_return",
            "avg_volatility",
            "total_volume",
            "affected_tickers",
            F.date_diff("event_end", "event_start").cast("bigint").alias("event_duration_days"),
        )
    )


def tickers_by_year(months: DataFrame, numbers: DataFrame) -> DataFrame:
    """Distinct tickers of each year and segment, from the rollup by month; over rows with a return."""
    rows = months.where((F.length("market_category") > 0) & (F.col("return_count") > 0))
    return (
        _numbered(rows.select("symbol", "market_category", "trade_month"), numbers)
        .groupBy(year_of(F.col("trade_month")).alias("trade_year"), "market_category", "bucket")
        .agg(F.bitmap_count(F.bitmap_construct_agg("bit")).alias("tickers"))
        .groupBy("trade_year", "market_category")
        .agg(F.sum("tickers").alias("ticker_count"))
    )
