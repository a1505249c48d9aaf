"""Per-ticker indicators over frames of rows (not of calendar days).

Frame work. Spark evaluates a sliding frame by aggregating all of its rows again
for each output row, so a frame costs one update per row of it and function. Here no
frame slides: a block of 5 rows is put together from the 4 rows before, a block of 30
rows from six of those, and the longer frames from blocks of 30 rows: the 60-row sum is
this block plus the block 30 rows earlier, the 252-row maximum is the greatest of nine
blocks that cover the year. All rows of a block are fetched by ``lag``. Only additions and
comparisons are involved, so nothing cancels and the results are those of the plain
frames. Squared deviations are taken from the mean of 5 rows and then from that of 30, as
parallel variances are merged, so nothing cancels there either.

Long series. A window over one symbol runs in one task. That suits daily data
(60 years are 15,000 rows), but nothing guarantees it. Symbols with more than
``max_rows`` rows are therefore cut into blocks of consecutive rows, each preceded by
the rows its first frames look back on, and the blocks are computed as independent
window partitions. Results do not depend on the cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.functions.columns import month_of, relative_change
from quotemill.session import materialize

MAX_ROWS_PER_TASK = 2_000_000

_CELL_BITS = 12

# Rows put together first; blocks of 30 rows are made of so many.
_SMALL_ROWS = 5
_SMALL = (
    "small_sum", "small_count", "small_high", "small_low",
    "small_returns", "small_return_sum", "small_mean", "small_squares",
)
_BLOCK = ("block_sum", "block_count", "block_high", "block_low")

# What the frames read of earlier rows.
_FRAMED = ("close", "high", "low")

_LOOK_BACK = max(S.YEAR_ROWS, S.LONG_AVERAGE_ROWS, S.VOLATILITY_ROWS + 1) - 1


def _earlier(name: str, rows: int, series: WindowSpec) -> Column:
    return F.lag(name, rows).over(series) if rows else F.col(name)


def _earlier_rows(names: Sequence[str], offsets: Sequence[int], series: WindowSpec) -> dict[str, Column]:
    """Each column as it was ``offsets`` rows earlier, named ``column@offset``."""
    return {f"{name}@{rows}": _earlier(name, rows, series) for name in names for rows in offsets}


def _total(values: Iterable[Column], zero: object) -> Column:
    return reduce(add, (F.coalesce(value, F.lit(zero)) for value in values))


def _returns(rows: int) -> list[Column]:
    """The daily returns of this row and the rows before, from their closes."""
    closes = [F.col(f"close@{number}") for number in range(rows + 1)]
    return [relative_change(now, before) for now, before in zip(closes, closes[1:], strict=False)]


def add_small_blocks(prices: DataFrame, series: WindowSpec) -> DataFrame:
    """``daily_return``, and sums, counts and extremes of the last few rows, as ``small_`` columns.

    ``small_squares`` are the squared deviations of the returns from their own mean.
    """
    offsets = range(_SMALL_ROWS)
    fetched = prices.withColumns(
        _earlier_rows(["close"], range(_SMALL_ROWS + 1), series) | _earlier_rows(["high", "low"], offsets, series)
    )
    returns = {f"return@{rows}": value for rows, value in enumerate(_returns(_SMALL_ROWS))}
    closes, changes = ([F.col(f"{name}@{rows}") for rows in offsets] for name in ("close", "return"))
    sums = fetched.withColumns(returns).withColumns(
        {
            "small_sum": _total(closes, 0.0),
            "small_count": _total((close.isNotNull().cast("int") for close in closes), 0),
            "small_high": F.greatest(*(F.col(f"high@{rows}") for rows in offsets)),
            "small_low": F.least(*(F.col(f"low@{rows}") for rows in offsets)),
            "small_returns": _total((change.isNotNull().cast("int") for change in changes), 0),
            "small_return_sum": _total(changes, 0.0),
        }
    )
    mean = F.try_divide("small_return_sum", "small_returns")
    squares = sums.withColumn("small_mean", mean).withColumn(
        "small_squares", _total(((change - F.col("small_mean")) * (change - F.col("small_mean")) for change in changes), 0.0)
    )
    return squares.select(*prices.columns, F.col("return@0").alias("daily_return"), *_SMALL)


def add_blocks(prices: DataFrame, series: WindowSpec) -> DataFrame:
    """Sums, counts and extremes of the last 30 rows as ``block_`` columns, and the volatility."""
    offsets = range(0, S.SHORT_AVERAGE_ROWS, _SMALL_ROWS)
    fetched = prices.withColumns(_earlier_rows(_SMALL, offsets, series))

    def parts(name: str) -> list[Column]:
        return [F.col(f"{name}@{rows}") for rows in offsets]

    blocks = fetched.withColumns(
        {
            "block_sum": _total(parts("small_sum"), 0.0),
            "block_count": _total(parts("small_count"), 0),
            "block_high": F.greatest(*parts("small_high")),
            "block_low": F.least(*parts("small_low")),
            "block_returns": _total(parts("small_returns"), 0),
        }
    ).withColumn("block_mean", F.try_divide(_total(parts("small_return_sum"), 0.0), F.col("block_returns")))
    away = (mean - F.col("block_mean") for mean in parts("small_mean"))
    between = (count * gap * gap for count, gap in zip(parts("small_returns"), away, strict=True))
    squares = _total(parts("small_squares"), 0.0) + _total(between, 0.0)
    volatility = F.when(F.col("block_returns") > 1, F.sqrt(squares / (F.col("block_returns") - 1)))
    kept = [name for name in prices.columns if name not in _SMALL]
    return blocks.select(*kept, *_BLOCK, volatility.alias("volatility_30"))


def _average_of_blocks(block_rows: int, rows: int, series: WindowSpec) -> Column:
    """Mean close of ``rows`` rows from disjoint blocks of sums and counts."""
    if rows % block_rows:
        raise ValueError(f"{rows} rows are not a whole number of {block_rows}-row blocks")
    offsets = range(0, rows, block_rows)
    total = _total((_earlier("block_sum", offset, series) for offset in offsets), 0.0)
    return F.try_divide(total, _total((_earlier("block_count", offset, series) for offset in offsets), 0))


def _cover(block_rows: int, rows: int) -> list[int]:
    """Offsets of earlier blocks that, with the current one, cover ``rows`` rows."""
    last = rows - block_rows
    return [*range(block_rows, last, block_rows), last]


def add_frames(prices: DataFrame, series: WindowSpec) -> DataFrame:
    """Returns, moving averages, volatility and year range of each row."""
    block_rows = S.SHORT_AVERAGE_ROWS
    blocks = add_blocks(add_small_blocks(prices, series), series)
    year = _cover(block_rows, S.YEAR_ROWS)
    return blocks.withColumns(
        {
            "moving_avg_30": _average_of_blocks(block_rows, S.SHORT_AVERAGE_ROWS, series),
            "moving_avg_60": _average_of_blocks(block_rows, S.LONG_AVERAGE_ROWS, series),
            # greatest and least skip the NULLs before the start of a series
            "week52_high": F.greatest(
                "block_high", *(_earlier("block_high", rows, series) for rows in year)
            ),
            "week52_low": F.least(
                "block_low", *(_earlier("block_low", rows, series) for rows in year)
            ),
        }
    )


def _with_indicators(
    prices: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    series = Window.partitionBy(*keys).orderBy(*order)
    computed = add_frames(prices, series)
    return computed.select(*keep, *S.INDICATOR_COLUMNS)


def _fingerprint(prices: DataFrame) -> Column:
    """Orders rows of one symbol and date, so that repeats give repeatable results.

    Hashes take 0.0 and -0.0 for one; only zeros are told apart by their text.
    """
    others = [(name, kind) for name, kind in prices.dtypes if name not in ("symbol", "trade_date")]
    signs = (F.when(F.col(n) == 0, F.col(n).cast("string")) for n, kind in others if kind in ("double", "float"))
    return F.xxhash64(*(name for name, _ in others), *signs)


def long_series(prices: DataFrame, max_rows: int) -> DataFrame:
    """Symbols with more than ``max_rows`` rows."""
    sizes = prices.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
    return sizes.where(F.col("rows") > max_rows).select("symbol")


def _as_planned(rows: DataFrame, name: str) -> DataFrame:
    return rows


def _dealt_to_blocks(
    prices: DataFrame, span: int, keep: Callable[[DataFrame, str], DataFrame] = _as_planned
) -> DataFrame:
    """Rows of long series with their ``position`` and the ``block`` that needs them.

    Equal rows travel as one row with a count. Positions come from cumulative sums on
    three levels: over the months of a symbol, over the cells (date, slice of the
    fingerprint) of a month, and over the rows of one cell. There are as many cells as rows
    ask for, up to 4,096 for a date, so the different rows of a date are spread that far; a
    group of copies is one row until it is written out inside its blocks. A task thus adds
    up a month's cells at most, whatever a symbol holds, and one row for each of its months.

    A row that a block only looks back on has its symbol and the prices of the frames there,
    and nothing else. ``keep`` may write what is read more than once, or from shuffles that
    then need not be there beside those of the rows.
    """
    columns = prices.columns
    cell = ["symbol", "trade_date", "cell"]
    marked = prices.withColumn("tie", _fingerprint(prices)).withColumn(
        "cell", F.shiftright("tie", 64 - _CELL_BITS)
    )
    # Grouping would make one of 0.0 and -0.0; a flag of the sign keeps zeros apart.
    others = [name for name in columns if name not in cell]
    signs = {
        f"minus_{name}": (F.col(name) == 0) & F.startswith(F.col(name).cast("string"), F.lit("-"))
        for name, kind in prices.dtypes
        if kind in ("double", "float") and name in others
    }
    keys = [*cell, "tie", *signs, *others]
    signed = {
        name: F.when(F.col(f"minus_{name}"), -F.abs(F.col(name))).otherwise(F.col(name))
        for name in others if f"minus_{name}" in signs
    }
    runs = keep(marked.withColumns(signs).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")), "long-runs")

    counted = runs.groupBy(*cell).agg(F.sum("copies").alias("cell_rows")).withColumn("month", month_of(F.col("trade_date")))
    earlier_months = Window.partitionBy("symbol").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    months = (
        counted.groupBy("symbol", "month")
        .agg(F.sum("cell_rows").alias("month_rows"))
        .select("symbol", "month", F.coalesce(F.sum("month_rows").over(earlier_months), F.lit(0)).alias("month_start"))
    )
    earlier_cells = (
        Window.partitionBy("symbol", "month").orderBy("trade_date", "cell").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("cell_rows").over(earlier_cells), F.lit(0))
    starts = keep(
        counted.withColumn("before", before).join(months, ["symbol", "month"]).select(
            *cell, (F.col("month_start") + F.col("before")).alias("cell_start")
        ),
        "cell-starts",
    )

    earlier_runs = (
        Window.partitionBy(*cell)
        .orderBy(*keys[len(cell):])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("cell_start") + F.coalesce(
        F.sum("copies").over(earlier_runs), F.lit(0)
    )
    placed = (
        runs.join(starts, cell)
        .withColumn("first", first)
        .withColumn("last", F.col("first") + F.col("copies") - 1)
    )

    block_start = F.col("block") * span
    blocks = F.sequence(
        F.floor(F.col("first") / span), F.floor((F.col("last") + _LOOK_BACK) / span)
    )
    positions = F.sequence(
        F.greatest("first", block_start - _LOOK_BACK), F.least("last", block_start + span - 1)
    )
    # A block looks back on the prices of the rows before it only; their other values stay behind.
    own = F.col("last") >= block_start
    lent = {name: F.when(own, F.col(name)) for name in columns if name not in ("symbol", *_FRAMED)}
    return (
        placed.withColumn("block", F.explode(blocks))
        .withColumns(lent)
        .repartition("symbol", "block")
        .withColumns({"position": F.explode(positions), **signed})
        .select(*columns, "block", "position")
    )


def with_indicators(
    prices: DataFrame,
    max_rows: int = MAX_ROWS_PER_TASK,
    candidates: DataFrame | None = None,
    metadata: DataFrame | None = None,
) -> DataFrame:
    """Clean price rows (each with symbol and date) with the six indicators.

    Series of more than ``max_rows`` rows are cut; which they are is counted first, a
    job over one column. A caller who can tell without reading rows that only some
    series may be that long passes them as ``candidates``, and only those are counted;
    if there are none, nothing is. Without long series the plan is one shuffle by symbol.

    ``metadata``, one row per symbol, is joined as ``companies.enrich`` does, but before
    short and long series are put together again: the short ones are still distributed
    by symbol then, and the long ones are not yet cut.
    """
    columns = prices.columns

    def enriched(rows: DataFrame) -> DataFrame:
        return rows if metadata is None else rows.join(metadata, "symbol", "left")

    def whole(usual: DataFrame) -> DataFrame:
        # Dealt out first, so that the shuffle does not carry the tie, which no codec shortens.
        tied = usual.repartition("symbol").withColumn("tie", _fingerprint(prices))
        return enriched(_with_indicators(tied, ["symbol"], ["trade_date", "tie"], columns))

    def cut(long: DataFrame) -> DataFrame:
        helpers = ["block", "position"]
        rows = _with_indicators(
            _dealt_to_blocks(long, max_rows, materialize), ["symbol", "block"], ["position"],
            [*long.columns, *helpers],
        )
        # a block only reads the rows it shares with the block before
        return rows.where(F.col("position") >= F.col("block") * max_rows).drop(*helpers)

    if candidates is not None:
        if candidates.isEmpty():
            return whole(prices)
        counted = prices.join(candidates, "symbol", "left_semi")
    else:
        counted = prices
    long_symbols = materialize(long_series(counted, max_rows), "long-series")
    if long_symbols.isEmpty():
        return whole(prices)
    long = enriched(prices.join(long_symbols, "symbol", "left_semi"))
    usual = whole(prices.join(long_symbols, "symbol", "left_anti"))
    return usual.unionByName(cut(long))
