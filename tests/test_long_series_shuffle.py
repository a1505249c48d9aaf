"""Rows of long series travel as they are, not as texts beside their values."""

import datetime as dt

from quotemill.operators.indicators import _dealt_to_blocks, with_indicators


def test_copies_keep_the_signs_of_zeros_without_texts(spark):
    day = dt.date(2020, 1, 2)
    rows = [("A", day, value) for value in (0.0, -0.0, -0.0, float("nan"), None, 1.5, 1.5)]
    dealt = _dealt_to_blocks(spark.createDataFrame(rows, "symbol string, trade_date date, close double"), 1000)
    assert "text_close" not in dealt._jdf.queryExecution().optimizedPlan().toString()
    found = dealt.collect()
    assert sorted(str(row.close) for row in found) == ["-0.0", "-0.0", "0.0", "1.5", "1.5", "None", "nan"]
    assert sorted(row.position for row in found) == list(range(7))


def test_rows_of_other_blocks_lend_their_prices_only(spark):
    rows = [("A", day_after(n), float(n), float(n), float(n), float(n), n) for n in range(300)]
    names = "symbol string, trade_date date, close double, high double, low double, open double, volume bigint"
    dealt = _dealt_to_blocks(spark.createDataFrame(rows, names), 100).collect()
    for row in dealt:
        assert row.symbol == "A" and row.close == row.high == row.low == row.position
        others = (row.trade_date, row.open, row.volume)
        own = row.position >= row.block * 100
        assert others == ((day_after(row.position), row.position, row.position) if own else (None, None, None))
    kept = sorted((row.block, row.position) for row in dealt if row.position >= row.block * 100)
    assert kept == [(n // 100, n) for n in range(300)]


def test_a_cut_counts_before_it_deals_rows(spark, price_rows):
    """The source and the shuffles of the counts are in no plan that deals rows out."""
    rows = price_rows([("A", day_after(n), 1.0 + n) for n in range(300)])
    found = with_indicators(rows, max_rows=100)
    cut = found._jdf.queryExecution().executedPlan().toString().partition("Union")[2]
    assert "cell_rows" not in cut and "hashpartitioning(symbol#" in cut
    assert sorted(row.trade_date for row in found.collect()) == [day_after(n) for n in range(300)]


def day_after(days):
    return dt.date(2000, 1, 1) + dt.timedelta(days=days)
