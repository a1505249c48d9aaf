import datetime as dt
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quotemill.operators import indicators
from quotemill.operators.indicators import long_series, with_indicators


def brute(rows):
    """Indicators of one series by definition; rows are (close, high, low) in order."""
    returns, out = [], []
    for i, (close, _, _) in enumerate(rows):
        before = rows[i - 1][0] if i else None
        returns.append((close - before) / before if before else None)

        def frame(values, length):
            return [v for v in values[max(0, i - length + 1): i + 1] if v is not None]

        closes = [row[0] for row in rows]
        highs = frame([row[1] for row in rows], 252)
        lows = frame([row[2] for row in rows], 252)
        recent = frame(returns, 30)
        out.append(
            (
                returns[i],
                statistics.fmean(frame(closes, 30)),
                statistics.fmean(frame(closes, 60)),
                statistics.stdev(recent) if len(recent) > 1 else None,
                max(highs) if highs else None,
                min(lows) if lows else None,
            )
        )
    return out


def random_series(seed, count):
    rng = random.Random(seed)
    rows, close = [], 50.0
    for _ in range(count):
        close *= 1 + rng.uniform(-0.05, 0.05)
        high = None if rng.random() < 0.05 else close * 1.01
        low = None if rng.random() < 0.05 else close * 0.99
        rows.append((close, high, low))
    return rows


@pytest.fixture
def two_series(price_rows, business_days):
    series = {"A": random_series(1, 620), "B": random_series(2, 290)}
    rows = [
        (symbol, day, close, high, low)
        for symbol, values in series.items()
        for day, (close, high, low) in zip(business_days(len(values)), values)
    ]
    random.Random(3).shuffle(rows)
    return series, price_rows(rows)


def assert_matches(result, series):
    rows = result.select("symbol", "trade_date", *indicators.S.INDICATOR_COLUMNS)
    by_symbol = {symbol: [] for symbol in series}
    for row in rows.orderBy("symbol", "trade_date").collect():
        by_symbol[row.symbol].append(tuple(row)[2:])
    for symbol, values in series.items():
        want = brute(values)
        assert len(by_symbol[symbol]) == len(want)
        for got, expected in zip(by_symbol[symbol], want):
            for ours, theirs in zip(got, expected):
                if theirs is None:
                    assert ours is None
                else:
                    assert ours == pytest.approx(theirs, rel=1e-10, abs=1e-13)


def test_frames_by_definition(two_series):
    series, prices = two_series
    assert_matches(with_indicators(prices), series)


@pytest.mark.parametrize("max_rows", [300, 97, 500])
def test_cutting_long_series_changes_nothing(two_series, max_rows):
    """300 cuts one of the series, 97 both and below the look-back, 500 barely one."""
    series, prices = two_series
    assert_matches(with_indicators(prices, max_rows), series)


def test_long_series_are_those_above_the_limit(two_series):
    _, prices = two_series
    assert [row.symbol for row in long_series(prices, 290).collect()] == ["A"]
    assert long_series(prices, 620).isEmpty()


def test_only_candidates_are_counted_and_cut(two_series, spark):
    series, prices = two_series
    listed = spark.createDataFrame([("B",), ("not there",)], "symbol string")
    assert_matches(with_indicators(prices, 100, listed), series)
    assert_matches(with_indicators(prices, 100, listed.where("false")), series)


def test_signed_zeros_and_nan_survive_the_cut(price_rows):
    day = dt.date(2001, 1, 1)
    rows = [("A", day + dt.timedelta(days=i), 5.0 + i % 3, (-0.0, 0.0, float("nan"), None, 1.5)[i % 5], -0.0 if i % 2 else 0.0) for i in range(120)]
    rows += [("A", day, 5.0, -0.0, -0.0)] * 3
    prices = price_rows(rows)
    text = [f"cast({c} AS string) AS {c}" for c in ("symbol", "trade_date", "high", "low", "week52_low", "week52_high")]
    whole, cut = (with_indicators(prices, n).selectExpr(text) for n in (1000, 30))
    assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()
    assert whole.where("high = '-0.0'").count() > 20


def test_copies_and_repeated_dates_survive_the_cut(price_rows):
    """A third of all rows are copies of one row; the cut result equals the whole one."""
    day = dt.date(2001, 1, 1)
    rows = [("A", day + dt.timedelta(days=i), 10.0 + i % 7) for i in range(200)]
    rows += [("A", day + dt.timedelta(days=50), 12.5)] * 400
    rows += [("A", day + dt.timedelta(days=60), 20.0 + i) for i in range(300)]
    rows += [("B", day + dt.timedelta(days=i), 5.0 + i % 3) for i in range(40)]
    prices = price_rows(rows)
    digits = [c if c in prices.columns else f"round({c}, 9) AS {c}"
              for c in with_indicators(prices).columns]
    whole = with_indicators(prices).selectExpr(digits)
    cut = with_indicators(prices, 64).selectExpr(digits)
    assert cut.count() == len(rows)
    assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()


def test_row_order_and_other_tickers_do_not_matter(two_series):
    _, prices = two_series
    names = ["symbol", "trade_date", *indicators.S.INDICATOR_COLUMNS]
    alone = with_indicators(prices.where("symbol = 'A'").repartition(5)).select(names)
    among = with_indicators(prices.coalesce(1)).where("symbol = 'A'").select(names)
    assert alone.exceptAll(among).isEmpty() and among.exceptAll(alone).isEmpty()


def test_first_rows_and_gaps(price_rows):
    rows = [
        ("A", dt.date(2001, 1, 1), 10.0),
        ("A", dt.date(2002, 6, 1), 11.0),  # frames count rows, so the gap is nothing special
        ("A", dt.date(2002, 6, 2), 11.0),
    ]
    first, second, third = with_indicators(price_rows(rows)).orderBy("trade_date").collect()
    assert first.daily_return is None and first.volatility_30 is None
    assert first.moving_avg_30 == 10.0 and first.week52_high == 10.0
    assert second.daily_return == pytest.approx(0.1) and second.volatility_30 is None
    assert second.moving_avg_60 == 10.5
    assert third.daily_return == 0.0
    assert third.volatility_30 == pytest.approx(statistics.stdev([0.1, 0.0]))
    assert "prev_close" not in first.asDict()


def test_no_return_after_a_close_that_is_not_positive(price_rows):
    rows = [("A", dt.date(2001, 1, 1), 0.0), ("A", dt.date(2001, 1, 2), 5.0)]
    assert with_indicators(price_rows(rows)).where("daily_return is not null").isEmpty()


@settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(
    closes=st.lists(st.floats(0.01, 1e4), min_size=1, max_size=330),
    max_rows=st.integers(5, 400),
)
def test_any_series_any_cut(price_rows, business_days, closes, max_rows):
    values = [(close, close, close) for close in closes]
    prices = price_rows(
        [("A", day, close) for day, close in zip(business_days(len(closes)), closes)]
    )
    assert_matches(with_indicators(prices, max_rows), {"A": values})
