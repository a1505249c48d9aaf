import datetime as dt

import pytest

from quotemill.operators.prices import fact_prices, stage_prices, ticker_months
from quotemill.plans import dashboards, marts

FACT = (
    "symbol string, trade_date date, close double, volume bigint, daily_return double,"
    " volatility_30 double, market_category string"
)
DIM = "symbol string, security_name string, market_category string, is_etf boolean"


@pytest.fixture
def fact(spark):
    def build(*rows):
        """Rows of (symbol, date, close, volume, return, volatility, category)."""
        return spark.createDataFrame(list(rows), FACT)

    return build


@pytest.fixture
def dim(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), DIM)

    return build


def day(text):
    return dt.date.fromisoformat(text)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_staging_restates_the_filters(spark):
    columns = "symbol string, trade_date date, close double"
    rows = [
        ("A", day("2001-01-01"), 1.0), ("", day("2001-01-01"), 1.0), (None, day("2001-01-01"), 1.0),
        ("A", None, 1.0), ("A", day("2001-01-02"), None), ("A", day("2001-01-02"), 0.0),
        ("A", day("2001-01-02"), float("nan")),
    ]
    from quotemill import schemas as S

    missing = [c for c in S.STAGED_PRICE_COLUMNS if c not in ("symbol", "trade_date", "close")]
    raw = spark.createDataFrame(rows, columns).selectExpr("*", *(f"null AS {c}" for c in missing))
    staged = stage_prices(raw)
    assert staged.columns == list(S.STAGED_PRICE_COLUMNS) and staged.count() == 1
    assert fact_prices(staged).columns == list(S.FACT_COLUMNS)


def test_segments_drop_rows_without_return_or_category(fact):
    months = ticker_months(fact(
        ("A", day("2001-01-31"), 10.0, 5, None, None, "NYSE"),
        ("A", day("2001-01-30"), 20.0, 7, 0.1, None, "NYSE"),
        ("B", day("2001-01-02"), 40.0, 1, 0.4, 0.2, "NYSE"),
        ("B", day("2001-01-03"), 40.0, 1, 0.1, 0.4, "NYSE"),
        ("C", day("2001-01-03"), 1.0, 1, 9.0, 9.0, None),
        ("D", day("2001-01-03"), 1.0, 1, 9.0, 9.0, ""),
    ))
    row = one(marts.segment_by_month(months))
    assert row.asDict() == {
        "trade_month": day("2001-01-01"), "market_category": "NYSE",
        "avg_daily_return": 0.2,  # over ticker-days, not over ticker means
        "avg_volatility": 0.3, "avg_close": 33.3333, "total_volume": 9, "ticker_count": 2,
    }


def test_market_counts_all_rows_and_ranks_those_with_returns(fact):
    row = one(marts.market_by_month(ticker_months(fact(
        ("A", day("2001-01-02"), 10.0, 5, None, None, None),
        ("B", day("2001-01-02"), 20.0, None, 0.3, 0.1, "NYSE"),
        ("B", day("2001-01-03"), 20.0, 2, 0.1, 0.3, ""),
        ("C", day("2001-01-03"), 30.0, 2, -0.1, None, "NYSE"),
    ))))
    assert row.asDict() == {
        "trade_month": day("2001-01-01"), "avg_close": 20.0, "total_volume": 9,
        "avg_daily_return": 0.1, "avg_volatility": 0.2, "active_ticker_count": 3,
        "top_gainer_symbol": "B", "top_loser_symbol": "C",
    }


def test_month_without_returns_has_totals_and_no_movers(fact):
    months = ticker_months(fact(("A", day("2001-01-02"), 10.0, 5, None, None, "NYSE")))
    row = one(marts.market_by_month(months))
    assert (row.total_volume, row.active_ticker_count, row.avg_daily_return) == (5, 1, None)
    assert row.top_gainer_symbol is None and row.top_loser_symbol is None
    assert marts.monthly_movers(months).isEmpty()


def test_ties_go_to_the_smaller_symbol(fact):
    months = ticker_months(fact(
        ("B", day("2001-01-02"), 1.0, 1, 0.1, None, "x"),
        ("A", day("2001-01-02"), 1.0, 1, 0.1, None, "x"),
        ("D", day("2001-01-02"), 1.0, 1, -0.1, None, "x"),
        ("C", day("2001-01-02"), 1.0, 1, -0.1, None, "x"),
    ))
    row = one(marts.monthly_movers(months))
    assert (row.top_gainer_symbol, row.top_loser_symbol) == ("A", "C")
    assert (row.top_gainer_return, row.top_loser_return) == (0.1, -0.1)


def test_ticker_in_two_categories_is_one_ticker_of_the_market(fact):
    months = ticker_months(fact(
        ("A", day("2001-01-02"), 1.0, 1, 0.3, None, "x"),
        ("A", day("2001-01-02"), 1.0, 1, 0.1, None, "y"),
    ))
    assert one(marts.market_by_month(months)).active_ticker_count == 1
    assert one(marts.monthly_movers(months)).top_gainer_return == 0.2
    assert marts.segment_by_month(months).count() == 2


def test_years_are_annualised_from_the_unrounded_mean(fact):
    row = one(marts.segment_by_year(ticker_months(fact(
        ("A", day("2001-01-02"), 1.0, 1, 0.0010004, None, "x"),
        ("A", day("2001-12-31"), 1.0, 2, 0.0010005, None, "x"),
    ))))
    assert (row.trade_year, row.ticker_count, row.total_volume) == (2001, 1, 3)
    assert row.avg_volatility is None
    assert row.approx_annual_return == round(1.00100045**252 - 1, 4)


EVENTS = [
    ("one", dt.date(2001, 1, 10), dt.date(2001, 2, 5)),
    ("overlapping", dt.date(2001, 2, 5), dt.date(2001, 2, 6)),
    ("no rows", dt.date(1950, 1, 1), dt.date(1950, 12, 31)),
    ("reversed", dt.date(2001, 3, 1), dt.date(2001, 1, 1)),
]


def test_event_bounds_are_inclusive_and_may_overlap(fact):
    rows = [
        ("A", dt.date(2001, 1, 9) + dt.timedelta(days=i), 1.0, 1, 0.1, 0.2, "x") for i in range(40)
    ]
    rows.append(("B", day("2001-02-05"), 1.0, 10, 0.1, None, None))
    rows.append(("C", day("2001-02-05"), 1.0, 10, None, None, None))
    found = {row.event_name: row for row in marts.market_events(fact(*rows), EVENTS).collect()}
    assert set(found) == {"one", "overlapping"}
    assert found["one"].total_volume == 27 + 10 and found["one"].affected_tickers == 2
    assert found["overlapping"].total_volume == 2 + 10
    assert (found["one"].event_duration_days, found["overlapping"].event_duration_days) == (26, 1)


def test_many_events_and_none(fact):
    rows = fact(("A", day("2001-02-05"), 1.0, 1, 0.1, 0.2, "x"))
    many = [(f"e{i}", day("2001-01-01"), day("2001-02-05")) for i in range(60)]
    assert marts.market_events(rows, many).count() == 60
    assert marts.market_events(rows, []).isEmpty()


def test_published_events(fact):
    rows = fact(*(
        ("A", day(text), 1.0, 1, 0.1, 0.2, "x")
        for text in ("1987-09-01", "2002-10-31", "2008-01-01", "2020-01-20", "2020-04-02")
    ))
    found = {row.event_name: row.event_duration_days for row in marts.market_events(rows).collect()}
    assert found == {
        "Black Monday (1987)": 121, "Dot-com Crash (2000–2002)": 974,
        "Financial Crisis (2007–09)": 547, "COVID Crash (2020)": 72,
    }


def test_ranking_wants_a_year_of_listed_stock(fact, dim):
    start = dt.date(2001, 1, 1)
    lengths = {"enough": 252, "short": 251, "etf": 300, "unlisted": 300, "wild": 5000}
    rows = []
    for symbol, length in lengths.items():
        mean = 2.0 if symbol == "wild" else 0.001
        rows.append((symbol, start, 1.0, 1, None, None, "x"))
        rows += [
            (symbol, start + dt.timedelta(days=i + 1), 1.0, 1, mean, 0.1, "x") for i in range(length)
        ]
    rows.append(("short", start + dt.timedelta(days=1), 1.0, 1, 0.001, 0.1, "y"))  # a day twice
    companies = dim(
        *((s, f"{s} inc", "NYSE American", s == "etf") for s in lengths if s != "unlisted")
    )
    ranking = marts.ticker_ranking(ticker_months(fact(*rows)), companies)
    found = {row.symbol: row for row in ranking.collect()}
    assert set(found) == {"enough", "wild"}
    row = found["enough"]
    assert (row.trading_days, row.total_volume, row.market_category) == (252, 252, "NYSE American")
    assert (row.first_trade_date, row.last_trade_date) == (day("2001-01-02"), day("2001-09-10"))
    assert row.approx_total_return == round(1.001**252 - 1, 4)
    assert found["wild"].approx_total_return is None and found["wild"].avg_daily_return == 2.0


def test_volume_of_segments_and_of_left_out_rows_is_that_of_the_market(spark):
    import __spark_entry__ as entry
    from conftest import TESTDATA
    from pyspark.sql import functions as F

    all_rows = entry._fact(spark, TESTDATA)
    months = ticker_months(all_rows)
    left_out = all_rows.where("daily_return is null or market_category is null")
    total = {
        name: df.agg(F.sum(column)).first()[0]
        for name, df, column in (
            ("market", marts.market_by_month(months), "total_volume"),
            ("segments", marts.segment_by_month(months), "total_volume"),
            ("left out", left_out, "volume"),
        )
    }
    assert total["market"] == total["segments"] + total["left out"]


def test_leaderboards_fall_back_to_the_symbol(spark):
    ranking = spark.createDataFrame(
        [("B", None, "x", 0.1), ("A", "Alpha", "x", 0.1), ("C", "Gamma", "x", -0.1)],
        "symbol string, security_name string, market_category string, avg_daily_return double",
    )
    assert [row.label for row in dashboards.best_tickers(ranking).collect()] == ["Alpha", "B", "Gamma"]
    assert [row.symbol for row in dashboards.worst_tickers(ranking, 2).collect()] == ["C", "A"]


def test_panels_filter_and_sort(spark):
    market = spark.createDataFrame(
        [(day("2001-02-01"), 2, "A", "B"), (day("2001-01-01"), 1, "A", "B"), (day("2000-12-01"), 3, "A", "B")],
        "trade_month date, total_volume bigint, top_gainer_symbol string, top_loser_symbol string",
    )
    rows = dashboards.volume_trend(market, day("2001-01-15"), day("2001-02-01")).collect()
    assert [row.total_volume for row in rows] == [1, 2]
    assert dashboards.movers(market, end=day("2000-12-31")).count() == 1
    segments = spark.createDataFrame(
        [(day("2001-01-01"), "x", 0.1, 0.5), (day("2001-02-01"), "x", 0.3, 0.5), (day("2001-01-01"), "y", 0.9, 0.1)],
        "trade_month date, market_category string, avg_daily_return double, avg_volatility double",
    )
    assert [tuple(r) for r in dashboards.return_by_segment(segments).collect()] == [("y", 0.9), ("x", 0.2)]
    assert [r.market_category for r in dashboards.risk_by_segment(segments).collect()] == ["x", "y"]


def test_summaries_have_an_order_of_display(spark):
    ranking = spark.createDataFrame(
        [("B", 0.1), ("C", 0.3), ("A", 0.1)], "symbol string, avg_daily_return double"
    )
    shown = dashboards.in_order(ranking, "agg_top_tickers_alltime").collect()
    assert [row.symbol for row in shown] == ["C", "A", "B"]
    yearly = spark.createDataFrame(
        [(2001, "y"), (2000, "z"), (2001, "x")], "trade_year bigint, market_category string"
    )
    shown = dashboards.segment_years(yearly, 2000, 2001).collect()
    assert [tuple(row) for row in shown] == [(2000, "z"), (2001, "x"), (2001, "y")]
    assert dashboards.segment_years(yearly, 2001).count() == 2
