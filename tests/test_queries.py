import pytest

import __spark_entry__ as entry
from compare import connect, differences
from conftest import TESTDATA
from quotemill.sources import testbed


@pytest.fixture(scope="module")
def connection():
    return connect(TESTDATA)


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_equals_its_sql(spark, connection, name):
    rows, found = differences(spark, connection, TESTDATA, name)
    assert not found and rows > 0


def test_every_price_query_has_sql():
    assert set(entry._price_queries()) == set(entry.ORACLE)


@pytest.mark.parametrize("folder_kind", ["defects", "edges"])
def test_every_filter_drops_something(spark, connection, folder_kind):
    if folder_kind == "defects":
        kinds = connection.sql(
            entry.ORACLE["dirty_files"].replace(
                "SELECT * FROM dirty", "SELECT DISTINCT (date_diff('day', DATE '1990-01-01', trade_date) * 31"
                " + CAST(right(symbol, 9) AS INTEGER)) % 40 AS kind FROM prices",
            )
        ).fetchall()
        assert {k for (k,) in kinds} >= set(range(len(testbed.DEFECTS)))
    else:
        ranking = entry.queries()["ranking_edges"](spark, TESTDATA).collect()
        everyone = entry.queries()["agg_top_tickers"](spark, TESTDATA).count()
        assert 0 < len(ranking) < everyone  # short tickers are left out
        assert any(r.approx_total_return is None for r in ranking)  # the power overflows
        assert any(r.approx_total_return is not None for r in ranking)


def test_flagship(spark):
    assert entry.entry(spark).count() == 83
