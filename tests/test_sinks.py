import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from quotemill.sinks.tables import write_by_month, write_by_year, write_flat
from quotemill.sources.tables import scan_processed, within_dates, within_years


@pytest.fixture
def prices(price_rows):
    start = dt.date(2000, 11, 1)
    return price_rows([
        (symbol, start + dt.timedelta(days=i), 10.0 + i) for symbol in "CAB" for i in range(420)
    ])


def same(a, b):
    columns = a.columns
    return a.exceptAll(b.select(columns)).isEmpty() and b.select(columns).exceptAll(a).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_table_round_trip(spark, prices, tmp_path):
    path = str(tmp_path / "t")
    assert write_by_year(prices, path).rows == 1260
    assert sorted(p.name for p in Path(path).glob("year=*")) == ["year=2000", "year=2001"]
    assert same(prices, scan_processed(spark, path))
    assert "year" not in scan_processed(spark, path).columns
    assert write_by_year(prices.limit(10), path).rows == 10  # replaces the old content
    assert scan_processed(spark, path).count() == 10


@pytest.mark.parametrize("limit", [None, 1, 8])
def test_files_per_year(spark, prices, tmp_path, limit):
    path = tmp_path / "t"
    write_by_year(prices.repartition(8), str(path), limit)
    for year in path.glob("year=*"):
        assert len(list(year.glob("*.parquet"))) <= (limit or 8)
    assert same(prices, scan_processed(spark, str(path)))


def test_a_big_year_is_split_over_tasks(spark, prices, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        write_by_year(prices.repartition(8), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "year=2001").glob("*.parquet"))) > 1
    assert same(prices, scan_processed(spark, str(tmp_path / "t")))


def test_years_prune_directories(spark, prices, tmp_path):
    write_by_year(prices, str(tmp_path / "t"))
    rows = within_years(spark.read.parquet(str(tmp_path / "t")), 2001, 2001)
    assert rows.count() == 3 * 359
    assert "PartitionFilters: [isnotnull(year" in plan(rows)


@pytest.mark.parametrize("clustered", [False, True])
def test_month_table_is_pruned_and_clustered(spark, prices, tmp_path, clustered):
    path = str(tmp_path / "t")
    source = prices.coalesce(1) if clustered else prices
    assert write_by_month(source, path, clustered).rows == 1260
    table = spark.read.parquet(path)
    assert same(prices, table)

    rows = within_dates(table, dt.date(2001, 2, 10), dt.date(2001, 3, 5))
    assert rows.count() == 3 * 24
    scan = plan(rows)
    assert "PartitionFilters: [isnotnull(trade_month" in scan
    assert "PushedFilters: [IsNotNull(trade_date), GreaterThanOrEqual(trade_date" in scan
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,A)]" in plan(table.where("symbol = 'A'"))

    for file in Path(path).glob("trade_month=*/*.parquet"):
        keys = pq.ParquetFile(file).read(["symbol", "trade_date"]).to_pylist()
        assert keys == sorted(keys, key=lambda row: (row["symbol"], row["trade_date"]))


def test_flat_table_takes_names_with_blanks(spark, tmp_path):
    rows = spark.createDataFrame([("A", "Alpha")], "Symbol string, `Security Name` string")
    assert write_flat(rows, str(tmp_path / "t")).rows == 1
    assert spark.read.parquet(str(tmp_path / "t")).collect() == rows.collect()


def test_failed_writes_raise(prices, tmp_path):
    broken = prices.selectExpr("*", "raise_error('no') AS boom")
    with pytest.raises(Exception, match="no"):
        write_flat(broken, str(tmp_path / "t"))


def test_failed_writes_leave_the_old_table(spark, prices, tmp_path):
    path = str(tmp_path / "t")
    write_by_year(prices, path)
    with pytest.raises(Exception, match="no"):
        write_by_year(prices.selectExpr("* EXCEPT (volume)", "raise_error('no') AS volume"), path)
    assert same(prices, scan_processed(spark, path))
    assert [p.name for p in tmp_path.iterdir()] == ["t"]  # and nothing beside it
