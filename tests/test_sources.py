import datetime as dt

import pytest

from quotemill.operators.cleaning import clean_prices, combine
from quotemill.sources.price_files import (
    first_files,
    long_series_candidates,
    scan_prices,
)
from quotemill.sources.tables import listing, scan_metadata

HEADER = "Date,Open,High,Low,Close,Adj Close,Volume\n"
GOOD = "2020-01-02,1,2,0.5,1.5,1.5,100\n"


def write(folder, name, *lines, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(header + "".join(lines))


def test_malformed_records_are_dropped_whatever_the_query_reads(spark, tmp_path):
    write(
        tmp_path / "stocks", "A.csv",
        GOOD,
        "2020-01-03,xx,2,0.5,1.6,1.6,100\n",  # bad number in a column few queries read
        "2020-01-06,1,2,0.5,1.7,1.7,100.0\n",  # volume is not a whole number
        "2020-01-07,1,2,0.5,1.7,1.7, 100\n",  # nor is a padded one
        "2020-01-09,1,2,0.5,3\n",  # too few fields
        "2020-01-10,1,2,0.5,3,3,100,extra\n",  # too many
        "2020-01-13,,,,2.5,,\n",  # missing values are not malformed
        "bad,1,2,0.5,1.7,1.7,100\n",  # the date is text at this point
    )
    scan = scan_prices(spark, f"{tmp_path}/stocks/*.csv")
    assert scan.count() == 3
    assert scan.select("symbol").count() == 3
    assert len(scan.select("Close").collect()) == 3
    assert sorted(row.Date for row in scan.collect()) == ["2020-01-02", "2020-01-13", "bad"]


def test_cleaning_drops_unusable_rows_without_exceptions(spark, tmp_path):
    write(
        tmp_path / "stocks", "A.csv",
        GOOD,
        "bad,1,2,0.5,1.7,1.7,100\n",
        "2020-02-30,1,2,0.5,1.7,1.7,100\n",
        "2020-01-03,1,2,0.5,,1.7,100\n",
        "2020-01-06,1,2,0.5,0,1.7,100\n",
        "2020-01-07,1,2,0.5,-1,1.7,100\n",
        "2020-01-08,1,2,0.5,NaN,1.7,100\n",
        "2020-01-09,,,,1.7,,\n",
    )
    rows = clean_prices(scan_prices(spark, f"{tmp_path}/stocks/*.csv")).orderBy("trade_date")
    assert rows.columns == [
        "trade_date", "open", "high", "low", "close", "adj_close", "volume", "is_etf", "symbol",
    ]
    assert [(row.trade_date, row.close, row.volume) for row in rows.collect()] == [
        (dt.date(2020, 1, 2), 1.5, 100),
        (dt.date(2020, 1, 9), 1.7, None),
    ]
    assert clean_prices(scan_prices(spark, f"{tmp_path}/stocks/*.csv")).count() == 2


def test_symbol_and_asset_class_come_from_the_path(spark, tmp_path):
    for name in ("BRK.B.csv", "A B+C.csv", "50%.csv"):
        write(tmp_path / "stocks", name, GOOD)
    write(tmp_path / "etfs", "SPY.csv", GOOD)
    both = combine(
        scan_prices(spark, f"{tmp_path}/stocks/*.csv"), scan_prices(spark, f"{tmp_path}/etfs/*.csv")
    )
    found = {row.symbol: row.is_etf for row in both.collect()}
    assert found == {"BRK.B": False, "A B+C": False, "50%": False, "SPY": True}


def test_one_scan_of_both_directories_equals_the_union(spark, tmp_path):
    write(tmp_path / "stocks", "A.csv", GOOD)
    write(tmp_path / "etfs", "A.csv", GOOD)
    globs = [f"{tmp_path}/stocks/*.csv", f"{tmp_path}/etfs/*.csv"]
    union = combine(*(scan_prices(spark, glob) for glob in globs))
    assert sorted(scan_prices(spark, globs).collect()) == sorted(union.collect())
    assert union.count() == 2  # the same ticker in both directories keeps both rows


def test_sample_takes_the_first_files_by_name(spark, tmp_path):
    for name in ("C.csv", "A.csv", "B [x].csv"):
        write(tmp_path / "stocks", name, GOOD)
    glob = f"{tmp_path}/stocks/*.csv"
    sample = scan_prices(spark, first_files(spark, glob, 2))
    assert sorted(row.symbol for row in sample.collect()) == ["A", "B [x]"]
    assert len(first_files(spark, glob, 5)) == 3


def test_sample_of_an_empty_glob_is_an_error(spark, tmp_path):
    (tmp_path / "stocks").mkdir()
    with pytest.raises(FileNotFoundError):
        first_files(spark, f"{tmp_path}/stocks/*.csv", 2)


def test_long_series_are_recognised_by_file_length(spark, tmp_path):
    write(tmp_path / "stocks", "LONG+1.csv", *[GOOD] * 50)
    write(tmp_path / "stocks", "SHORT.csv", GOOD)
    found = long_series_candidates(listing(spark, f"{tmp_path}/stocks/*.csv"), 40)
    assert [row.symbol for row in found.collect()] == ["LONG+1"]


def test_metadata_is_text_by_header_name(spark, tmp_path):
    write(
        tmp_path, "meta.csv", 'SPY,"Trust, S&P",100\n', "B,,\n",
        header="Symbol,Security Name,Round Lot Size\n",
    )
    rows = scan_metadata(spark, f"{tmp_path}/meta.csv")
    assert set(dict(rows.dtypes).values()) == {"string"}
    assert [tuple(row) for row in rows.orderBy("Symbol").collect()] == [
        ("B", None, None), ("SPY", "Trust, S&P", "100"),
    ]
