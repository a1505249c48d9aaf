from quotemill.operators.companies import (
    company_dimension,
    enrich,
    price_metadata,
    stage_metadata,
)

import datetime as dt

import pytest

COLUMNS = (
    "Nasdaq Traded", "Symbol", "Security Name", "Listing Exchange", "Market Category", "ETF",
    "Round Lot Size", "Test Issue", "Financial Status", "CQS Symbol", "NASDAQ Symbol",
    "NextShares",
)


@pytest.fixture
def metadata(spark):
    def build(*rows):
        default = dict(zip(COLUMNS, ("Y", "X", "Name", "Q", "Q", "N", "100", "N", "N", "X", "X", "N")))
        full = [tuple({**default, **row}[name] for name in COLUMNS) for row in rows]
        return spark.createDataFrame(full, ", ".join(f"`{name}` string" for name in COLUMNS))

    return build


def labels(df):
    return {row.symbol: row.market_category for row in df.collect()}


def test_two_vocabularies_of_categories(metadata):
    codes = {"q": "Q", "g": " G", "s": "S ", "n": "N", "a": "A", "blank": " ", "odd": "Z", "none": None}
    raw = metadata(*({"Symbol": s, "Market Category": c} for s, c in codes.items()))
    common = {
        "q": "NASDAQ Global Select Market", "g": "NASDAQ Global Market",
        "s": "NASDAQ Capital Market", "n": "NYSE", "blank": "Other", "odd": "Other", "none": "Other",
    }
    assert labels(price_metadata(raw)) == {**common, "a": "Other"}
    assert labels(company_dimension(stage_metadata(raw))) == {**common, "a": "NYSE American"}


def test_staging_trims_types_and_keeps_duplicates(metadata):
    raw = metadata(
        {"Symbol": " A ", "Security Name": " Alpha ", "ETF": "Y", "Test Issue": "Y"},
        {"Symbol": "A", "Round Lot Size": "10.5", "NextShares": "?"},
        {"Symbol": "  "},
        {"Symbol": None},
    )
    staged = stage_metadata(raw)
    first = staged.where("security_name = 'Alpha'").first()
    assert staged.count() == 2
    assert (first.symbol, first.is_etf, first.is_test_issue) == ("A", True, True)
    other = staged.where("security_name = 'Name'").first()
    assert (other.round_lot_size, other.is_nextshares, other.is_etf) == (10.5, None, False)
    assert stage_metadata(raw, exclude_test_issues=True).count() == 1


def test_dimension_keeps_the_first_name(metadata):
    raw = metadata(
        {"Symbol": "R", "Security Name": "B", "Market Category": "Q"},
        {"Symbol": "R", "Security Name": "A", "Market Category": "N", "Financial Status": "D"},
        {"Symbol": "T", "Security Name": "Z"},
        {"Symbol": "T", "Security Name": None},
    )
    rows = {row.symbol: row for row in company_dimension(stage_metadata(raw)).collect()}
    assert (rows["R"].security_name, rows["R"].market_category, rows["R"].financial_status) == (
        "A", "NYSE", "D",
    )
    assert rows["T"].security_name is None  # NULL sorts first
    assert labels(price_metadata(raw))["R"] == "NYSE"


def test_dimension_does_not_depend_on_row_order(metadata):
    rows = [{"Symbol": "R", "Security Name": "A", "CQS Symbol": str(i), "Round Lot Size": str(i)}
            for i in range(20)]
    there = company_dimension(stage_metadata(metadata(*rows).repartition(7))).collect()
    back = company_dimension(stage_metadata(metadata(*reversed(rows)).coalesce(1))).collect()
    assert there == back and len(there) == 1


def test_unlisted_prices_stay_with_nulls(metadata, price_rows):
    prices = price_rows([("X", dt.date(2001, 1, 1), 1.0), ("gone", dt.date(2001, 1, 1), 1.0)])
    found = {row.symbol: row for row in enrich(prices, price_metadata(metadata({}))).collect()}
    assert found["X"].market_category == "NASDAQ Global Select Market"
    assert found["X"].etf_flag == "N"
    assert found["gone"].market_category is None and found["gone"].security_name is None


def test_staging_strips_white_space_of_any_kind_and_prices_blanks_only(spark):
    names = [
        "Symbol", "Security Name", "Listing Exchange", "Market Category", "Financial Status", "CQS Symbol",
        "NASDAQ Symbol", "ETF", "Nasdaq Traded", "Test Issue", "NextShares", "Round Lot Size",
    ]
    row = ["\t AAA\u00a0", "\u2003Alpha x\n", "Q", "Q\t", "N", "A", "A", "N", "Y", "N", "N", "100"]
    raw = spark.createDataFrame([row], ", ".join(f"`{n}` string" for n in names))
    staged = stage_metadata(raw).first()
    assert (staged.symbol, staged.security_name, staged.market_category_code) == ("AAA", "Alpha x", "Q")
    assert price_metadata(raw).first().symbol == "\t AAA\u00a0"
