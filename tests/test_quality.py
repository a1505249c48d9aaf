import datetime as dt
from collections import Counter

import pytest

from quotemill.operators import quality as Q


@pytest.fixture
def tables(spark):
    day = dt.date(2001, 1, 1)
    return {
        "t": spark.createDataFrame(
            [("A", day, "x"), ("A", day, "y"), ("A", day + dt.timedelta(days=1), None),
             ("B", day, "odd"), ("B", day, "odd"), ("B", day, "odd"), (None, day, "x")],
            "symbol string, trade_date date, category string",
        ),
        "p": spark.createDataFrame([("A",), ("C",), (None,)], "symbol string"),
    }


def report(tables, *checks):
    return [(row.failures, row.status) for row in Q.quality_report(tables, checks).collect()]


def test_each_rule_passes_and_fails(tables):
    assert report(tables, *Q.not_null("t", "symbol", "trade_date")) == [(1, "fail"), (0, "pass")]
    assert report(tables, Q.unique("t", "symbol")) == [(2, "fail")]
    assert report(tables, Q.unique("p", "symbol")) == [(0, "pass")]
    assert report(tables, Q.accepted_values("t", "category", ["x", "y"], Q.WARN)) == [(3, "warn")]
    assert report(tables, Q.accepted_values("t", "category", ["x", "y", "odd"])) == [(0, "pass")]
    assert report(tables, Q.relationship("t", "symbol", "p", "symbol", Q.WARN)) == [(3, "warn")]
    assert report(tables, Q.relationship("p", "symbol", "p", "symbol")) == [(0, "pass")]


@pytest.mark.parametrize("key", [("symbol", "trade_date"), ("trade_date", "symbol")])
def test_keys_of_two_columns_count_repeated_keys(tables, key):
    assert report(tables, Q.unique("t", *key)) == [(2, "fail")]
    first_rows = {"t": tables["t"].dropDuplicates(["symbol", "trade_date"])}
    assert report(first_rows, Q.unique("t", *key)) == [(0, "pass")]
    assert report(tables, Q.unique("t", "symbol", "category")) == [(1, "fail")]


def test_empty_tables_pass(tables):
    empty = {name: table.where("false") for name, table in tables.items()}
    checks = (
        *Q.not_null("t", "symbol"), Q.unique("t", "symbol"), Q.unique("t", "symbol", "trade_date"),
        Q.relationship("t", "symbol", "p", "symbol"),
    )
    assert report(empty, *checks) == [(0, "pass")] * 4


def test_only_errors_stop_the_run(tables):
    warning = Q.quality_report(tables, [Q.accepted_values("t", "category", ["x"], Q.WARN)])
    assert [row.status for row in Q.enforce(warning)] == ["warn"]
    with pytest.raises(Q.QualityError, match="t.symbol unique"):
        Q.enforce(Q.quality_report(tables, [Q.unique("t", "symbol")]))


def test_the_published_suite():
    rules = Counter(check.rule for check in Q.MODEL_CHECKS)
    assert rules == {"not_null": 26, "unique": 5, "accepted_values": 1, "relationships": 1}
    warnings = [check.rule for check in Q.MODEL_CHECKS if check.severity == Q.WARN]
    assert sorted(warnings) == ["accepted_values", "relationships"]


def listed(frame):
    return Counter((r.column_name, r.check_name, tuple(sorted(r.key.items(), key=str)), r.value) for r in frame.collect())


def test_violations_are_the_rows_behind_the_counts(tables):
    keys = {"t": ("symbol", "trade_date"), "p": ("symbol",)}
    checks = [
        *Q.not_null("t", "symbol", "category"), Q.accepted_values("t", "category", ["x", "y"]),
        Q.unique("t", "symbol", "trade_date"), Q.relationship("t", "symbol", "p", "symbol", Q.WARN), *Q.not_null("p", "symbol"),
    ]
    found = Q.violations(tables, checks, keys)
    assert found.columns == ["table_name", "column_name", "check_name", "severity", "key", "value"]

    def key(symbol, day):
        return (("symbol", symbol), ("trade_date", day))

    assert listed(found) == Counter({
        ("symbol", "not_null", key(None, "2001-01-01"), None): 1,
        ("category", "not_null", key("A", "2001-01-02"), None): 1,
        ("category", "accepted_values", key("B", "2001-01-01"), "odd"): 3,
        ("symbol, trade_date", "unique", key("A", "2001-01-01"), "2"): 1,
        ("symbol, trade_date", "unique", key("B", "2001-01-01"), "3"): 1,
        ("symbol", "relationships", key("B", "2001-01-01"), "B"): 3,
        ("symbol", "not_null", (("symbol", None),), None): 1,
    })
    counts = Counter((r.table_name, r.column_name, r.check_name) for r in found.collect())
    for row in Q.quality_report(tables, checks).collect():
        assert counts[(row.table_name, row.column_name, row.check_name)] == row.failures


def test_row_rules_of_a_table_are_tagged_in_one_pass(tables):
    checks = [*Q.not_null("t", "symbol", "category"), Q.accepted_values("t", "category", ["x"])]
    plan = Q.violations(tables, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and plan.count("Union") == 0
    # a table without a declared key is named by all its columns
    assert set(Q.violations(tables, checks, {}).first().key) == {"symbol", "trade_date", "category"}
    assert Q.violations({"t": tables["t"].where("false")}, checks).collect() == []


def test_counts_taken_by_the_write_are_not_taken_again(tables):
    checks = [*Q.not_null("t", "symbol"), Q.accepted_values("t", "category", ["x", "y"], Q.WARN), *Q.not_null("p", "symbol")]
    measures = Q.row_measures(checks, "t")
    measured = tables["t"].agg(*(m.alias(name) for name, m in measures.items())).first().asDict()
    whole = Q.quality_report(tables, checks)
    short = Q.quality_report(tables, checks, measured=measured)
    assert sorted(short.collect()) == sorted(whole.collect())
    scans = [f._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") for f in (whole, short)]
    assert scans == [2, 1]


@pytest.mark.parametrize("seed", range(3))
def test_repeated_days_from_the_rollup(spark, seed):
    import random

    from quotemill.operators.prices import merged_days, ticker_months

    random.seed(seed)
    start = dt.date(2001, 1, 25)
    rows = [
        (random.choice(["A", "B", None]), start + dt.timedelta(days=random.randint(0, 40)), random.choice(["x", "y", None]))
        for _ in range(80)
    ]
    extra = ["cast(1 AS double) AS close", "1L AS volume", "cast(null AS double) AS volatility_30", "cast(null AS double) AS daily_return"]
    fact = spark.createDataFrame(rows, "symbol string, trade_date date, market_category string").selectExpr("*", *extra)
    months = ticker_months(fact)
    check = Q.unique("t", "symbol", "trade_date")
    plain = Q.quality_report({"t": fact}, [check])
    quick = Q.quality_report({"t": fact}, [check], months={"t": months})
    assert quick.collect() == plain.collect() and plain.first().failures > 0
    counts = Counter((s, d) for s, d, _ in rows)
    for row in merged_days(months).collect():
        days = {d.day: n for (s, d), n in counts.items() if s == row.symbol and d.replace(day=1) == row.trade_month}
        assert row.days_seen == sum(1 << (d - 1) for d in days)
        assert row.days_twice == sum(1 << (d - 1) for d, n in days.items() if n > 1)
    exchanges = [line for line in quick._jdf.queryExecution().sparkPlan().toString().splitlines() if "Aggregate" in line]
    assert not any("keys=[symbol" in line and "trade_date" in line.split("]")[0] for line in exchanges)
