import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from quotemill.operators import days
from quotemill.plans import marts
from quotemill.session import materialize

FACT = "symbol string, trade_date date, daily_return double, volatility_30 double, volume bigint"
EVENTS = "event_name string, event_start date, event_end date"
START = dt.date(2000, 1, 3)


def some_fact(seed, rows=900, span=300, symbols=40):
    chance = random.Random(seed)
    open_days = [START + dt.timedelta(days=i) for i in range(span) if i % 7 < 5]
    return [
        (f"S{chance.randint(1, symbols)}", chance.choice(open_days), chance.choice([None, chance.uniform(-1, 1)]),
         chance.choice([None, chance.uniform(0, 1)]), chance.choice([None, chance.randint(1, 99)]))
        for _ in range(rows)
    ]


def some_events(seed, count, span=300):
    chance = random.Random(seed)
    events = []
    for i in range(count):
        first = START + dt.timedelta(days=chance.randint(-40, span + 20))
        events.append((f"e{i}", first, first + dt.timedelta(days=chance.randint(0, 200))))
    return events


def rollup(spark, rows):
    fact = spark.createDataFrame(rows, FACT)
    numbers = days.ticker_numbers(fact.select("symbol").distinct())
    by_day = materialize(days.market_days(fact, numbers), "days")
    calendar = materialize(days.trading_calendar(by_day), "calendar")
    return materialize(days.day_blocks(by_day, calendar), "blocks"), calendar


def plain(rows, events):
    out = {}
    for name, first, last in events:
        own = [r for r in rows if first <= r[1] <= last and r[2] is not None]
        if own:
            risks = [r[3] for r in own if r[3] is not None]
            volumes = [r[4] for r in own if r[4] is not None]
            out[name] = (
                sum(r[2] for r in own) / len(own), sum(risks) / len(risks) if risks else None,
                sum(volumes) if volumes else None, len({r[0] for r in own}), (last - first).days,
            )
    return out


def same(got, want):
    assert set(got) == set(want)
    for name, row in want.items():
        for a, b in zip(got[name], row, strict=True):
            assert a == b if a is None or b is None else math.isclose(a, b, abs_tol=1.1e-6)


def told(frame):
    return {
        r.event_name: (r.avg_daily_return, r.avg_volatility, r.total_volume, r.affected_tickers, r.event_duration_days)
        for r in frame.collect()
    }


@pytest.mark.parametrize("seed", range(2))
def test_ten_thousand_overlapping_ranges(spark, seed):
    rows, events = some_fact(seed), some_events(seed, 10_000)
    blocks, calendar = rollup(spark, rows)
    frame = spark.createDataFrame(events, EVENTS)
    got = told(days.range_totals(blocks, calendar, frame))
    checked = events if seed == 0 else events[:500]
    same({n: got[n] for n in got if int(n[1:]) < len(checked)}, plain(rows, checked))


def test_a_range_is_a_few_blocks(spark):
    """At most two of each level, side by side, and together the range."""
    spans = [(a, b) for a in range(70) for b in range(a, 70)]
    frame = spark.createDataFrame(spans, "a bigint, b bigint")
    for row in frame.select("a", "b", days._pieces(F.col("a"), F.col("b"), 70).alias("pieces")).collect():
        covered = sorted(day for p in row.pieces for day in range(p.block << p.level, (p.block + 1) << p.level))
        assert covered == list(range(row.a, row.b))
        assert len(row.pieces) <= 2 * max(1, (row.b - row.a).bit_length())


def test_agrees_with_the_range_join(spark):
    rows, events = some_fact(7), some_events(7, 30)
    fact = spark.createDataFrame(rows, FACT)
    blocks, calendar = rollup(spark, rows)
    same(told(days.range_totals(blocks, calendar, spark.createDataFrame(events, EVENTS))), told(marts.market_events(fact, events)))


def test_a_value_that_is_not_finite_stays_in_its_ranges(spark):
    rows = [*((f"S{i}", START + dt.timedelta(days=i), 0.5, 0.1, 1) for i in range(40)), ("X", START + dt.timedelta(days=20), float("nan"), 0.1, 1)]
    blocks, calendar = rollup(spark, rows)
    events = [("before", START, START + dt.timedelta(days=19)), ("with", START, START + dt.timedelta(days=20)), ("after", START + dt.timedelta(days=21), dt.date(2001, 1, 1))]
    got = told(days.range_totals(blocks, calendar, spark.createDataFrame(events, EVENTS)))
    assert got["before"][0] == got["after"][0] == 0.5 and math.isnan(got["with"][0])


def test_empty_fact_and_ranges_outside_it(spark):
    blocks, calendar = rollup(spark, [])
    events = spark.createDataFrame(some_events(1, 5), EVENTS)
    assert days.range_totals(blocks, calendar, events).collect() == []
    blocks, calendar = rollup(spark, some_fact(3))
    outside = [("early", dt.date(1990, 1, 1), dt.date(1990, 2, 1)), ("late", dt.date(2020, 1, 1), dt.date(2020, 2, 1)), ("turned", START + dt.timedelta(days=9), START)]
    assert days.range_totals(blocks, calendar, spark.createDataFrame(outside, EVENTS)).collect() == []


def test_tickers_over_several_bitmaps(spark, monkeypatch):
    """More tickers than one bitmap and one task hold."""
    monkeypatch.setattr(days, "_TICKERS_PER_TASK", 30_000)
    fact = spark.range(70_000).selectExpr(
        "concat('S', id) AS symbol", "date_add(DATE '2000-01-03', CAST(id % 3 AS INT)) AS trade_date",
        "0.5D AS daily_return", "0.1D AS volatility_30", "1L AS volume",
    )
    numbers = days.ticker_numbers(fact.select("symbol"))
    assert numbers.select("ticker").distinct().count() == 70_000
    by_day = materialize(days.market_days(fact, numbers), "days")
    calendar = materialize(days.trading_calendar(by_day), "calendar")
    blocks = days.day_blocks(by_day, calendar)
    event = spark.createDataFrame([("all", START, START + dt.timedelta(days=2)), ("one", START, START)], EVENTS)
    got = told(days.range_totals(blocks, calendar, event))
    assert got["all"][3] == 70_000 and got["one"][3] == 23_334


def test_years_count_tickers_with_one_large_shuffle(spark):
    months = spark.createDataFrame(
        [(f"S{i % 50}", dt.date(2000 + i % 3, 1 + i % 12, 1), f"c{i % 4}", i % 5) for i in range(2000)],
        "symbol string, trade_month date, market_category string, return_count bigint",
    )
    numbers = days.ticker_numbers(months.select("symbol").distinct())
    plain_ = months.where("return_count > 0").groupBy(F.year("trade_month").cast("bigint").alias("trade_year"), "market_category").agg(
        F.count_distinct("symbol").alias("ticker_count")
    )
    got = days.tickers_by_year(months, numbers)
    assert sorted(got.collect()) == sorted(plain_.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "symbol" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning(trade_year" in line)
