"""

Prices and metadata come from the test tables through ``quotemill.sources.testbed``.
Indicator columns are rounded here, not in the operators, because engines sum in
different orders.
"""

from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oracle import ORACLE
from quotemill import schemas as S
from quotemill.operators import cleaning, companies, days, prices, quality, reports
from quotemill.operators.indicators import MAX_ROWS_PER_TASK, with_indicators
from quotemill.plans import dashboards, jobs, marts
from quotemill.session import file_system, materialize, scratch_path
from quotemill.sinks.snapshots import current, read_snapshot, replace_table
from quotemill.sinks.tables import write_by_month, write_by_year, write_flat
from quotemill.sources import testbed
from quotemill.sources.price_files import first_files, scan_prices
from quotemill.sources.tables import (
    literal_events,
    register_views,
    scan_metadata,
    scan_processed,
    scan_table,
    stored_bytes,
    within_dates,
    within_years,
)

try:
    import corpus_pipeline
    from quotemill import llm
    from quotemill.llm import queries as llm_queries
except ImportError:  # the corpus operators and what they import are an optional part
    llm_queries = None
else:
    # Their functions travel with the tasks, so executors need no copy of the package.
    cloudpickle.register_pickle_by_value(llm)

Query = Callable[[SparkSession, str], DataFrame]

AVERAGE_DIGITS = {"moving_avg_30": 6, "moving_avg_60": 6, "volatility_30": 9}
SLICE_START, SLICE_END = dt.date(1997, 1, 1), dt.date(1998, 6, 30)
SLICE_SEGMENT = "NYSE"


def _rounded(df: DataFrame) -> DataFrame:
    digits = {name: n for name, n in AVERAGE_DIGITS.items() if name in df.columns}
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


def _indicators(spark: SparkSession, folder: str) -> DataFrame:
    return with_indicators(
        testbed.market_prices(spark, folder),
        candidates=testbed.long_series_candidates(spark, folder, MAX_ROWS_PER_TASK),
    )


def _indicator_query(*names: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(_indicators(spark, folder).select("symbol", "trade_date", *names))

    return query


def _cut_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """The indicators with every series treated as too long for one task."""
    cut = with_indicators(testbed.market_prices(spark, folder), max_rows=200)
    return _rounded(cut.select("symbol", "trade_date", *S.INDICATOR_COLUMNS))


def _cut_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """As ``prices_enriched``, half of the series short and half cut."""
    prices_ = testbed.market_prices(spark, folder)
    middle = prices_.groupBy("symbol").count().agg(F.percentile("count", 0.5)).first()[0]
    metadata = companies.price_metadata(_raw_metadata(spark, folder))
    return _rounded(with_indicators(prices_, max_rows=int(middle), metadata=metadata))


def _raw_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.market_metadata(spark, folder)


def _staged_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return companies.stage_metadata(_raw_metadata(spark, folder))


def _companies(spark: SparkSession, folder: str) -> DataFrame:
    return companies.company_dimension(_staged_metadata(spark, folder))


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return with_indicators(
        testbed.market_prices(spark, folder),
        candidates=testbed.long_series_candidates(spark, folder, MAX_ROWS_PER_TASK),
        metadata=companies.price_metadata(_raw_metadata(spark, folder)),
    )


def _staged_prices(spark: SparkSession, folder: str) -> DataFrame:
    return prices.stage_prices(_enriched(spark, folder))


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return prices.fact_prices(_staged_prices(spark, folder))


def _months(spark: SparkSession, folder: str) -> DataFrame:
    return prices.ticker_months(_fact(spark, folder))


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return marts.segment_by_month(_months(spark, folder))


def _market(spark: SparkSession, folder: str) -> DataFrame:
    return marts.market_by_month(_months(spark, folder))


def _years(spark: SparkSession, folder: str) -> DataFrame:
    return marts.segment_by_year(_months(spark, folder))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return marts.market_events(_fact(spark, folder), testbed.TEST_EVENTS)


def _day_rollup(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Blocks of days and the trading calendar, written."""
    fact = materialize(_fact(spark, folder), "fact")
    numbers = days.ticker_numbers(fact.select("symbol").distinct())
    by_day = materialize(days.market_days(fact, numbers), "market-days")
    calendar = materialize(days.trading_calendar(by_day), "calendar")
    return materialize(days.day_blocks(by_day, calendar), "day-blocks"), calendar


def _reduced_star(spark: SparkSession, folder: str) -> DataFrame:
    """As ``star_query``, over the fact written by month, cut by symbol before the join."""
    companies_ = materialize(_companies(spark, folder), jobs.COMPANIES)
    return dashboards.reduced_star_slice(_written_months(spark, folder), companies_, SLICE_START, SLICE_END, SLICE_SEGMENT)


def _named_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Days and volume of each company, joined in another session by the names of the tables in buckets."""
    base, database = _modelled(spark, folder), f"models_{uuid.uuid4().hex}"
    jobs.name_models(spark, base, database, buckets=8)
    return spark.newSession().sql(
        f"SELECT d.symbol, d.security_name, count(*) AS days, sum(f.volume) AS volume,"
        f" (SELECT count(*) FROM {database}.{jobs.FACT}) AS all_days"
        f" FROM {database}.{jobs.FACT_BY_SYMBOL} AS f JOIN {database}.{jobs.COMPANIES_BY_SYMBOL} AS d ON f.symbol = d.symbol"
        f" GROUP BY d.symbol, d.security_name"
    )


def _events_from_days(spark: SparkSession, folder: str) -> DataFrame:
    """As ``agg_market_events``, from blocks of days."""
    blocks, calendar = _day_rollup(spark, folder)
    return days.range_totals(blocks, calendar, literal_events(spark, testbed.TEST_EVENTS))


def _many_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Market behaviour in overlapping ranges: one from every third trading day, 1 to 400 days long."""
    blocks, calendar = _day_rollup(spark, folder)
    opened = calendar.withColumn("after", F.lead("before").over(Window.orderBy("date"))).where("after > before AND before % 3 = 0")
    ranges = opened.select(
        F.concat(F.lit("from "), F.col("date").cast("string")).alias("event_name"),
        F.col("date").alias("event_start"),
        F.date_add("date", (F.col("before") * 7 % 400).cast("int")).alias("event_end"),
    )
    return days.range_totals(blocks, calendar, ranges)


def _years_from_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """As ``agg_yearly_performance``, with tickers counted in bitmaps."""
    months = materialize(_months(spark, folder), jobs.TICKER_MONTHS)
    return marts.segment_by_year(months, days.ticker_numbers(months.select("symbol").distinct()))


def _ranking(spark: SparkSession, folder: str) -> DataFrame:
    return marts.ticker_ranking(_months(spark, folder), _companies(spark, folder))


def _cleaned_files(spark: SparkSession, folder: str, defects: bool) -> DataFrame:
    lines = testbed.price_lines(testbed.market_prices(spark, folder), defects)
    globs = testbed.write_price_files(lines, scratch_path(spark, "price-files"))
    return cleaning.clean_prices(scan_prices(spark, globs)).select(
        "symbol", *(short for short, _ in S.PRICE_FILE_COLUMNS.values()), "is_etf"
    )


def _price_files(spark: SparkSession, folder: str) -> DataFrame:
    """Prices written as one CSV per ticker below stocks/ and etfs/, scanned and cleaned."""
    return _cleaned_files(spark, folder, defects=False)


def _dirty_files(spark: SparkSession, folder: str) -> DataFrame:
    """As ``csv_roundtrip``, with spoilt records among the others."""
    return _cleaned_files(spark, folder, defects=True)


def _first_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the first three files of each class, in sample mode."""
    lines = testbed.price_lines(testbed.market_prices(spark, folder))
    globs = testbed.write_price_files(lines, scratch_path(spark, "price-files"))
    paths = [path for glob in globs for path in first_files(spark, glob, 3)]
    return cleaning.clean_prices(scan_prices(spark, paths)).groupBy("symbol", "is_etf").agg(
        F.count(F.lit(1)).alias("price_rows")
    )


def _landed(spark: SparkSession, folder: str) -> tuple[str, list[str]]:
    """A fresh folder with a price file of every ticker and the metadata file; and the globs."""
    base = scratch_path(spark, "jobs")
    lines = testbed.price_lines(testbed.market_prices(spark, folder))
    globs = testbed.write_price_files(lines, base)
    _raw_metadata(spark, folder).write.csv(f"{base}/metadata", header=True)
    return base, globs


def _free(spark: SparkSession, path: str) -> None:
    """Removes a scratch table of this query that no later step reads; it would stay until the driver ends."""
    files, place = file_system(spark, path)
    files.delete(place, True)


@contextmanager
def _processed(spark: SparkSession, folder: str) -> Iterator[str]:
    """The price job over files of all tickers, which go while the next jobs run: they are the largest of all."""
    base, globs = _landed(spark, folder)
    jobs.run_prices(spark, globs, f"{base}/metadata", f"{base}/processed")
    with testbed.removing_price_files(spark, globs):
        yield base


def _load(spark: SparkSession, base: str) -> None:
    """The raw load; the processed table goes, since the raw one has all of it."""
    jobs.run_raw_load(spark, base, f"{base}/processed", f"{base}/metadata")
    _free(spark, f"{base}/processed")


def _loaded(spark: SparkSession, folder: str) -> str:
    """The price job and the raw load over files of all tickers."""
    with _processed(spark, folder) as base:
        _load(spark, base)
    return base


def _modelled(spark: SparkSession, folder: str) -> str:
    """All batch jobs over files of all tickers."""
    with _processed(spark, folder) as base:
        _load(spark, base)
        jobs.build_models(spark, base, testbed.TEST_EVENTS)
    return base


def _job_processed(spark: SparkSession, folder: str) -> DataFrame:
    """The processed table as the price job wrote it."""
    base, globs = _landed(spark, folder)
    jobs.run_prices(spark, globs, f"{base}/metadata", f"{base}/processed")
    return _rounded(scan_processed(spark, f"{base}/processed").select(*S.STAGED_PRICE_COLUMNS))


def _job_raw_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table as the load left it."""
    table = scan_table(spark, _loaded(spark, folder), jobs.RAW_PRICES)
    return _rounded(table.select(*S.STAGED_PRICE_COLUMNS))


def _job_table(name: str, *columns: str) -> Query:
    """A whole table as the jobs wrote it."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        table = scan_table(spark, _modelled(spark, folder), name)
        return _rounded(table.select(*columns) if columns else table)

    return query


def _job_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The checks of the built warehouse, from what its writes measured where they could."""
    return jobs.check_models(spark, _modelled(spark, folder))


def _partial_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Both raw tables after loads of one of them at a time, each onto other content.

    First both are loaded from funds only; then prices alone from all files, and metadata
    alone from all rows.
    """
    base, globs = _landed(spark, folder)
    funds = [glob for glob in globs if "/etfs/" in glob]
    some = f"{base}/some-metadata"
    _raw_metadata(spark, folder).where("ETF = 'Y'").write.csv(some, header=True)
    jobs.run_prices(spark, funds, some, f"{base}/funds")
    jobs.run_raw_load(spark, base, f"{base}/funds", some)
    _free(spark, f"{base}/funds")

    def counted(step: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            scan_table(spark, base, name).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(step).alias("step"), F.lit(name).alias("table_name"), "rows"
            )
            for name in (jobs.RAW_PRICES, jobs.RAW_METADATA)
        ])

    steps = [counted("funds")]
    jobs.run_prices(spark, globs, f"{base}/metadata", f"{base}/processed")
    with testbed.removing_price_files(spark, globs):
        jobs.run_raw_load(spark, base, processed=f"{base}/processed", table="prices")
        _free(spark, f"{base}/processed")
        steps.append(counted("prices"))
        jobs.run_raw_load(spark, base, metadata=f"{base}/metadata", table="meta")
        steps.append(counted("meta"))
    return reduce(DataFrame.unionByName, steps)


def _replaced_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table after a load, after one that failed, after one more, and as opened before that."""
    table = f"{scratch_path(spark, 'replaced')}/companies"
    companies_ = _companies(spark, folder)

    def load(rows: DataFrame) -> None:
        replace_table(spark, table, lambda path: write_flat(rows, path, new=True))

    def seen(step: str, frame: DataFrame) -> DataFrame:
        return frame.select(F.lit(step).alias("step"), "symbol", "security_name", "is_etf")

    load(companies_)
    opened = read_snapshot(spark, table)
    steps = [seen("loaded", opened)]
    broken = F.when(F.col("is_etf"), F.raise_error(F.lit("broken load"))).otherwise(F.col("symbol"))
    try:
        load(companies_.withColumn("symbol", broken))
    except Exception as error:
        if "broken load" not in str(error):
            raise
    steps.append(seen("failed", read_snapshot(spark, table)))
    load(companies_.where("NOT is_etf"))
    steps += [seen("replaced", read_snapshot(spark, table)), seen("opened before", opened)]
    return reduce(DataFrame.unionByName, steps)


def _edge_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking over short and leaping tickers."""
    fact = prices.fact_prices(
        prices.stage_prices(
            with_indicators(
                testbed.edge_prices(spark, folder),
                metadata=companies.price_metadata(_raw_metadata(spark, folder)),
            )
        )
    )
    ranking = marts.ticker_ranking(prices.ticker_months(fact), _companies(spark, folder))
    return ranking.drop("avg_volatility")


def _repeated_days(spark: SparkSession, folder: str) -> DataFrame:
    """Keys found more than once when every tenth ticker's days come three times."""
    rows = testbed.market_prices(spark, folder)
    copies = F.when(F.col("symbol").endswith("0"), 3).otherwise(1)
    thrice = rows.withColumn("n", F.explode(F.sequence(F.lit(1), copies)))
    check = quality.unique("t", "symbol", "trade_date", severity=quality.WARN)
    return quality.quality_report({"t": thrice}, [check])


def _ranked_days(spark: SparkSession, folder: str) -> DataFrame:
    """The best and worst tickers with their places, so that their order is compared."""
    ranking = _ranking(spark, folder)
    order = Window.orderBy("place")
    best = dashboards.best_tickers(ranking).withColumn("place", F.monotonically_increasing_id())
    return best.withColumn("place", F.row_number().over(order)).select("place", "symbol")


def _metadata_file(spark: SparkSession, folder: str) -> DataFrame:
    """Raw metadata written as CSV, scanned again and staged."""
    path = scratch_path(spark, "metadata")
    _raw_metadata(spark, folder).write.csv(path, header=True)
    return companies.stage_metadata(scan_metadata(spark, path))


def _written_years(spark: SparkSession, folder: str, files_per_year: int | None = None) -> DataFrame:
    path = scratch_path(spark, "by-year")
    write_by_year(_enriched(spark, folder), path, files_per_year)
    return spark.read.parquet(path)


def _year_table(files_per_year: int | None = None) -> Query:
    """Enriched prices written by year and read back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        table = _written_years(spark, folder, files_per_year)
        return _rounded(table.drop("year").select(*S.STAGED_PRICE_COLUMNS))

    return query


def _whole_years(spark: SparkSession, folder: str) -> DataFrame:
    """Two whole years of the table by year."""
    years = within_years(_written_years(spark, folder), SLICE_START.year, SLICE_END.year)
    return _rounded(years.drop("year").select(*S.STAGED_PRICE_COLUMNS))


def _written_months(spark: SparkSession, folder: str) -> DataFrame:
    """Fact written by month as the jobs do: by row identity, then clustered as it is."""
    first, second = scratch_path(spark, "by-month"), scratch_path(spark, "by-month")
    fact = materialize(_fact(spark, folder), "fact")
    place = F.col("_metadata.row_index")
    write_by_month(fact, first, row_id=place)
    write_by_month(spark.read.parquet(first).drop("trade_month"), second, clustered=True)
    return spark.read.parquet(second)


def _month_table(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_written_months(spark, folder).select(*S.FACT_COLUMNS))


def _some_months(spark: SparkSession, folder: str) -> DataFrame:
    """A date range of the table by month."""
    rows = within_dates(_written_months(spark, folder), SLICE_START, SLICE_END)
    return _rounded(rows.select(*S.FACT_COLUMNS))


def _flat_table(spark: SparkSession, folder: str) -> DataFrame:
    """Dimension written flat, registered by name and read by SQL."""
    path = scratch_path(spark, "flat")
    write_flat(_companies(spark, folder), path)
    register_views({"companies_written": spark.read.parquet(path)})
    return spark.sql(
        "SELECT market_category, is_etf, count(*) AS companies"
        " FROM companies_written GROUP BY market_category, is_etf"
    )


def _load_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows reported by the two raw loads."""
    return _raw_loads(spark, folder).select("table_name", "rows_loaded")


def _load_report_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows reported by the two raw loads, and whether the bytes are those of their files."""
    return _raw_loads(spark, folder).select("table_name", "rows_loaded", (F.col("bytes") == F.col("found")).alias("bytes_agree"))


def _raw_loads(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "raw-load")
    write_by_year(_enriched(spark, folder), f"{base}/processed")
    _raw_metadata(spark, folder).write.csv(f"{base}/metadata", header=True)
    loaded = jobs.run_raw_load(spark, base, f"{base}/processed", f"{base}/metadata")
    return spark.createDataFrame(
        [(name, report.rows, report.bytes, stored_bytes(spark, current(spark, f"{base}/{name}").folder)) for name, report in loaded.items()],
        "table_name string, rows_loaded bigint, bytes bigint, found bigint",
    )


def _tables(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """All checked tables, and the rollup; the fact and the rollup are written, as in the batch job."""
    staged = materialize(_staged_prices(spark, folder), jobs.STAGED_PRICES)
    fact = prices.fact_prices(staged)
    months = materialize(prices.ticker_months(fact), jobs.TICKER_MONTHS)
    staged_metadata = _staged_metadata(spark, folder)
    dimension = materialize(companies.company_dimension(staged_metadata), jobs.COMPANIES)
    tables = {
        jobs.STAGED_PRICES: staged,
        jobs.STAGED_METADATA: staged_metadata,
        jobs.COMPANIES: dimension,
        jobs.FACT: fact,
        jobs.SEGMENT_MONTHS: marts.segment_by_month(months),
        jobs.MARKET_MONTHS: marts.market_by_month(months),
        jobs.SEGMENT_YEARS: marts.segment_by_year(months),
        jobs.EVENTS: marts.market_events(fact, testbed.TEST_EVENTS),
        jobs.RANKING: marts.ticker_ranking(months, dimension),
    }
    return tables, months


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    """The published checks; the fact's key is checked on the rollup's days."""
    tables, months = _tables(spark, folder)
    return quality.quality_report(tables, jobs.PUBLISHED_CHECKS, months={jobs.FACT: months})


def _repeated_days_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """As ``repeated_days``, from the days of the rollup; two segments may share a ticker's day."""
    fact = _fact(spark, folder)
    copies = F.when(F.col("symbol").endswith("0"), 3).otherwise(1)
    thrice = fact.withColumn("n", F.explode(F.sequence(F.lit(1), copies)))
    moved = thrice.withColumn("market_category", F.when(F.col("n") == 2, "moved").otherwise(F.col("market_category")))
    check = quality.unique("t", "symbol", "trade_date", severity=quality.WARN)
    return quality.quality_report({"t": moved}, [check], months={"t": prices.ticker_months(moved)})


def _violations(spark: SparkSession, folder: str) -> DataFrame:
    """The violating rows of a dirty table of prices and of the dimension, keys as text."""
    tables = {
        "fact_daily_prices": testbed.violating_rows(_fact(spark, folder)),
        "stg_symbols_meta": _staged_metadata(spark, folder),
        "dim_companies": _companies(spark, folder),
    }
    checks = [
        *quality.not_null("fact_daily_prices", "symbol", "close", "volume"),
        quality.accepted_values(
            "fact_daily_prices", "market_category", (*S.COMPANY_CATEGORY_LABELS.values(), S.OTHER_CATEGORY), quality.WARN
        ),
        quality.FACT_KEY_CHECK,
        quality.relationship("fact_daily_prices", "symbol", "dim_companies", "symbol", quality.WARN),
        quality.unique("stg_symbols_meta", "symbol"),
        quality.unique("dim_companies", "symbol"),
    ]
    found = quality.violations(tables, checks)
    key = F.array_join(F.transform(F.array_sort(F.map_entries("key")), lambda e: F.concat(e.key, F.lit("="), e.value)), ",")
    return found.withColumn("key", key)


def _staged_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The staging projection over rows of which some must go."""
    return _rounded(prices.stage_prices(testbed.spoilt_rows(_enriched(spark, folder))))


def _mart_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The key of every row of the five marts, with its place in the order of display."""
    made = {
        jobs.SEGMENT_MONTHS: (_segments, ("trade_month", "market_category")),
        jobs.MARKET_MONTHS: (_market, ("trade_month",)),
        jobs.SEGMENT_YEARS: (_years, ("trade_year", "market_category")),
        jobs.EVENTS: (_events, ("event_name",)),
        jobs.RANKING: (_ranking, ("symbol",)),
    }
    shown = []
    for name, (mart, key) in made.items():
        # Ids follow the order of the rows, though with gaps; places have none.
        ordered = dashboards.in_order(mart(spark, folder), name).withColumn("id", F.monotonically_increasing_id())
        place = F.row_number().over(Window.orderBy("id"))
        shown.append(ordered.select(F.lit(name).alias("mart"), place.alias("place"), F.concat_ws(" ", *key).alias("key")))
    return reduce(DataFrame.unionByName, shown)


def _uri_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each price file, read by a list of globs, by one glob with braces, and by a folder, all as URIs."""
    base, _ = _landed(spark, folder)
    files, place = file_system(spark, base)
    uri = files.makeQualified(place).toString()
    forms = {"list": [f"{uri}/stocks/*.csv", f"{uri}/etfs/*.csv"], "braces": f"{uri}/{{stocks,etfs}}/*.csv", "folders": [f"{uri}/stocks", f"{uri}/etfs"]}
    return reduce(DataFrame.unionByName, [
        scan_prices(spark, paths).groupBy("symbol", "is_etf").agg(F.count(F.lit(1)).alias("price_rows")).withColumn("form", F.lit(form))
        for form, paths in forms.items()
    ])


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    return quality.orphans(
        testbed.market_prices(spark, folder), "symbol", _companies(spark, folder), "symbol"
    )


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the market by month with its best and worst ticker."""
    return _market(spark, "/root/testdata/sf0.001").orderBy("trade_month")


def queries() -> dict[str, Query]:
    corpus = llm_queries.queries() | {"pipeline": corpus_pipeline.run} if llm_queries else {}
    return _price_queries() | corpus


def _price_queries() -> dict[str, Query]:
    return {
        # per-ticker windows
        "daily_return": _indicator_query("close", "daily_return"),
        "moving_averages": _indicator_query("moving_avg_30", "moving_avg_60"),
        "volatility_30": _indicator_query("volatility_30"),
        "week52_range": _indicator_query("week52_high", "week52_low"),
        "indicators_long_series": _cut_indicators,
        "enriched_long_series": _cut_enriched,
        # metadata and star schema
        "meta_staged": _staged_metadata,
        "meta_staged_no_test_issues": lambda spark, folder: companies.stage_metadata(
            _raw_metadata(spark, folder), exclude_test_issues=True
        ),
        "price_metadata": lambda spark, folder: companies.price_metadata(
            _raw_metadata(spark, folder)
        ),
        "dim_companies": _companies,
        "prices_enriched": lambda spark, folder: _rounded(_enriched(spark, folder)),
        "stg_daily_prices": lambda spark, folder: _rounded(_staged_prices(spark, folder)),
        "fact_daily_prices": lambda spark, folder: _rounded(_fact(spark, folder)),
        # marts
        "agg_sector_performance": _segments,
        "agg_monthly_summary": _market,
        "agg_yearly_performance": _years,
        "agg_market_events": _events,
        "agg_market_crash_analysis": lambda spark, folder: marts.market_events(
            _fact(spark, folder)
        ),
        "agg_top_tickers": _ranking,
        "events_from_days": _events_from_days,
        "many_ranges": _many_ranges,
        "years_from_bitmaps": _years_from_bitmaps,
        # dashboard and documented queries
        "ranking_edges": _edge_ranking,
        "ranking_places": _ranked_days,
        "top20": lambda spark, folder: dashboards.best_tickers(_ranking(spark, folder)),
        "bottom20": lambda spark, folder: dashboards.worst_tickers(_ranking(spark, folder)),
        "dash_volume": lambda spark, folder: dashboards.volume_trend(_market(spark, folder)),
        "dash_return_by_segment": lambda spark, folder: _dashboard_mean(
            dashboards.return_by_segment(_segments(spark, folder), SLICE_START, SLICE_END)
        ),
        "dash_risk_by_segment": lambda spark, folder: _dashboard_mean(
            dashboards.risk_by_segment(_segments(spark, folder))
        ),
        "dash_gainers": lambda spark, folder: dashboards.movers(_market(spark, folder)),
        "dash_gainer_returns": lambda spark, folder: marts.monthly_movers(
            _months(spark, folder)
        ),
        "dash_segment_years": lambda spark, folder: dashboards.segment_years(
            _years(spark, folder), 1996, 1999
        ),
        "dash_events": lambda spark, folder: dashboards.event_comparison(_events(spark, folder)),
        "star_query": lambda spark, folder: dashboards.star_slice(
            _fact(spark, folder), _companies(spark, folder), SLICE_START, SLICE_END, SLICE_SEGMENT
        ),
        "star_reduced": _reduced_star,
        "named_tables": _named_tables,
        "row_count": lambda spark, folder: dashboards.row_count(_fact(spark, folder)),
        # reports and checks
        "run_report": lambda spark, folder: reports.run_report(_enriched(spark, folder)),
        "sample_rows": lambda spark, folder: _rounded(
            reports.sample_rows(_enriched(spark, folder))
        ),
        "dq_report": _quality,
        "dq_violations": _violations,
        "staged_filter": _staged_filter,
        "mart_orders": _mart_orders,
        "orphan_symbols": _orphans,
        "repeated_days": _repeated_days,
        "repeated_days_rollup": _repeated_days_rollup,
        # the batch jobs, from files to checked tables
        "job_processed": _job_processed,
        "job_raw_prices": _job_raw_prices,
        "job_companies": _job_table(jobs.COMPANIES),
        "job_fact": _job_table(jobs.FACT, *S.FACT_COLUMNS),
        "job_sector": _job_table(jobs.SEGMENT_MONTHS),
        "job_market": _job_table(jobs.MARKET_MONTHS),
        "job_yearly": _job_table(jobs.SEGMENT_YEARS),
        "job_events": _job_table(jobs.EVENTS),
        "job_ranking": _job_table(jobs.RANKING),
        "job_checks": _job_checks,
        # sources and sinks
        "csv_roundtrip": _price_files,
        "dirty_files": _dirty_files,
        "first_files": _first_files,
        "metadata_csv": _metadata_file,
        "parquet_by_year": _year_table(),
        "parquet_files_per_year": _year_table(files_per_year=2),
        "parquet_pruned_years": _whole_years,
        "parquet_by_month": _month_table,
        "parquet_pruned_months": _some_months,
        "flat_table_sql": _flat_table,
        "load_report": _load_report,
        "load_report_bytes": _load_report_bytes,
        "uri_scan": _uri_scan,
        "replaced_table": _replaced_table,
        "partial_reload": _partial_reload,
    }


def _dashboard_mean(df: DataFrame) -> DataFrame:
    """Means of monthly figures, rounded for the comparison between engines."""
    metric = df.columns[1]
    return df.withColumn(metric, F.round(metric, 9))


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE) | (llm_queries.oracle_sql() if llm_queries else {})
