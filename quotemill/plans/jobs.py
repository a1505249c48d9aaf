"""Batch jobs: prices, raw load, models. Tables hand over from one to the next."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.operators import companies, days, prices, quality, reports
from quotemill.operators.cleaning import clean_prices
from quotemill.operators.indicators import MAX_ROWS_PER_TASK, with_indicators
from quotemill.plans import marts
from quotemill.session import freed_shuffles, materialize, sized_shuffles
from quotemill.sinks.catalog import name_tables, write_buckets
from quotemill.sinks.snapshots import current, replace_table
from quotemill.sinks.tables import LoadReport, write_by_month, write_by_year, write_flat
from quotemill.sources.price_files import first_files, long_series_candidates, scan_portions
from quotemill.sources.tables import (
    Located,
    listing,
    literal_events,
    locate,
    register_views,
    scan_metadata,
    scan_processed,
    scan_table,
    stored_bytes,
    total_bytes,
)

# --- fixed values: table names ------------------------------------------------------
RAW_PRICES = "raw_daily_prices"
RAW_METADATA = "raw_symbols_meta"
STAGED_PRICES = "stg_daily_prices"
STAGED_METADATA = "stg_symbols_meta"
COMPANIES = "dim_companies"
FACT = "fact_daily_prices"
SEGMENT_MONTHS = "agg_sector_performance"
MARKET_MONTHS = "agg_monthly_summary"
SEGMENT_YEARS = "agg_yearly_performance"
EVENTS = "agg_market_crash_analysis"
RANKING = "agg_top_tickers_alltime"
# Ours: the rollup most marts are computed from.
TICKER_MONTHS = "ticker_months"
# Ours: what date ranges are answered from.
TICKER_NUMBERS = "ticker_numbers"
CALENDAR = "trading_calendar"
DAY_BLOCKS = "day_blocks"
# Ours: copies in buckets of the symbol.
FACT_BY_SYMBOL = "fact_by_symbol"
COMPANIES_BY_SYMBOL = "companies_by_symbol"

WRITTEN_TABLES = (
    RAW_PRICES, RAW_METADATA, COMPANIES, FACT, TICKER_MONTHS, TICKER_NUMBERS, CALENDAR, DAY_BLOCKS,
    SEGMENT_MONTHS, MARKET_MONTHS, SEGMENT_YEARS, EVENTS, RANKING,
)

# Independent models written at a time, as many as the source's scheduler runs.
MODELS_AT_ONCE = 4
PUBLISHED_CHECKS = (*quality.MODEL_CHECKS, quality.FACT_KEY_CHECK)
#: Price files of more bytes are worked off in portions, so that the shuffles of a few are on disk at a time.
BYTES_PER_PORTION = 8 * 1024**3
# Rows in a shuffle take about this many times their Parquet size.
PARQUET_EXPANSION = 3


@dataclass(frozen=True)
class PriceRun:
    written: LoadReport
    summary: Row
    sample: list[Row]


def enriched_prices(
    spark: SparkSession,
    price_globs: Iterable[str],
    metadata_path: str,
    sample: int = 0,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Clean price rows of all files with indicators and metadata.

    All globs are read by one scan. File lengths tell which series could be long, so
    rows are counted for those alone. ``sample`` limits each glob to its first files.
    """
    source = locate(spark, _paths(spark, price_globs, sample))
    files = listing(spark, source)
    (prices_,) = _enriched(spark, source, files, total_bytes(files), metadata_path, max_rows)
    return prices_


def _paths(spark: SparkSession, price_globs: Iterable[str], sample: int) -> list[str]:
    paths: list[str] = []
    for glob in price_globs:
        paths += first_files(spark, glob, sample) if sample > 0 else [glob]
    return paths


def _enriched(
    spark: SparkSession,
    source: Located,
    files: DataFrame,
    file_bytes: int,
    metadata_path: str,
    max_rows: int,
    portions: int = 1,
) -> Iterator[DataFrame]:
    """The enriched prices in frames of whole tickers; what one does beforehand it does when it is asked for."""
    metadata = companies.price_metadata(scan_metadata(spark, metadata_path))
    for rows in scan_portions(spark, source, file_bytes, portions):
        yield with_indicators(clean_prices(rows), max_rows, long_series_candidates(files, max_rows), metadata)


def run_prices(
    spark: SparkSession,
    price_globs: Iterable[str],
    metadata_path: str,
    output: str,
    sample: int = 0,
    files_per_year: int | None = None,
    bytes_per_portion: int = BYTES_PER_PORTION,
) -> PriceRun:
    """Raw files to the processed table, and a report on what was written.

    The report reads the written table, so the lineage runs once. Files of more than
    ``bytes_per_portion`` are worked off in portions of tickers, unless ``files_per_year``
    limits the files, of which each portion writes its own.
    """
    source = locate(spark, _paths(spark, price_globs, sample))
    files = materialize(listing(spark, source), "price-files")
    file_bytes = total_bytes(files)
    portions = max(1, -(-file_bytes // bytes_per_portion)) if files_per_year is None else 1
    with sized_shuffles(spark, -(-file_bytes // portions)):
        frames = _enriched(spark, source, files, file_bytes, metadata_path, MAX_ROWS_PER_TASK, portions)
        written = write_by_year(next(frames), output, files_per_year, more=frames)
    table = scan_processed(spark, output)
    return PriceRun(
        written, reports.run_report(table).first(), reports.sample_rows(table).collect()
    )


def run_raw_load(
    spark: SparkSession,
    warehouse: str,
    processed: str | None = None,
    metadata: str | None = None,
    table: str = "both",
) -> dict[str, LoadReport]:
    """Replace the raw tables; ``table`` is ``prices``, ``meta`` or ``both``."""
    if table not in ("prices", "meta", "both"):
        raise ValueError(f"unknown table {table!r}")
    loaded = {}
    if table in ("prices", "both"):
        rows = scan_processed(spark, processed)
        place = F.col("_metadata.row_index")
        with sized_shuffles(spark, stored_bytes(spark, processed) * PARQUET_EXPANSION):
            loaded[RAW_PRICES] = replace_table(
                spark,
                f"{warehouse}/{RAW_PRICES}",
                lambda folder: write_by_month(rows, folder, row_id=place, new=True),
            )
    if table in ("meta", "both"):
        listed = scan_metadata(spark, metadata)
        loaded[RAW_METADATA] = replace_table(
            spark, f"{warehouse}/{RAW_METADATA}", lambda folder: write_flat(listed, folder, new=True)
        )
    return loaded


def build_models(
    spark: SparkSession,
    warehouse: str,
    events: Iterable[tuple[str, dt.date, dt.date]] = S.MARKET_EVENTS,
    checks: Iterable[quality.Check] = PUBLISHED_CHECKS,
) -> dict[str, DataFrame]:
    """Write star schema and marts from the raw tables and open them.

    Each write counts the violations of the row-level ``checks`` of its table on the way.
    The fact keeps the clustering of the raw table, so it is written without a
    shuffle; the rollup is written once and serves four marts.
    """
    stored = current(spark, f"{warehouse}/{RAW_PRICES}").bytes
    # Its threads share the session, so the setting is held around all of them.
    with sized_shuffles(spark, stored * PARQUET_EXPANSION), freed_shuffles(spark):
        _write_models(spark, warehouse, events, tuple(checks))
    return open_models(spark, warehouse)


def _write_models(
    spark: SparkSession,
    warehouse: str,
    events: Iterable[tuple[str, dt.date, dt.date]],
    checks: Sequence[quality.Check],
) -> None:
    def written(name: str) -> DataFrame:
        return scan_table(spark, warehouse, name)

    def publish(name: str, rows: DataFrame) -> DataFrame:
        measures = quality.row_measures(checks, name)
        replace_table(
            spark, f"{warehouse}/{name}", lambda folder: write_flat(rows, folder, new=True, measures=measures)
        )
        return written(name)

    staged = prices.stage_prices(written(RAW_PRICES))
    # The fact has every row of the staged view, whose rules are measured with its own.
    facts = prices.fact_prices(staged)
    replace_table(
        spark,
        f"{warehouse}/{FACT}",
        lambda folder: write_by_month(
            facts, folder, clustered=True, new=True, measures=quality.row_measures(checks, FACT, STAGED_PRICES)
        ),
    )
    fact = written(FACT)
    staged_metadata = companies.stage_metadata(written(RAW_METADATA))
    dimension = publish(COMPANIES, companies.company_dimension(staged_metadata))
    months = publish(TICKER_MONTHS, prices.ticker_months(fact))
    numbers = publish(TICKER_NUMBERS, days.ticker_numbers(months.select("symbol").distinct()))

    def event_mart() -> None:
        by_day = materialize(days.market_days(fact, numbers), "market-days")
        calendar = publish(CALENDAR, days.trading_calendar(by_day))
        blocks = publish(DAY_BLOCKS, days.day_blocks(by_day, calendar))
        publish(EVENTS, days.range_totals(blocks, calendar, literal_events(spark, events)))

    _side_by_side(
        spark,
        (
            lambda: publish(SEGMENT_MONTHS, marts.segment_by_month(months)),
            lambda: publish(MARKET_MONTHS, marts.market_by_month(months)),
            lambda: publish(SEGMENT_YEARS, marts.segment_by_year(months, numbers)),
            event_mart,
            lambda: publish(RANKING, marts.ticker_ranking(months, dimension)),
        ),
    )


def _side_by_side(spark: SparkSession, steps: Sequence[Callable[[], object]]) -> None:
    """Runs independent steps as concurrent Spark jobs of this session; raises the first failure.

    Short jobs then fill the cores that others leave idle at their ends. Each step has a
    scheduler pool of its own, which counts where the cluster schedules fairly.
    """
    def step(number: int) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"models-{number}")
        return steps[number]()

    with ThreadPoolExecutor(MODELS_AT_ONCE) as threads:
        for done in [threads.submit(inheritable_thread_target(spark)(step), n) for n in range(len(steps))]:
            done.result()


def open_models(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """All relations of a built warehouse, registered by name for SQL.

    The staging relations are views: they are computed from the raw tables when read.
    """
    tables = {name: scan_table(spark, warehouse, name) for name in WRITTEN_TABLES}
    tables[STAGED_PRICES] = prices.stage_prices(tables[RAW_PRICES])
    tables[STAGED_METADATA] = companies.stage_metadata(tables[RAW_METADATA])
    register_views(tables)
    return tables


def name_models(spark: SparkSession, warehouse: str, database: str, buckets: int = 0) -> None:
    """Names of the built tables in ``database``, for any session of the catalog.

    With ``buckets``, the fact and the dimension also come as ``fact_by_symbol`` and
    ``companies_by_symbol``, between which joins by symbol need no shuffle.
    """
    name_tables(spark, warehouse, WRITTEN_TABLES, database)
    if buckets:
        for table, name, order in ((FACT, FACT_BY_SYMBOL, ("trade_date",)), (COMPANIES, COMPANIES_BY_SYMBOL, ())):
            place = f"{warehouse}/{name}/{uuid.uuid4().hex}"
            write_buckets(scan_table(spark, warehouse, table), database, name, place, buckets, "symbol", sort=order)


def check_models(
    spark: SparkSession, warehouse: str, checks: Iterable[quality.Check] = PUBLISHED_CHECKS
) -> DataFrame:
    """The report on a built warehouse; what the writes have counted is not counted again.

    The fact's key is checked on the days of the rollup.
    """
    tables = open_models(spark, warehouse)
    measured: dict[str, int] = {}
    for name in WRITTEN_TABLES:
        measured |= current(spark, f"{warehouse}/{name}").measures
    return quality.quality_report(tables, checks, measured=measured, months={FACT: tables[TICKER_MONTHS]})


def run_models(
    spark: SparkSession,
    warehouse: str,
    events: Iterable[tuple[str, dt.date, dt.date]] = S.MARKET_EVENTS,
    checks: Iterable[quality.Check] = PUBLISHED_CHECKS,
) -> list[Row]:
    """Build all models, then check them; raises if an error-level check fails."""
    checks = tuple(checks)
    build_models(spark, warehouse, events, checks)
    return quality.enforce(check_models(spark, warehouse, checks))
