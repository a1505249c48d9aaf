"""Daily prices and listing metadata derived from the TPC-H-like test tables.

A supplier is a ticker and its shipments of a day are the day's trades. Prices are
damped around 100. The divisor is a prime so that averages do not fall on rounding
boundaries, and mean prices are formed from whole cents so that every engine gets
the same doubles whatever the order of summation.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotemill.schemas import PRICE_FILE_COLUMNS
from quotemill.session import file_system, freed_shuffles

# --- fixed values: the adapter --------------------------------------------------------
DAMPING = 20011
REGION_CODES = {"AFRICA": "Q", "AMERICA": "G", "ASIA": "S", "EUROPE": "N", "MIDDLE EAST": "A"}
TEST_EVENTS = (
    ("E50", dt.date(1950, 1, 1), dt.date(1950, 12, 31)),
    ("E95", dt.date(1995, 6, 1), dt.date(1995, 8, 31)),
    ("E97", dt.date(1997, 1, 1), dt.date(1997, 12, 31)),
    ("E97b", dt.date(1997, 7, 1), dt.date(1998, 3, 31)),
    ("E00", dt.date(2000, 3, 1), dt.date(2002, 10, 31)),
)

# Every 40th day of a ticker, counted from its number, has one of these defects.
DEFECTS = (
    "bad date", "bad number", "missing field", "extra field", "no close", "zero close",
    "negative close", "NaN close", "decimal volume", "no high", "no volume", "repeated day",
)
DEFECT_PERIOD = 40
# Price files are removed by so many threads, so many to a step: a disk may take a millisecond or two for each.
REMOVERS = 16
REMOVED_IN_A_STEP = 256


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def market_prices(spark: SparkSession, folder: str) -> DataFrame:
    """One row per supplier and ship date, shaped like cleaned price rows."""
    damped = 100 + F.col("l_extendedprice") / DAMPING
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    trades = (
        _table(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("trade_date"))
        .agg(
            F.min(damped).alias("low"),
            F.max(damped).alias("high"),
            (100 + F.sum(cents) / F.count(F.lit(1)) / (100 * DAMPING)).alias("close"),
            F.sum(F.col("l_quantity")).cast("bigint").alias("volume"),
        )
    )
    tickers = _table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("symbol")
    )
    return trades.join(tickers, "l_suppkey").select(
        "symbol",
        "trade_date",
        F.col("low").alias("open"),
        "high",
        "low",
        "close",
        F.col("close").alias("adj_close"),
        "volume",
        (F.col("l_suppkey") % 8 == 5).alias("is_etf"),
    )


def long_series_candidates(spark: SparkSession, folder: str, max_rows: int) -> DataFrame:
    """Tickers with more than ``max_rows`` shipments; they may have fewer days."""
    shipments = (
        _table(spark, folder, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.count(F.lit(1)).alias("shipments"))
        .where(F.col("shipments") > max_rows)
    )
    suppliers = _table(spark, folder, "supplier")
    return shipments.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("symbol")
    )


def market_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Raw listing metadata, one text row per supplier, some of them twice.

    Every tenth supplier has a blank symbol, so its prices have no metadata. Texts are
    padded with blanks. A repeated symbol carries a later name.
    """
    key = F.col("s_suppkey")
    name = F.concat_ws(" ", "s_name", "n_name")
    names = F.when(key % 7 == 0, F.array(name, F.concat(name, F.lit(" Z")))).otherwise(F.array(name))
    codes = F.create_map(*(F.lit(text) for pair in REGION_CODES.items() for text in pair))
    code = codes[F.col("r_name")]

    def flag(condition):
        return F.when(condition, "Y").otherwise("N")

    suppliers = (
        _table(spark, folder, "supplier")
        .join(_table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return suppliers.select(
        flag(key % 3 != 0).alias("Nasdaq Traded"),
        F.when(key % 10 == 9, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), "s_name", F.lit(" ")))
        .alias("Symbol"),
        F.explode(names).alias("Security Name"),
        F.substring("r_name", 1, 1).alias("Listing Exchange"),
        F.concat(code, F.lit(" ")).alias("Market Category"),
        flag(key % 8 == 5).alias("ETF"),
        F.lit("100").alias("Round Lot Size"),
        flag(F.col("s_acctbal") > 9000).alias("Test Issue"),
        F.when(F.col("s_acctbal") < 0, "D").otherwise("N").alias("Financial Status"),
        F.col("s_name").alias("CQS Symbol"),
        F.col("s_name").alias("NASDAQ Symbol"),
        F.lit("N").alias("NextShares"),
    )


def _key(symbol: Column) -> Column:
    """The number in a ticker's name: what is left without the text before its last digits.

    A regular expression would cost more per row than the rest of a record.
    """
    before = F.length(F.rtrim(symbol, F.lit("0123456789")))
    return F.substr(symbol, before + 1).cast("int")


def _line(*fields: Column | str) -> Column:
    parts = [F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields]
    return F.concat_ws(",", *parts)


def price_lines(prices: DataFrame, defects: bool = False) -> DataFrame:
    """Price rows as records of a price file: ``symbol``, ``is_etf``, ``line``.

    With ``defects`` some records are spoilt in the ways of ``DEFECTS``, by ticker and day.
    """
    names = [short for short, _ in PRICE_FILE_COLUMNS.values()]
    whole = _line(*names)
    if not defects:
        return prices.select("symbol", "is_etf", whole.alias("line"))
    # Texts, the kind and the whole record are columns first, so that each is formed once.
    texts = prices.select(
        "symbol", "is_etf", *(F.col(name).cast("string").alias(name) for name in names),
        _kind(F.col("symbol"), F.col("trade_date")).alias("kind"),
    )
    records = texts.withColumn("whole", whole)

    def changed(**new: str) -> Column:
        return _line(*(F.lit(new[name]) if name in new else name for name in names))

    spoilt = (
        F.array(changed(trade_date="not a date")),
        F.array(changed(open="x1")),
        F.array(_line(*names[:-1])),
        F.array(F.concat("whole", F.lit(",more"))),
        F.array(changed(close="")),
        F.array(changed(close="0")),
        F.array(changed(close="-1.5")),
        F.array(changed(close="NaN")),
        F.array(changed(volume="100.0")),
        F.array(changed(high="")),
        F.array(changed(volume="")),
        F.array("whole", "whole"),
    )
    lines = F.when(F.col("kind") == 0, spoilt[0])
    for number, record in enumerate(spoilt[1:], 1):
        lines = lines.when(F.col("kind") == number, record)
    return records.select("symbol", "is_etf", F.explode(lines.otherwise(F.array("whole"))).alias("line"))


def _kind(symbol: Column, day: Column) -> Column:
    """A number from 0 to 39 by ticker and day."""
    return F.pmod(F.date_diff(day, F.lit(dt.date(1990, 1, 1))) * 31 + _key(symbol), F.lit(DEFECT_PERIOD))


def spoilt_rows(prices: DataFrame) -> DataFrame:
    """Rows of prices of which every one of 40 kinds 0 to 6 is unusable."""
    kind, close = _kind(F.col("symbol"), F.col("trade_date")), F.col("close")
    spoilt = {
        "close": F.when(kind == 0, F.lit(None)).when(kind == 1, 0.0).when(kind == 2, -close).when(kind == 3, float("nan")).otherwise(close),
        "trade_date": F.when(kind != 4, F.col("trade_date")),
        "symbol": F.when(kind == 5, "").when(kind != 6, F.col("symbol")),
    }
    return prices.select(*(spoilt.get(name, F.col(name)).alias(name) for name in prices.columns))


def violating_rows(prices: DataFrame) -> DataFrame:
    """Rows of prices that break rules: kinds 0 to 2 lack a value, 3 has an odd segment, 4 comes twice."""
    kind = _kind(F.col("symbol"), F.col("trade_date"))
    marked = prices.withColumn("n", F.explode(F.sequence(F.lit(1), F.when(kind == 4, 2).otherwise(1))))
    spoilt = {
        "close": F.when(~kind.isin(0, 1), F.col("close")),
        "volume": F.when(~kind.isin(1, 2), F.col("volume")),
        "market_category": F.when(kind == 3, F.concat(F.lit("Pink "), "symbol")).otherwise(F.col("market_category")),
    }
    return marked.select(*(spoilt.get(name, F.col(name)).alias(name) for name in prices.columns))


def _place(spark: SparkSession, folder: str) -> tuple[bool, str]:
    """Whether a folder is on a local file system, and its path there, or else its URI."""
    files, top = file_system(spark, folder)
    place = files.makeQualified(top).toUri()
    local = place.getScheme() == "file"
    return local, place.getPath() if local else place.toString()


def write_price_files(lines: DataFrame, folder: str) -> list[str]:
    """One headered file per ticker below stocks/ and etfs/; returns a glob for each.

    The tasks write the files where they belong, each ticker in one of them, so the driver
    has nothing to do per ticker. A file gets its name when it is whole; a repeated task
    writes the same. As in folders by ticker, one without a name is called
    ``__HIVE_DEFAULT_PARTITION__``.
    """
    spark = lines.sparkSession
    for name in ("stocks", "etfs", "parts"):
        files, place = file_system(spark, f"{folder}/{name}")
        files.mkdirs(place)
    local, target = _place(spark, folder)
    header = ",".join(PRICE_FILE_COLUMNS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = (fs.LocalFileSystem(), target) if local else fs.FileSystem.from_uri(target)
        opened = draft = stream = None

        def close() -> None:
            stream.close()
            final = f"{base}/{opened}.csv"
            try:
                store.move(draft, final)
            except OSError:  # some file systems refuse a name that another attempt has given
                if store.get_file_info(final).type != fs.FileType.File:
                    raise
                store.delete_file(draft)

        for batch in batches:
            runs = pc.run_end_encode(batch["file"])
            # The records of a run are joined in Arrow; as Python strings they would cost the most of all.
            records = pc.binary_join(pa.ListArray.from_arrays([0, *runs.run_ends.to_pylist()], batch["record"]), "")
            for file, record in zip(runs.values.to_pylist(), records, strict=True):
                if file != opened:
                    if stream is not None:
                        close()
                    opened, draft = file, f"{base}/parts/{uuid.uuid4().hex}"
                    stream = store.open_output_stream(draft)
                    stream.write(f"{header}\n".encode())
                stream.write(record.as_buffer())
        if stream is not None:
            close()
        yield from ()

    directory = F.when(F.col("is_etf"), "etfs/").otherwise("stocks/")
    ticker = F.coalesce(F.nullif("symbol", F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    file = F.concat(directory, F.replace(ticker, F.lit("/"), F.lit("%2F")))
    written = (
        lines.select(file.alias("file"), F.concat("line", F.lit("\n")).alias("record"))
        .withColumn("hash", F.xxhash64("file"))  # names begin alike, so they alone sort slowly
        .repartition("hash", "file")
        .sortWithinPartitions("hash", "file", "record")
        .select("file", "record")
        .mapInArrow(write, "written int")
    )
    with freed_shuffles(spark):
        written.write.format("noop").mode("overwrite").save()
    return [f"{folder}/{name}/*.csv" for name in ("stocks", "etfs")]


@contextmanager
def removing_price_files(spark: SparkSession, globs: Sequence[str]) -> Iterator[None]:
    """Removes the files that ``write_price_files`` has written while the caller goes on.

    For callers that have read them for the last time. Nobody waits for it: files that are
    left when the block ends go with the driver's scratch folder.
    """

    def remove(store: fs.FileSystem, paths: Sequence[str]) -> None:
        for path in paths:
            store.delete_file(path)

    threads = ThreadPoolExecutor(REMOVERS)
    try:
        removals = []
        for glob in globs:
            local, place = _place(spark, glob.rpartition("/")[0])
            store, folder = (fs.LocalFileSystem(), place) if local else fs.FileSystem.from_uri(place)
            paths = [found.path for found in store.get_file_info(fs.FileSelector(folder)) if found.type == fs.FileType.File]
            for first in range(0, len(paths), REMOVED_IN_A_STEP):
                removals.append(threads.submit(remove, store, paths[first : first + REMOVED_IN_A_STEP]))
        yield
    finally:
        threads.shutdown(cancel_futures=True)
    for removal in removals:
        if not removal.cancelled():
            removal.result()


def edge_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices that try the ranking: every third ticker is short, some of the others leap daily.

    A short ticker has its first 100 days only. The close of a leaping one is a
    hundredfold every other day, so its mean return to the power of its days leaves the
    range of a double.
    """
    prices = market_prices(spark, folder)
    key = _key(F.col("symbol"))
    number = F.row_number().over(Window.partitionBy("symbol").orderBy("trade_date"))
    leap = (key % 4 == 2) & (number % 2 == 0)
    rows = prices.withColumns({"number": number, "close": F.when(leap, F.col("close") * 100).otherwise(F.col("close"))})
    return rows.where((key % 3 != 0) | (F.col("number") <= 100)).drop("number")
