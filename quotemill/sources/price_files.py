"""Raw price files: one headered CSV per ticker, asset class given by directory."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.columns import is_etf_file, ticker_of
from quotemill.schemas import PRICE_FILE_COLUMNS
from quotemill.sources.tables import Located, listing, read_files

# No price record is shorter than a date, six commas and a line end.
_SHORTEST_RECORD_BYTES = 17
# Every file gets a parser with a buffer of its own, which is by default made for millions of characters.
_PARSER_BUFFER = 64 * 1024
#: Files that one task reads have about this many bytes, however many they are.
BYTES_PER_TASK = 16 * 1024**2
# Where the files are few bytes, as many tasks for each core, since files differ.
_TASKS_PER_CORE = 4

_SCHEMA = T.StructType(
    [T.StructField(name, wanted) for name, (_, wanted) in PRICE_FILE_COLUMNS.items()]
)


def _reads_whole_records() -> Column:
    """True for every row, but only after every column has been read.

    DROPMALFORMED judges a record by the columns a query reads, so a count could
    differ from the rows collected. A filter over a hash of all columns makes each
    query read, and judge, the whole record.
    """
    return F.hash(*(F.col(f"`{name}`") for name in PRICE_FILE_COLUMNS)) >= F.lit(-(2**31))


def scan_prices(
    spark: SparkSession, paths: str | Sequence[str] | Located, file_bytes: int | None = None
) -> DataFrame:
    """Rows of all files under ``paths`` (glob or list, any Hadoop URI).

    A record with a bad number or a wrong number of fields is dropped, whichever
    columns are used later. Spark takes a file for 4 MB at least, so small ones would be
    dealt out by their number; if the total of ``file_bytes`` is known, by their bytes.
    """
    reader = spark.read.format("csv").schema(_SCHEMA).options(
        header=True, mode="DROPMALFORMED", inputBufferSize=_PARSER_BUFFER
    )
    raw = read_files(reader, spark, paths)
    # The name comes ready with the file; a filter on the symbol would cut it off the path again for each row.
    located = raw.where(_reads_whole_records()).withColumns(
        {"is_etf": is_etf_file(F.col("_metadata.file_path")), "file": F.col("_metadata.file_name")}
    )
    rows = located.withColumn("symbol", ticker_of(F.col("file"))).drop("file")
    return rows if file_bytes is None else _dealt(rows, file_bytes)


def _dealt(rows: DataFrame, file_bytes: int) -> DataFrame:
    least = _TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(-(-file_bytes // BYTES_PER_TASK), least))


def scan_portions(
    spark: SparkSession, paths: str | Sequence[str] | Located, file_bytes: int, portions: int
) -> list[DataFrame]:
    """The rows of ``scan_prices`` in so many frames, with every ticker whole in one of them.

    The files are listed once for all. A ticker is known by its file's name, so each frame
    opens the files of its own tickers only.
    """
    if portions == 1:
        return [scan_prices(spark, paths, file_bytes)]
    rows = scan_prices(spark, paths)
    number = F.pmod(F.xxhash64("symbol"), F.lit(portions))
    return [_dealt(rows.where(number == n), -(-file_bytes // portions)) for n in range(portions)]


def first_files(spark: SparkSession, glob: str, count: int) -> list[str]:
    """The first ``count`` files by name; an error if nothing matches."""
    try:
        rows = listing(spark, glob).select("path").orderBy("path").limit(count).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    if not rows:
        raise FileNotFoundError(f"no price files match {glob}")
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", row.path) for row in rows]


def long_series_candidates(files: DataFrame, max_rows: int) -> DataFrame:
    """Symbols whose files could hold more than ``max_rows`` records, from their ``listing``.

    An upper bound by file length alone: it may name a symbol too many, never one too
    few. Whether a series is long is decided by its rows.
    """
    return (
        files.groupBy(ticker_of(F.col("file")).alias("symbol"))
        .agg(F.sum("length").alias("bytes"))
        .where(F.col("bytes") > max_rows * _SHORTEST_RECORD_BYTES)
        .select("symbol")
    )
