"""Metadata files, written tables, literal relations and named views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from quotemill.functions.columns import file_name, month_of
from quotemill.schemas import EVENT_SCHEMA
from quotemill.session import file_system
from quotemill.sinks.snapshots import read_snapshot

# Folders that the driver lists at a time.
_LISTED_AT_ONCE = 8


def _same_pattern(paths: Sequence[str]) -> tuple[list[str], str] | None:
    """The folders of globs that share a pattern of file names, and the pattern; else None."""
    parts = [path.rpartition("/") for path in paths]
    folders, patterns = [head for head, _, _ in parts], {pattern for _, _, pattern in parts}
    whole = all(folders) and all(text.count("{") == text.count("}") for pair in parts for text in pair)
    if len(patterns) != 1 or len(set(folders)) != len(folders) or not whole:
        return None
    (pattern,) = patterns
    return (folders, pattern) if set(pattern) & set("*?[{") else None


@dataclass(frozen=True)
class Located:
    """What a reader loads: paths, and the pattern of file names that counts below them, if any."""

    paths: tuple[str, ...]
    pattern: str | None = None


def locate(spark: SparkSession, paths: str | Sequence[str] | Located) -> Located:
    """Tells how to read the files below ``paths``; a job that reads them twice asks once.

    A glob makes Spark list every file it matches by itself, in thousands of tasks. Globs of
    file names are therefore read as their folders with a filter of names, one listing for
    each folder, unless a folder has folders with content, which Spark would read too.
    """
    if isinstance(paths, Located):
        return paths
    given = (paths,) if isinstance(paths, str) else tuple(paths)
    found = _same_pattern(given)
    if found is not None:
        folders, pattern = found

        def matched(glob: str) -> int:
            files, place = file_system(spark, glob)
            return len(files.globStatus(place) or ())

        # Each lists a whole folder on the driver, where no executor helps; so they are listed at a time.
        asked = [*given, *(f"{folder}/*/*" for folder in folders)]
        with ThreadPoolExecutor(min(len(asked), _LISTED_AT_ONCE)) as threads:
            counts = list(threads.map(matched, asked))
        if all(counts[: len(given)]) and not any(counts[len(given):]):
            return Located(tuple(folders), pattern)
    return Located(given)


def read_files(reader: DataFrameReader, spark: SparkSession, paths: str | Sequence[str] | Located) -> DataFrame:
    """The files below ``paths``, by a reader with a format."""
    found = locate(spark, paths)
    if found.pattern is not None:
        reader = reader.option("pathGlobFilter", found.pattern)
    return reader.load(list(found.paths))


def listing(spark: SparkSession, paths: str | Sequence[str] | Located) -> DataFrame:
    """``path``, ``file`` and ``length`` of the files below ``paths``; contents are not read.

    Tasks of a file scan follow the bytes of the files, which nothing reads here, so
    they are merged to what the cluster runs at a time.
    """
    files = read_files(spark.read.format("binaryFile").option("recursiveFileLookup", True), spark, paths)
    return files.select("path", file_name(F.col("_metadata.file_path")).alias("file"), "length").coalesce(
        spark.sparkContext.defaultParallelism
    )


def total_bytes(files: DataFrame) -> int:
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def stored_bytes(spark: SparkSession, paths: str | Sequence[str]) -> int:
    return total_bytes(listing(spark, paths))


def scan_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Listing metadata with every column as text, addressed by header name.

    Empty fields are NULL. Types are given by the staging projection, so no
    inference pass over the file is needed.
    """
    return spark.read.options(header=True, inferSchema=False, sep=",", nullValue="").csv(path)


def scan_processed(spark: SparkSession, path: str) -> DataFrame:
    """Processed price table without its directory key."""
    return spark.read.parquet(path).drop("year")


def scan_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A table of the warehouse as its last load left it; later loads don't disturb the result."""
    return read_snapshot(spark, f"{warehouse}/{name}")


def within_dates(table: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Rows between two dates, both included.

    On a table partitioned by month the same range is also put on the partition
    key: Spark prunes directories only by predicates on that key.
    """
    rows = table.where(F.col("trade_date").between(F.lit(start), F.lit(end)))
    if "trade_month" in table.columns:
        rows = rows.where(
            F.col("trade_month").between(month_of(F.lit(start)), month_of(F.lit(end)))
        )
    return rows


def within_years(table: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of whole years from a table partitioned by year."""
    return table.where(F.col("year").between(first, last))


def literal_events(
    spark: SparkSession, events: Iterable[tuple[str, dt.date, dt.date]]
) -> DataFrame:
    return spark.createDataFrame(list(events), EVENT_SCHEMA)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Name each relation for use in SQL and by ``spark.table``."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
