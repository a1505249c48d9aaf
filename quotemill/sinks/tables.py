"""Writers of partitioned and flat Parquet tables.

Each replaces the old content of a folder, or with ``new`` writes a folder that nobody
reads yet, as a version of a table does (``snapshots``).
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quotemill.functions.columns import month_of
from quotemill.session import file_system, freed_shuffles


@dataclass(frozen=True)
class LoadReport:
    """Rows and bytes that a load wrote, and what it measured on the way."""

    path: str
    rows: int
    bytes: int = 0
    measures: Mapping[str, int] = field(default_factory=dict)


def _write(
    df: DataFrame,
    path: str,
    partition: str | None = None,
    new: bool = False,
    measures: Mapping[str, Column] | None = None,
    more: Iterable[DataFrame] = (),
) -> LoadReport:
    """Write, count and measure in one pass, beside the old table, which is then replaced.

    A failed job raises out of the write and leaves the old table as it was. A ``new``
    folder is written in place. ``measures`` are counts over the written rows. The rows of
    ``more`` are added frame by frame; each is asked for when the one before is written.
    """
    measures = measures or {}
    fresh = path if new else f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    taken = [measure.alias(f"m{number}") for number, measure in enumerate(measures.values())]
    files, written = file_system(df.sparkSession, fresh)
    found: Counter[str] = Counter()
    try:
        for rows in chain([df], more):
            counted = Observation()
            writer = rows.observe(counted, F.count(F.lit(1)).alias("rows"), *taken).write
            if partition:
                writer = writer.partitionBy(partition)
            with freed_shuffles(df.sparkSession):
                writer.parquet(fresh, mode="append" if rows is not df else None)
            found.update(counted.get)
    except Exception:
        files.delete(written, True)
        raise
    size = files.getContentSummary(written).getLength()
    if not new:
        _replace(df.sparkSession, fresh, path)
    told = {name: found[f"m{number}"] for number, name in enumerate(measures)}
    return LoadReport(path, found["rows"], size, told)


def _replace(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts a written table in the place of another; the old one goes last."""
    files, source = file_system(spark, fresh)
    _, target = file_system(spark, path)
    _, old = file_system(spark, f"{fresh}.old")
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"cannot move {path} away")
    if not files.rename(source, target):
        if replaced:
            files.rename(old, target)
        raise OSError(f"cannot move {fresh} to {path}")
    if replaced:
        files.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_by_year(
    df: DataFrame, path: str, files_per_year: int | None = None, more: Iterable[DataFrame] = ()
) -> LoadReport:
    """Parquet below one directory per year.

    By default the rows are rebalanced on the year: AQE splits a big year over
    many tasks and packs small years together, so files come out near the advisory
    partition size and no task holds a whole hot year. ``files_per_year`` caps the
    number of files instead; rows of a year are then spread by hash over that many
    tasks, which suits small data only. Splitting a big year needs AQE; without it a
    year is one task unless ``files_per_year`` spreads it.

    Rows of ``more`` frames get files of their own after those of ``df``, so that the
    shuffles of one frame only are on disk at a time.
    """

    def by_year(rows: DataFrame) -> DataFrame:
        dated = rows.withColumn("year", F.year("trade_date"))
        if files_per_year is None:
            dated = dated.hint("rebalance", F.col("year"))
        else:
            slot = F.pmod(F.xxhash64("symbol", "trade_date"), F.lit(files_per_year))
            dated = dated.repartition(F.col("year"), slot)
        return dated.sortWithinPartitions("year", "symbol", "trade_date")

    return _write(by_year(df), path, "year", more=map(by_year, more))


def write_by_month(
    df: DataFrame,
    path: str,
    clustered: bool = False,
    row_id: Column | None = None,
    new: bool = False,
    measures: Mapping[str, Column] | None = None,
) -> LoadReport:
    """Parquet below one directory per month, clustered by symbol.

    The range shuffle on (month, symbol, date) gives tasks of even size whatever
    month or symbol dominates, and files with narrow symbol ranges, so Parquet
    statistics serve ``symbol = x``. Rows that agree on the key are parted by their
    content, or by ``row_id`` if the caller has a stable one, which parts copies too.
    Spark samples the rows to find the ranges, so ``df`` runs twice: pass a scan of a
    written table, not a long lineage.

    Rows scanned from such a table keep their clustering; ``clustered=True`` then
    sorts locally and skips the shuffle.
    """
    keys = ["trade_month", "symbol", "trade_date"]
    columns = df.columns
    if row_id is None:
        row_id = F.xxhash64(*columns)
    dated = df.withColumns({"row_id": row_id, "trade_month": month_of(F.col("trade_date"))})
    if not clustered:
        dated = dated.repartitionByRange(*keys, "row_id")
    rows = dated.sortWithinPartitions(*keys).select(*columns, "trade_month")
    return _write(rows, path, "trade_month", new, measures)


def write_flat(
    df: DataFrame, path: str, new: bool = False, measures: Mapping[str, Column] | None = None
) -> LoadReport:
    """Unpartitioned Parquet table."""
    return _write(df, path, new=new, measures=measures)
