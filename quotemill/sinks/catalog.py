"""Names for written tables in the session's catalog, which outlive the session that wrote them.

A version of a table is an external table of its own, with statistics, so that the optimizer
knows its size and columns before it reads a file. The name that people use is a view of the
current version; replacing a view is one step in every catalog, so a query finds the old
version or the new one, and a query at work keeps the files it has planned.

Tables that are joined often can also be kept in buckets of their key: such joins, and
aggregations by the key, then need no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.session import file_system, freed_shuffles
from quotemill.sinks.snapshots import Snapshot, current

#: A bucket may hold this many times the mean before the table is better left without.
MOST_UNEVEN = 4.0


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def name_tables(spark: SparkSession, warehouse: str, names: Iterable[str], database: str) -> None:
    """Gives the current versions of warehouse tables their names in ``database``.

    Tables of versions that are no longer named are dropped; their files are not touched.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    for name in names:
        snapshot = current(spark, f"{warehouse}/{name}")
        version = f"{name}__v{snapshot.number}"
        if not spark.catalog.tableExists(f"{database}.{version}"):
            _external_table(spark, database, version, snapshot)
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database, name)} AS SELECT * FROM {_quoted(database, version)}")
        for table in spark.catalog.listTables(database, f"{name}__v*"):
            if table.name != version and table.name.removeprefix(f"{name}__v").isdigit():
                spark.sql(f"DROP TABLE {_quoted(database, table.name)}")


def _external_table(spark: SparkSession, database: str, name: str, snapshot: Snapshot) -> None:
    """An external table over a version, its partitions known and its columns analysed."""
    keys = _partition_keys(spark, snapshot)
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in snapshot.schema.fields)
    parted = f" PARTITIONED BY ({', '.join(map(_quoted, keys))})" if keys else ""
    location = snapshot.folder.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {_quoted(database, name)} ({columns}) USING parquet{parted} LOCATION '{location}'")
    if keys:
        spark.catalog.recoverPartitions(f"{database}.{name}")
    spark.sql(f"ANALYZE TABLE {_quoted(database, name)} COMPUTE STATISTICS FOR ALL COLUMNS")


def _partition_keys(spark: SparkSession, snapshot: Snapshot) -> list[str]:
    """Columns that are in the folders' names and not in the files: they come last."""
    files, place = file_system(spark, snapshot.folder)
    for status in files.listStatus(place):
        head, sign, _ = status.getPath().getName().partition("=")
        if status.isDirectory() and sign:
            return [head]
    return []


def even_buckets(rows: DataFrame, buckets: int, *keys: str) -> bool:
    """Whether no bucket of these keys would hold much more than its share of the rows."""
    sizes = rows.groupBy(F.pmod(F.hash(*keys), F.lit(buckets))).agg(F.count(F.lit(1)).alias("rows"))
    most, total = sizes.agg(F.max("rows"), F.sum("rows")).first()
    return not total or most <= MOST_UNEVEN * max(total / buckets, 1.0)


def write_buckets(
    rows: DataFrame, database: str, name: str, path: str, buckets: int, *keys: str, sort: tuple[str, ...] = ()
) -> bool:
    """Writes ``rows`` as the external table ``database.name`` at ``path``, in buckets of ``keys``.

    ``rows`` are a scan of a written table: they are counted by bucket first. Where one key
    holds so much that a bucket would be a task of its own size, the table is written without
    buckets, and joins are left to the shuffle, which can split it. Tells whether it has
    buckets.
    """
    spark = rows.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    even = even_buckets(rows, buckets, *keys)
    if even:
        writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys, *sort)
    else:
        writer = rows.write
    with freed_shuffles(spark):
        writer.format("parquet").mode("overwrite").option("path", path).saveAsTable(f"{database}.{name}")
    spark.sql(f"ANALYZE TABLE {_quoted(database, name)} COMPUTE STATISTICS FOR ALL COLUMNS")
    return even
