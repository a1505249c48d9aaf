"""Tables that are replaced as a whole, without a moment in which a reader sees none or half.

A table is a folder of immutable versions (``data/<version>``) and of numbered manifests.
A load writes a version of its own and then commits it: the manifest with the next free
number is put in place by one rename that fails if that number is taken. Readers take the
version named by the highest manifest. Nothing is moved or copied, and a load that fails
leaves no manifest. Two loads at a time both succeed; the one that commits last is read.

Versions that have been replaced stay for a while, so that queries at work on them end in
peace, and go with a later load.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quotemill.session import file_system
from quotemill.sinks.tables import LoadReport

#: How long a replaced version can still be read.
KEPT_SECONDS = 6 * 3600
#: After this long without a manifest, a version is what a lost driver has left.
ABANDONED_SECONDS = 7 * 24 * 3600


@dataclass(frozen=True)
class Snapshot:
    """A committed version: its folder, and what the load wrote."""

    number: int
    folder: str
    schema: StructType
    rows: int
    bytes: int
    measures: dict[str, int]


class NoSnapshot(LookupError):
    """Nothing has been loaded into this table yet."""


def replace_table(
    spark: SparkSession, table: str, write: Callable[[str], LoadReport], kept_seconds: float = KEPT_SECONDS
) -> LoadReport:
    """Runs a load into a new version of ``table`` and commits it.

    ``write`` gets the folder of the version and writes it in place. If it raises, what it
    wrote goes and readers keep the version they had.
    """
    folder = f"{table.rstrip('/')}/data/{uuid.uuid4().hex}"
    try:
        report = write(folder)
        schema = spark.read.parquet(folder).schema
        _commit(spark, table, {
            "version": folder.rsplit("/", 1)[1], "schema": schema.jsonValue(),
            "rows": report.rows, "bytes": report.bytes, "measures": dict(report.measures),
        })
    except Exception:
        files, place = file_system(spark, folder)
        files.delete(place, True)
        raise
    _retire(spark, table, kept_seconds)
    return replace(report, path=table)


def current(spark: SparkSession, table: str) -> Snapshot:
    """The version that readers take now."""
    while True:
        numbers = _manifests(spark, table)
        if not numbers:
            raise NoSnapshot(table)
        try:
            return _snapshot(spark, table, max(numbers))
        except FileNotFoundError:
            continue  # a newer one has come, and this one has gone since


def is_snapshot_table(spark: SparkSession, table: str) -> bool:
    return bool(_manifests(spark, table))


def read_snapshot(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now; the result keeps reading this version."""
    snapshot = current(spark, table)
    return spark.read.schema(snapshot.schema).parquet(snapshot.folder)


def _folder(table: str) -> str:
    return f"{table.rstrip('/')}/manifests"


def _manifests(spark: SparkSession, table: str) -> dict[int, int]:
    """Numbers of the manifests, and when each came, in milliseconds."""
    files, place = file_system(spark, _folder(table))
    if not files.exists(place):
        return {}
    found = {}
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.endswith(".json") and name.removesuffix(".json").isdigit():
            found[int(name.removesuffix(".json"))] = status.getModificationTime()
    return found


def _path(table: str, number: int) -> str:
    return f"{_folder(table)}/{number:020d}.json"


def _snapshot(spark: SparkSession, table: str, number: int) -> Snapshot:
    files, place = file_system(spark, _path(table, number))
    try:
        stream = files.open(place)
    except Py4JJavaError as error:
        if "FileNotFound" in error.java_exception.getClass().getName():
            raise FileNotFoundError(place.toString()) from None
        raise
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    told = json.loads(text)
    return Snapshot(
        number,
        f"{table.rstrip('/')}/data/{told['version']}",
        StructType.fromJson(told["schema"]),
        told["rows"],
        told["bytes"],
        told["measures"],
    )


def _commit(spark: SparkSession, table: str, told: dict) -> int:
    """Puts the manifest in place under the first number that nobody has taken."""
    files, draft = file_system(spark, f"{_folder(table)}/.{uuid.uuid4().hex}")
    stream = files.create(draft)
    try:
        stream.write(json.dumps(told).encode())
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE  # never over another manifest
    number = max(_manifests(spark, table), default=0) + 1
    while True:
        _, place = file_system(spark, _path(table, number))
        try:
            context.rename(draft, place, options)
            return number
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            number += 1


def _retire(spark: SparkSession, table: str, kept_seconds: float) -> None:
    """Removes versions replaced long ago, and what lost loads have left."""
    now = time.time() * 1000
    numbers = _manifests(spark, table)
    order = sorted(numbers)
    held = {_snapshot(spark, table, number).folder.rsplit("/", 1)[1] for number in order}
    for number, following in zip(order, order[1:], strict=False):
        if now - numbers[following] > kept_seconds * 1000:
            snapshot = _snapshot(spark, table, number)
            files, data = file_system(spark, snapshot.folder)
            _, manifest = file_system(spark, _path(table, number))
            files.delete(manifest, False)
            files.delete(data, True)
    files, place = file_system(spark, f"{table.rstrip('/')}/data")
    for status in files.listStatus(place):
        lost = status.getPath().getName() not in held
        if lost and now - status.getModificationTime() > ABANDONED_SECONDS * 1000:
            files.delete(status.getPath(), True)
