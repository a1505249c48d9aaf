"""Session defaults, shuffle sizing, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution stays at Spark's own default, which is on. The advisory size is
# what rebalanced writes aim at per task, hence per file.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

FREED_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
#: Rows of one shuffle partition: small enough to sort in an executor's share of memory.
BYTES_PER_PARTITION = 256 * 1024**2


def get_session(
    app_name: str = "quotemill", conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Session for the batch jobs; what spark-submit or the caller sets wins."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in DEFAULTS.items():
        if not _chosen(spark, key):
            spark.conf.set(key, value)
    return spark


def _chosen(spark: SparkSession, key: str) -> bool:
    """Whether somebody has set it, at submission or in the running session."""
    return key in spark.conf.getAll


@contextmanager
def sized_shuffles(
    spark: SparkSession, input_bytes: int, bytes_per_partition: int = BYTES_PER_PARTITION
) -> Iterator[int | None]:
    """Within it, shuffles start with partitions that fit executor memory for this input.

    AQE merges what turns out small but cannot split an ordinary partition, so the
    first guess must be high enough: at least Spark's own default, and as many as the
    input asks for. Nothing is changed if a number has been chosen, and the session is
    left as it was.
    """
    if _chosen(spark, SHUFFLE_PARTITIONS) or _chosen(spark, INITIAL_PARTITIONS):
        yield None
        return
    partitions = max(-(-input_bytes // bytes_per_partition), int(spark.conf.get(SHUFFLE_PARTITIONS)))
    spark.conf.set(INITIAL_PARTITIONS, str(partitions))
    try:
        yield partitions
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when the query ends.

    Otherwise they stay until the driver happens to collect its garbage, so a job of many
    writes holds the shuffles of all of them at once. For writes only: nothing reads their
    shuffles again. Nothing is changed if it has been chosen.
    """
    if _chosen(spark, FREED_SHUFFLES):
        yield
        return
    spark.conf.set(FREED_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED_SHUFFLES)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A machine-local folder is chosen only in local mode, where driver and
    executors are one process; elsewhere the setting must be present.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="quotemill-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def _own_folder(spark: SparkSession, shared: str) -> str:
    """This application's part of the shared folder; it goes when the driver ends."""
    path = f"{shared}/quotemill-{spark.sparkContext.applicationId}"
    files, place = file_system(spark, path)
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it; for renames and removals."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A fresh, unused path below ``folder``, or below this application's shared folder."""
    base = folder or _own_folder(spark, shared_folder(spark))
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table.

    For results that several later queries read: they then scan columns from
    files that outlive any executor, in place of repeating the whole lineage. The files
    go when the driver ends, unless a ``folder`` of the caller's holds them.
    """
    path = scratch_path(df.sparkSession, name, folder)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
