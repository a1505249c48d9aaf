import json
import threading
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotemill.sinks import snapshots
from quotemill.sinks.snapshots import NoSnapshot, current, read_snapshot, replace_table
from quotemill.sinks.tables import write_flat


def load(spark, table, version, rows=500, **options):
    frame = spark.range(rows).repartition(4).withColumn("version", F.lit(version))
    return replace_table(spark, table, lambda folder: write_flat(frame, folder, new=True), **options)


def state(frame):
    return tuple(frame.agg(F.min("version"), F.max("version"), F.count(F.lit(1))).first())


def test_readers_never_fail_nor_see_mixed_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    load(spark, table, 0)
    done, seen, failed = threading.Event(), [], []

    def read():
        while not done.is_set():
            try:
                seen.append(state(read_snapshot(spark, table)))
            except Exception as error:  # noqa: BLE001
                failed.append(error)
                return

    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    for version in range(1, 11):
        load(spark, table, version, rows=500 + version)
    done.set()
    for reader in readers:
        reader.join()
    assert not failed
    assert all(least == most and rows == 500 + most for least, most, rows in seen)
    assert len({most for _, most, _ in seen}) > 1
    assert state(read_snapshot(spark, table)) == (10, 10, 510)


def test_a_failed_load_leaves_no_trace(spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(NoSnapshot):
        read_snapshot(spark, table)
    broken = spark.range(10).select(F.raise_error(F.lit("no")).alias("version"))

    def fail():
        with pytest.raises(Exception, match="no"):
            replace_table(spark, table, lambda folder: write_flat(broken, folder, new=True))

    fail()
    assert not snapshots.is_snapshot_table(spark, table)
    load(spark, table, 1)
    fail()
    assert state(read_snapshot(spark, table)) == (1, 1, 500)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_loads_at_the_same_time_all_commit(spark, tmp_path):
    table = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as threads:
        list(threads.map(lambda version: load(spark, table, version), range(6)))
    manifests = sorted(p.name for p in (tmp_path / "t" / "manifests").glob("*.json"))
    assert [int(name.split(".")[0]) for name in manifests] == list(range(1, 7))
    versions = {json.loads((tmp_path / "t" / "manifests" / name).read_text())["version"] for name in manifests}
    assert len(versions) == 6
    assert state(read_snapshot(spark, table))[2] == 500


def test_a_manifest_is_never_replaced(spark, tmp_path, monkeypatch):
    """A commit that has counted before another one came takes the next number."""
    table = str(tmp_path / "t")
    load(spark, table, 1)
    first = (tmp_path / "t" / "manifests" / f"{1:020d}.json").read_text()
    told = json.loads(first) | {"rows": -1}
    known = snapshots._manifests
    monkeypatch.setattr(snapshots, "_manifests", lambda *_: {})
    assert snapshots._commit(spark, table, told) == 2
    monkeypatch.setattr(snapshots, "_manifests", known)
    assert (tmp_path / "t" / "manifests" / f"{1:020d}.json").read_text() == first
    assert current(spark, table).rows == -1


def test_old_versions_stay_for_a_while_and_then_go(spark, tmp_path):
    table = str(tmp_path / "t")
    load(spark, table, 1)
    opened = read_snapshot(spark, table)
    load(spark, table, 2)
    assert state(opened) == (1, 1, 500)  # still there
    load(spark, table, 3, kept_seconds=-1)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    assert state(read_snapshot(spark, table)) == (3, 3, 500)


def test_report_and_manifest_tell_rows_bytes_and_measures(spark, tmp_path):
    table = str(tmp_path / "t")
    frame = spark.range(100)
    report = replace_table(
        spark, table, lambda folder: write_flat(frame, folder, new=True, measures={"odd": F.count_if(F.col("id") % 2 == 1)})
    )
    snapshot = current(spark, table)
    size = sum(p.stat().st_size for p in Path(snapshot.folder).rglob("*.parquet"))
    assert (report.path, report.rows, report.bytes, report.measures) == (table, 100, size, {"odd": 50})
    assert (snapshot.rows, snapshot.bytes, snapshot.measures) == (100, size, {"odd": 50})


def test_an_empty_table_keeps_its_columns(spark, tmp_path):
    table = str(tmp_path / "t")
    load(spark, table, 1, rows=0)
    assert read_snapshot(spark, table).columns == ["id", "version"]
    assert read_snapshot(spark, table).count() == 0
