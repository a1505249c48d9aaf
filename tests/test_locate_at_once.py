"""Folders of price files are listed at a time, not one after the other."""

import threading

from quotemill.sources import tables


def test_folders_are_listed_at_a_time(spark, tmp_path, monkeypatch):
    for kind in ("stocks", "etfs"):
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "A.csv").write_text("x\n")
    meeting = threading.Barrier(4, timeout=20)  # broken unless all four listings wait here together

    def awaited(session, path, real=tables.file_system):
        meeting.wait()
        return real(session, path)

    monkeypatch.setattr(tables, "file_system", awaited)
    found = tables.locate(spark, [f"{tmp_path}/{kind}/*.csv" for kind in ("stocks", "etfs")])
    assert found == tables.Located((f"{tmp_path}/stocks", f"{tmp_path}/etfs"), "*.csv")


def test_folders_with_folders_are_still_read_by_glob(spark, tmp_path):
    for place in ("stocks", "etfs", "etfs/old"):
        (tmp_path / place).mkdir()
        (tmp_path / place / "A.csv").write_text("x\n")
    globs = tuple(f"{tmp_path}/{kind}/*.csv" for kind in ("stocks", "etfs"))
    assert tables.locate(spark, globs) == tables.Located(globs)
    missing = (f"{tmp_path}/stocks/*.csv", f"{tmp_path}/none/*.csv")
    assert tables.locate(spark, missing) == tables.Located(missing)
