"""Many price files are found by listing their folders."""

import pytest

from quotemill.sources.price_files import scan_prices
from quotemill.sources.tables import listing

HEADER = "Date,Open,High,Low,Close,Adj Close,Volume\n"


@pytest.mark.parametrize("form", ["{}/stocks/*.csv", "{}/{{stocks,etfs}}/*.csv"])
def test_many_files_are_listed_without_a_job(spark, tmp_path, form):
    for kind in ("stocks", "etfs"):
        (tmp_path / kind).mkdir()
        for n in range(50):
            (tmp_path / kind / f"T{n}.csv").write_text(HEADER + "2020-01-02,1,2,0.5,1.5,1.5,100\n")
        (tmp_path / kind / "notes.txt").write_text("no prices")
    context, group = spark.sparkContext, f"listed-{form}"
    context.setJobGroup(group, "opening files")
    try:
        files, scan = listing(spark, form.format(tmp_path)), scan_prices(spark, form.format(tmp_path))
        assert not context.statusTracker().getJobIdsForGroup(group)
    finally:
        context._jsc.clearJobGroup()
    wanted = 50 * (2 if "{" in form.replace("{}", "") else 1)
    assert files.count() == scan.count() == wanted


def test_folders_below_keep_what_a_glob_means(spark, tmp_path):
    for place in ("stocks", "stocks/year=2020", "stocks/whole.csv"):
        (tmp_path / place).mkdir()
    for file in ("A.csv", "year=2020/B.csv", "whole.csv/part-0.csv"):
        (tmp_path / "stocks" / file).write_text(HEADER + "2020-01-02,1,2,0.5,1.5,1.5,100\n")
    scan = scan_prices(spark, f"{tmp_path}/stocks/*.csv")
    assert "year" not in scan.columns
    assert sorted(row.symbol for row in scan.collect()) == ["A", "part-0"]


def test_a_glob_without_files_is_an_error(spark, tmp_path):
    (tmp_path / "stocks").mkdir()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_prices(spark, f"{tmp_path}/stocks/*.csv")
