"""What the jobs leave on disk while they go on."""

import time
from pathlib import Path

import __spark_entry__ as entry
from conftest import TESTDATA
from quotemill.plans import jobs
from quotemill.session import FREED_SHUFFLES, freed_shuffles, materialize
from quotemill.sinks.tables import write_by_year, write_flat
from quotemill.sources import testbed
from quotemill.sources.price_files import scan_portions


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = manager.getAllFiles()
    names = (found.apply(n).getName() for n in range(found.length()))
    return {name for name in names if name.startswith("shuffle_")}


def left(spark, before, seconds=10):
    """New shuffle files, once they have had time to go: the driver does not wait for that."""
    until = time.time() + seconds
    while (now := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return now


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 7 AS key", "DATE'2020-01-01' + cast(id % 900 AS int) AS trade_date", "'A' AS symbol")
    before = shuffle_files(spark)
    dealt = rows.repartition(3, "key")
    write_flat(dealt, f"{tmp_path}/flat")
    write_by_year(dealt, f"{tmp_path}/years")
    kept = materialize(dealt, "dealt", str(tmp_path))
    lines = testbed.price_lines(testbed.market_prices(spark, TESTDATA))
    testbed.write_price_files(lines, f"{tmp_path}/files")
    assert left(spark, before) == set()
    assert kept.count() == 1000
    assert FREED_SHUFFLES not in spark.conf.getAll


def test_a_choice_of_the_caller_stays(spark):
    spark.conf.set(FREED_SHUFFLES, "false")
    try:
        with freed_shuffles(spark):
            assert spark.conf.get(FREED_SHUFFLES) == "false"
        assert spark.conf.get(FREED_SHUFFLES) == "false"
    finally:
        spark.conf.unset(FREED_SHUFFLES)


def test_a_frame_is_read_again_after_its_shuffle_went(spark, tmp_path):
    rows = spark.range(1000).groupBy("id").count()
    with freed_shuffles(spark):
        again = rows.where("id < 5")
        assert len(again.collect()) == len(again.collect()) == 5
        write_flat(rows, f"{tmp_path}/flat")
    assert rows.count() == 1000


def test_what_the_next_job_has_read_goes(spark):
    base = Path(entry._loaded(spark, TESTDATA).removeprefix("file:"))
    assert not (base / "processed").exists()
    assert not [*base.glob("stocks/*.csv"), *base.glob("etfs/*.csv")]
    assert spark.read.parquet(f"{base}/{jobs.RAW_PRICES}/data").count() == testbed.market_prices(spark, TESTDATA).count()


def test_price_files_go_while_others_go_on(spark, tmp_path):
    for name in ("stocks", "etfs", "kept"):
        (tmp_path / name).mkdir()
        for n in range(600):
            (tmp_path / name / f"{n}.csv").write_text("")
    (tmp_path / "stocks" / "folder").mkdir()
    with testbed.removing_price_files(spark, [f"{tmp_path}/stocks/*.csv", f"{tmp_path}/etfs/*.csv"]):
        until = time.time() + 10
        while (gone := not [*tmp_path.glob("[se]t*/*.csv")]) is False and time.time() < until:
            time.sleep(0.1)
    assert gone and (tmp_path / "stocks" / "folder").exists()
    assert len([*tmp_path.glob("kept/*.csv")]) == 600


def test_portions_are_whole_tickers_and_make_the_same_table(spark, tmp_path):
    for kind, names in (("stocks", ["A", "B+C", "Ü", "F 1", *(f"T{n}" for n in range(20))]), ("etfs", ["A", "F 1"])):
        (tmp_path / kind).mkdir()
        for name in names:
            days = [f"{2018 + n % 3}-01-{n % 28 + 1:02d},1,2,0.5,{len(name) + n},1.5,{n}" for n in range(80)]
            text = "Date,Open,High,Low,Close,Adj Close,Volume\n" + "\n".join([*days, "bad,1,1,1,1,1,1", days[0]]) + "\n"
            (tmp_path / kind / f"{name}.csv").write_text(text)
    (tmp_path / "meta.csv").write_text("Symbol,Security Name,Listing Exchange,Market Category,ETF\nA,A Inc,Q,Q,N\n")
    globs = [f"{tmp_path}/{kind}/*.csv" for kind in ("stocks", "etfs")]
    tables = {}
    for name, options in (("one", {}), ("many", {"bytes_per_portion": 5000}), ("few", {"bytes_per_portion": 5000, "files_per_year": 2})):
        run = jobs.run_prices(spark, globs, f"{tmp_path}/meta.csv", f"{tmp_path}/{name}", **options)
        tables[name] = sorted(map(str, spark.read.parquet(f"{tmp_path}/{name}").collect()))
        assert run.written.rows == run.summary.total_rows == len(tables[name]) == 26 * 81
        assert run.written.bytes == sum(f.stat().st_size for f in (tmp_path / name).rglob("*.parquet"))
    assert tables["one"] == tables["many"] == tables["few"]
    assert all(len([*(tmp_path / "few" / f"year={year}").glob("*.parquet")]) <= 2 for year in (2018, 2019, 2020))
    parts = [frame.select("symbol").distinct().collect() for frame in scan_portions(spark, globs, 10**5, 4)]
    names = [row.symbol for part in parts for row in part]
    assert len(names) == len(set(names)) == 24 and sum(map(bool, parts)) > 1


def test_a_portion_opens_its_own_files_only(spark, tmp_path):
    (tmp_path / "stocks").mkdir()
    for n in range(40):
        (tmp_path / "stocks" / f"T{n}.csv").write_text("Date,Open,High,Low,Close,Adj Close,Volume\n2020-01-01,1,2,0.5,1.5,1.5,1\n")
    read = 0
    for frame in scan_portions(spark, [f"{tmp_path}/stocks/*.csv"], 10**5, 4):
        plan = frame._jdf.queryExecution().executedPlan()
        frame._jdf.queryExecution().toRdd().count()
        leaves = plan.collectLeaves()
        read += leaves.apply(0).metrics().apply("numFiles").value()
    assert read == 40


def test_tasks_that_write_price_files_need_no_copy_of_the_package(spark, tmp_path):
    sent = []

    class Rows:
        """As a frame up to the function that its tasks run."""

        sparkSession = spark
        select = withColumn = repartition = sortWithinPartitions = lambda self, *_: self

        def mapInArrow(self, function, _):
            sent.append(function)
            return spark.range(0)

    testbed.write_price_files(Rows(), f"{tmp_path}/files")
    used = {*sent[0].__code__.co_names, *(name for code in sent[0].__code__.co_consts if hasattr(code, "co_names") for name in code.co_names)}
    assert not [name for name in used if getattr(getattr(testbed, name, None), "__module__", "").startswith("quotemill")]
