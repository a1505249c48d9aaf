"""Price files are dealt to tasks by their bytes, whatever their number."""

from quotemill.operators.cleaning import clean_prices
from quotemill.plans import jobs
from quotemill.sources.price_files import scan_prices

HEADER = "Date,Open,High,Low,Close,Adj Close,Volume\n"
META = "Symbol,Security Name,Listing Exchange,Market Category,ETF\nT1,One Inc,Q,Q,N\n"


def landed(folder, files):
    (folder / "stocks").mkdir()
    for n in range(files):
        (folder / "stocks" / f"T{n}.csv").write_text(f"{HEADER}2020-01-0{n % 9 + 1},1,2,0.5,1.5,1.5,{n}\n")
    (folder / "meta.csv").write_text(META)
    return f"{folder}/stocks/*.csv"


def test_many_small_files_are_few_tasks(spark, tmp_path):
    glob = landed(tmp_path, 150)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")  # one file for each partition of the plain scan
    try:
        plain, dealt = scan_prices(spark, glob), scan_prices(spark, glob, file_bytes=15_000)
        assert plain.rdd.getNumPartitions() == 150
        assert dealt.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert sorted(dealt.collect()) == sorted(plain.collect())
        prices = jobs.enriched_prices(spark, [glob], f"{tmp_path}/meta.csv")
        plan = prices._jdf.queryExecution().optimizedPlan().toString()
        assert f"Repartition {4 * spark.sparkContext.defaultParallelism}, false" in plan
        assert prices.count() == 150
    finally:
        spark.conf.set(key, before)


def test_more_bytes_are_more_tasks(spark, tmp_path):
    glob = landed(tmp_path, 2)
    plan = scan_prices(spark, glob, file_bytes=10**12)._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {-(-10**12 // 2**24)}, false" in plan


def test_records_longer_than_the_parsers_buffer_are_whole(spark, tmp_path):
    glob = landed(tmp_path, 1)
    long = "0" * 200_000 + "2.5"
    with open(tmp_path / "stocks" / "T0.csv", "a") as file:
        file.write(f"2020-01-02,1,2,0.5,{long},1.5,100\n2020-01-03,1,2,0.5,3.5,1.5,100\n")
    rows = clean_prices(scan_prices(spark, glob)).orderBy("trade_date").collect()
    assert [row.close for row in rows] == [1.5, 2.5, 3.5]
