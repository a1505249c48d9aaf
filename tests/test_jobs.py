import datetime as dt
import subprocess
import sys
from pathlib import Path

import pytest

from quotemill import schemas as S
from quotemill.operators.quality import QualityError
from quotemill.plans import jobs
from quotemill.session import get_session, scratch_path, shared_folder, sized_shuffles

META_HEADER = (
    "Nasdaq Traded,Symbol,Security Name,Listing Exchange,Market Category,ETF,Round Lot Size,"
    "Test Issue,Financial Status,CQS Symbol,NASDAQ Symbol,NextShares\n"
)


@pytest.fixture
def landed(tmp_path):
    """Price files of two stocks, a fund and an unlisted stock, and their metadata."""
    start = dt.date(2000, 1, 3)
    for folder, ticker, count in (
        ("stocks", "AAA", 300), ("stocks", "BBB", 100), ("etfs", "FND", 300), ("stocks", "ZZZ", 20),
    ):
        (tmp_path / folder).mkdir(exist_ok=True)
        lines = ["Date,Open,High,Low,Close,Adj Close,Volume\n"]
        for i in range(count):
            price = 10 + (i * 7 % 11) / 10
            lines.append(f"{start + dt.timedelta(days=i)},1,{price + 1},{price - 1},{price},{price},{i}\n")
        lines.append("not a date,1,2,1,1,1,1\n")
        (tmp_path / folder / f"{ticker}.csv").write_text("".join(lines))
    rows = [
        f"Y,{symbol},{symbol} Inc,Q,{code},{etf},100,N,N,{symbol},{symbol},N\n"
        for symbol, code, etf in (("AAA", "Q", "N"), ("BBB", "A", "N"), ("FND", "N", "Y"))
    ]
    (tmp_path / "meta.csv").write_text(META_HEADER + "".join(rows))
    return tmp_path


def globs(folder):
    return [f"{folder}/stocks/*.csv", f"{folder}/etfs/*.csv"]


def run_all(spark, landed):
    run = jobs.run_prices(spark, globs(landed), f"{landed}/meta.csv", f"{landed}/processed")
    loaded = jobs.run_raw_load(
        spark, f"{landed}/warehouse", f"{landed}/processed", f"{landed}/meta.csv"
    )
    return run, loaded


def test_from_files_to_checked_marts(spark, landed):
    run, loaded = run_all(spark, landed)
    assert run.written.rows == 720
    assert tuple(run.summary) == (720, 4, dt.date(2000, 1, 3), dt.date(2000, 10, 28))
    assert [(row.symbol, row.trade_date.day) for row in run.sample] == [("AAA", d) for d in range(3, 8)]
    assert {name: report.rows for name, report in loaded.items()} == {
        "raw_daily_prices": 720, "raw_symbols_meta": 3,
    }

    checks = jobs.run_models(
        spark, f"{landed}/warehouse", [("spring", dt.date(2000, 3, 1), dt.date(2000, 5, 31))]
    )
    assert len(checks) == 34
    assert {row.check_name for row in checks if row.status == "warn"} == {"relationships"}
    assert next(row.failures for row in checks if row.status == "warn") == 20

    count = {name: spark.table(name).count() for name in (
        "stg_daily_prices", "stg_symbols_meta", "dim_companies", "fact_daily_prices",
        "agg_sector_performance", "agg_monthly_summary", "agg_yearly_performance",
        "agg_market_crash_analysis", "agg_top_tickers_alltime",
    )}
    assert count == {
        "stg_daily_prices": 720, "stg_symbols_meta": 3, "dim_companies": 3, "fact_daily_prices": 720,
        "agg_sector_performance": 24, "agg_monthly_summary": 10, "agg_yearly_performance": 3,
        "agg_market_crash_analysis": 1, "agg_top_tickers_alltime": 1,
    }
    star = spark.sql(
        "SELECT d.market_category, f.market_category AS price_side, count(*) AS n"
        " FROM fact_daily_prices f JOIN dim_companies d ON f.symbol = d.symbol"
        " WHERE f.symbol = 'BBB' GROUP BY ALL"
    ).first()
    assert tuple(star) == ("NYSE American", "Other", 100)


def test_built_models_can_be_opened_again(spark, landed):
    run_all(spark, landed)
    built = jobs.build_models(spark, f"{landed}/warehouse")
    for name in built:
        spark.catalog.dropTempView(name)
    opened = jobs.open_models(spark, f"{landed}/warehouse")
    assert set(opened) == set(built)
    assert spark.sql("SELECT count(*) FROM raw_daily_prices").first()[0] == 720
    assert spark.table("stg_daily_prices").columns == list(S.STAGED_PRICE_COLUMNS)


def test_repeated_metadata_fails_the_run(spark, landed):
    with open(landed / "meta.csv", "a") as file:
        file.write("Y,AAA,AAA again,Q,Q,N,100,N,N,AAA,AAA,N\n")
    run_all(spark, landed)
    with pytest.raises(QualityError, match="stg_symbols_meta.symbol unique"):
        jobs.run_models(
            spark, f"{landed}/warehouse", [("spring", dt.date(2000, 3, 1), dt.date(2000, 5, 31))]
        )
    assert spark.table("dim_companies").count() == 3


def test_partial_reload(spark, landed):
    run_all(spark, landed)
    warehouse = f"{landed}/warehouse"
    again = jobs.run_raw_load(spark, warehouse, metadata=f"{landed}/meta.csv", table="meta")
    assert list(again) == ["raw_symbols_meta"]
    again = jobs.run_raw_load(spark, warehouse, processed=f"{landed}/processed", table="prices")
    assert again["raw_daily_prices"].rows == 720
    with pytest.raises(ValueError):
        jobs.run_raw_load(spark, warehouse, table="other")


def test_sample_takes_files_of_each_glob(spark, landed):
    rows = jobs.enriched_prices(spark, globs(landed), f"{landed}/meta.csv", sample=1)
    assert {row.symbol for row in rows.select("symbol").distinct().collect()} == {"AAA", "FND"}


def test_long_files_are_cut_with_the_same_result(spark, landed):
    whole = jobs.enriched_prices(spark, globs(landed), f"{landed}/meta.csv")
    cut = jobs.enriched_prices(spark, globs(landed), f"{landed}/meta.csv", max_rows=150)
    digits = [f"round({c}, 9) AS {c}" if t == "double" else c for c, t in whole.dtypes]
    a, b = whole.selectExpr(digits), cut.selectExpr(digits)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_scratch_lies_in_the_application_folder_or_the_callers(spark):
    assert f"quotemill-{spark.sparkContext.applicationId}/x-" in scratch_path(spark, "x")
    assert scratch_path(spark, "x", "/mine").startswith("/mine/x-")


def test_settings_of_the_caller_win(spark):
    session = get_session(conf={"spark.sql.session.timeZone": "Europe/Paris"})
    try:
        assert session.conf.get("spark.sql.session.timeZone") == "Europe/Paris"
        session.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert get_session().conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        session.conf.set("spark.sql.shuffle.partitions", 17)
        with sized_shuffles(session, 10**15) as chosen:
            assert chosen is None and session.conf.get("spark.sql.shuffle.partitions") == "17"
    finally:
        session.conf.set("spark.sql.session.timeZone", "UTC")
        session.conf.set("spark.sql.shuffle.partitions", 8)
        session.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_shuffles_follow_the_input_and_the_session_is_restored(spark, monkeypatch):
    monkeypatch.setattr("quotemill.session._chosen", lambda *_: False)
    key, sizes = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", []
    for bytes_ in (0, 10**12, 10**14):
        with sized_shuffles(spark, bytes_) as partitions:
            assert spark.conf.get(key) == str(partitions)
            sizes.append(partitions)
        assert key not in spark.conf.getAll
    assert sizes == [8, 3726, 372_530]


def test_command_line(landed):
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, "-m", "quotemill", "prices", "--prices", globs(landed)[0], "--prices",
         globs(landed)[1], "--metadata", f"{landed}/meta.csv", "--output", f"{landed}/out",
         "--sample", "2"],
        cwd=root, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "rows=700" in done.stdout
