import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from quotemill.plans import dashboards
from quotemill.session import materialize
from quotemill.sinks.catalog import even_buckets, name_tables, write_buckets
from quotemill.sinks.snapshots import replace_table
from quotemill.sinks.tables import write_by_month, write_flat


@pytest.fixture
def database():
    return f"d_{uuid.uuid4().hex}"


def days(spark, symbols=40, count=90):
    return spark.range(symbols * count).selectExpr(
        f"concat('S', lpad(CAST(id DIV {count} AS STRING), 3, '0')) AS symbol",
        f"date_add(DATE '2001-01-01', CAST(id % {count} AS INT)) AS trade_date", "CAST(id AS DOUBLE) AS close",
        "0.5D AS daily_return",
    )


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_names_follow_the_versions_in_any_session(spark, tmp_path, database):
    warehouse = str(tmp_path)
    fact = days(spark)
    replace_table(spark, f"{warehouse}/fact", lambda folder: write_by_month(fact, folder, new=True))
    replace_table(spark, f"{warehouse}/dim", lambda folder: write_flat(fact.select("symbol").distinct(), folder, new=True))
    name_tables(spark, warehouse, ["fact", "dim"], database)
    other = spark.newSession()
    assert other.table(f"{database}.fact").count() == 3600 and other.table(f"{database}.dim").count() == 40
    statistics = other.sql(f"DESCRIBE EXTENDED {database}.fact__v1").where("col_name = 'Statistics'").first().data_type
    assert "3600 rows" in statistics
    month = other.table(f"{database}.fact").where("trade_month = DATE '2001-02-01'")
    assert month.count() == 40 * 28
    opened = other.table(f"{database}.fact")
    opened.count()
    replace_table(spark, f"{warehouse}/fact", lambda folder: write_by_month(fact.limit(10), folder, new=True))
    assert opened.count() == 3600  # until the new version is named, and for queries planned before
    name_tables(spark, warehouse, ["fact", "dim"], database)
    assert other.table(f"{database}.fact").count() == 10
    assert [t.name for t in spark.catalog.listTables(database, "fact__v*")] == ["fact__v2"]


def test_joins_between_buckets_need_no_shuffle(spark, tmp_path, database):
    fact = materialize(days(spark), "fact")
    dim = materialize(fact.select("symbol").distinct().withColumn("name", F.lower("symbol")), "dim")
    assert write_buckets(fact, database, "f", str(tmp_path / "f"), 4, "symbol", sort=("trade_date",))
    assert write_buckets(dim, database, "d", str(tmp_path / "d"), 4, "symbol")
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    f, d = other.table(f"{database}.f"), other.table(f"{database}.d")
    for joined in (f.join(d, "symbol", "left"), f.join(d, "symbol", "left_anti"), f.join(d, "symbol").groupBy("symbol").count()):
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert f.join(d, "symbol", "left").where("name IS NOT NULL").count() == 3600
    assert f.join(d, "symbol", "left_anti").isEmpty()


def test_a_key_that_holds_most_rows_gets_no_buckets(spark, tmp_path, database):
    rows = materialize(days(spark, 40, 5).unionByName(days(spark, 1, 2000)), "rows")
    assert even_buckets(days(spark), 4, "symbol") and not even_buckets(rows, 16, "symbol")
    assert even_buckets(rows.where("false"), 16, "symbol")
    assert not write_buckets(rows, database, "f", str(tmp_path / "f"), 16, "symbol")
    assert spark.table(f"{database}.f").count() == 2200


@pytest.mark.parametrize("most", [1, 2, 3, 16])
def test_ranges_hold_all_chosen_symbols_and_leave_the_widest_gaps(spark, most):
    chosen = [1, 2, 3, 10, 11, 30, 31, 39]
    dim = days(spark, 40, 1).select("symbol", (F.substring("symbol", 2, 3).cast("int").isin(chosen)).alias("good"))
    ranges = dashboards.symbol_ranges(dim, F.col("good"), most)
    assert len(ranges) == min(most, 4)
    covered = {i for i in range(40) for a, b in ranges if a <= f"S{i:03d}" <= b}
    assert covered >= set(chosen)
    assert len(covered) == {1: 39, 2: 21, 3: 14, 16: 8}[most]
    assert dashboards.symbol_ranges(dim, F.lit(False)) == []


def rows_read(frame):
    """Rows that the scans of an executed plan handed on."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan()
    found = 0
    stack = [text]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if name == "FileSourceScanExec" and "close" in node.simpleString(100):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_ranges_of_symbols_skip_row_groups(spark, tmp_path):
    fact = days(spark, 400, 31)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "500")
    try:
        write_by_month(fact.coalesce(1), str(tmp_path / "f"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    table = spark.read.parquet(str(tmp_path / "f"))
    dim = materialize(
        fact.select("symbol").distinct().selectExpr(
            "symbol", "symbol AS security_name", "CASE WHEN symbol BETWEEN 'S100' AND 'S119' THEN 'NYSE' ELSE 'x' END AS market_category"
        ), "dim",
    )
    dates = (dt.date(2001, 1, 1), dt.date(2001, 1, 31))
    whole = dashboards.star_slice(table, dim, *dates, "NYSE")
    cut = dashboards.reduced_star_slice(table, dim, *dates, "NYSE")
    assert sorted(whole.collect()) == sorted(cut.collect()) and cut.count() == 20 * 31
    assert re.search(r"PushedFilters: \[.*symbol", plan(cut))
    assert 0 < rows_read(cut) < rows_read(whole) / 4
    assert dashboards.reduced_star_slice(table, dim, *dates, "none").collect() == []
