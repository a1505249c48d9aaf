"""The batch jobs on many copies of the test prices, each with its own tickers.

``python tests/scale_run.py [folder] [copies]``; prints seconds per step. 49 copies of
sf0.1 are about 26 million ticker-days.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quotemill.operators import quality
from quotemill.plans import jobs
from quotemill.session import scratch_path
from quotemill.sources import testbed


def copied(df, column: str, copies: int):
    """Every row once per copy, the key column suffixed by the number of the copy."""
    numbered = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    suffixed = F.concat_ws("-", F.trim(F.col(f"`{column}`")), F.col("copy"))
    return numbered.withColumn(column, F.when(F.trim(F.col(f"`{column}`")) != "", suffixed)).drop("copy")


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 49
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_path(spark, "scale")
    prices = copied(testbed.market_prices(spark, folder), "symbol", copies)
    unique = testbed.market_metadata(spark, folder).where(~F.col("Security Name").endswith(" Z"))
    copied(unique, "Symbol", copies).write.csv(f"{base}/meta", header=True)

    def step(name, work):
        start = time.time()
        result = work()
        print(f"{name:28s} {time.time() - start:7.1f}s  {result}", flush=True)
        return result

    globs = step("price files", lambda: testbed.write_price_files(testbed.price_lines(prices), base))
    step("price job", lambda: jobs.run_prices(
        spark, globs, f"{base}/meta", f"{base}/processed").written.rows)
    step("raw load", lambda: jobs.run_raw_load(
        spark, f"{base}/warehouse", f"{base}/processed", f"{base}/meta")["raw_daily_prices"].rows)
    step("star schema and marts", lambda: len(
        jobs.build_models(spark, f"{base}/warehouse", testbed.TEST_EVENTS)))
    tables = jobs.open_models(spark, f"{base}/warehouse")
    checks = (*quality.MODEL_CHECKS, quality.FACT_KEY_CHECK)
    step("34 checks", lambda: [
        (r.column_name, r.check_name, r.failures)
        for r in quality.quality_report(tables, checks).where("status <> 'pass'").collect()])
    spark.stop()


if __name__ == "__main__":
    main()
