"""Command line: ``python -m quotemill prices|load|models`` (or by spark-submit)."""

from __future__ import annotations

import argparse

from quotemill.plans import jobs
from quotemill.session import get_session


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quotemill")
    commands = parser.add_subparsers(dest="command", required=True)

    prices = commands.add_parser("prices", help="raw price files to the processed table")
    prices.add_argument("--prices", action="append", required=True, help="glob; repeatable")
    prices.add_argument("--metadata", required=True)
    prices.add_argument("--output", required=True)
    prices.add_argument("--sample", type=int, default=0, help="first N files of each glob")
    prices.add_argument("--files-per-year", type=int)

    load = commands.add_parser("load", help="processed table and metadata to raw tables")
    load.add_argument("--warehouse", required=True)
    load.add_argument("--processed")
    load.add_argument("--metadata")
    load.add_argument("--table", choices=["prices", "meta", "both"], default="both")

    models = commands.add_parser("models", help="star schema, marts and checks")
    models.add_argument("--warehouse", required=True)
    return parser.parse_args()


def main() -> None:
    given = _arguments()
    spark = get_session(f"quotemill {given.command}")
    if given.command == "prices":
        run = jobs.run_prices(
            spark, given.prices, given.metadata, given.output, given.sample, given.files_per_year
        )
        print(run.written)
        print(run.summary)
        for row in run.sample:
            print(row)
    elif given.command == "load":
        loaded = jobs.run_raw_load(
            spark, given.warehouse, given.processed, given.metadata, given.table
        )
        for name, report in loaded.items():
            print(name, report)
    else:
        for row in jobs.run_models(spark, given.warehouse):
            print(*row)
    spark.stop()


if __name__ == "__main__":
    main()
