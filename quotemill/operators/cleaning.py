"""Cleaning of raw price rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.columns import parsed_date, usable_price
from quotemill.schemas import PRICE_FILE_COLUMNS


def combine(*sources: DataFrame) -> DataFrame:
    """All rows of several price scans, matched by column name."""
    whole, *rest = sources
    for part in rest:
        whole = whole.unionByName(part)
    return whole


def clean_prices(raw: DataFrame) -> DataFrame:
    """Short names, parsed dates, and only rows with a usable price.

    Missing open, high, low or volume do not disqualify a row.
    """
    names = {name: short for name, (short, _) in PRICE_FILE_COLUMNS.items()}
    renamed = raw.withColumnsRenamed(names)
    return renamed.withColumn("trade_date", parsed_date(F.col("trade_date"))).where(usable_price())
