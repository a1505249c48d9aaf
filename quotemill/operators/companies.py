"""Listing metadata: the projection joined to prices, staging, and the dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.functions.columns import category_label, yes_no

# Order that decides which of several rows of one symbol is kept.
_PREFERENCE = ("security_name", "market_category_code", "listing_exchange")


def _trimmed(name: str) -> Column:
    """Without blanks at its ends, as the price side takes metadata."""
    return F.trim(F.col(f"`{name}`"))


def _stripped(name: str) -> Column:
    """Without white space of any kind at its ends, as staging takes metadata."""
    return F.regexp_replace(F.col(f"`{name}`"), S.OUTER_SPACE_PATTERN, "")


def _named() -> Column:
    return F.length("symbol") > 0


def one_per_symbol(rows: DataFrame) -> DataFrame:
    """The first row of each symbol by security name, NULL first.

    Taken as the minimum of a struct with the ordering columns in front, which
    Spark combines before the shuffle: a symbol repeated any number of times costs
    one row per task. The remaining columns break ties, so the choice is repeatable.
    """
    others = [name for name in rows.columns if name not in ("symbol", *_PREFERENCE)]
    kept = F.min(F.struct(*_PREFERENCE, *others)).alias("kept")
    return rows.groupBy("symbol").agg(kept).select("symbol", "kept.*").select(*rows.columns)


def price_metadata(raw: DataFrame) -> DataFrame:
    """Five trimmed columns and the category label, one row per named symbol."""
    code = F.col("market_category_code")
    listed = raw.select(
        _trimmed("Symbol").alias("symbol"),
        _trimmed("Security Name").alias("security_name"),
        _trimmed("Listing Exchange").alias("listing_exchange"),
        _trimmed("Market Category").alias("market_category_code"),
        _trimmed("ETF").alias("etf_flag"),
    ).where(_named())
    return one_per_symbol(
        listed.withColumn("market_category", category_label(code, S.PRICE_CATEGORY_LABELS))
    )


def enrich(prices: DataFrame, metadata: DataFrame) -> DataFrame:
    """Price rows with metadata; rows of unlisted symbols stay, with NULLs.

    No broadcast hint: Spark broadcasts the metadata while its size is below
    ``spark.sql.autoBroadcastJoinThreshold``. Beyond that it joins by symbol, which
    is how the indicators have already distributed and sorted the prices, so only
    the metadata is shuffled.
    """
    return prices.join(metadata, "symbol", "left")


def stage_metadata(raw: DataFrame, exclude_test_issues: bool = False) -> DataFrame:
    """Staging projection of the metadata, duplicates included."""
    staged = raw.select(
        _stripped("Symbol").alias("symbol"),
        _stripped("Security Name").alias("security_name"),
        _stripped("Listing Exchange").alias("listing_exchange"),
        _stripped("Market Category").alias("market_category_code"),
        _stripped("Financial Status").alias("financial_status"),
        _stripped("CQS Symbol").alias("cqs_symbol"),
        _stripped("NASDAQ Symbol").alias("nasdaq_symbol"),
        yes_no(F.col("ETF")).alias("is_etf"),
        yes_no(F.col("`Nasdaq Traded`")).alias("nasdaq_traded"),
        yes_no(F.col("`Test Issue`")).alias("is_test_issue"),
        yes_no(F.col("NextShares")).alias("is_nextshares"),
        _stripped("Round Lot Size").try_cast("double").alias("round_lot_size"),
        category_label(_stripped("Market Category"), S.COMPANY_CATEGORY_LABELS).alias(
            "market_category"
        ),
    ).where(_named())
    if exclude_test_issues:
        staged = staged.where(~F.coalesce("is_test_issue", F.lit(False)))
    return staged


def company_dimension(staged: DataFrame) -> DataFrame:
    """One row per symbol, ten descriptive columns."""
    return one_per_symbol(staged.select(*S.COMPANY_COLUMNS))
