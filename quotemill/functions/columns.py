"""Column expressions shared by the operators. No UDFs."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotemill import schemas as S


# --- text and paths -----------------------------------------------------------

def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def ticker_of(file: Column) -> Column:
    """Ticker named by a price file, empty for other files.

    File URIs are percent-encoded, so such a name is decoded; a literal plus sign is
    protected first because form decoding would turn it into a blank. Plain string
    functions, since this runs for every row and a regular expression costs as much
    as parsing the record.
    """
    name = F.left(file, F.length(file) - len(S.TICKER_FILE_SUFFIX))
    decoded = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    readable = F.when(F.contains(name, F.lit("%")), F.coalesce(decoded, name)).otherwise(name)
    return F.when(F.endswith(file, F.lit(S.TICKER_FILE_SUFFIX)), readable).otherwise("")


def is_etf_file(path: Column) -> Column:
    return F.contains(path, F.lit(S.ETF_DIRECTORY))


def yes_no(flag: Column) -> Column:
    """Boolean from a marker such as Y or N, as the cast knows them; anything else is NULL."""
    return F.trim(flag).try_cast("boolean")


def category_label(code: Column, labels: Mapping[str, str]) -> Column:
    """Readable market category of a trimmed code; unknown and NULL become Other."""
    pairs = F.create_map(*(F.lit(text) for text in chain.from_iterable(labels.items())))
    return F.coalesce(pairs[code], F.lit(S.OTHER_CATEGORY))


# --- dates ------------------------------------------------------------------------

def parsed_date(text: Column) -> Column:
    """Date of an ISO day, NULL if it is not one (also under ANSI mode).

    The cast alone would also take shorter and padded forms; a date format would
    cost several times as much per row.
    """
    return F.when(text.rlike(S.PRICE_DATE_PATTERN), text.try_cast("date"))


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def year_of(day: Column) -> Column:
    return F.year(day).cast("bigint")


def day_bit(day: Column) -> Column:
    """The day of month as one bit of an int, so that bit_or collects distinct days."""
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)


# --- numbers ----------------------------------------------------------------------

def relative_change(now: Column, before: Column) -> Column:
    """Change relative to a positive earlier value, else NULL."""
    return F.when(before > 0, (now - before) / before)


def return_digits(value: Column) -> Column:
    return F.round(value, S.RETURN_DIGITS)


def price_digits(value: Column) -> Column:
    return F.round(value, S.PRICE_DIGITS)


def compounded(rate: Column, periods: Column) -> Column:
    """Growth after ``periods`` steps of ``rate``, to price digits."""
    return price_digits(F.pow(1.0 + rate, periods) - 1.0)


def compounded_or_null(rate: Column, periods: Column) -> Column:
    """As ``compounded``, but NULL where the power leaves the range of a double."""
    growth = F.pow(1.0 + rate, periods)
    finite = F.abs(growth) < F.lit(float("inf"))  # NaN compares as larger
    return F.when(finite, price_digits(growth - 1.0))


# --- predicates -------------------------------------------------------------------

def usable_price() -> Column:
    """Dated row of a named ticker with a positive close; NaN is no price."""
    close = F.col("close")
    return (
        F.col("trade_date").isNotNull()
        & (F.length("symbol") > 0)
        & (close > 0)
        & ~F.isnan(close)
    )
