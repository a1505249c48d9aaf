"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word of a text: a run of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"
_HASH_SPACE = 2.0**53
#: Classes that a model learns, at most.
MOST_CLASSES = 1000


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2.

    A null id counts as not held out; learning leaves such rows alone all the same.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def row_key(columns: list[str]) -> list[Column]:
    """``key_a`` and ``key_b``, 128 bits that name a row by its columns, in which a null has its place.

    Two columns, not a struct: Spark then knows rows grouped by them as placed for a join.
    """
    nulls = F.lit(0).cast("bigint")
    for at, name in enumerate(columns):
        mark = F.when(F.col(f"`{name}`").isNull(), F.lit(1 << at % 63)).otherwise(F.lit(0)).cast("bigint")
        nulls = F.xxhash64(nulls, mark) if at % 63 == 0 and at else nulls.bitwiseOR(mark)
    content = [F.col(f"`{name}`") for name in columns]
    return [F.xxhash64(nulls, *content).alias("key_a"), F.xxhash64(F.lit("second"), nulls, *content).alias("key_b")]


def hash_sample(df: DataFrame, key: Column, fraction: Column | float) -> DataFrame:
    """About that fraction of the rows, chosen by a hash of ``key``.

    The choice depends on the key alone, so every run and every retried task agrees,
    and no sort is needed. The number of rows is binomial around what is asked for.
    """
    share = F.shiftrightunsigned(F.xxhash64(key, F.lit("sample")), 11) / _HASH_SPACE
    return df.where(share < fraction)


def class_sample(df: DataFrame, key: Column, label: str, rows: int, most: int = MOST_CLASSES) -> DataFrame:
    """About ``rows`` rows of each value of ``label``, or all where there are fewer.

    The values are counted first; as classes to be learned they are few, and more than
    ``most`` of them are refused, so that neither the counts nor the sample grow with
    the table. Rows without a label are left out, and no rows give none.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).count().limit(most + 1).collect()
    if len(counts) > most:
        raise ValueError(f"{label} has over {most} values, too many to be learned as classes")
    if not counts:
        return df.where("false")
    shares = F.create_map(*[F.lit(x) for value, count in counts for x in (value, min(1.0, rows / count))])
    return hash_sample(df, key, F.coalesce(F.try_element_at(shares, F.col(label)), F.lit(0.0)))
