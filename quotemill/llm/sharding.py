"""Balanced shards: global prefix sums of byte sizes, cut at equal targets.

Rows are range-partitioned and sorted; every partition's totals give the offset at
which it begins, a running sum inside it the offset of each row. Shard boundaries are
equal parts of the grand total, so shards are contiguous and as even as rows allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import row_key
from quotemill.session import materialize

SHARDS = 40
#: Groups of equal texts up to this part of a shard are never cut.
SLACK = 0.01
_ROWS_PER_PARTITION = 50_000


def document_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 16 for the record around it; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint")


def text_group(text: Column) -> Column:
    """A number that equal texts share, from 60 bits of their MD5; null and empty are equal."""
    digits = F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, *, slack: float = SLACK) -> DataFrame:
    """Adds ``shard``, 0 to ``shards`` - 1, and ``slot``, gapless from 0 within the shard.

    ``docs`` has ``size``, a positive bigint, ``grp``, a bigint that is equal for equal
    texts, and any other columns; all are kept. The order is by ``grp``, so equal texts
    stand together: a group of at most ``slack`` of a shard lies in one shard, a larger
    one over consecutive shards. Sizes of shards differ from the mean by at most one
    row or ``slack``, whichever is more, on either side.

    Ties are broken by ``doc_id``, null first, then by the size; repeated rows are
    separate rows. A null ``grp`` forms one group. Columns named ``shard`` and ``slot``
    are replaced; others may have any name. Fewer rows than shards leave some
    shards empty, and an empty table gives no rows.
    """
    rows = docs.count()
    parts = max(1, -(-rows // _ROWS_PER_PARTITION))
    order = ["grp", "doc_id", "size"]
    # Other columns travel in one, so that no name of theirs meets one used here.
    others = [c for c in docs.columns if c not in (*order, "shard", "slot")]
    packed = [F.struct(*(F.col(f"`{c}`") for c in others)).alias("_others")] if others else []
    spread = materialize(
        docs.select(*order, *packed).repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "shard-rows"
    )
    totals = spread.groupBy("_part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("_rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("_all_bytes"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        spread.join(F.broadcast(starts) if parts <= 10_000 else starts, "_part")
        .withColumn("_offset", F.col("_bytes_before") + F.sum("size").over(upto) - F.col("size"))
        .withColumn("_place", F.col("_rows_before") + F.row_number().over(inside) - 1)
        .drop("_part", "_bytes_before", "_rows_before")
    )
    groups = placed.groupBy("grp").agg(
        F.min("_offset").alias("_grp_start"), F.sum("size").alias("_grp_bytes"), F.count(F.lit(1)).alias("members")
    )
    wide = groups.where("members > 1").select(F.col("grp").alias("_g"), "_grp_start", "_grp_bytes")
    joined = placed.join(wide, F.col("grp").eqNullSafe(F.col("_g")), "left")
    target = F.col("_all_bytes") / shards
    whole = F.col("_grp_bytes") <= target * slack
    middle = F.when(whole, F.col("_grp_start") + F.col("_grp_bytes") / 2).otherwise(F.col("_offset") + F.col("size") / 2)
    cut = joined.withColumn("shard", F.least(F.floor(middle / target), F.lit(shards - 1)).cast("int"))
    cut = materialize(cut.drop("_g", "_grp_start", "_grp_bytes", "_offset", "_all_bytes"), "shard-places")
    firsts = cut.groupBy("shard").agg(F.min("_place").alias("_first_place"))
    return (
        cut.join(F.broadcast(firsts), "shard")  # at most one row per shard
        .select(
            *order,
            *(F.col("_others")[c].alias(c) for c in others),
            "shard",
            (F.col("_place") - F.col("_first_place")).alias("slot"),
        )
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, *, slack: float = SLACK) -> DataFrame:
    """Documents with ``size``, ``shard`` and ``slot``, as ``shard_by_bytes`` places them.

    Places are found for digests of the rows, so texts are shuffled once, to meet their
    places. Equal rows are one text with several places. Columns of ``docs`` by the
    three names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    # The caller's columns travel in one, so that no name of theirs meets one used here.
    keyed = docs.select(F.struct(*(F.col(f"`{name}`") for name in columns)).alias("doc"), *row_key(columns))
    digest = keyed.select(
        "key_a",
        "key_b",
        F.col("doc.doc_id").alias("doc_id"),
        document_size(F.col("doc.text")).alias("size"),
        text_group(F.col("doc.text")).alias("grp"),
    )
    places = materialize(shard_by_bytes(digest, shards, slack=slack).select("key_a", "key_b", "size", "shard", "slot"), "document-places")
    return keyed.dropDuplicates(["key_a", "key_b"]).join(places, ["key_a", "key_b"]).select(
        *(F.col("doc")[name].alias(name) for name in columns), "size", "shard", "slot"
    )
