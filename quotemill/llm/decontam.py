"""Benchmark decontamination by spaced seeds, with DataFrame operations only.

A seed is a mask over eight consecutive words that ignores two of them. Hashes of the
words a mask keeps, at every position, are made for the test items and for the
documents, and joined. A hit aligns an item with a document; around it the words are
compared one by one, and a stretch that agrees well enough is an overlap, whatever
words were put in place of others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.session import materialize

#: Together these two meet every stretch of 13 words in which at most 2 differ.
MASKS = ("11101011", "11001111")
WINDOW = 13
SIMILARITY = 0.8
#: Items below this many words are a copy only word for word.
SHORTEST = len(MASKS[0])
#: Test hashes are sent to all tasks up to so many (16 bytes of content each).
BROADCAST_SEEDS = 2_000_000
_GAP = r"[^\p{L}\p{N}]+"


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, letters and digits in lower case; empty for null."""
    found = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _GAP), lambda w: w != "")
    return F.transform(found, lambda w: F.xxhash64(w))


def _seeds(hashes: Column) -> Column:
    """(mask, position, hash) of all positions at which the masks fit."""
    def sown(number: int, mask: str) -> Column:
        kept = [place for place, mark in enumerate(mask) if mark == "1"]
        last = F.size(hashes) - len(mask)
        positions = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

        def seed(at: Column) -> Column:
            key = F.xxhash64(F.lit(number), *[F.get(hashes, at + place) for place in kept])
            return F.struct(at.alias("at"), key.alias("seed"))

        return F.transform(positions, seed)

    return F.concat(*[sown(number, mask) for number, mask in enumerate(MASKS)])


def _spans(size: int, similarity: float) -> list[tuple[int, int]]:
    """(start, length) of spans of an item, one of which at least every similar stretch keeps whole."""
    parts = 1 if size < SHORTEST else size - math.ceil(size * similarity) + 1
    cuts = [size * part // parts for part in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _span_seed(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(-length), *[F.get(hashes, at + place) for place in range(length)])


def _short_seeds(hashes: Column, sizes: list[int], similarity: float) -> Column:
    """(position, hash) of the spans of an item whose number of words is one of ``sizes``."""
    out = F.array().cast("array<struct<at:int,seed:bigint>>")
    for size in sizes:
        spans = [
            F.struct(F.lit(at).alias("at"), _span_seed(hashes, F.lit(at), length).alias("seed"))
            for at, length in _spans(size, similarity)
        ]
        out = F.when(F.size(hashes) == size, F.array(*spans)).otherwise(out)
    return out


def _stretches(hashes: Column, lengths: list[int]) -> Column:
    """(position, hash) of all stretches of the given lengths in a text."""
    def each(length: int) -> Column:
        last = F.size(hashes) - length
        positions = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(positions, lambda at: F.struct(at.alias("at"), _span_seed(hashes, at, length).alias("seed")))

    return F.concat(*[each(length) for length in lengths])


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    short_items: bool = True,
) -> DataFrame:
    """Texts of ``docs`` that share a stretch with a test item: one row per text and item.

    ``docs`` has ``text`` and ``items`` has ``item_id`` and ``text``. The result has
    ``text_key`` (the digest of a whole text, ``text_hash``), ``item_id``, ``matched`` (the
    most words that agree within one window, 13 words or the whole of a shorter item),
    ``item_words``, and ``item_start`` and ``text_start``, the words at which that window
    begins. A window counts if at least ``similarity`` of its words agree in place. The share
    holds for items shorter than a window too: one of 8 words or more counts where at least
    ``similarity`` of its words agree, found by spans of which a similar stretch keeps one
    whole, and one of 1 to 7 words where all do. Spans are only made for the lengths that
    occur among the items.

    Without ``short_items``, for test sets of short common phrases, items of 8 to 12 words have
    to be there word for word and those of fewer words take no part.

    Equal texts are one text. Null texts and ids of items take no part, nor do items without
    words. Repeated items are one. Empty tables give no rows.
    """
    spark = docs.sparkSession
    test = (
        items.where("item_id IS NOT NULL AND text IS NOT NULL")
        .select("item_id", word_hashes(F.col("text")).alias("item_hashes"))
        .where(F.size("item_hashes") >= (1 if short_items else SHORTEST))
        .distinct()
    )
    test = materialize(test, "test-items")
    sizes = []
    if short_items:
        brief = test.select(F.size("item_hashes").alias("n")).where(F.col("n") < window).distinct().collect()
        sizes = sorted(row.n for row in brief)
    lengths = sorted({length for size in sizes for _, length in _spans(size, similarity)})
    item_seeds, text_seeds = _seeds(F.col("item_hashes")), _seeds(F.col("hashes"))
    if sizes:
        item_seeds = F.concat(item_seeds, _short_seeds(F.col("item_hashes"), sizes, similarity))
        text_seeds = F.concat(text_seeds, _stretches(F.col("hashes"), lengths))
    sown = test.select("item_id", F.explode(item_seeds).alias("s")).select(
        "item_id", F.col("s.at").alias("item_at"), "s.seed"
    )
    sown = materialize(sown.distinct(), "test-seeds")
    keyed = docs.where("text IS NOT NULL").select(text_hash(F.col("text")).alias("text_key"), "text")
    # The hashes are made once, then walked by both masks.
    sought = (
        keyed.select("text_key", word_hashes(F.col("text")).alias("hashes"))
        .select("text_key", F.explode(text_seeds).alias("s"))
        .select("text_key", F.col("s.at").alias("at"), "s.seed")
    )
    small = sown.count() <= BROADCAST_SEEDS
    hits = (
        sought.join(F.broadcast(sown) if small else sown, "seed")
        .select("text_key", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    hits = materialize(hits, "seed-hits")
    # Only texts with hits are read again; equal ones once.
    texts = (
        keyed.join(hits.select("text_key").distinct(), "text_key", "left_semi")
        .dropDuplicates(["text_key"])
        .select("text_key", word_hashes(F.col("text")).alias("hashes"))
    )
    aligned = hits.join(texts, "text_key").join(test, "item_id")
    begin = F.greatest(F.lit(0), -F.col("shift"))
    end = F.least(F.size("item_hashes"), F.size("hashes") - F.col("shift"))
    width = F.least(F.lit(window), F.size("item_hashes"))
    lined = aligned.select(
        "text_key",
        "item_id",
        "shift",
        begin.alias("begin"),
        width.alias("width"),
        F.size("item_hashes").alias("item_words"),
        F.zip_with(
            F.slice("hashes", begin + F.col("shift") + 1, end - begin),
            F.slice("item_hashes", begin + 1, end - begin),
            lambda a, b: (a == b).cast("int"),
        ).alias("same"),
    ).where(F.size("same") >= F.col("width"))
    # Each window's agreement, best first; earlier windows win ties.
    windows = F.transform(
        F.sequence(F.lit(0), F.size("same") - F.col("width")),
        lambda at: F.struct(
            F.aggregate(F.slice("same", at + 1, F.col("width")), F.lit(0), lambda total, one: total + one).alias("matched"),
            (-at).alias("back"),
        ),
    )
    whole = SHORTEST if short_items else window
    best = lined.withColumn("best", F.array_max(windows)).where(
        F.col("best.matched") >= F.when(F.col("width") < whole, F.col("width")).otherwise(F.ceil(F.col("width") * similarity))
    )
    row = F.struct(
        F.col("best.matched").alias("matched"),
        (-(F.col("begin") - F.col("best.back"))).alias("order"),
        (-F.col("shift")).alias("back"),
    )
    return (
        best.groupBy("text_key", "item_id")
        .agg(F.max(row).alias("row"), F.max("item_words").alias("item_words"))
        .select(
            "text_key",
            "item_id",
            F.col("row.matched").alias("matched"),
            "item_words",
            (-F.col("row.order")).alias("item_start"),
            (-F.col("row.order") - F.col("row.back")).alias("text_start"),
        )
    )


def text_hash(text: Column) -> Column:
    """The key by which ``overlaps`` names a text: its MD5, 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document and test item that overlap: ``doc_id`` and what ``overlaps`` tells.

    Copies of a text are reported each; repeated rows as often as they come. A null id
    stays null.
    """
    found = materialize(overlaps(docs, items, **options), "overlaps")
    named = docs.where("text IS NOT NULL").select("doc_id", text_hash(F.col("text")).alias("text_key"))
    return named.join(found, "text_key").drop("text_key")


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that overlap no test item, with their own columns; null texts stay."""
    found = materialize(overlaps(docs, items, **options).select("text_key").distinct(), "overlapping-texts")
    return docs.join(found, text_hash(F.col("text")) == found.text_key, "left_anti")
