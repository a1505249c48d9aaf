"""Mixing sources to target weights, block by block, with DataFrame operations only.

The words of a source form one stream, cut into blocks of fixed length. A source's
target says how many slots of the output it fills; each slot draws its output shard, so
that the counts of a source over the shards are multinomial. Slots are numbered through
shard after shard and mapped to blocks by a pseudorandom permutation of the source's
block numbers; a stream that is needed more than once is run through whole before it is
drawn from again, so no block is taken more than once oftener than another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import row_key, words
from quotemill.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 512
SLOTS_PER_SHARD = 4096
_SLOTS_PER_TASK = 32_768
#: Rounds of the permutation; each decides for every number whether to trade places.
_ROUNDS = 16
#: Documents of one source whose offsets are summed in one task, on average.
_ROWS_PER_CELL = 4096


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``source``, ``source_size``, ``weight``, ``target`` of every source.

    ``sizes`` has one row per source. Sources take the weights in turn, by code point,
    null last. Targets share ``share`` of all words by weight; none exceeds ``most``
    times its source, and what a source can't use goes to the others by weight. Full
    sources are those with the least size per weight, so the level of the others
    follows from running sums in that order. One row per source is sorted, no text.
    """
    total = F.sum("source_size").over(Window.partitionBy())
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ).withColumn("all_words", F.coalesce(total, F.lit(0)) * share)
    fullness = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullness.rowsBetween(Window.unboundedPreceding, -1)
    onward = fullness.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("all_words") - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    leveled = ranked.withColumn("level", level)
    # The first source that isn't full sets the level of all that follow.
    fits = F.col("weight") * F.col("level") <= F.col("source_size") * most
    first = F.first(F.when(fits, F.col("level")), ignorenulls=True).over(
        fullness.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return leveled.withColumn("chosen", first).select(
        "source",
        "source_size",
        "weight",
        F.least(
            F.col("source_size") * most, F.coalesce(F.col("weight") * F.col("chosen"), F.col("source_size") * most)
        ).alias("target"),
    )


def hashed(*parts: Column) -> Column:
    """60 bits of the MD5 of the parts, written out with colons between; a null reads ``null``.

    Any engine can tell it, so the whole mix can be told in SQL.
    """
    written = F.concat_ws(":", *[F.coalesce(part.cast("string"), F.lit("null")) for part in parts])
    return F.conv(F.substring(F.md5(written), 1, 15), 16, 10).cast("bigint")


def permuted(number: Column, size: Column, *key: Column) -> Column:
    """``number`` of 0..size-1 under a pseudorandom permutation that ``key`` chooses.

    In each round a number and its mirror about a round constant trade places or not,
    decided by a hash of the larger of the two; that is a permutation for any size.
    """

    def swap_or_not(now: Column, round_: Column) -> Column:
        mirror = F.pmod(F.pmod(hashed(*key, round_), size) + size - now, size)
        trade = hashed(*key, round_, F.greatest(now, mirror)).bitwiseAND(1) == 1
        return F.when(trade, mirror).otherwise(now)

    # A fold, as the number occurs several times in each round.
    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), number, swap_or_not)


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """The mix of a corpus: (documents with their source's target, pieces taken).

    ``docs`` has ``doc_id``, ``source`` and ``size``, the number of words. The first
    result has ``sid`` and ``row``, numbers of the source and of the row in it,
    ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``first_word``, the
    offset in the source's stream. The second has ``sid``, ``row``, ``pass``, ``shard``,
    ``slot``, ``start`` and ``words``: in that pass over the source, the slot takes so many
    of the row's words from ``start`` on.

    A source's pieces add up to its target rounded to whole words, within the last block
    exactly. Null sources are one source, null ids are documents like any others,
    repeated rows are separate documents, documents without words are never taken, and
    an empty table gives empty results. The order of a stream is by a hash of the id and
    the size, so reruns agree.
    """
    spark = docs.sparkSession
    rows = materialize(
        docs.select("doc_id", "source", F.col("size").cast("bigint").alias("size")).withColumn(
            "turn", hashed(F.col("doc_id"), F.col("size"), F.lit(seed))
        ),
        "mix-documents",
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    targets = materialize(
        source_targets(sizes.select("source", "source_size"), weights, share, most)
        .join(
            sizes.select(F.col("source").alias("s"), "documents"), F.col("source").eqNullSafe(F.col("s"))
        )
        .drop("s")
        .withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("cells", F.ceil(F.col("documents") / _ROWS_PER_CELL))
        .withColumn("goal", F.round("target").cast("bigint"))
        .withColumn("blocks", F.floor(F.col("source_size") / block_words)),
        "mix-targets",
    )

    # Offsets in the stream: within cells of a source, cells by their totals.
    celled = rows.join(targets, rows.source.eqNullSafe(targets.source)).select(
        "doc_id", rows.source, "size", "turn", "sid", "source_size", "target",
        F.pmod("turn", "cells").alias("cell"),
    )
    totals = celled.groupBy("sid", "cell").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    in_source = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "sid", "cell",
        F.coalesce(F.sum("words").over(in_source), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("rows").over(in_source), F.lit(0)).alias("rows_before"),
    )
    order = Window.partitionBy("sid", "cell").orderBy("turn", "doc_id", "size")
    placed = celled.join(starts, ["sid", "cell"]).select(
        (F.col("rows_before") + F.row_number().over(order) - 1).alias("row"),
        "doc_id", "source", "size", "source_size", "target", "sid",
        (F.col("words_before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("first_word"),
    )
    placed = materialize(placed, "mix-offsets")

    # Slots: passes over the whole stream, then what is left of the goal.
    passes = (
        targets.where("goal > 0")
        .select("sid", "source_size", "blocks", "goal", F.expr("goal div source_size").alias("whole"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole"))).alias("pass"))
        .withColumn("take", F.when(F.col("pass") < F.col("whole"), F.col("source_size")).otherwise(F.pmod("goal", "source_size")))
        .where("take > 0")
        .withColumn("slots", F.ceil(F.col("take") / block_words))
    )
    all_slots = passes.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-all_slots // SLOTS_PER_SHARD))
    # Few rows become many here, so the number of tasks follows what they become.
    tasks = max(1, -(-all_slots // _SLOTS_PER_TASK))
    # The draw: one shard for each slot, counted; then the counts are numbered through.
    runs = passes.select(
        "sid", "pass", "blocks", "take", "slots",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / SLOTS_PER_SHARD))).alias("run"),
    ).repartition(tasks, "sid", "pass", "run")
    draws = (
        runs.select(
            "sid", "pass", "blocks", "take",
            F.explode(
                F.sequence(
                    F.col("run") * SLOTS_PER_SHARD,
                    F.least(F.col("slots"), (F.col("run") + 1) * SLOTS_PER_SHARD) - 1,
                )
            ).alias("draw"),
        )
        .withColumn("shard", F.pmod(F.xxhash64("sid", "pass", "draw", F.lit(seed)), F.lit(shards)))
        .groupBy("sid", "pass", "blocks", "take", "shard")
        .count()
    )
    through = Window.partitionBy("sid", "pass").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    slots = (
        draws.withColumn("upto", F.sum("count").over(through))
        .repartition(tasks, "sid", "pass", "shard")
        .select("sid", "pass", "blocks", "take", "shard", F.explode(F.sequence(F.col("upto") - F.col("count"), F.col("upto") - 1)).alias("slot"))
        # The stream's last, shorter block keeps its place after all others.
        .withColumn(
            "block",
            F.when(
                F.col("slot") < F.col("blocks"),
                permuted(F.col("slot"), F.greatest("blocks", F.lit(1)), F.col("sid"), F.col("pass"), F.lit(seed)),
            ).otherwise(F.col("slot")),
        )
        .withColumn("block_take", F.least(F.lit(block_words).cast("bigint"), F.col("take") - F.col("slot") * block_words))
    )
    inside = (
        placed.where("size > 0")
        .select(
            "row", "sid", "size", "first_word",
            F.explode(
                F.sequence(
                    F.floor(F.col("first_word") / block_words),
                    F.floor((F.col("first_word") + F.col("size") - 1) / block_words),
                )
            ).alias("block"),
        )
    )
    left = F.greatest(F.col("first_word"), F.col("block") * block_words)
    right = F.least(F.col("first_word") + F.col("size"), F.col("block") * block_words + F.col("block_take"))
    pieces = (
        # Slots come out of small counts, so their size would be guessed far too low.
        inside.join(slots.hint("merge"), ["sid", "block"])
        .select("sid", "row", "pass", "shard", "slot", (left - F.col("first_word")).alias("start"), (right - left).alias("words"))
        .where("words > 0")
    )
    return placed, pieces


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` words.

    ``docs`` has ``doc_id``, ``text`` and ``source``; a null text has no words.
    """
    sized = docs.select("doc_id", "source", F.size(words(F.col("text"))).alias("size"))
    placed, pieces = mix(sized, **options)
    taken = pieces.groupBy("sid", "row").agg(F.sum("words").alias("taken"))
    return placed.join(taken, ["sid", "row"], "left").select(
        "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus, with the columns of ``docs``: a row per document and pass.

    A document that a pass takes whole keeps its text as it is. Of one taken in part the
    row holds the words of the blocks taken, in their order, joined by spaces, and
    ``n_chars``, if there, is theirs. Documents without words have no place in a mix.
    """
    # The caller's columns travel in one, so that no name of theirs meets one used here.
    counted = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("doc"),
        *row_key(docs.columns),
        "source",
        F.size(words(F.col("text"))).alias("size"),
    )
    placed, pieces = mix(counted.select(F.struct("key_a", "key_b").alias("doc_id"), "source", "size"), **options)
    # Equal rows share a key and a text; each has pieces of its own.
    taken = (
        pieces.groupBy("sid", "row", "pass")
        .agg(F.array_sort(F.collect_list(F.struct("start", "words"))).alias("pieces"), F.sum("words").alias("taken"))
        .join(placed.select("sid", "row", "doc_id"), ["sid", "row"])
        .select("doc_id.key_a", "doc_id.key_b", "pieces", "taken")
    )
    joined = counted.drop("source").dropDuplicates(["key_a", "key_b"]).join(taken, ["key_a", "key_b"])
    # Words first: one lambda in another would share variables between its uses.
    cut = joined.withColumn("words", words(F.col("doc.text"))).withColumn(
        "kept", F.transform("pieces", lambda p: F.slice("words", (p["start"] + 1).cast("int"), p["words"].cast("int")))
    )
    text = F.when(F.col("taken") == F.col("size"), F.col("doc.text")).otherwise(F.array_join(F.flatten("kept"), " "))
    whole = cut.select("doc", text.alias("text"))
    made = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return whole.select(*(made.get(name, F.col("doc")[name]).alias(name) for name in docs.columns))
