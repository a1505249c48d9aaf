"""SimHash fingerprints and near-duplicate classes by a Gray-ordered hierarchical index.

Distinct fingerprints are sorted by Gray rank, the order in which consecutive codes
differ in one bit, so that neighbours share many bit positions. Consecutive runs form
the groups of the index. A node holds the positions on which everything below it
agrees (its mask) and their values (its pattern). A fingerprint that differs from the
pattern on more than ``max_bits`` masked positions cannot have a partner below the
node, so the whole group is pruned. The upper nodes, a bounded number, travel to every
task; the fingerprints themselves are only ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.components import component_ids
from quotemill.session import materialize

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Hashes turned into bit counts at a time, so that a very long text needs no more memory.
_HASHES_AT_ONCE = 1 << 16
#: Fingerprints compared at a time in a group.
_ROWS_AT_ONCE = 2048
_PROBES_PER_TASK = 131_072
#: Fingerprints below one node of the lowest level.
_LEAF = 32
_FANOUT = 16


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a whole text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    shingles = max(1, len(words) - width + 1)
    ends = np.cumsum([len(word) + 1 for word in words])
    joined = b" ".join(words)
    starts = np.concatenate(([0], ends[:-1]))[:shingles].tolist()
    stops = (ends - 1)[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, shingles, _HASHES_AT_ONCE):
        pieces = zip(starts[at : at + _HASHES_AT_ONCE], stops[at : at + _HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in pieces], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(counts * 2 > shingles)
    return int.from_bytes(bits.tobytes(), "big")


def with_fingerprint(docs: DataFrame, width: int = 3, text: str = "text") -> DataFrame:
    """Adds ``fp``, the fingerprint as a signed 64-bit integer, in place of the text."""

    @F.pandas_udf("bigint")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = np.fromiter(
                (fingerprint(t, width) for t in batch), dtype=np.uint64, count=len(batch)
            )
            yield pd.Series(values.view(np.int64))

    return docs.withColumn("fp", fingerprints(F.col(text)))


def gray_rank(fp: Column) -> Column:
    """Position of a code in the Gray sequence, shifted so that signed order is its order."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(2**63)).cast("bigint"))


def _ranks(codes: np.ndarray) -> np.ndarray:
    """``gray_rank`` of an array."""
    rank = codes
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return (rank ^ np.uint64(2**63)).view(np.int64)


class Nodes:
    """Nodes of one tree, level by level: masks, patterns and the range of children."""

    def __init__(self, shared_and: np.ndarray, shared_or: np.ndarray):
        self.levels = []
        while True:
            self.levels.append((~(shared_and ^ shared_or), shared_and))
            if len(shared_and) <= _FANOUT:
                break
            cuts = np.arange(0, len(shared_and), _FANOUT)
            shared_and = np.bitwise_and.reduceat(shared_and, cuts)
            shared_or = np.bitwise_or.reduceat(shared_or, cuts)
        self.levels.reverse()

    def reached(self, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (code, lowest node) whose accumulated differences stay within the bound."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(codes), _ROWS_AT_ONCE):
            part = codes[at : at + _ROWS_AT_ONCE]
            top = len(self.levels[0][0])
            row = np.repeat(np.arange(len(part)), top)
            node = np.tile(np.arange(top), len(part))
            for depth, (mask, pattern) in enumerate(self.levels):
                if depth:
                    children = node[:, None] * _FANOUT + np.arange(_FANOUT)
                    row, node = np.repeat(row, _FANOUT), children.ravel()
                    there = node < len(mask)
                    row, node = row[there], node[there]
                near = np.bitwise_count((part[row] ^ pattern[node]) & mask[node]) <= max_bits
                row, node = row[near], node[near]
            found.append((row + at, node))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _local_links(probes: np.ndarray, codes: np.ndarray, max_bits: int):
    """Pairs (probe, code) of positions within the bound; ``codes`` come in Gray order."""
    cuts = np.arange(0, len(codes), _LEAF)
    leaves = Nodes(np.bitwise_and.reduceat(codes, cuts), np.bitwise_or.reduceat(codes, cuts))
    for at in range(0, len(probes), _ROWS_AT_ONCE):
        part = probes[at : at + _ROWS_AT_ONCE]
        row, leaf = leaves.reached(part, max_bits)
        place = (leaf[:, None] * _LEAF + np.arange(_LEAF)).ravel()
        row = np.repeat(row, _LEAF)
        there = place < len(codes)
        row, place = row[there], place[there]
        near = np.bitwise_count(part[row] ^ codes[place]) <= max_bits
        yield row[near] + at, place[near]


def fingerprint_links(
    codes: DataFrame, max_bits: int = 2, *, group_rows: int = 65_536, max_groups: int = 16_384
) -> DataFrame:
    """All pairs (``src``, ``dst``) of ``node`` whose codes ``fp`` differ in 1..max_bits bits.

    ``codes`` has one row per distinct code: ``fp`` and a unique ``node``. Groups hold
    ``group_rows`` codes or, in very large inputs, as many as keep the number of groups,
    hence what is sent to every task, below ``max_groups``.
    Every code probes the groups from its own one on, so a pair is met once. Groups that
    many codes probe are split over tasks by the probing code.
    """
    spark = codes.sparkSession
    total = codes.count()
    rows = max(group_rows, -(-total // max_groups))
    parts = max(1, min(max_groups, -(-total // rows)))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            batch["part"], batch["place"] = part, seen + np.arange(len(batch))
            seen += len(batch)
            yield batch

    ranked = materialize(
        codes.select("fp", "node", gray_rank(F.col("fp")).alias("rank"))
        .repartitionByRange(parts, "rank")
        .sortWithinPartitions("rank")
        .mapInPandas(placed, "fp bigint, node bigint, rank bigint, part int, place bigint"),
        "gray-order",
    )
    # Groups are runs of the whole order, wherever its partitions end.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranked.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before")
    )
    grouped = ranked.join(starts, "part").select(
        "fp", "node", "rank", F.expr(f"(before + place) div {rows}").alias("grp")
    )
    grouped = materialize(grouped, "gray-groups")
    upper = (
        grouped.groupBy("grp")
        .agg(F.bit_and("fp").alias("a"), F.bit_or("fp").alias("o"))
        .orderBy("grp")
        .toPandas()
    )
    if upper.empty:
        return spark.createDataFrame([], "src bigint, dst bigint")
    ids = upper["grp"].to_numpy(np.int64)
    tree = Nodes(upper["a"].to_numpy(np.int64).view(np.uint64), upper["o"].to_numpy(np.int64).view(np.uint64))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            code = batch["fp"].to_numpy(np.int64)
            row, group = tree.reached(code.view(np.uint64), max_bits)
            later = ids[group] >= batch["grp"].to_numpy(np.int64)[row]
            row, group = row[later], group[later]
            yield pd.DataFrame(
                {"fp": code[row], "node": batch["node"].to_numpy(np.int64)[row], "grp": ids[group]}
            )

    probes = materialize(
        grouped.select("fp", "node", "grp").mapInPandas(probe, "fp bigint, node bigint, grp bigint"),
        "gray-probes",
    )
    # A group met by many codes is solved in several tasks, each with its share of them.
    shares = (
        probes.groupBy("grp")
        .count()
        .select("grp", F.ceil(F.col("count") / _PROBES_PER_TASK).cast("int").alias("shares"))
    )
    left = probes.join(shares, "grp").select(
        "grp", F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int").alias("share"), "fp", "node"
    )
    right = grouped.join(shares, "grp").select(
        "grp",
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
        "fp",
        "node",
        "rank",
    )

    def solve(probing: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("rank")
        order = members["rank"].to_numpy(np.int64)
        code = members["fp"].to_numpy(np.int64).view(np.uint64)
        node = members["node"].to_numpy(np.int64)
        asking = probing["fp"].to_numpy(np.int64).view(np.uint64)
        asker = probing["node"].to_numpy(np.int64)
        place_of = _ranks(asking)
        found = [pd.DataFrame({"src": [], "dst": []}, dtype=np.int64)]
        if len(code) and len(asking):
            for row, place in _local_links(asking, code, max_bits):
                # Groups follow the order, so of each pair the one that comes first asks.
                once = place_of[row] < order[place]
                found.append(pd.DataFrame({"src": asker[row][once], "dst": node[place][once]}))
        return pd.concat(found, ignore_index=True)

    return (
        left.groupBy("grp", "share")
        .cogroup(right.groupBy("grp", "share"))
        .applyInPandas(solve, "src bigint, dst bigint")
    )


def simhash_classes(
    docs: DataFrame, *, width: int = 3, max_bits: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Near-duplicate class of every document: ``doc_id``, ``fp``, ``component_id``.

    Two documents link when their fingerprints differ in at most ``max_bits`` of 64
    bits; a class is everything reachable over links, named by its smallest id. Equal
    fingerprints meet by grouping, so copies never form pairs.

    A null text counts as empty; texts without words have fingerprint zero and link like
    any other. A row with a null id is fingerprinted and gets the class of its
    fingerprint, but gives no name to it: its ``component_id`` is null when no document
    with an id has that fingerprint. Repeated rows come back as often as they came in.
    No rows in, no rows out. Other columns of ``docs`` are not looked at.
    """
    marked = materialize(
        with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), width)
        .select("doc_id", "fp"),
        "fingerprints",
    )
    codes = marked.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"))
    codes = materialize(codes, "fingerprint-nodes")
    classes = component_ids(fingerprint_links(codes, max_bits))
    named = codes.join(classes, "node", "left").select(
        "fp", F.coalesce("component_id", "node").alias("component_id")
    )
    return marked.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents without near copies: of each class, the row with the smallest id.

    Rows that repeat that id are one document: the one with the smallest text stays.
    Rows without an id are kept, as nothing names them.
    """
    classes = simhash_classes(docs, **options)
    kept = classes.where("doc_id = component_id").select("doc_id").distinct()
    first = docs.join(kept, "doc_id", "left_semi")
    others = [c for c in docs.columns if c != "doc_id"]
    one = first.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in others if c != "text"])).alias("row"))
    return one.select(*[F.col("doc_id") if c == "doc_id" else F.col("row")[c].alias(c) for c in docs.columns]).unionByName(
        docs.where("doc_id IS NULL")
    )
