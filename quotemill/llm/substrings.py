"""Substring deduplication by Rabin-Karp hashes of every window of words.

A window is a fixed number of consecutive words of a document. Its hash is a polynomial
in the hashes of its words, so all windows of a text follow from one running sum. The
hashes of all windows are counted in Spark, combined in the task before the shuffle.
Windows that more than one text holds are looked up again with a hash of twice the
length; each is removed from every document but that with the smallest id, and the
windows removed from a text merge into maximal intervals of words.

Copies of a whole text, of which all but the first go as a whole, are told by their
digests and kept out of the counting where possible. Filters of bounded size keep
windows and texts that certainly take no part from being shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.bloom import Bloom, bloom_of
from quotemill.session import materialize, sized_shuffles

WIDTH = 50
#: Two pairs of moduli just below 2^31 and their bases; a pair makes a hash of 62 bits.
_FIELDS = ((2147483647, 1483721947), (2147483629, 1103527590), (2147483587, 1812433253), (2147483579, 1664525011))
#: Words hashed at a time, unless one text has more.
_WORDS_AT_ONCE = 1 << 18
_CACHED_WORDS = 1 << 18
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: A hash met in more texts than this, and than one in 2^21 bytes, is settled without a
#: shuffle of its rows; there are at most 2^20 such hashes.
_COMMON = 1000
#: Rows of the count take about this many times the bytes of the text.
_EXPANSION = 5


class _WordHashes(dict):
    """Hashes of words, remembered while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _powers(base: int, modulus: int, count: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), modulus)) % np.uint64(modulus)])
    return out[:count]


class WindowHasher:
    """Hashes of all windows of texts, many texts at a time."""

    def __init__(self, width: int):
        self.width = width
        self._words = _WordHashes()
        self._tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def values(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._words.__getitem__, words), np.uint64, len(words))

    def starts(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places at which windows begin in texts laid end to end, and the text of each."""
        windows = np.maximum(lengths - self.width + 1, 0)
        text = np.repeat(np.arange(len(lengths)), windows)
        before = np.cumsum(lengths) - lengths
        return np.arange(len(text)) - (np.cumsum(windows) - windows)[text] + before[text], text

    def hashes(self, values: np.ndarray, starts: np.ndarray, pair: int) -> np.ndarray:
        """62-bit hashes of the windows that begin at ``starts``, by the first or second pair of fields."""
        high, low = (self._field(values, starts, 2 * pair + half) for half in (0, 1))
        return (high << np.uint64(31)) | low

    def _field(self, values: np.ndarray, starts: np.ndarray, field: int) -> np.ndarray:
        modulus, base = _FIELDS[field]
        if field not in self._tables or len(self._tables[field][0]) < len(values):
            count = max(len(values), 1024)
            self._tables[field] = (_powers(base, modulus, count), _powers(pow(base, -1, modulus), modulus, count))
        up, down = self._tables[field]
        p = np.uint64(modulus)
        # The running sum stays below 2^64 for 2^33 words.
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values % p * up[: len(values)] % p)])
        return (total[starts + self.width] - total[starts]) % p * down[starts] % p


def _laid_out(batches: Iterator[pa.RecordBatch], hasher: WindowHasher, leading: Bloom):
    """Texts with a window, some at a time: batch, their rows, lengths, and values of all their words.

    Batches have the columns ``key``, by which ``leading`` tells what may take part, and ``text``.
    """
    for batch in batches:
        rows: list[int] = []
        parts: list[np.ndarray] = []
        held = 0
        texts = batch.column("text")
        for row in np.flatnonzero(leading.perhaps(batch.column("key").to_numpy(zero_copy_only=False))):
            words = texts[row].as_buffer().to_pybytes().split()
            if len(words) >= hasher.width:
                rows.append(row)
                parts.append(hasher.values(words))
                held += len(words)
            if held >= _WORDS_AT_ONCE:
                yield batch, np.array(rows), np.array([len(p) for p in parts]), np.concatenate(parts)
                rows, parts, held = [], [], 0
        if rows:
            yield batch, np.array(rows), np.array([len(p) for p in parts]), np.concatenate(parts)


def _once_per_text(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places that keep each key once for each text, in the order of the keys; ``text`` ascends."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (text[order][1:] != text[order][:-1])
    return order[new]


def removed_windows(docs: DataFrame, *, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``text_hash``, ``whole`` and ``windows``: what goes from which text.

    ``docs`` has ``doc_id`` (bigint) and ``text``. One row for each text, named by its id and
    ``text_hash`` (xxhash64 of the text), that loses something: ``windows`` are the hash pairs
    (struct of ``a`` and ``b``) of its windows that a document with a smaller id also holds;
    ``whole`` is true for a text that equals one of a smaller id, all of whose windows go
    whether listed or not.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    base = docs.where("doc_id IS NOT NULL").select(
        "doc_id",
        F.xxhash64(text).alias("text_hash"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        text.cast("binary").alias("text"),
    )
    named = materialize(base.select("doc_id", "text_hash", "digest", F.octet_length("text").alias("bytes")), "text-digests")
    size = named.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    # Enough bits that few windows of different words meet by chance, and no more to shuffle.
    bits = min(62, max(32, size.bit_length() + 10))
    common = max(_COMMON, size >> 21)
    with sized_shuffles(spark, size * _EXPANSION):
        firsts = materialize(named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "first-texts")
        copies = materialize(
            named.select("doc_id", "digest", "text_hash").distinct().join(firsts, ["digest", "doc_id"], "left_anti"),
            "text-copies",
        )
        leading = bloom_of(firsts.select(F.xxhash64("digest", "doc_id")))
        # What the filter rejects is certainly a copy; a copy it lets through is only more work.
        sought = base.select(F.xxhash64("digest", "doc_id").alias("key"), "doc_id", "text_hash", "text")

        def short(hashes: np.ndarray) -> np.ndarray:
            return (hashes * _SPREAD) >> np.uint64(64 - bits)

        def sow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher = WindowHasher(width)
            for _, _, lengths, values in _laid_out(batches, hasher, leading):
                starts, own = hasher.starts(lengths)
                keys = short(hasher.hashes(values, starts, 0))
                each, texts = np.unique(keys[_once_per_text(keys, own)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(each.view(np.int64)), pa.array(texts)], names=["h", "texts"])

        # Counts of some 2^18 words at a time leave the task, so a hash comes once for all texts
        # that these words make up. Nearly all hashes are unlike; a map of them in the task would
        # take memory and combine little more.
        sown = sought.select("key", "text").mapInArrow(sow, "h bigint, texts bigint").repartition("h")
        counts = sown.groupBy("h").agg(F.sum("texts").alias("texts"))
        repeated = materialize(counts.where("texts > 1"), "repeated-hashes")
        known = bloom_of(repeated.select("h"))
        # At most one in 2^20 of the windows, by the definition of ``common``.
        hot = np.sort(repeated.where(F.col("texts") > common).select("h").toPandas()["h"].to_numpy(np.int64))

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher = WindowHasher(width)
            for batch, rows, lengths, values in _laid_out(batches, hasher, leading):
                starts, own = hasher.starts(lengths)
                a = hasher.hashes(values, starts, 0)
                keys = short(a).view(np.int64)
                at = np.flatnonzero(known.perhaps(keys))
                if len(at):
                    at = at[_once_per_text(a[at], own[at])]
                    b = hasher.hashes(values, starts[at], 1)
                    place = pa.array(rows[own[at]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(a[at].view(np.int64)),
                            pa.array(b.view(np.int64)),
                            pa.array(np.isin(keys[at], hot)),
                            batch.column("doc_id").take(place),
                            batch.column("text_hash").take(place),
                        ],
                        names=["a", "b", "hot", "doc_id", "text_hash"],
                    )

        found = materialize(
            sought.mapInArrow(find, "a bigint, b bigint, hot boolean, doc_id bigint, text_hash bigint"), "repeated-windows"
        )
        usual, hottest = found.where("NOT hot"), found.where("hot")
        least = F.min("doc_id").over(Window.partitionBy("a", "b"))
        later = usual.withColumn("least", least).where("doc_id > least")
        # As many rows as there are hot hashes, which are bounded.
        leaders = hottest.groupBy("a", "b").agg(F.min("doc_id").alias("least"))
        hot_later = hottest.join(F.broadcast(leaders), ["a", "b"]).where("doc_id > least")
        pair = F.struct("a", "b").alias("pair")
        parts = [frame.select("doc_id", "text_hash", F.lit(False).alias("whole"), pair) for frame in (later, hot_later)]
        no_pair = F.lit(None).cast("struct<a:bigint,b:bigint>").alias("pair")
        marks = parts[0].unionByName(parts[1]).unionByName(copies.select("doc_id", "text_hash", F.lit(True).alias("whole"), no_pair))
        return materialize(
            marks.groupBy("doc_id", "text_hash").agg(F.max("whole").alias("whole"), F.collect_list("pair").alias("windows")),
            "removed-windows",
        )


def _intervals(words: int, starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal intervals of words that windows at ``starts`` cover; an interval that meets another joins it."""
    change = np.zeros(words + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    inside = np.concatenate([[0], (np.cumsum(change)[:-1] > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(inside))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def remove_repeats(docs: DataFrame, *, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``spans`` and ``kept`` of every document.

    ``docs`` has ``doc_id`` (bigint) and ``text``; other columns are not looked at. Words are
    runs of anything but ASCII white space, as they are. A word goes if some window of
    ``width`` words that covers it begins, word for word, in a document with a smaller id.
    ``spans`` are the maximal intervals of removed words, from their first word to the one
    after their last; ``kept`` are the other words, joined by one space.

    Windows are judged on the texts as they come, not on what is left of them. Rows with one
    id are one document: they take nothing from each other, and repeated rows come back as
    often as they are there. A row without an id has no place in the order: it loses nothing
    and costs others nothing. Null and empty texts have no words; texts shorter than a window
    stay whole. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    marks = removed_windows(docs, width=width)
    touched = bloom_of(marks.select(F.xxhash64("doc_id", "text_hash")))
    hashed = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    rows = hashed.withColumn("key", F.xxhash64("doc_id", "text_hash"))
    # Only texts that may lose something are shuffled to their marks.
    cut = rows.where(touched.column(F.col("key"))).join(marks, ["doc_id", "text_hash"], "left")

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The other texts, which have no marks."""
        for batch in batches:
            own = batch.filter(pa.array(~touched.perhaps(batch.column(0).to_numpy(zero_copy_only=False))))
            none = [pa.nulls(len(own), pa.bool_()), pa.nulls(len(own), pa.null())]
            yield pa.RecordBatch.from_arrays([own.column(1), own.column(2), *none], names=["doc_id", "text", "whole", "windows"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WindowHasher(width)
        for batch in batches:
            lengths, removed, spans, kept = [], [], [], []
            for text_, whole, windows in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                words = text_.as_buffer().to_pybytes().split()
                gone: list[tuple[int, int]] = []
                if len(words) >= width and whole.as_py():
                    gone = [(0, len(words))]
                elif len(words) >= width and windows.is_valid and len(windows):
                    starts = np.arange(len(words) - width + 1)
                    gone = _intervals(len(words), starts[_marked(hasher, hasher.values(words), starts, windows.values)], width)
                rest, at = [], 0
                for start, end in gone:
                    rest += words[at:start]
                    at = end
                rest += words[at:]
                lengths.append(len(words))
                removed.append(len(words) - len(rest))
                spans.append([{"start": a, "end": b} for a, b in gone])
                kept.append(b" ".join(rest).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    schema = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept string"
    same = rows.select("key", "doc_id", "text").mapInArrow(lambda batches: remove(stay(batches)), schema)
    return same.unionByName(cut.select("doc_id", "text", "whole", "windows").mapInArrow(remove, schema))


def _marked(hasher: WindowHasher, values: np.ndarray, starts: np.ndarray, windows: pa.StructArray) -> np.ndarray:
    """Which windows of a text are among the given pairs of hashes."""
    pairs = np.stack([windows.field(name).to_numpy(zero_copy_only=False) for name in ("a", "b")], axis=1)
    own = np.stack([hasher.hashes(values, starts, pair).view(np.int64) for pair in (0, 1)], axis=1)
    joined = np.concatenate([pairs, own]).view([("a", np.int64), ("b", np.int64)]).ravel()
    _, number = np.unique(joined, return_inverse=True)
    return np.isin(number[len(pairs) :], number[: len(pairs)])
