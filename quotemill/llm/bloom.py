"""Bloom filters of a fixed greatest size, to save work before an exact join or comparison.

A filter tells "certainly not" or "perhaps". It is built in Spark by OR-ing bits, and
sent to the tasks. Its size follows the number of keys up to a fixed bound; beyond that
it answers "perhaps" more often, which costs work and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of the largest filter: 16 MiB, about 12 bits a key for 11 million keys.
MOST_WORDS = 1 << 21
_BITS_PER_KEY = 12
#: Words that reach the driver in one row; the smallest filter.
_SLICE = 1 << 10


def _mixed(keys: np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _places(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each key and its bits in it; ``words`` is a power of two."""
    x = _mixed(keys)
    bits = np.zeros(len(x), dtype=np.uint64)
    for shift in (46, 52, 58):
        bits |= np.uint64(1) << ((x >> np.uint64(shift)) & np.uint64(63))
    return (x & np.uint64(words - 1)).astype(np.int64), bits


class Bloom:
    def __init__(self, table: np.ndarray):
        self.table = table

    def perhaps(self, keys: np.ndarray) -> np.ndarray:
        """Which keys (64-bit, signed or not) may be in the set; False is certain."""
        word, bits = _places(keys.view(np.uint64), len(self.table))
        return self.table[word] & bits == bits

    def column(self, key: Column) -> Column:
        """``perhaps`` of a bigint column without nulls."""
        own = self

        @F.pandas_udf("boolean")
        def perhaps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(own.perhaps(batch.to_numpy(np.int64)))

        return perhaps(key)


def bloom_of(keys: DataFrame) -> Bloom:
    """The filter of the one bigint column of a written table; nulls are not allowed."""
    words = _SLICE
    wanted = keys.count() * _BITS_PER_KEY // 64
    while words < min(wanted, MOST_WORDS):
        words *= 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, bits = _places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), words)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    marked = keys.mapInArrow(place, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # At most MOST_WORDS rows are left, whatever the number of keys; they come packed.
    slices = marked.groupBy(F.expr(f"word div {_SLICE}").alias("slice")).agg(F.collect_list(F.struct("word", "bits")).alias("marks"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for number, marks in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.zeros(_SLICE, dtype="<u8")
                word = marks.values.field("word").to_numpy(zero_copy_only=False)
                own[word - number * _SLICE] = marks.values.field("bits").to_numpy(zero_copy_only=False).view(np.uint64)
                packed.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["slice", "packed"])

    table = np.zeros(words, dtype=np.uint64)
    for row in slices.mapInArrow(pack, "slice bigint, packed binary").collect():
        table[row.slice * _SLICE : (row.slice + 1) * _SLICE] = np.frombuffer(row.packed, dtype="<u8")
    return Bloom(table)
