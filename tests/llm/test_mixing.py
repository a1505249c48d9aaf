import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from quotemill.llm import mixing
from quotemill.llm.oracle import ORACLE


def number(*parts):
    told = ":".join("null" if part is None else str(part) for part in parts)
    return int(hashlib.md5(told.encode()).hexdigest()[:15], 16)


def plain_mix(rows, block_words):
    """(place in ``rows``, words taken by each pass as (start, stop) in order) of (id, source, size)."""
    sources = sorted({source for _, source, _ in rows}, key=lambda s: (s is None, s or ""))
    targets = plain_targets({s: sum(n for _, own, n in rows if own == s) for s in sources})
    found = []
    for sid, source in enumerate(sources, 1):
        own = [(number(i, n, 0), at, n) for at, (i, s, n) in enumerate(rows) if s == source]
        cells = -(-len(own) // 4096)
        stream = [(at, word) for _, at, n in sorted(own, key=lambda t: (t[0] % cells, t[0])) for word in range(n)]
        goal = round(targets[source])
        for turn in range(-(-goal // len(stream)) if goal else 0):
            take = min(len(stream), goal - turn * len(stream))
            whole_blocks, words = len(stream) // block_words, {}
            for slot in range(-(-take // block_words)):
                block = slot
                for step in range(1, 17):
                    if slot < whole_blocks:
                        mirror = (number(sid, turn, 0, step) - block) % whole_blocks
                        if number(sid, turn, 0, step, max(block, mirror)) % 2:
                            block = mirror
                for at, word in stream[block * block_words :][: min(block_words, take - slot * block_words)]:
                    words.setdefault(at, []).append(word)
            found += [(at, sorted(own)) for at, own in words.items()]
    return found


def plain_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    """The rule as it is told: excess goes to the others by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_)
        target = {s: left * weight[s] / total for s in open_}
        above = [s for s in open_ if target[s] > most * sizes[s]]
        if not above:
            return {**full, **target}
        for s in above:
            full[s] = most * sizes[s]
            left -= full[s]


@pytest.mark.parametrize(
    "sizes", [{"a": 100, "b": 100, "c": 100}, {"b": 5, None: 1000, "a": 10, "é": 300, "z": 0}, {"a": 7}, {"a": 0}]
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutation(spark, size):
    frame = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size).cast("bigint"), F.lit(3)).alias("p"))
    assert sorted(r.p for r in frame.collect()) == list(range(size))


ROWS = [(i, "w " * (i * 37 % 400), "en", f"src{i % 4}") for i in range(120)]
ROWS += [(900, None, "en", None), (901, "a b c", "en", None), (None, "d e", "en", None), (3, "same row", "en", "src1")] * 2


def test_taken_words(spark, documents):
    rows = mixing.mixed_sizes(documents(ROWS, extra="row sid target shard"), block_words=16).collect()
    again = mixing.mixed_sizes(documents(ROWS), block_words=16).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(i), len((t or "").split())) for i, t, *_ in ROWS)
    sizes, taken = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    targets = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for source, words in taken.items():
        assert abs(words - targets[source]) <= 1


def test_taken_words_equal_sql(spark, documents):
    """All rows of the fixture, nulls and repeats included, and texts of many blocks."""
    rows = [(i, f"w{i} " * (i * 997 % 9000), "en", None if i % 5 == 0 else f"s{i % 5}") for i in range(60)] + ROWS
    docs = documents(rows)
    connection = duckdb.connect()
    connection.register("documents", docs.toArrow())
    want = connection.sql(ORACLE["op9_mixed_sources"])
    got = mixing.mixed_sizes(docs)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_taken_words_equal_the_plain_mix(spark, documents):
    rows = [(i, f"w{i} " * (i * 37 % 400), "en", None if i % 5 == 0 else f"s{i % 7}") for i in range(90)]
    sizes = [(i, source, len(text.split())) for i, text, _, source in rows]
    taken = dict.fromkeys(range(90), 0)
    for at, words in plain_mix(sizes, 16):
        taken[at] += len(words)
    got = mixing.mixed_sizes(documents(rows), block_words=16).collect()
    assert {r.doc_id: r.taken for r in got} == taken


def test_pieces_do_not_overlap_and_fill_slots(spark, documents):
    sized = documents(ROWS).select("doc_id", "source", F.size(mixing.words(F.col("text"))).alias("size"))
    _, pieces = mixing.mix(sized, block_words=16)
    seen = set()
    slots = {}
    for r in pieces.collect():
        for word in range(r.start, r.start + r.words):
            assert (r.sid, r.row, r["pass"], word) not in seen
            seen.add((r.sid, r.row, r["pass"], word))
        slots[(r.sid, r["pass"], r.slot)] = slots.get((r.sid, r["pass"], r.slot), 0) + r.words
    assert max(slots.values()) <= 16


def test_documents(spark, documents):
    rows = mixing.mixed_documents(documents(ROWS), block_words=16).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {}
    for i, text, _, source in ROWS:
        texts.setdefault((i, source), set()).add(text)
    for r in rows:
        assert r.n_chars == len(r.text)
        assert any(len(r.text.split()) <= len((t or "").split()) for t in texts[(r.doc_id, r.source)])
    taken = mixing.mixed_sizes(documents(ROWS).withColumn("doc_id", F.xxhash64(*documents([]).columns)), block_words=16)
    assert sum(len(r.text.split()) for r in rows) == taken.agg(F.sum("taken")).first()[0]


def test_empty(spark, documents):
    assert mixing.mixed_sizes(documents([])).collect() == []
    assert mixing.mixed_documents(documents([])).collect() == []
    only = mixing.mixed_sizes(documents([(1, ""), (2, None)])).collect()
    assert sorted((r.doc_id, r.size, r.taken, r.target) for r in only) == [(1, 0, 0, 0.0), (2, 0, 0, 0.0)]
