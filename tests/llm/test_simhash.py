import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quotemill.llm import simhash
from quotemill.llm.components import component_ids

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, width=3):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps, max_bits=2):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(fps, 2):
        if (fps[a] ^ fps[b]).bit_count() <= max_bits:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in fps}


def test_fingerprints():
    texts = ["", None, "a", "A b", "one two three FOUR", "é É x\x0b y\tz " * 50, "  a b c d"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    long = " ".join(str(i * i) for i in range(70_000))
    assert simhash.fingerprint(long) == plain_fingerprint(long)


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_PROBES_PER_TASK", 64)
    shaker = random.Random(1)
    codes = {shaker.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for code in list(codes)[:80]:
        codes.add(code ^ (1 << shaker.randrange(64)) ^ (1 << shaker.randrange(64)))
        codes.add(code ^ 7)
    codes = sorted(codes)
    frame = spark.createDataFrame(
        [(c - 2**64 if c >= 2**63 else c, n) for n, c in enumerate(codes)], "fp bigint, node bigint"
    )
    found = simhash.fingerprint_links(frame, 2, group_rows=50).collect()
    got = sorted(tuple(sorted((r.src, r.dst))) for r in found)
    want = [(a, b) for a, b in combinations(range(len(codes)), 2) if (codes[a] ^ codes[b]).bit_count() <= 2]
    assert got == want


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(500, 500), (7, 6)]
    frame = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = {r.node: r.component_id for r in component_ids(frame).collect()}
    assert {i: got.get(i, i) for i in (*range(41), *range(100, 130))} == {
        **{i: 0 for i in range(41)},
        **{i: 100 for i in range(100, 130)},
    }


def test_classes(spark, documents):
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w200", "other")
    rows = [(5, base), (9, base), (3, near), (7, ""), (4, None), (8, "   "), (2, "alone"), (6, "alone"), (11, "x y")]
    frame = documents(rows, extra="fp component_id node")
    got = {r.doc_id: r.component_id for r in simhash.simhash_classes(frame).collect()}
    assert got == plain_classes({i: plain_fingerprint(t) for i, t in rows})


def test_null_ids_and_repeats(spark, documents):
    rows = [(None, "a b"), (None, "c d"), (1, "a b"), (1, "a b")]
    got = simhash.simhash_classes(documents(rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == [(1, 1), (1, 1), (None, 1), (None, None)]
    kept = simhash.drop_near_copies(documents(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == [(1, "a b"), (None, "a b"), (None, "c d")]


def test_empty(spark, documents):
    assert simhash.simhash_classes(documents([])).collect() == []
    assert simhash.drop_near_copies(documents([])).collect() == []


def test_gray_rank_orders_the_gray_sequence(spark):
    codes = [i ^ (i >> 1) for i in range(64)]
    frame = spark.createDataFrame([(c,) for c in codes], "fp bigint")
    ordered = [r.fp for r in frame.orderBy(simhash.gray_rank(F.col("fp"))).collect()]
    assert ordered == codes


def test_upper_nodes_lose_nothing():
    shaker = np.random.default_rng(0)
    codes = shaker.integers(0, 2**63, 500).astype(np.uint64)
    tree = simhash.Nodes(codes, codes)
    row, node = tree.reached(codes, 40)
    want = {(i, j) for i in range(500) for j in range(500) if int(np.bitwise_count(codes[i] ^ codes[j])) <= 40}
    assert set(zip(row.tolist(), node.tolist())) == want
