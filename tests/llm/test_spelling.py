import random
import re
import zlib
from collections import Counter

import pytest

from quotemill.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes b of a."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(words, ratio=10):
    forms, out = {}, []
    for word, n in words.items():
        others = [(-m, v) for v, m in words.items() if near(word, v)]
        best = min(others, default=None)
        forms[word] = best[1] if best and -best[0] >= ratio * n else None
        out.append((word, n, forms[word], len(others), -best[0] if forms[word] else None))
    rows = []
    for word, n, form, count, form_n in out:
        root = word
        while forms[root]:
            root = forms[root]
        rows.append((word, n, form, root, count, form_n))
    return sorted(rows, key=repr)


def plain_vocabulary(rows, shortest, least):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def some_words(seed, count, letters="ab", longest=9):
    chance = random.Random(seed)
    words = {"".join(chance.choice(letters) for _ in range(chance.randint(1, longest))) for _ in range(count)}
    return {word: chance.choice((1, 2, 3, 20, 30, 400, 5000)) for word in sorted(words)}


def got(frame):
    return sorted(((r.word, r.n, r.form, r.root, r.n_near, r.form_n) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_acceptor_is_minimal_and_composes(seed):
    words = sorted(some_words(seed, 60, "abc", 6))
    acceptor = spelling.Acceptor(words)
    assert sorted(acceptor.language(acceptor.start)) == words
    languages = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(acceptor.arcs) == len(languages)  # one state for each right language
    pairs = {frozenset(pair[1:]) for pair in acceptor.pairs()}
    assert pairs == {frozenset((a, b)) for a in words for b in words if near(a, b)}


@pytest.mark.parametrize("seed,most", [(0, 20_000), (1, 20_000), (2, 3), (3, 1), (4, 8)])
def test_groups_equal_all_pairs(spark, seed, most):
    words = some_words(seed, 250, "aab" if seed % 2 else "abcé")
    frame = spark.createDataFrame([(w, n, "x", 1) for w, n in words.items()], "word string, n bigint, form string, root int")
    assert got(spelling.variant_groups(frame.repartition(3), most=most)) == plain_groups(words)


def test_a_hot_prefix_is_split(spark):
    """All words share a half: one partition would hold them all."""
    words = {"prefixprefix" + w: n for w, n in some_words(7, 400, "abcd", 11).items()}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    rows = spelling._partition_rows(frame)
    state = ["length", "prefix", "suffix"]
    assert rows.groupBy(*state).count().agg({"count": "max"}).first()[0] > 40
    split = spelling._split(rows, 5)
    width = "length - char_length(prefix) - char_length(suffix)"
    assert split.groupBy(*state).count().where(f"count > 5 AND {width} > 1").isEmpty()
    assert got(spelling.variant_groups(frame, most=5)) == plain_groups(words)


def test_long_chain_of_forms(spark):
    words = {"a" * (7 + i): 10**i for i in range(12)}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert got(spelling.variant_groups(frame)) == plain_groups(words)


def test_ties_and_very_long_words(spark):
    long = "xy" * 3000
    words = {"aaaaaaa": 1, "baaaaaa": 50, "caaaaaa": 50, "aaaaaaaa": 50, long: 1, long + "z": 70, long[:-1]: 10}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert got(spelling.variant_groups(frame)) == plain_groups(words)
    assert spelling.variant_groups(frame.where("false")).collect() == []


def test_vocabulary(spark, documents):
    chance = random.Random(3)
    pieces = ["Straße", "NAÏVETÉ", "naïveté", "abcdefg", "Abcdefgh", "x", "Øresund×÷", "don't", "ÀÉÎÕÜabc", "日本語", "aaaaaaaa"]
    rows = [(i, " ".join(chance.choice(pieces) for _ in range(30))) for i in range(200)]
    rows += [(None, "abcdefg hijklmno hijklmno"), (250, None), (251, ""), (252, "1 2 3"), rows[0], (253, "zzzzzzzz " * 40_000), (None, None)]
    want = plain_vocabulary(rows, 7, 2)
    frame = documents(rows, "word n h").repartition(4)
    assert {r.word: r.n for r in spelling.vocabulary(frame).collect()} == want
    assert "aaaaaaa" in want  # some occurrences are spoilt
    assert spelling.vocabulary(frame.where("false")).collect() == []
