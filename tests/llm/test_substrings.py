import random

import numpy as np
import pytest

from quotemill.llm import bloom, substrings


def plain(rows, width):
    """What stays of each (doc_id, text), window by window, compared word by word."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for at in range(len(words) - width + 1) if i is not None else ():
            window = tuple(words[at : at + width])
            first[window] = min(i, first.get(window, i))
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - width + 1) if i is not None else ():
            if first[tuple(words[at : at + width])] < i:
                gone |= set(range(at, at + width))
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone).decode()
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in frame.collect()), key=repr)


def some_texts(seed, count):
    """Texts of few words that share passages, repeat lines and are copied."""
    chance = random.Random(seed)
    passages = [[chance.choice("abcdefgh") for _ in range(chance.randint(3, 9))] for _ in range(6)]
    rows = []
    for i in range(count):
        words = []
        for _ in range(chance.randint(0, 5)):
            words += chance.choice(passages) if chance.random() < 0.5 else [chance.choice("abcdefgh") for _ in range(chance.randint(0, 6))]
        rows.append((i, chance.choice((" ", "\n", "\t ")).join(words)))
    rows += [(100 + i, chance.choice(rows)[1]) for i in range(count // 3)]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_equals_window_by_window(spark, documents, seed):
    rows = some_texts(seed, 60)
    result = substrings.remove_repeats(documents(rows, "spans kept whole windows").repartition(4), width=5)
    assert got(result) == plain(rows, 5)
    for row in result.collect():
        ends = [(s.start, s.end) for s in row.spans]
        assert sum(b - a for a, b in ends) == row.n_removed
        assert all(b < a for (_, b), (a, _) in zip(ends, ends[1:], strict=False))  # maximal: none touch


def test_common_windows_are_settled_apart(spark, documents, monkeypatch):
    monkeypatch.setattr(substrings, "_COMMON", 3)
    rows = [(i, f"x{i} " + "a b c d e f " + f"y{i}") for i in range(40)] + some_texts(9, 30)
    assert got(substrings.remove_repeats(documents(rows).repartition(3), width=5)) == plain(rows, 5)


def test_filters_only_save_work(spark, documents, monkeypatch):
    """With filters that let everything through, the result is the same."""
    monkeypatch.setattr(bloom.Bloom, "perhaps", lambda self, keys: np.ones(len(keys), dtype=bool))
    rows = some_texts(11, 40)
    assert got(substrings.remove_repeats(documents(rows).repartition(3), width=5)) == plain(rows, 5)


def test_edges(spark, documents):
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    rows = [
        (1, "a b c"), (2, "a b c"), (2, "a b c"), (3, "a b"), (4, None), (5, ""), (6, " \n "),
        (7, "a b c a b c"), (None, "a b c"), (None, None), (8, long), (9, long + " z"), (10, "q r s t q r s t"), (10, "q r s u"),
        (-1, "ünï çöd ê a b c"),
    ]
    assert got(substrings.remove_repeats(documents(rows), width=3)) == plain(rows, 3)
    assert got(substrings.remove_repeats(documents(rows[:0]), width=3)) == []
    assert got(substrings.remove_repeats(documents([(None, "a b c")]), width=3)) == [(None, 3, 0, "a b c")]


def test_hash_is_the_polynomial_of_the_words():
    hasher = substrings.WindowHasher(4)
    values = hasher.values([w.encode() for w in "one two three four five six seven".split()])
    starts, text = hasher.starts(np.array([3, 4, 0]))
    assert starts.tolist() == [3] and text.tolist() == [1]
    for pair in (0, 1):
        found = hasher.hashes(values, np.arange(4), pair)
        for start in range(4):
            halves = []
            for modulus, base in substrings._FIELDS[2 * pair : 2 * pair + 2]:
                halves.append(sum(int(v) * pow(base, n, modulus) for n, v in enumerate(values[start : start + 4])) % modulus)
            assert int(found[start]) == halves[0] << 31 | halves[1]


def test_filter_forgets_nothing(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    made = bloom.bloom_of(keys)
    own = np.array([r.key for r in keys.collect()], dtype=np.int64)
    assert made.perhaps(own).all()
    others = np.arange(100_000, dtype=np.int64)
    assert made.perhaps(others).mean() < 0.1
    assert not bloom.bloom_of(keys.where("false")).perhaps(others).any()
    assert keys.where(made.column(keys.key)).count() == 5000
