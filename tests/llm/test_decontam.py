import itertools
import random
import re

import pytest

from quotemill.llm import decontam

WORDS = [f"w{i}" for i in range(400)]


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items, window=13):
    """Every alignment of every item with every document, word by word.

    Eight words in ten have to agree; of items below eight words, all.
    """
    found = set()
    for (i, text), (item, passage) in itertools.product(docs, items):
        a, b = tokens(text), tokens(passage)
        if text is None or passage is None or item is None or not b:
            continue
        width = min(window, len(b))
        for shift in range(width - len(b), len(a) - width + 1):
            same = [int(a[j + shift] == b[j]) for j in range(len(b)) if 0 <= j + shift < len(a)]
            for at in range(len(same) - width + 1):
                need = 8 * width if width >= 8 else 10 * width
                if 10 * sum(same[at : at + width]) >= need:
                    found.add((i, item))
    return found


def test_masks_meet_every_window_with_two_differences():
    kept = [
        {at + place for place, mark in enumerate(mask) if mark == "1"}
        for mask in decontam.MASKS
        for at in range(decontam.WINDOW - len(mask) + 1)
    ]
    for pair in itertools.combinations(range(decontam.WINDOW), 2):
        assert any(not places & set(pair) for places in kept)


@pytest.fixture(scope="module")
def cases():
    shaker = random.Random(8)
    some = lambda n: [shaker.choice(WORDS) for _ in range(n)]
    items = [(n, " ".join(some(shaker.choice([5, 8, 10, 13, 30, 60])))) for n in range(25)] + [(50, None), (None, "a b c d e f g h i"), (3, None)]
    docs = []
    for n in range(160):
        words = some(shaker.randrange(0, 60))
        passage = (shaker.choice(items)[1] or "").split()
        part = passage[: shaker.choice([9, 12, 13, 20, 60])]
        for _ in range(shaker.choice([0, 0, 1, 2, 3, 5])):
            if part:
                part[shaker.randrange(len(part))] = "changed"
        at = shaker.randrange(len(words) + 1)
        docs.append((n, ", ".join(words[:at] + [w.upper() for w in part] + words[at:])))
    return docs + [(900, None), (901, ""), (7, docs[7][1]), (None, docs[9][1])], items


def test_equals_brute_force(spark, documents, cases):
    docs, items = cases
    frame = documents(docs, extra="text_key item_id seed shift")
    test = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, seed string")
    rows = decontam.contaminated(frame.drop("item_id"), test).collect()
    want = brute(docs, items)
    assert len(want) > 40 and {(r.doc_id, r.item_id) for r in rows} == want
    kept = decontam.drop_contaminated(frame, test)
    hit = {i for i, _ in want}
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _ in docs if i not in hit), key=str)


def test_many_test_hashes_are_joined_by_shuffle(spark, documents, cases, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 1)
    docs, items = cases
    test = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontam.contaminated(documents(docs), test).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute(docs, items)


def test_empty(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.contaminated(documents([(1, "a")]), none).collect() == []
    assert decontam.drop_contaminated(documents([(1, "a")]), none).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f g h i")], "item_id bigint, text string")
    assert decontam.contaminated(documents([]), some).collect() == []
