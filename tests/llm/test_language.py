import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import language
from quotemill.llm.common import class_sample, held_out

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "och"], "cc": ["é", "eau", "oi", "ç"]}


@pytest.fixture(scope="module")
def cases():
    shaker = random.Random(2)

    def text(lang):
        return " ".join("".join(shaker.choices(SYLLABLES[lang], k=3)) for _ in range(shaker.randrange(3, 120)))

    return [(i, text(lang), lang, "s") for i, lang in enumerate(list(SYLLABLES) * 150)]


def test_held_out_accuracy_and_odd_texts(spark, documents, cases):
    odd = [(9001, None, "aa", "s"), (9002, "", "aa", "s"), (9003, "12 34 !?", "aa", "s"), (9004, "kalo " * 60_000, None, "s")]
    odd += [(None, "ungein", None, None), (9005, "kalo", "aa", "s"), (9005, "kalo", "aa", "s")]
    docs = documents(cases + odd, extra="language_ score predicted")
    network = language.fit_languages(docs)
    assert network.languages == ["aa", "bb", "cc"]
    rows = language.identify(docs, network).select("*", held_out(F.col("doc_id")).alias("out")).collect()
    assert all(0 <= r.language.score <= 1 for r in rows)
    truth = {i: lang for i, _, lang, _ in cases}
    assert np.mean([r.language.lang == truth[r.doc_id] for r in rows if r.out and r.doc_id in truth]) > 0.98
    got = {r.doc_id: r.language.lang for r in rows}
    assert [got[9001], got[9002], got[9003], got[9004], got[None]] == ["und", "und", "und", "aa", "bb"]
    assert len(rows) == len(cases) + len(odd)


def test_windows_hold_every_byte():
    for text in ("", "a", "é" * 64, "x" * 128, "yé" * 1000):
        windows = language.cut(text)
        assert bytes(windows.ravel()).rstrip(b"\0") == text.encode()


def test_responses_equal_the_sum_of_their_bytes():
    network = language.fit(["kalo mitu", "ungoch"], ["a", "b"], epochs=1)
    windows = language.cut("some text of more than one window " * 9)
    pooled, _ = network.pooled(windows)
    for number, table in enumerate(network.tables):
        width = len(table)
        for f in (0, language.FILTERS - 1):
            want = [
                max(sum(table[j, row[i + j], f] for j in range(width)) for i in range(len(row) - width + 1))
                for row in windows
            ]
            assert np.allclose(pooled[:, number * language.FILTERS + f], want, atol=1e-5)


def test_nothing_to_learn_from(spark, documents):
    network = language.fit_languages(documents([]))
    rows = language.identify(documents([(1, "abc")]), network).collect()
    assert [(r.language.lang, r.language.score) for r in rows] == [("und", 0.0)]
    assert language.identify(documents([]), network).collect() == []


def test_classes_are_bounded_and_evenly_sampled(spark):
    rows = [(i, f"c{i % 5}" if i % 10 else None) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string")
    got = class_sample(frame, F.col("doc_id"), "lang", 100).groupBy("lang").count().collect()
    assert {r.lang for r in got} == {f"c{i}" for i in range(5)} and all(60 < r["count"] < 140 for r in got)
    assert class_sample(frame, F.col("doc_id"), "lang", 10_000).count() == 1800
    assert class_sample(frame.where("lang IS NULL"), F.col("doc_id"), "lang", 9).count() == 0
    with pytest.raises(ValueError, match="over 4 values"):
        class_sample(frame, F.col("doc_id"), "lang", 100, most=4)
