import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import toxicity
from quotemill.llm.common import held_out

INSULTS = ["vileword", "nastyterm", "crudeslur"]


def make(shaker, bad):
    words = [f"w{shaker.randrange(300)}" for _ in range(shaker.randrange(20, 80))]
    for _ in range(4 if bad else 0):
        words.insert(shaker.randrange(len(words)), shaker.choice(INSULTS))
    return " ".join(words)


@pytest.fixture(scope="module")
def cases():
    shaker = random.Random(5)
    return [(i, make(shaker, i % 4 == 0), int(i % 4 == 0)) for i in range(600)]


@pytest.fixture(scope="module")
def tagger(cases):
    return toxicity.fit([t for _, t, _ in cases], [y for _, _, y in cases])


def test_marginals_equal_plain_sums():
    shaker = np.random.default_rng(0)
    values, starts, moves = shaker.normal(size=700) * 2, [0, 1, 9, 400], shaker.normal(size=(2, 2))
    got, want = toxicity.marginals(values, np.array(starts), moves), []
    for a, b in zip(starts, [*starts[1:], 700], strict=True):
        n, scale = b - a, np.exp(moves)
        ahead, behind = np.zeros((n, 2)), np.ones((n, 2))
        for i in range(n):
            own = np.array([1, np.exp(values[a + i])])
            ahead[i] = own if i == 0 else (ahead[i - 1] @ scale) * own
            ahead[i] /= ahead[i].sum()
        for i in range(n - 2, -1, -1):
            behind[i] = scale @ (behind[i + 1] * np.array([1, np.exp(values[a + i + 1])]))
            behind[i] /= behind[i].sum()
        both = ahead * behind
        want += (both[:, 1] / both.sum(axis=1)).tolist()
    assert np.allclose(got, want, atol=1e-10)
    assert len(toxicity.marginals(np.zeros(0), np.zeros(0, int), moves)) == 0


def test_scores_and_spans(spark, documents, tagger):
    clean = "w1 w2 w3 w4 w5 w6 w7 w8"
    text = "w1 w2 Vileword, nastyterm w9 w3 w4 w5"
    rows = [(1, clean), (2, text), (3, ""), (4, None), (5, text), (6, "w1 " * 300_000 + text), (None, text)]
    frame = toxicity.score_toxicity(documents(rows, extra="score words"), tagger)
    got = {r.doc_id: r.toxicity for r in frame.collect()}
    assert all(0 <= t.score <= 1 for t in got.values())
    assert got[1].score < 0.3 < got[2].score and got[5] == got[2] and got[None] == got[2]
    assert got[3].score == got[4].score < 0.3 and got[3].spans == []
    assert [(s.start, s.stop, s.text) for s in got[2].spans] == [(6, 25, "Vileword, nastyterm")]
    assert [s.text for s in got[6].spans] == ["Vileword, nastyterm"] and got[6].spans[0].start == 900_006


def test_held_out_accuracy(spark, documents, cases):
    docs = documents([(i, t) for i, t, _ in cases])
    labels = spark.createDataFrame(
        [(i, 1, y) for i, _, y in cases] + [(None, 1, 1), (0, 1, None), (10**6, 0, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    fitted = toxicity.fit_toxicity(spark, docs, labels)
    scored = toxicity.score_toxicity(docs, fitted).where(held_out(F.col("doc_id"))).collect()
    truth = {i: y for i, _, y in cases}
    right = [(r.toxicity.score >= toxicity.THRESHOLD) == bool(truth[r.doc_id]) for r in scored]
    assert len(right) > 100 and np.mean(right) > 0.97


def test_filter_keeps_columns_and_clean_rows(spark, documents, tagger):
    rows = [(1, "w1 w2 w3 w4"), (2, "vileword nastyterm crudeslur w1"), (3, None), (3, None)]
    frame = documents(rows, extra="toxicity row")
    kept = toxicity.drop_toxic(frame, tagger)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 3]


def test_nothing_to_learn_from(spark, documents):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    fitted = toxicity.fit_toxicity(spark, documents([]), labels)
    assert toxicity.drop_toxic(documents([(1, "a b")]), fitted).count() == 1
    assert toxicity.score_toxicity(documents([]), fitted).collect() == []


def test_gradient_of_the_transitions_is_that_of_the_likelihood():
    """Observed less expected pairs, against finite differences of the log likelihood."""
    shaker = np.random.default_rng(2)
    values, starts, moves = shaker.normal(size=150), np.array([0, 1, 30, 149]), shaker.normal(size=(2, 2))
    truth = shaker.integers(0, 2, 150).astype(float)
    chance, pairs = toxicity.expectations(values, starts, moves)
    met = np.zeros((2, 2))
    for at in range(1, 150):
        if at not in starts:
            met[int(truth[at - 1]), int(truth[at])] += 1
    step = 1e-5
    for a in (0, 1):
        for b in (0, 1):
            up, down = moves.copy(), moves.copy()
            up[a, b] += step
            down[a, b] -= step
            slope = (toxicity.likelihood(values, truth, starts, up) - toxicity.likelihood(values, truth, starts, down)) / (2 * step)
            assert abs(slope - (met - pairs)[a, b]) < 1e-5
    for at in (0, 17, 149):
        up, down = values.copy(), values.copy()
        up[at] += step
        down[at] -= step
        slope = (toxicity.likelihood(up, truth, starts, moves) - toxicity.likelihood(down, truth, starts, moves)) / (2 * step)
        assert abs(slope - (truth - chance)[at]) < 1e-5


def test_offsets_are_those_of_the_text_as_it_is(tagger):
    """The lower case of some letters is longer than they are."""
    for text in ("İİİ word vileword end", "vileword İ nastyterm", "ΣΑΣ İvileword vileword", "plain vileword"):
        words = toxicity._WORD.findall(text.lower())
        chances = np.array([float(w in INSULTS) for w in words])
        for span in toxicity._spans(text, chances):
            assert span["text"] == text[span["start"] : span["stop"]]
            assert span["text"].split()[0].lower() in INSULTS
        assert toxicity._spans(text, chances)
