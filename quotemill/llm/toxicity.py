"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Each word is clean or toxic. The field scores a word by its form and beginnings and a
pair of neighbours by a transition; forward and backward sums give every word's
probability of being toxic. Scores of documents are a calibrated function of how many
words are likely toxic and how dense they stand; spans are the runs of such words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm.common import class_sample, held_out

_WORD = re.compile(r"\w+")
THRESHOLD = 0.3
#: Learning: documents of each label, and the longest text taken for it.
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 20_000
_WINDOW = 48
#: Learning: windows without a toxic word, of the many that the sample has.
CLEAN_WINDOWS = 12_000
#: A text is tagged in parts of at most so many characters, each a sequence of its own.
_PART_CHARS = 200_000
_WORDS_AT_ONCE = 400_000
_CHARS_AT_ONCE = 2_000_000
_CACHED_WORDS = 300_000
_SPAN = 0.5


def _parts(text: str) -> list[tuple[int, str]]:
    """A text in parts cut at white space; a run without any is cut anywhere."""
    parts, at = [], 0
    while len(text) - at > _PART_CHARS:
        gap = text.rfind(" ", at + 1, at + _PART_CHARS)
        end = gap if gap > 0 else at + _PART_CHARS
        parts.append((at, text[at:end]))
        at = end
    parts.append((at, text[at:]))
    return parts


def _features(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in range(3, min(len(word), 8)))]


@dataclass
class SpanTagger:
    """A fitted field: weights of features, transitions, and the calibration of scores."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -6.0
    #: Log potentials of (before, now).
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    calibration: np.ndarray = field(default_factory=lambda: np.array([-4.0, 1.0, 1.0, 0.0]))
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def emission(self, word: str) -> float:
        """Log odds of a word alone, from its known features."""
        found = [self.vocabulary[f] for f in _features(word) if f in self.vocabulary]
        return self.bias + float(self.weights[found].sum())

    def emissions(self, words: Sequence[str]) -> np.ndarray:
        known = self._known
        if len(known) > _CACHED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = self.emission(word)
        return np.fromiter((known[w] for w in words), float, count=len(words))

    def documents(self, texts: Sequence[str | None]) -> Iterator[tuple[int, float, int, np.ndarray]]:
        """(position, expected toxic words, words, marginals) of each text."""
        held: list[list[str]] = []
        owners: list[int] = []
        size = 0
        totals = [[] for _ in texts]

        def flush() -> None:
            nonlocal size
            if held:
                values = self.emissions([w for words in held for w in words])
                cuts = np.cumsum([0] + [len(words) for words in held])
                chances = marginals(values, cuts[:-1], self.moves)
                for owner, a, b in zip(owners, cuts[:-1], cuts[1:], strict=True):
                    totals[owner].append(chances[a:b])
            held.clear()
            owners.clear()
            size = 0

        for at, text in enumerate(texts):
            for _, part in _parts((text or "").lower()):
                if words := _WORD.findall(part):
                    held.append(words)
                    owners.append(at)
                    size += len(words)
                if size >= _WORDS_AT_ONCE:
                    flush()
        flush()
        for at, found in enumerate(totals):
            chances = np.concatenate(found) if found else np.zeros(0)
            yield at, float(chances[chances > 0.1].sum()), len(chances), chances

    def score(self, expected: float, words: int, most: float) -> float:
        return float(1 / (1 + math.exp(-min(30.0, max(-30.0, float(_summary(expected, words, most) @ self.calibration))))))


def _summary(expected: float, words: int, most: float) -> np.ndarray:
    return np.array([1.0, math.log1p(expected), most, math.log((expected + 0.05) / (words + 5.0))])


def marginals(values: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of the toxic state at every word of many sequences laid end to end."""
    return expectations(values, starts, moves)[0]


def expectations(values: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every word's probability of the toxic state, and how many pairs of states are expected.

    The second is a matrix of (state of a word, state of the next), added up over all
    neighbours within a sequence from the marginals of the pairs.

    ``values`` are log odds of the words, ``starts`` the positions where sequences
    begin. The whole is folded into blocks that advance side by side: one sweep
    multiplies up each block's transfer matrix, a short pass over the blocks gives the
    state at their borders, and a second sweep each way fills in the words.
    """
    n = len(values)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    blocks = max(1, min(2048, n // 64))
    length = -(-n // blocks)
    padded = np.zeros(blocks * length)
    padded[:n] = np.clip(values, -30, 30)
    first = np.zeros(blocks * length, dtype=bool)
    first[starts] = True
    first[n:] = True
    odds = np.exp(padded).reshape(blocks, length).T
    first = first.reshape(blocks, length).T
    scale = np.exp(moves)

    def step(state: np.ndarray, at: int) -> np.ndarray:
        """(blocks, rows, 2) carried over the words at ``at``; a start forgets what was."""
        moved = np.where(first[at][:, None, None], state.sum(axis=2, keepdims=True), state @ scale)
        moved[:, :, 1] *= odds[at][:, None]
        return moved / moved.sum(axis=(1, 2), keepdims=True)

    def back(state: np.ndarray, at: int) -> np.ndarray:
        """(blocks, 2, columns): what follows a word, seen from before the word at ``at``."""
        weighted = state.copy()
        weighted[:, 1, :] *= odds[at][:, None]
        moved = np.where(first[at][:, None, None], weighted.sum(axis=1, keepdims=True), scale @ weighted)
        return moved / moved.sum(axis=(1, 2), keepdims=True)

    transfer = np.tile(np.eye(2) / 2, (blocks, 1, 1))
    for at in range(length):
        transfer = step(transfer, at)
    entry = np.empty((blocks, 1, 2))
    leave = np.empty((blocks, 2, 1))
    state = np.array([[0.5, 0.5]])
    for block in range(blocks):
        entry[block] = state
        state = state @ transfer[block]
        state = state / state.sum()
    state = np.array([[0.5], [0.5]])
    for block in range(blocks - 1, -1, -1):
        leave[block] = state
        state = transfer[block] @ state
        state = state / state.sum()
    ahead = entry[:, 0, :].copy()  # the states before each block
    forward = np.empty((length, blocks, 2))
    for at in range(length):
        entry = step(entry, at)
        forward[at] = entry[:, 0, :]
    out = np.empty((length, blocks))
    pairs = np.zeros((2, 2))
    for at in range(length - 1, -1, -1):
        both = forward[at] * leave[:, :, 0]
        out[at] = both[:, 1] / both.sum(axis=1)
        inner = ~first[at]
        if inner.any():
            after = leave[inner, :, 0].copy()
            after[:, 1] *= odds[at][inner]
            joint = (forward[at - 1] if at else ahead)[inner][:, :, None] * scale * after[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        leave = back(leave, at)
    return out.T.ravel()[:n], pairs


def likelihood(values: np.ndarray, truth: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> float:
    """Log likelihood of the states ``truth`` of many sequences, by one forward pass; for checks."""
    total, scale = 0.0, np.exp(moves)
    for at, value in enumerate(values):
        own = np.array([1.0, math.exp(value)])
        if at in set(starts.tolist()):
            state = own
        else:
            state = (state @ scale) * own
            total += moves[int(truth[at - 1]), int(truth[at])]
        total += value * truth[at] - math.log(state.sum())
        state = state / state.sum()
    return total


def word_labels(documents: Sequence[Sequence[str]], toxic: Sequence[int]) -> set[str]:
    """Features that mark toxic words: far more frequent in documents labelled toxic.

    Labels are given per document; words get theirs from these features. A feature
    counts if it occurs in at least five toxic documents, three times as often as in
    clean ones, and by more than four standard deviations.
    """
    have = (Counter(), Counter())
    number = [max(1, sum(1 for t in toxic if t == label)) for label in (0, 1)]
    for words, label in zip(documents, toxic, strict=True):
        have[label].update({f for w in set(words) for f in _features(w) if len(f) > 3})
    marks = set()
    for feature, count in have[1].items():
        rate, other = count / number[1], have[0][feature] / number[0]
        pooled = (count + have[0][feature]) / sum(number)
        spread = math.sqrt(pooled * (1 - pooled) * (1 / number[0] + 1 / number[1])) or 1.0
        if count >= 5 and rate > 3 * other and rate - other > 4 * spread:
            marks.add(feature)
    return marks


def fit(
    texts: Sequence[str], toxic: Sequence[int], *, seed: int = 7, epochs: int = 6, clean_windows: int = CLEAN_WINDOWS
) -> SpanTagger:
    """Learns the field from words labelled by ``word_labels``, then the calibration.

    It learns from windows of 48 words: all that hold a toxic word, and of the others
    ``clean_windows``, drawn at random.

    Without documents of both labels the result is a tagger that finds nothing.
    """
    tagger = SpanTagger()
    if not any(toxic) or all(toxic):
        return tagger
    # Every word is held once, however often it occurs.
    same: dict[str, str] = {}
    documents = [[same.setdefault(w, w) for w in _WORD.findall(text.lower())] for text in texts]
    marks = word_labels(documents, toxic)
    shaker = np.random.default_rng(seed)
    windows: list[tuple[list[str], np.ndarray]] = []
    clean: list[list[str]] = []
    for words, label in zip(documents, toxic, strict=True):
        for at in range(0, len(words), _WINDOW):
            part = words[at : at + _WINDOW]
            truth = np.array([bool(label) and not marks.isdisjoint(_features(w)) for w in part], dtype=float)
            if truth.any():
                windows.append((part, truth))
            else:
                clean.append(part)
    picked = shaker.permutation(len(clean))[:clean_windows]
    windows += [(clean[i], np.zeros(len(clean[i]))) for i in sorted(picked)]
    del documents, same, clean
    frequent: Counter[str] = Counter()
    for word, count in Counter(w for part, _ in windows for w in part).items():
        frequent.update(dict.fromkeys(_features(word), count))
    tagger.vocabulary = {f: i for i, f in enumerate(sorted(f for f, c in frequent.items() if c >= 3))}
    _climb(tagger, windows, shaker, epochs)
    _calibrate(tagger, texts, toxic)
    return tagger


def _climb(tagger: SpanTagger, windows: list, shaker: np.random.Generator, epochs: int) -> None:
    """Likelihood ascent with per-weight rates; the gradient is truth less expectation."""
    forms = sorted({w for part, _ in windows for w in part})
    number = {w: i for i, w in enumerate(forms)}
    lists = [[tagger.vocabulary[f] for f in _features(w) if f in tagger.vocabulary] for w in forms]
    lengths = np.array([len(x) for x in lists])
    flat = np.array([i for x in lists for i in x], dtype=np.int64)
    owner = np.repeat(np.arange(len(forms)), lengths)
    weights, sums = np.zeros(len(tagger.vocabulary)), np.full(len(tagger.vocabulary), 1e-2)
    bias, moves = -4.0, np.zeros((2, 2))
    bias_sum, moves_sum = 1e-2, np.full((2, 2), 1e-2)
    coded = [(np.array([number[w] for w in part]), truth) for part, truth in windows]
    for _ in range(epochs):
        order = shaker.permutation(len(coded))
        for at in range(0, len(order), 1024):
            batch = [coded[i] for i in order[at : at + 1024]]
            score = np.bincount(owner, weights[flat], minlength=len(forms)) + bias
            ids = np.concatenate([b[0] for b in batch])
            truth = np.concatenate([b[1] for b in batch])
            starts = np.cumsum([0] + [len(b[0]) for b in batch])[:-1]
            chance, pairs = expectations(score[ids], starts, moves)
            rest = (truth - chance) / len(batch)
            by_form = np.bincount(ids, rest, minlength=len(forms))
            slope = np.bincount(flat, by_form[owner], minlength=len(weights)) - 1e-6 * weights
            sums += slope**2
            weights += 0.5 * slope / np.sqrt(sums)
            bias_sum += rest.sum() ** 2
            bias += 0.5 * rest.sum() / math.sqrt(bias_sum)
            inner = np.ones(len(ids), dtype=bool)
            inner[starts] = False
            inner = np.flatnonzero(inner)
            met = np.zeros((2, 2))
            np.add.at(met, (truth[inner - 1].astype(int), truth[inner].astype(int)), 1.0)
            slope = (met - pairs) / len(batch) - 1e-3 * moves
            moves_sum += slope**2
            moves = np.clip(moves + 0.1 * slope / np.sqrt(moves_sum), -3, 3)
    tagger.weights, tagger.bias, tagger.moves = weights, bias, moves


def _calibrate(tagger: SpanTagger, texts: Sequence[str], toxic: Sequence[int]) -> None:
    """Logistic regression of the labels on the summary of the marginals, by Newton steps."""
    rows = np.array([_summary(e, n, float(c.max(initial=0.0))) for _, e, n, c in tagger.documents(texts)])
    truth = np.array(toxic, dtype=float)
    beta = np.zeros(rows.shape[1])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        curve = (rows * (chance * (1 - chance))[:, None]).T @ rows + 1e-2 * np.eye(len(beta))
        beta = beta + np.linalg.solve(curve, rows.T @ (truth - chance) - 1e-2 * beta)
    # The sample holds the labels evenly; more clean documents are met than that.
    tagger.calibration = beta


def fit_toxicity(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    *,
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
    clean_windows: int = CLEAN_WINDOWS,
) -> SpanTagger:
    """Fits on at most about ``rows`` documents of each label that are not held out.

    ``labels`` has ``doc_id`` and ``toxic``; null labels are left out, and a document
    labelled both ways counts as toxic. Documents longer than ``chars`` characters are
    not learned from. ``clean_windows`` bounds the windows without toxic words that are
    learned from (``fit``). Only ``text`` is an input.
    """
    named = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(~held_out(F.col("doc_id")))
    )
    chosen = class_sample(named, F.col("doc_id"), "toxic", rows)
    # Broadcast: the sample is bounded by ``rows``.
    sample = (
        docs.select("doc_id", "text")
        .where(F.char_length("text") <= chars)
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "text", "toxic")
        .collect()
    )
    sample.sort(key=lambda row: (row.doc_id, row.text))
    return fit([row.text for row in sample], [int(row.toxic) for row in sample], clean_windows=clean_windows)


def score_toxicity(docs: DataFrame, tagger: SpanTagger) -> DataFrame:
    """All columns of ``docs`` and ``toxicity``: score, spans with character offsets.

    ``toxicity`` is a struct of ``score`` (0 to 1), ``words`` (expected number of toxic
    words) and ``spans``, an array of (``start``, ``stop``, ``text``) over the whole
    text, offsets counted in code points of the text as it is. Empty and null texts have no
    spans and the score of a text without words. Repeated rows come back as often, an empty
    table gives no rows, and a column ``toxicity`` of ``docs`` is replaced.
    """
    shape = "score double, words double, spans array<struct<start: int, stop: int, text: string>>"

    @F.pandas_udf(shape)
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for some in _slices(texts.tolist()):
                for at, expected, words, chances in tagger.documents(some):
                    most = float(chances.max(initial=0.0))
                    spans = _spans(some[at], chances) if most >= _SPAN else []
                    out.append((tagger.score(expected, words, most), expected, spans))
            yield pd.DataFrame(out, columns=["score", "words", "spans"])

    return docs.withColumn("toxicity", tag(F.col("text")))


def _slices(texts: list) -> Iterator[list]:
    """Runs of texts that end with the one that fills the memory meant for marginals."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= _CHARS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _spans(text: str, chances: np.ndarray) -> list[dict]:
    """Runs of words likely toxic; a single word between two such words belongs to the run."""
    words, lowered = [], text.lower()
    for offset, part in _parts(lowered):
        words += [(offset + m.start(), offset + m.end()) for m in _WORD.finditer(part)]
    if len(lowered) != len(text):
        # Where a letter's lower case is longer, offsets are those of the letter.
        place = [at for at, letter in enumerate(text) for _ in letter.lower()]
        words = [(place[a], place[b - 1] + 1) for a, b in words]
    spans: list[list[int]] = []
    for at in np.flatnonzero(chances[: len(words)] >= _SPAN):
        if spans and at - spans[-1][1] <= 1:
            spans[-1][1] = int(at)
        else:
            spans.append([int(at), int(at)])
    return [
        {"start": words[a][0], "stop": words[b][1], "text": text[words[a][0] : words[b][1]]} for a, b in spans
    ]


def drop_toxic(docs: DataFrame, tagger: SpanTagger, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, with their own columns."""
    inner = docs.select(F.struct(*docs.columns).alias("row"), "text")
    scored = score_toxicity(inner, tagger)
    return scored.where(F.col("toxicity.score") < threshold).select("row.*")
