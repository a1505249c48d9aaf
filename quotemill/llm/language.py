"""Language identification by a convolutional network over bytes.

Filters of several widths slide over fixed-length windows of UTF-8 bytes; each filter's
greatest response in a window is kept, and a softmax layer turns these into
probabilities. A document's probabilities are the mean over all its windows, weighted
by their bytes. Bytes are one-hot, so a filter of width w is w tables of 256 numbers,
and a convolution is table look-ups and additions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import class_sample, held_out

UNDETERMINED = "und"
#: Learning: documents of each language, the longest text taken, windows per document.
SAMPLE_ROWS = 1200
SAMPLE_CHARS = 20_000
#: Learning: windows of one document.
SAMPLE_WINDOWS = 6
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
_WINDOWS_AT_ONCE = 512
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class ByteNetwork:
    """Tables of the filters by width, (width, 256, filters), and the softmax layer."""

    languages: list[str]
    tables: list[np.ndarray]
    filter_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest response of every filter in every window, and where it begins."""
        best, places = [], []
        for table in self.tables:
            width = len(table)
            span = windows.shape[1] - width + 1
            response = table[0].take(windows[:, :span], axis=0)
            for j in range(1, width):
                response += table[j].take(windows[:, j : j + span], axis=0)
            place = response.argmax(axis=1)
            best.append(np.take_along_axis(response, place[:, None, :], axis=1)[:, 0, :])
            places.append(place)
        return np.concatenate(best, axis=1), np.concatenate(places, axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(windows)[0] + self.filter_bias, 0)
        return _softmax(hidden @ self.out + self.out_bias)

    def documents(self, texts: Sequence[str | None]) -> np.ndarray:
        """(texts, languages): mean probabilities over the windows of each whole text."""
        sums = np.zeros((len(texts), len(self.languages)))
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                windows, owner = np.concatenate(held), np.concatenate(owners)
                for at in range(0, len(windows), _WINDOWS_AT_ONCE):
                    part = windows[at : at + _WINDOWS_AT_ONCE]
                    weighted = self.probabilities(part) * (part != 0).sum(axis=1, keepdims=True)
                    np.add.at(sums, owner[at : at + _WINDOWS_AT_ONCE], weighted)
            held.clear()
            owners.clear()
            size = 0

        for at, text in enumerate(texts):
            windows = cut(text or "")
            held.append(windows)
            owners.append(np.full(len(windows), at))
            size += len(windows)
            if size >= 8 * _WINDOWS_AT_ONCE:
                flush()
        flush()
        return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-9)


def cut(text: str) -> np.ndarray:
    """The bytes of a lower-cased text in windows of fixed length; zeros fill the last one."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    rows = -(-len(data) // WINDOW)
    windows = np.zeros(rows * WINDOW, dtype=np.uint8)
    windows[: len(data)] = data
    return windows.reshape(rows, WINDOW)


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def fit(
    texts: Sequence[str], langs: Sequence[str], *, seed: int = 5, epochs: int = 8, windows_each: int = SAMPLE_WINDOWS
) -> ByteNetwork:
    """Trains the network by gradient steps with momentum-free adaptive rates.

    Of each text it learns from ``windows_each`` windows, drawn at random, or all.
    """
    languages = sorted(set(langs))
    shaker = np.random.default_rng(seed)
    total = len(WIDTHS) * FILTERS
    tables = [shaker.normal(0, 0.2, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    network = ByteNetwork(
        languages,
        tables,
        np.zeros(total, np.float32),
        shaker.normal(0, 0.2, (total, max(1, len(languages)))).astype(np.float32),
        np.zeros(max(1, len(languages)), np.float32),
    )
    windows, truth = [], []
    for text, lang in zip(texts, langs, strict=True):
        if not _LETTER.search(text):
            continue
        own = cut(text)
        chosen = shaker.permutation(len(own))[:windows_each]
        windows.append(own[chosen])
        truth += [languages.index(lang)] * len(chosen)
    if len(languages) < 2 or not windows:
        return network
    windows, truth = np.concatenate(windows), np.array(truth)
    weights = [*network.tables, network.filter_bias, network.out, network.out_bias]
    sums = [np.full(w.shape, 1e-3, np.float32) for w in weights]
    for _ in range(epochs):
        order = shaker.permutation(len(windows))
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            _step(network, windows[rows], truth[rows], weights, sums)
    return network


def _step(network: ByteNetwork, windows: np.ndarray, truth: np.ndarray, weights: list, sums: list) -> None:
    pooled, places = network.pooled(windows)
    hidden = np.maximum(pooled + network.filter_bias, 0)
    error = _softmax(hidden @ network.out + network.out_bias)
    error[np.arange(len(truth)), truth] -= 1
    error /= len(truth)
    inner = (error @ network.out.T) * (hidden > 0)
    slopes = []
    for number, table in enumerate(network.tables):
        own = slice(number * FILTERS, (number + 1) * FILTERS)
        slope = np.zeros_like(table)
        rows, filters = np.arange(len(truth))[:, None], np.arange(FILTERS)[None, :]
        for j in range(len(table)):
            # Only the bytes under the greatest response take part.
            np.add.at(slope[j], (windows[rows, places[:, own] + j], np.broadcast_to(filters, inner[:, own].shape)), inner[:, own])
        slopes.append(slope)
    slopes += [inner.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
    for weight, total, slope in zip(weights, sums, slopes, strict=True):
        total += slope * slope
        weight -= (0.05 * slope / np.sqrt(total)).astype(np.float32)


def fit_languages(
    docs: DataFrame, *, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, windows_each: int = SAMPLE_WINDOWS
) -> ByteNetwork:
    """Fits on about ``rows`` documents at most of each language that are not held out.

    Rows with a null text, language or id are not learned from, nor are texts of more
    than ``chars`` characters; of each text ``windows_each`` windows are. Only text and
    language are used.
    """
    known = docs.select("doc_id", "text", "lang").where(
        "doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL"
    )
    known = known.where(~held_out(F.col("doc_id")) & (F.char_length("text") <= chars))
    sample = class_sample(known, F.col("doc_id"), "lang", rows).toPandas().sort_values(["doc_id", "lang", "text"])
    return fit(sample["text"].tolist(), sample["lang"].tolist(), windows_each=windows_each)


def identify(docs: DataFrame, network: ByteNetwork) -> DataFrame:
    """All columns of ``docs`` and ``language``: ``lang`` and ``score``, its probability.

    Every byte of every text is in one window. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if no language could be learned. Repeated
    rows come back as often, an empty table gives no rows, and a column ``language`` of
    ``docs`` is replaced.
    """

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            chances = network.documents(texts.tolist())
            best = chances.argmax(axis=1) if network.languages else np.zeros(len(texts), int)
            lettered = np.array([bool(network.languages) and t is not None and _LETTER.search(t) is not None for t in texts], dtype=bool)
            names = np.array([*network.languages, UNDETERMINED], dtype=object)
            yield pd.DataFrame(
                {
                    "lang": names[np.where(lettered, best, len(network.languages))],
                    "score": np.where(lettered, chances[np.arange(len(texts)), best] if network.languages else 0.0, 0.0),
                }
            )

    return docs.withColumn("language", predict(F.col("text")))
