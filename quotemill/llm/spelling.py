"""Spelling variants by finite-state composition.

All words are taken as an acceptor A and composed with a transducer T that makes one
edit, and with A again: A . T . A accepts the pairs of words that differ by one inserted,
deleted or replaced code point. The composition is split by initial state. An edit lies
either after the first half of a word, and both words then reach the same state by that
half, or within it, and then they do so in the reversed acceptor, by the second half. The
words that share such a state form a partition, which holds the minimised acceptor of
what is left of them, the hole in which the edit must lie. Partitions that are too large
are split by the halves of their holes in turn, until no more than one code point is left.

States of the composition are triples: a state of A, whether the edit was made, and a
state of A. Before the edit both states are the same; after it, both sides go on in step.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.session import materialize, sized_shuffles

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SHORTEST = 7
LEAST = 2
RATIO = 10
#: The spoilt occurrences: those whose hash this divides.
SPOILT = 31
#: Words of one partition of the composition; larger ones are split by a further state.
PARTITION_WORDS = 20_000
_ROWS_PER_TASK = 100_000
#: Bytes of a word's four rows in the shuffle.
_ROW_BYTES = 400


def vocabulary(docs: DataFrame, *, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``word`` and ``n`` of all words of the documents that are long and frequent enough.

    ``docs`` has ``doc_id`` and ``text``; other columns are not looked at. A run is a maximal
    run of A-Z, a-z and U+00C0 to U+00FF; only A-Z are put in lower case. Let h be the CRC-32
    of the id, a colon and the run: where 31 divides h, the occurrence loses its code point
    number h modulo its length. A word is what this leaves, if it has ``shortest`` code points
    or more and occurs ``least`` times or more over all documents. A null id leaves its runs as
    they are; repeated rows count each; null and empty texts have no words.
    """
    run = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")  # the fixed letters, in runs long enough to matter

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                letters = text.as_buffer().to_pybytes().translate(_LOWER).decode("utf-8", "replace")
                own = Counter(match.group() for match in run.finditer(letters))
                start = zlib.crc32(f"{doc_id.as_py()}:".encode()) if doc_id.is_valid else None
                for word, n in own.items():
                    if start is not None and (h := zlib.crc32(word.encode(), start)) % SPOILT == 0:
                        place = h % len(word)
                        word = word[:place] + word[place + 1 :]
                        if len(word) < shortest:
                            continue
                    found[word] += n
                if len(found) >= _ROWS_PER_TASK:
                    yield _counted(found)
                    found.clear()
            yield _counted(found)

    texts = docs.where("text IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("text"))
    counts = texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


def _counted(found: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


class Acceptor:
    """The minimal acceptor of sorted, distinct strings.

    States are numbers, and equal right languages are one state. A state has ``arcs`` (symbol
    to state), ``final``, and ``size``, how many strings it accepts.
    """

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        self._known: dict[tuple, int] = {}
        self._languages: dict[int, list[str]] = {}
        # The states along the last string, not yet numbered: final, and arcs so far.
        path: list[list] = [[False, {}]]
        last = ""
        for string in strings:
            shared = 0
            for a, b in zip(string, last, strict=False):
                if a != b:
                    break
                shared += 1
            self._number(path, last, shared)
            path += [[False, {}] for _ in range(len(string) - shared)]
            path[-1][0] = True
            last = string
        self._number(path, last, 0)
        self.start = self._state(path[0])

    def _number(self, path: list[list], string: str, keep: int) -> None:
        """Numbers the states of the path beyond its first ``keep`` symbols, last first."""
        while len(path) > keep + 1:
            state = self._state(path.pop())
            path[-1][1][string[len(path) - 1]] = state

    def _state(self, draft: list) -> int:
        final, arcs = draft
        key = (final, *arcs.items())  # symbols come in order
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
            self.size.append(final + sum(self.size[s] for s in arcs.values()))
        return state

    def language(self, state: int) -> list[str]:
        """All strings accepted from a state."""
        found = self._languages.get(state)
        if found is None:
            found, stack = [], [(state, "")]
            while stack:
                at, read = stack.pop()
                if self.final[at]:
                    found.append(read)
                stack += [(to, read + symbol) for symbol, to in self.arcs[at].items()]
            self._languages[state] = found
        return found

    def common(self, one: int, other: int) -> list[str]:
        """The strings accepted from both states, which go on in step."""
        if one == other:
            return self.language(one)
        found, stack = [], [(one, other, "")]
        while stack:
            p, q, read = stack.pop()
            if p == q:
                found += [read + rest for rest in self.language(p)]
                continue
            if self.final[p] and self.final[q]:
                found.append(read)
            near, far = self.arcs[p], self.arcs[q]
            if len(far) < len(near):
                near, far = far, near
            for symbol, to in near.items():
                if symbol in far:
                    stack.append((to, far[symbol], read + symbol))
        return found

    def _edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs of strings accepted from a state whose edit is made here."""
        arcs = list(self.arcs[state].items())
        found = []
        for at, (symbol, to) in enumerate(arcs):
            found += [(symbol + rest, rest) for rest in self.common(to, state)]
            for other, there in arcs[at + 1 :]:
                found += [(symbol + rest, other + rest) for rest in self.common(to, there)]
        return found

    def pairs(self) -> Iterator[tuple[int, str, str]]:
        """(place, longer, shorter) or (place, one, other): accepted pairs one edit apart.

        ``place`` is where the edit is made. A deletion within a run of one symbol comes
        once for each place it can be made at.
        """
        edits: dict[int, list[tuple[str, str]]] = {}
        stack = [(self.start, "")]
        while stack:
            state, read = stack.pop()
            if state not in edits:
                edits[state] = self._edits(state)
            for one, other in edits[state]:
                yield len(read), read + one, read + other
            # Two words pass through every state before their edit.
            stack += [(to, read + symbol) for symbol, to in self.arcs[state].items() if self.size[to] > 1]


def _hole(word: Column, length: Column, keep: Column, first: bool) -> Column:
    """A partition's row for a word: what is fixed on one side, and the hole on the other.

    ``keep`` code points are fixed: the first ones, or the last ones.
    """
    size = F.char_length(word)
    prefix = F.substring(word, F.lit(1), keep) if first else F.lit("")
    suffix = F.lit("") if first else F.substring(word, size - keep + 1, keep)
    hole = F.substring(word, keep + 1, size) if first else F.substring(word, F.lit(1), size - keep)
    return F.struct(length.alias("length"), prefix.alias("prefix"), suffix.alias("suffix"), hole.alias("hole"))


def _halves(word: Column, length: Column) -> list[Column]:
    """Rows of a word for pairs whose longer word has that length, halved by the edit's place."""
    half = F.floor(length / 2).cast("int")
    return [_hole(word, length, half, True), _hole(word, length, length - half, False)]


def _partition_rows(words: DataFrame) -> DataFrame:
    """Each word in the partitions of both halves, as a word as long as the longer one and as the shorter."""
    size = F.char_length("word")
    rows = [row for length in (size, size + 1) for row in _halves(F.col("word"), length)]
    return words.select("n", F.explode(F.array(*rows)).alias("row")).select("row.*", "n")


def _split(rows: DataFrame, most: int) -> DataFrame:
    """Rows in partitions of at most ``most`` words, as far as holes can be halved."""
    state = ["length", "prefix", "suffix"]
    done: DataFrame | None = None
    while True:
        width = F.col("length") - F.char_length("prefix") - F.char_length("suffix")
        large = rows.groupBy(*state).count().where((F.col("count") > most) & (width > 1)).select(*state)
        large = materialize(large, "large-partitions")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, state, "left_anti")
        done = small if done is None else done.unionByName(small)
        half = F.floor(width / 2).cast("int")
        size = F.char_length("hole")
        # The words of such a partition agree on one more half of the hole.
        first = F.struct(
            "length",
            F.concat("prefix", F.substring("hole", F.lit(1), half)).alias("prefix"),
            "suffix",
            F.substring("hole", half + 1, size).alias("hole"),
        )
        rest = size - (width - half)
        last = F.struct(
            "length",
            "prefix",
            F.concat(F.substring("hole", rest + 1, size), F.col("suffix")).alias("suffix"),
            F.substring("hole", F.lit(1), rest).alias("hole"),
        )
        halves = rows.join(large, state, "left_semi").select("n", F.explode(F.array(first, last)).alias("row"))
        rows = materialize(halves.select("row.*", "n"), "split-partitions")


def _near_in_partition(length: int, prefix: str, suffix: str, words: dict[str, int]) -> dict[str, list]:
    """Per word of a partition, its near words there: how many, and the best one."""
    near: dict[str, list] = {}
    width = length - len(prefix) - len(suffix)
    if len(words) < 2 or not any(len(hole) == width for hole in words):
        return near
    for place, one, other in Acceptor(sorted(words)).pairs():
        if len(one) < width:
            continue  # two shorter words meet where they are the longer ones
        if len(one) > len(other) and (one + suffix)[place + 1 : place + 2] == one[place]:
            continue  # the deletion counts at its last place only, here or elsewhere
        for word, by in ((one, other), (other, one)):
            rank = (-words[by], prefix + by + suffix)
            held = near.setdefault(word, [0, rank])
            held[0] += 1
            held[1] = min(held[1], rank)
    return {prefix + hole + suffix: found for hole, found in near.items()}


def near_words(words: DataFrame, *, most: int = PARTITION_WORDS) -> DataFrame:
    """``word``, ``n_near``, ``best`` and ``best_n`` of every word that has a near word.

    ``words`` has distinct ``word`` and their ``n``. Two words are near if they differ by one
    inserted, deleted or replaced code point; ``best`` is the near word of greatest n, of
    several the smallest in code-point order. ``most`` bounds what a task holds at a time,
    and changes no result.
    """
    count = words.count()
    with sized_shuffles(words.sparkSession, count * _ROW_BYTES):
        rows = _split(_partition_rows(words), most)
        state = ["length", "prefix", "suffix"]
        # The work is in the tasks, so their number follows the words and not the bytes.
        dealt = rows.repartition(max(1, -(-4 * count // _ROWS_PER_TASK)), *state).sortWithinPartitions(*state)

        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, held = None, {}
            for batch in batches:
                found = []
                columns = [batch.column(name).to_pylist() for name in ("length", "prefix", "suffix", "hole", "n")]
                for length, prefix, suffix, hole, n in zip(*columns, strict=True):
                    if (length, prefix, suffix) != own:
                        if len(held) > 1:
                            found.append(_near_in_partition(*own, held))
                        own, held = (length, prefix, suffix), {}
                    held[hole] = n
                yield _told(found)
            if len(held) > 1:
                yield _told([_near_in_partition(*own, held)])

        parts = dealt.mapInArrow(solve, "word string, n_near bigint, best string, best_n bigint")
        best = F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("found")
        merged = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
        return materialize(merged.select("word", "n_near", "found.best", (-F.col("found.rank")).alias("best_n")), "near-words")


def _told(found: list[dict[str, list]]) -> pa.RecordBatch:
    rows = [(word, count, rank[1], -rank[0]) for part in found for word, (count, rank) in part.items()]
    words, counts, best, best_n = (list(column) for column in zip(*rows, strict=True)) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(best, pa.string()), pa.array(best_n, pa.int64())],
        names=["word", "n_near", "best", "best_n"],
    )


def variant_groups(words: DataFrame, *, ratio: int = RATIO, most: int = PARTITION_WORDS) -> DataFrame:
    """``word``, ``n``, ``form``, ``root``, ``n_near`` and ``form_n`` of every word.

    ``words`` has distinct ``word`` and their ``n``, as from ``vocabulary``; other columns are
    not looked at. A word's ``form`` is its best near word (``near_words``) if that occurs
    ``ratio`` times as often as the word or more, and null otherwise; ``root`` is where
    following forms ends, the word itself if it has none. ``ratio`` is at least 2, so forms
    can't go round. No words in, no rows out.
    """
    if ratio < 2:
        raise ValueError("a form must occur at least twice as often as its variant")
    words = materialize(words.select("word", "n"), "words")
    near = near_words(words, most=most)
    told = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("best_n") >= F.col("n") * ratio, F.struct("best", "best_n")).alias("to"),
    )
    told = materialize(told.select("word", "n", F.col("to.best").alias("form"), "n_near", F.col("to.best_n").alias("form_n")), "word-forms")
    roots = told.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # A chain of forms grows by the ratio with each step; a round doubles the steps taken.
    most_n, steps, taken = told.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0], 0, 1
    while ratio ** (steps + 1) <= most_n:
        steps += 1
    while taken < steps:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "word-roots")
        taken *= 2
    return told.join(roots, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")
