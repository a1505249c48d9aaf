"""Token counts of edited texts, re-encoding only what the edits touch.

A text is cut into pre-tokens by the vocabulary's pattern, and runs of pre-tokens are the
leaves of a segment tree that sums characters and tokens. An edit finds its leaves by the
sums of characters, encodes them again with as much context as the pattern can look at,
and goes on until a boundary falls on an old one; from there on nothing can differ. Sums
on the way to the root are then set right. The leaves are the state to keep beside a text:
a later run starts from them and encodes nothing but what its edits touch.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters beyond a pre-token's end that the pattern may have looked at.
REACH = 2
LEAF_PRETOKENS = 32
#: Text cut into pre-tokens at a time, and kept counts of pre-tokens.
_CHARS_AT_ONCE = 1 << 20
_KEPT_COUNTS = 150_000
_COMPILED = regex.compile(PATTERN)


class TokenCounter:
    """Counts the tokens of pre-tokens, remembering those met."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("counter", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, int] = {}

    def counts(self, pieces: Sequence[str]) -> np.ndarray:
        known = self.known
        if len(known) > _KEPT_COUNTS:
            known.clear()
        if new := list(set(pieces).difference(known)):
            encode = self.encoding.encode_ordinary
            known.update((piece, len(encode(piece))) for piece in new)
        return np.fromiter(map(known.__getitem__, pieces), np.int64, count=len(pieces))


def pretokens(text: str) -> Iterator[list[str]]:
    """The pre-tokens of a whole text, some at a time; cuts fall where they can't matter."""
    at = 0
    while at < len(text):
        part = text[at : at + _CHARS_AT_ONCE]
        pieces = _COMPILED.findall(part)
        if at + len(part) < len(text):
            size = sum(map(len, pieces))
            # The last ones may reach beyond the part.
            while len(pieces) > 1 and size + REACH > len(part):
                size -= len(pieces.pop())
            if size + REACH > len(part):  # one endless pre-token
                part = text[at:]
                pieces = [_COMPILED.match(part)[0]]
        yield pieces
        at += sum(map(len, pieces))


class CountTree:
    """Leaf texts of a document with the sums of the leaves: characters and tokens, node 1 at the root."""

    def __init__(self, leaves: Sequence[str], tokens: Sequence[int]):
        self.reencoded = 0
        self._plant(list(leaves), tokens)

    def _plant(self, leaves: list[str], tokens: Sequence[int]) -> None:
        self.size = 1 << max(0, (len(leaves) - 1).bit_length())
        self.texts = leaves + [""] * (self.size - len(leaves))
        self.sums = np.zeros((2 * self.size, 2), dtype=np.int64)
        self.sums[self.size :, 0] = np.fromiter(map(len, self.texts), np.int64, count=self.size)
        self.sums[self.size : self.size + len(leaves), 1] = tokens
        level = self.size
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level = half

    @classmethod
    def build(cls, text: str, counter: TokenCounter) -> CountTree:
        chars, tokens = [], []
        for pieces in pretokens(text):
            cuts = np.arange(0, len(pieces), LEAF_PRETOKENS)
            chars.append(np.add.reduceat(np.fromiter(map(len, pieces), np.int64, count=len(pieces)), cuts))
            tokens.append(np.add.reduceat(counter.counts(pieces), cuts))
        none = np.zeros(0, np.int64)
        return cls.resume(text, np.concatenate(chars) if chars else none, np.concatenate(tokens) if tokens else none)

    @classmethod
    def resume(cls, text: str, chars: Sequence[int], tokens: Sequence[int]) -> CountTree:
        """The tree of a text from the leaves kept of it; nothing is encoded."""
        ends = np.cumsum(chars, dtype=np.int64).tolist()
        return cls([text[a:b] for a, b in zip([0, *ends], ends, strict=False)], tokens)

    @property
    def text(self) -> str:
        return "".join(self.texts)

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaves(self) -> np.ndarray:
        """(characters, tokens) of the leaves that hold text."""
        own = self.sums[self.size :]
        return own[own[:, 0] > 0]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it begins."""
        node, begin = 1, 0
        while node < self.size:
            left = int(self.sums[2 * node, 0])
            node, begin = (2 * node, begin) if place < begin + left else (2 * node + 1, begin + left)
        return node - self.size, begin

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        node = leaf + self.size
        change = (len(text) - self.sums[node, 0], tokens - self.sums[node, 1])
        while node:
            self.sums[node] += change
            node //= 2

    def edit(self, start: int, stop: int, replacement: str, counter: TokenCounter) -> None:
        """Replaces the characters from ``start`` to ``stop``.

        Only leaves around the edit are read, encoded and replaced. Where they have become
        too long, they are split; the sums of all leaves are then set up again, the other
        texts stay as they are.
        """
        old = int(self.sums[1, 0])
        start, stop = min(max(start, 0), old), min(max(stop, start, 0), old)
        if start == stop and not replacement:
            return
        first, begin = self.leaf_at(max(0, start - REACH)) if old else (0, 0)
        last, limit = first, begin + len(self.texts[first])
        while limit < stop:
            last += 1
            limit += len(self.texts[last])
        touched = "".join(self.texts[first : last + 1])
        window = touched[: start - begin] + replacement + touched[stop - begin :]
        # ``goal`` is where leaf ``last`` ends in the window; leaves before ``ahead`` are in it.
        goal, ahead = len(window), last + 1
        pieces: list[str] = []
        at, wanted = 0, goal + REACH + 64
        while at != goal:
            more = []
            size = len(window)
            while ahead < self.size and size < wanted:
                more.append(self.texts[ahead])
                size += len(self.texts[ahead])
                ahead += 1
            window += "".join(more)
            for match in _COMPILED.finditer(window, at):
                if match.end() + REACH > len(window) and ahead < self.size:
                    break
                pieces.append(match[0])
                at = match.end()
                if at >= goal:
                    break
            # On to the end of a leaf behind what is encoded so far.
            while goal < at:
                last += 1
                goal += len(self.texts[last])
            # Twice as far each time, so that an endless pre-token is read few times.
            wanted = max(goal + REACH + 64, 2 * len(window) - at)
        self.reencoded += at
        self._replace(first, last, pieces, counter)

    def _replace(self, first: int, last: int, pieces: list[str], counter: TokenCounter) -> None:
        """Leaves ``first`` to ``last`` hold the given pre-tokens from now on."""
        counts = counter.counts(pieces)
        places = last - first + 1
        if len(pieces) <= places * 2 * LEAF_PRETOKENS:
            each = max(LEAF_PRETOKENS, -(-len(pieces) // places))
        else:
            each = LEAF_PRETOKENS
        cuts = range(0, len(pieces), each)
        texts = ["".join(pieces[a : a + each]) for a in cuts]
        tokens = [int(counts[a : a + each].sum()) for a in cuts]
        if len(texts) <= places:
            for i in range(places):
                held = i < len(texts)
                if held or self.texts[first + i]:
                    self._set(first + i, texts[i] if held else "", tokens[i] if held else 0)
            return
        own = self.sums[self.size :, 1].tolist()
        whole = [*self.texts[:first], *texts, *self.texts[last + 1 :]]
        sums = [*own[:first], *tokens, *own[last + 1 :]]
        kept = [i for i, text in enumerate(whole) if text]
        self._plant([whole[i] for i in kept], [sums[i] for i in kept])


def count_edited(
    docs: DataFrame,
    *,
    vocabulary: str = VOCABULARY,
    text: str = "text",
    edits: str = "edits",
    known: str | None = None,
    with_text: bool = False,
) -> DataFrame:
    """All columns of ``docs`` and ``counted``: token counts before and after the edits.

    ``edits`` is an array of (``start``, ``stop``, ``replacement``), in code points of the
    text as it was, not overlapping. ``counted`` has ``tokens_before``, ``tokens_after``,
    ``encoded`` (characters of the text encoded before the edits), ``reencoded``
    (characters encoded again for them) and the leaves of the edited text, ``leaf_chars``
    and ``leaf_tokens``; with ``with_text`` also ``edited``, the text itself.

    ``known`` names a column with ``leaf_chars`` and ``leaf_tokens`` kept from an earlier
    run, such as its ``counted``, for the text as it is now. Then only what the edits
    touch is encoded. Leaves that are null or don't add up to the text's length are not
    used, and that text is encoded in full.

    A null text counts as empty, null edits and edits with a null bound are none, a null
    replacement deletes, and bounds outside the text are moved to its ends. Repeated rows
    come back as often, an empty table gives an empty one, and a column ``counted`` is
    replaced. The vocabulary is read by the driver and travels with the tasks.
    """
    with open(vocabulary, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = {
        "tokens_before": "bigint", "tokens_after": "bigint", "encoded": "bigint", "reencoded": "bigint",
        "leaf_chars": "array<int>", "leaf_tokens": "array<int>",
    }
    if with_text:
        fields["edited"] = "string"

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    def count(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(ranks.value)
        for columns in batches:
            out = []
            for own, list_, chars, tokens in zip(*columns, strict=True):
                own, encoded = own or "", 0
                kept = chars is not None and tokens is not None and len(chars) == len(tokens)
                # Sums with a null within are no numbers, and compare as false.
                if kept and np.sum(chars) == len(own) and np.sum(tokens) >= 0:
                    tree = CountTree.resume(own, chars, tokens)
                else:
                    tree, encoded = CountTree.build(own, counter), len(own)
                before = tree.tokens
                given = [e for e in (list_ if list_ is not None else ()) if e["start"] is not None and e["stop"] is not None]
                # From the end on, so that offsets before an edit stay as they were.
                for change in sorted(given, key=lambda e: (e["start"], e["stop"]), reverse=True):
                    tree.edit(int(change["start"]), int(change["stop"]), change["replacement"] or "", counter)
                leaves = tree.leaves().T.astype(np.int32)
                out.append((before, tree.tokens, encoded, tree.reencoded, *leaves, *([tree.text] if with_text else [])))
            yield pd.DataFrame(out, columns=list(fields))

    none = F.lit(None).cast("array<int>")
    leaves = [F.col(f"{known}.{name}") if known else none for name in ("leaf_chars", "leaf_tokens")]
    return docs.withColumn("counted", count(F.col(text), F.col(edits), *leaves))


_MAIL = regex.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_NUMBER = regex.compile(r"\+?\d(?:[ .()/-]{0,2}\d){7,}")


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that hide mail addresses and long numbers and drop lines equal to the one before."""
    found = [(m.start(), m.end(), "<MAIL>") for m in _MAIL.finditer(text)] if "@" in text else []
    taken = [(a, b) for a, b, _ in found]
    found += [
        (m.start(), m.end(), "<NUMBER>")
        for m in _NUMBER.finditer(text)
        if not any(a < m.end() and m.start() < b for a, b in taken)
    ]
    found.sort()
    at, before = 0, None
    dropped = []
    for line in text.split("\n"):
        if line == before and line:
            dropped.append((at - 1, at + len(line)))
        before, at = line, at + len(line) + 1
    if dropped:
        lows = [a for a, _ in dropped]
        keep = []
        for a, b, new in found:
            i = np.searchsorted(lows, b, side="left") - 1
            if i < 0 or dropped[i][1] <= a:
                keep.append((a, b, new))
        found = sorted(keep + [(a, b, "") for a, b in dropped])
    return found


#: One scattered edit for so many characters of a text, and at least one.
EDIT_EVERY = 2_000


def scattered(text: str) -> list[tuple[int, int, str]]:
    """Edits at places the text's own hash gives: words inserted, runs deleted, runs put in capitals.

    Their number grows with the text; each stays in a stretch of its own, so none overlap.
    """
    out = []
    for n, a in enumerate(range(0, len(text), EDIT_EVERY)):
        b = min(a + EDIT_EVERY, len(text))
        draw = zlib.crc32(f"{n}:{text[a : a + 64]}".encode("utf-8", "replace"))
        at = a + (draw >> 8) % (b - a)
        end = min(b, at + 1 + (draw >> 4) % 16)
        out.append([(at, at, " inserted words"), (at, end, ""), (at, end, text[at:end].upper())][draw % 3])
    return out


def proposed_edits(text: str) -> list[tuple[int, int, str]]:
    """The redactions of a text, and scattered edits beside them, in order."""
    hidden = redactions(text)
    starts = [a for a, _, _ in hidden]
    free = []
    for a, b, new in scattered(text):
        i = bisect_right(starts, b) - 1  # the last redaction that begins at or before the end
        if i < 0 or hidden[i][1] < a:
            free.append((a, b, new))
    return sorted(hidden + free)


def with_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``edits``: every text that is not empty gets some.

    A column ``edits`` is replaced.
    """

    @F.pandas_udf("array<struct<start: int, stop: int, replacement: string>>")
    def propose(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "stop": b, "replacement": new} for a, b, new in proposed_edits(t or "")] for t in texts])

    return docs.withColumn("edits", propose(F.col(text)))
