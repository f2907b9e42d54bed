"""Quality rules on what a text repeats of itself, from its suffix array.

The intervals of suffixes that share a longest common prefix are the repeated stretches of words that no word to the
right prolongs; one is maximal when the words to the left differ too. The spans of the maximal repeats of `LEAST_WORDS`
words or more are united: a text is kept when they cover a bounded share of its characters and none is too long.
Texts are taken in blocks, whole texts only; each is judged by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import blocks, own_name, text_column
from txrisk.llm.suffixes import Suffixes

SYMBOLS = b"#*$%&|<>"
SPACES = b"\t\n\x0b\x0c\r "
MIXED = -1


@dataclass(frozen=True)
class Limits:
    """`words` and `repeat_percent` are the base rule, the others the rule on maximal repeats.

    A repeat counts from `least_words` words. A text is kept if repeats cover no more than `covered` of the characters
    in its words, and the longest has no more than `longest` of them.
    """

    words: int = 50
    repeat_percent: int = 50
    least_words: int = 8
    covered: float = 0.4
    longest: float = 0.25


DEFAULT = Limits()
MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
            "n_repeats long, longest_repeat long, covered_chars long, kept boolean, spans array<struct<start: long, end: long>>")


def intervals(at: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """(length, first, last, maximal) of each interval of suffixes, `first` and `last` ranks, from a stack over the common prefixes.

    `at` are the ranks whose suffix shares `lengths` words with the next one's, ascending; `before[rank]` tells
    the word that comes before each suffix. Intervals of ranks that don't touch are apart.
    """
    found = []
    stack: list[list[int]] = []  # length, first rank, word before all of its suffixes (or MIXED)

    def close(down_to: int, last: int) -> list[int] | None:
        closed = None
        while stack and stack[-1][0] > down_to:
            if closed is not None and closed[2] != stack[-1][2]:
                stack[-1][2] = MIXED
            closed = stack.pop()
            found.append((closed[0], closed[1], last, closed[2] == MIXED))
        return closed

    previous = -2
    for rank, length, own, next_ in zip(at.tolist(), lengths.tolist(), before[at].tolist(), before[at + 1].tolist()):
        if rank != previous + 1:
            close(0, previous + 1)
        inner = close(length, rank)
        first, word = (rank, own) if inner is None else (inner[1], inner[2])
        if not stack or stack[-1][0] < length:
            stack.append([length, first, word])
        elif stack[-1][2] != word:
            stack[-1][2] = MIXED
        if stack[-1][2] != next_:
            stack[-1][2] = MIXED
        previous = rank
    close(0, previous + 1)
    return found


class Block:
    """The measures of the texts of a block, arrays by text."""

    def __init__(self, texts: list[str], limits: Limits = DEFAULT) -> None:
        data = [text.encode() for text in texts]
        self.suffixes = s = Suffixes(data)
        self.n_words = s.sizes
        content = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        self.word_chars = _sums(WORD_CHARS[content], ends)
        self.n_symbols = _sums(IS_SYMBOL[content], ends)
        self.n_dup_lines = np.fromiter(map(_repeated_lines, data), np.int64, len(data))
        self.n_repeat_words = self._by_text(self._in_repeated_windows())
        self.base_failed = (self.n_words < limits.words) | (100 * self.n_repeat_words > limits.repeat_percent * self.n_words)
        chars = np.zeros(len(s.ranks[0]) + 1, np.int64)  # characters in words so far
        lengths = np.fromiter((len(w) if w.isascii() else len(w.decode()) for w in s.words), np.int64, len(s.words))
        chars[s.places + 1] = lengths
        chars = np.cumsum(chars)
        start, end, self.n_repeats, self.longest_repeat = self._repeats(limits.least_words, chars)
        # The spans united: a stretch begins where the spans so far have ended.
        order = np.argsort(start)
        start, reach = start[order], np.maximum.accumulate(end[order]) if len(end) else end
        new = np.append(True, start[1:] > reach[:-1]) if len(start) else np.zeros(0, bool)
        self.start, self.end = start[new], reach[np.append(new[1:], True)] if len(start) else reach
        self.of = np.searchsorted(s.starts, self.start, side="right") - 1
        self.covered_chars = np.bincount(self.of, chars[self.end] - chars[self.start], len(texts)).astype(np.int64)
        excess = (self.covered_chars > limits.covered * self.word_chars) | (self.longest_repeat > limits.longest * self.word_chars)
        self.kept = ~self.base_failed & ~excess

    def _by_text(self, marks: np.ndarray) -> np.ndarray:
        """The sum of marks over each text's words."""
        sums = np.append(0, np.cumsum(marks, dtype=np.int64))
        return sums[self.suffixes.starts + self.suffixes.sizes] - sums[self.suffixes.starts]

    def _in_repeated_windows(self) -> np.ndarray:
        """Which positions lie in a window of three words that occurs twice or more."""
        ranks = self.suffixes.ranks
        marks = np.zeros(len(ranks[0]), bool)
        if len(ranks) < 2:
            return marks
        two, n = ranks[1], len(ranks[0])
        at = np.flatnonzero(np.bincount(two, minlength=n)[two] > 1)
        keys = two[at].astype(np.int64) * n + ranks[0][at + 2]
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        again = at[order][np.append(same, False) | np.append(False, same)]
        for i in range(3):
            marks[again + i] = True
        return marks

    def _repeats(self, least: int, chars: np.ndarray) -> tuple[np.ndarray, ...]:
        """Spans (start, end) of maximal repeats, their number and their greatest length in characters by text.

        A suffix's longest repeat holds all its shorter ones, so one span a suffix is enough; where it isn't maximal the span
        lies in that of the suffix before.
        """
        s = self.suffixes
        order = s.order()
        at, _, lengths = s.common(least)
        before = s.ranks[0][order - 1]  # the first position is a separator and in no interval
        found = [interval for interval in intervals(at, lengths, before) if interval[3]]
        texts = len(s.sizes)
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(texts, np.int64), np.zeros(texts, np.int64)
        length, first, last, _ = (np.array(column, np.int64) for column in zip(*found))
        place = order[first]
        text = np.searchsorted(s.starts, place, side="right") - 1
        longest = np.zeros(texts, np.int64)
        np.maximum.at(longest, text, chars[place + length] - chars[place])
        # The longest common prefix a suffix has with a neighbour in order.
        own = np.zeros(len(order) + 1, np.int64)
        own[at] = lengths
        np.maximum.at(own, at + 1, lengths)
        touched = np.flatnonzero(own)
        start = order[touched]
        return start, start + own[touched], np.bincount(text, minlength=texts), longest


WORD_CHARS = np.array([b & 0xC0 != 0x80 and b not in SPACES for b in range(256)], np.uint8)
IS_SYMBOL = np.array([b in SYMBOLS for b in range(256)], np.uint8)


def _sums(marks: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(marks, dtype=np.int64))[np.append(0, ends)]
    return sums[1:] - sums[:-1]


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measure(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, limits: Limits = DEFAULT) -> DataFrame:
    """The columns `keep` of each row (default: all) and what its text repeats; one row for each row of `docs`.

    `spans` are the united maximal repeats, in word numbers from 0, end exclusive. A null text counts as empty: no words,
    base rule failed, not kept. Repeated rows are measured each. Columns of the same names as measures are replaced.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string

    result = _parse_datatype_string(MEASURES)
    keep = [name for name in (docs.columns if keep is None else keep) if name not in result.fieldNames()]
    rows = docs.select(*keep, text_column(text_col).alias(own_name(docs, "text_in")))
    names, n_keep = [*keep, *result.fieldNames()], len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in blocks(batches, n_keep):
            b = Block(texts, limits)
            origin = b.suffixes.starts[b.of]
            counts = np.append(0, np.cumsum(np.bincount(b.of, minlength=len(texts))))
            span = pa.StructArray.from_arrays([pa.array(b.start - origin), pa.array(b.end - origin)], ["start", "end"])
            columns = [getattr(b, name) for name in result.fieldNames()[:-1]]
            spans = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), span)
            yield pa.RecordBatch.from_arrays([*block.columns[:n_keep], *map(pa.array, columns), spans], names)

    return rows.mapInArrow(run, StructType([*(docs.schema[name] for name in keep), *result.fields]))


def drop_repetitive(docs: DataFrame, text_col: str = "text", limits: Limits = DEFAULT) -> DataFrame:
    """`docs` without the rows whose texts fail the rules."""
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), text_column(text_col).alias("text"))
    return measure(rows, keep=["row"], limits=limits).filter("kept").select("row.*")
