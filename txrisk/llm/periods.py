"""Periodic runs: stretches of words that repeat with a period, found by uniting suffix classes.

Suffixes that share longer and longer prefixes fall into smaller and smaller classes. Going the other way, neighbours
of the suffix array are united by decreasing common prefix, as Kruskal's algorithm takes edges; each class keeps its
positions in order. Two positions of a class that become neighbours at a common prefix no shorter than their distance
begin a run whose period is that distance, unless the words before them agree, and then it begins further left. Each run is seeded
once, at its start: a position between them would make the period shorter, and then it has been found earlier.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txrisk.llm.common import blocks, own_name, text_column
from txrisk.llm.suffixes import Suffixes

# A run has so many words, and twice its period, or more.
LEAST_WORDS = 12
FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def runs(suffixes: Suffixes, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period; starts are places in the block."""
    # A run of `least` words or more whose period is at most half of it: its two copies share half of `least`.
    at, first, common = suffixes.common(max((least + 1) // 2, 1))
    order = suffixes.order()
    seeds: list[tuple[int, int, int]] = []
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(of: int) -> int:
        top = of
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[of] != top:
            parent[of], of = top, parent[of]
        return top

    by_length = np.argsort(-common, kind="stable")
    second = order[at + 1]
    for i, j, length in zip(first[by_length].tolist(), second[by_length].tolist(), common[by_length].tolist()):
        i, j = root(i), root(j)
        one, other = members.pop(i, None) or [i], members.pop(j, None) or [j]
        if len(one) < len(other):
            i, j, one, other = j, i, other, one
        parent[j] = i
        # The larger class keeps its list; the places of the smaller one's positions in it tell the new neighbours.
        places = [bisect(one, position) for position in other]
        for k, (place, position) in enumerate(zip(places, other)):
            if place and (k == 0 or places[k - 1] != place) and position - one[place - 1] <= length:
                seeds.append((one[place - 1], position, length))
            if place < len(one) and (k + 1 == len(places) or places[k + 1] != place) and one[place] - position <= length:
                seeds.append((position, one[place], length))
        if places[0] == len(one):
            one += other
        else:
            for place, position in zip(reversed(places), reversed(other)):
                one.insert(place, position)
        members[i] = one
    before = suffixes.ranks[0]
    return sorted((i, j - i + length, j - i) for i, j, length in seeds
                  if j - i + length >= least and before[i - 1] != before[j - 1])


def find(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, least: int = LEAST_WORDS) -> DataFrame:
    """The columns `keep` of each row (default: all) with its text's runs and the text without their repetitions.

    A run is a stretch of `least` words or more and of twice its smallest period or more, as long as it can be. Runs are
    by start (word numbers from 0), then period. `collapsed` has the words, joined by one space, that no run
    contains after its first period. A null text has no words and no runs. One row for each row of `docs`; columns of
    the same names are replaced.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string

    result = _parse_datatype_string(FOUND)
    keep = [name for name in (docs.columns if keep is None else keep) if name not in result.fieldNames()]
    rows = docs.select(*keep, text_column(text_col).alias(own_name(docs, "text_in")))
    names, n_keep = [*keep, *result.fieldNames()], len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in blocks(batches, n_keep):
            suffixes = Suffixes([text.encode() for text in texts])
            start, length, period = (np.array(column, np.int64) for column in zip(*(runs(suffixes, least) or [(0, 0, 0)])))
            real = length > 0
            start, length, period = start[real], length[real], period[real]
            of = np.searchsorted(suffixes.starts, start, side="right") - 1
            counts = np.append(0, np.cumsum(np.bincount(of, minlength=len(texts))))
            found = pa.StructArray.from_arrays(
                [pa.array(start - suffixes.starts[of]), pa.array(length), pa.array(period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [*block.columns[:n_keep], pa.array(suffixes.sizes), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), found),
                 pa.array(_collapsed(suffixes, start, length, period), pa.string())], names)

    return rows.mapInArrow(run, StructType([*(docs.schema[name] for name in keep), *result.fields]))


def _collapsed(suffixes: Suffixes, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[str]:
    """Each text without the words that a run contains after its first period."""
    steps = np.zeros(len(suffixes.ranks[0]) + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    kept = np.cumsum(steps)[suffixes.places] == 0
    words, texts, at = suffixes.words, [], 0
    for size in suffixes.sizes.tolist():
        part = words[at:at + size]
        stays = kept[at:at + size]
        texts.append(b" ".join(part if stays.all() else [word for word, stay in zip(part, stays.tolist()) if stay]).decode())
        at += size
    return texts
