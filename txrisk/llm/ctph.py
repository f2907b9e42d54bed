"""Document fingerprints by context-triggered piecewise hashing.

A hash over the last seven bytes ends a chunk wherever it falls on a multiple of the block size. Each
chunk gives one letter, from a hash of its bytes; the letters are the signature. The block size doubles from
3 until the signature at that size has about 64 letters. A fingerprint is `size:signature:signature at twice
the size`, so that texts whose sizes differ by one doubling still compare.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 7
SMALLEST = 3
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
LENGTH = 64
# Signatures without so many letters in a row in common are not alike.
COMMON = 4
BYTES_AT_ONCE = 1 << 20

_FACTOR = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_LETTER = np.frombuffer(LETTERS.encode(), np.uint8)


class Powers:
    """Powers of a 64-bit factor and of its inverse, grown as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 1 << 17)
            self.up, self.down = (np.cumprod(np.concatenate(
                [np.ones(1, np.uint64), np.full(n - 1, factor, np.uint64)])) for factor in (_FACTOR, _INVERSE))


_POWERS = Powers()


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the seven bytes that end at each place; before the text are zeros."""
    result = np.empty(len(data), np.uint32)
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint8), data])
    for start in range(0, len(data), BYTES_AT_ONCE):
        part = padded[start:start + BYTES_AT_ONCE + WINDOW - 1].astype(np.uint32)
        n = len(part) - WINDOW + 1
        mixed = np.zeros(n, np.uint32)
        for i in range(WINDOW):
            mixed = mixed * np.uint32(0x01000193) + part[i:i + n]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        result[start:start + n] = mixed ^ (mixed >> np.uint32(13))
    return result


def _signature(data: np.ndarray, ends: np.ndarray) -> str:
    """A letter for each chunk; chunks end before `ends`, and the rest is the last one."""
    starts = np.concatenate([[0], ends])
    if starts[-1] == len(data):
        starts = starts[:-1]
    sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _POWERS.up[:len(data)], starts) * _POWERS.down[starts]
    sums ^= sums >> np.uint64(29)
    sums *= np.uint64(0xBF58476D1CE4E5B9)
    return _LETTER[(sums >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    """`size:signature:signature`; an empty text has empty signatures."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return f"{SMALLEST}::"
    _POWERS.grow(len(data))
    rolled = _rolling(data)
    size = SMALLEST
    while size * LENGTH < len(data):
        size *= 2

    def ends_at(size: int) -> np.ndarray:
        return np.flatnonzero(rolled % np.uint32(size) == 0) + 1

    # Repetitive texts have far fewer or more chunks than their length lets expect.
    ends = ends_at(size)
    while size > SMALLEST and len(ends) < LENGTH // 2 and len(smaller := ends_at(size // 2)) <= 2 * LENGTH:
        size, ends = size // 2, smaller
    while len(ends) > 2 * LENGTH and size < 1 << 30:
        size *= 2
        ends = ends_at(size)
    wide = ends[rolled[ends - 1] % np.uint32(2 * size) == 0]
    return f"{size}:{_signature(data, ends)}:{_signature(data, wide)}"


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each letter of `a`."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    ones = (1 << len(a)) - 1
    row = ones
    for letter in b:
        hit = row & places.get(letter, 0)
        row = ((row + hit) | (row - hit)) & ones
    return len(a) - row.bit_count()


def signature_likeness(a: str, b: str) -> float:
    """1 less the edit distance (insertions and deletions) as a share of both lengths."""
    if a == b:
        return 1.0
    least = min(COMMON, len(a), len(b))
    if not least or {a[i:i + least] for i in range(len(a) - least + 1)}.isdisjoint(
            b[i:i + least] for i in range(len(b) - least + 1)):
        return 0.0
    return 2 * _common_subsequence(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """From 0 to 1; fingerprints compare at equal block sizes, or at the size they share."""
    if a == b:
        return 1.0
    size_a, short_a, long_a = a.split(":")
    size_b, short_b, long_b = b.split(":")
    if size_a == size_b:
        return max(signature_likeness(short_a, short_b), signature_likeness(long_a, long_b) if long_a and long_b else 0.0)
    if int(size_a) == 2 * int(size_b):
        return signature_likeness(short_a, long_b) if short_a and long_b else 0.0
    if int(size_b) == 2 * int(size_a):
        return signature_likeness(long_a, short_b) if long_a and short_b else 0.0
    return 0.0


def fingerprints(df: DataFrame, columns: dict[str, str], pairs: dict[str, tuple[str, str]],
                 keep_texts: bool = True) -> DataFrame:
    """`df` with a fingerprint of each text column, under the names in `columns`, and likenesses of `pairs` of them.

    Null texts count as empty; the texts themselves go unless `keep_texts`. Columns that `df` has already under those names are replaced.
    """
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    new = [*columns.values(), *pairs]
    if not keep_texts:
        new += columns
    schema = StructType([*(f for f in df.schema.fields if f.name not in new),
                         *(StructField(name, StringType()) for name in columns.values()),
                         *(StructField(name, DoubleType()) for name in pairs)])
    kept = [f.name for f in df.schema.fields if f.name not in new]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {to: [fingerprint(text or "") for text in batch.column(of).to_pylist()] for of, to in columns.items()}
            alike = [[likeness(a, b) for a, b in zip(found[left], found[right])] for left, right in pairs.values()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), *(pa.array(v, pa.string()) for v in found.values()),
                 *(pa.array(v, pa.float64()) for v in alike)], schema.fieldNames())

    return df.mapInArrow(run, schema)


def likeness_column(left: str, right: str):
    """`likeness` of two columns of fingerprints; null where either is."""
    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) if x is not None and y is not None else None for x, y in zip(a, b)], dtype="float64")

    return alike(left, right)
