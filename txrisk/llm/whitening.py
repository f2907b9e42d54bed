"""Embeddings whitened onto their leading principal components.

An entry c counts as the whole number floor(64 c) + 1000000, so that sums, deviations and the covariance are exact and
don't depend on how rows are dealt out. Three passes: counts and sums; products of entries centred on the rounded mean;
the whitened rows' own covariance. Each task gives one row for a dimension or pair of dimensions, which Spark adds up. The covariance
matrix alone, as large as a vector is long, is solved by `feast`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from txrisk.llm import feast
from txrisk.llm.common import own_name, stored

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
# Entries are whole numbers of fewer bits than this, so that a double holds them; vectors with larger ones count as not finite.
MOST_BITS = 50
ROWS_AT_ONCE = 8192


@dataclass
class Model:
    """Of `n` vectors of length `size`: rounded means, what entries less those add up to, eigenvalues and eigenvectors."""

    size: int
    n: int
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = math.nan

    @property
    def explained(self) -> list[float]:
        return [float(value / self.trace) for value in self.values]

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """n times the entries less their sums, exact; `y` are entries less the rounded means."""
        most = self.n * int(np.abs(y).max(initial=0)) + int(np.abs(self.rest).max(initial=0))
        if most * most * max(self.size, 1) < 1 << 62:
            return self.n * y - self.rest
        return self.n * y.astype(object) - self.rest.astype(object)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (self.deviations(y).astype(np.float64) / self.n) @ self.vectors / np.sqrt(self.values)


def entries(column: pa.Array, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, entries) of the vectors that count, by length; of one length if `size` is given."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)  # null entries are NaN
    ends = np.cumsum(np.maximum(lengths, 0))
    starts = ends - np.maximum(lengths, 0)
    scaled = np.floor(SCALE * values)
    bad = np.append(0, np.cumsum(~(np.abs(scaled) < 1 << MOST_BITS)))
    good = (lengths >= 0) & (bad[ends] == bad[starts])
    for length in np.unique(lengths[good]) if size is None else [size]:
        rows = np.flatnonzero(good & (lengths == length))
        for at in range(0, len(rows), ROWS_AT_ONCE):
            some = rows[at:at + ROWS_AT_ONCE]
            yield some, scaled[starts[some][:, None] + np.arange(length)].astype(np.int64) + SHIFT


def products(y: np.ndarray) -> np.ndarray:
    """The exact sums of products of each two columns of whole numbers."""
    most = int(np.abs(y).max(initial=0)) ** 2
    if most * len(y) < 1 << 53:
        return (y.T.astype(np.float64) @ y.astype(np.float64)).astype(np.int64)
    if most < 1 << 52:
        half = len(y) // 2
        return products(y[:half]).astype(object) + products(y[half:])
    return y.T.astype(object) @ y.astype(object)


def _added(vectors: DataFrame, add: Callable[[Iterator[pa.Array]], Iterator[tuple[int, list]]], number: str) -> DataFrame:
    """(part, place, value): the arrays that `add` gives for parts of the rows, added up by part and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole numbers of any size go as text.
        for part, values in add(batch.column(0) for batch in batches):
            numbers = pa.array([[str(v) for v in values] if number != "double" else values])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), numbers], ["part", "numbers"])

    sent = "double" if number == "double" else "string"
    rows = vectors.mapInArrow(run, f"part long, numbers array<{sent}>")
    return rows.select("part", F.posexplode("numbers").alias("place", "value")).groupBy("part", "place").agg(
        F.sum(F.col("value").cast(number)).alias("value"))


def _square(rows: DataFrame, size: int) -> np.ndarray:
    """A matrix of `size` by `size` from its numbers; never more than that come here."""
    matrix = np.zeros((size, size), object)
    for part, place, value in rows.collect():
        matrix[part, place] = value if isinstance(value, float) else int(value)
    return matrix


def fit(table: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Model:
    """The whitening of all vectors of the table that count.

    Vectors that are null, hold null or non-finite entries, or entries of 2^50 / 64 or more are left out; so are those that haven't the
    table's most frequent length (of lengths equally frequent the greatest). Fewer components than asked for come
    out where the vectors vary in fewer directions: none for an empty table or for equal vectors.
    """
    vectors = table.select(F.col(f"`{vec_col}`").cast("array<double>").alias("vector"))

    def sums(columns: Iterator[pa.Array]) -> Iterator[tuple[int, list]]:
        total: dict[int, np.ndarray] = {}
        for column in columns:
            for rows, x in entries(column):
                own = np.append(x.sum(axis=0), len(rows)).astype(object)  # the last number counts the rows
                total[x.shape[1]] = total.get(x.shape[1], 0) + own
        yield from total.items()

    totals = stored(_added(vectors, sums, "decimal(38,0)"), "whitening-sums")
    largest = totals.filter("place = part").orderBy(F.desc("value"), F.desc("part")).first()
    if largest is None:
        return Model(0, 0, *np.zeros((2, 0), np.int64), np.zeros(0), np.zeros((0, 0)), 0.0)
    size, n = largest["part"], int(largest["value"])
    total = {row["place"]: int(row["value"]) for row in totals.filter((F.col("part") == size) & (F.col("place") < size)).collect()}
    total = [total[i] for i in range(size)]
    centre = np.array([(2 * t + n) // (2 * n) for t in total], np.int64)
    rest = np.array([t - n * int(c) for t, c in zip(total, centre)], np.int64)

    def centred(columns: Iterator[pa.Array]) -> Iterator[tuple[int, list]]:
        sums, small, room = np.zeros((size, size), object), np.zeros((size, size), np.int64), 1 << 62
        for column in columns:
            for _, x in entries(column, size):
                own = products(x - centre)
                if own.dtype == object or (most := int(np.abs(own).max(initial=0))) >= room:
                    sums, small, room = sums + small, np.zeros_like(small), 1 << 62
                if own.dtype == object:
                    sums = sums + own
                else:
                    small, room = small + own, room - most
        yield from enumerate((sums + small).tolist())

    exact = _square(_added(vectors, centred, "decimal(38,0)"), size)
    off = rest.astype(object)
    spread = n * exact - np.outer(off, off)
    covariance = np.array([[value / (n * n) for value in row] for row in spread.tolist()], np.float64).reshape(size, size)
    values, basis = feast.leading(covariance, components)
    model = Model(size, n, centre, rest, values, basis, float(np.trace(covariance)))
    model.identity_error = _identity_error(vectors, model)
    return model


def _identity_error(vectors: DataFrame, model: Model) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    sent = vectors.sparkSession.sparkContext.broadcast(model)

    def squares(columns: Iterator[pa.Array]) -> Iterator[tuple[int, list]]:
        model, total = sent.value, np.zeros((k + 1, k + 1))
        for column in columns:
            for rows, x in entries(column, model.size):
                w = np.hstack([model.whitened(x - model.centre), np.ones((len(rows), 1))])  # the last gives the sums
                total += w.T @ w
        yield from enumerate(total.tolist())

    sums = _square(_added(vectors, squares, "double"), k + 1).astype(np.float64) / model.n
    covariance = sums[:k, :k] - np.outer(sums[:k, k], sums[:k, k])
    return float(np.abs(covariance - np.eye(k)).max())


def transform(table: DataFrame, model: Model, vec_col: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all) of the rows whose vectors count, with `whitened` and `deviation`.

    `deviation` is the sum of the squares of n times the entries less their sums, null where a long can't hold it. Rows that `fit` leaves
    out are left out here too; repeated rows stay. Columns called as the results are replaced.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string

    result = _parse_datatype_string("whitened array<double>, deviation long")
    keep = [name for name in (table.columns if keep is None else keep) if name not in result.fieldNames()]
    rows = table.select(*(F.col(f"`{name}`") for name in keep),
                        F.col(f"`{vec_col}`").cast("array<double>").alias(own_name(table, "vector_in")))
    sent, names, n_keep = table.sparkSession.sparkContext.broadcast(model), [*keep, *result.fieldNames()], len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for some, x in entries(batch.column(n_keep), model.size):
                y = x - model.centre
                squares = model.deviations(y)
                deviation = (squares * squares).sum(axis=1)
                deviation = pa.array([d if d < 1 << 63 else None for d in deviation.tolist()], pa.int64())
                w = model.whitened(y)
                ends = np.arange(len(some) + 1, dtype=np.int32) * w.shape[1]
                whitened = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(w).reshape(-1)))
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(some)) for c in batch.columns[:n_keep]), whitened, deviation], names)

    return rows.mapInArrow(run, StructType([*(table.schema[name] for name in keep), *result.fields]))
