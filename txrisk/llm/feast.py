"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST), counted by inertia.

The matrix is as large as a vector is long, so it is solved where the job is planned; rows never come here. Eigenvalues
are wanted in an interval: a circle around it is integrated by quadrature, each node one solve with the matrix shifted by
a complex number, and what comes out spans the wanted eigenvectors. Rayleigh-Ritz takes them out of that span. The inertia of
the matrix shifted to both ends of the interval tells how many there must be.
"""

from __future__ import annotations

import numpy as np

NODES = 8
IN_AN_INTERVAL = 8
MOST_ROUNDS = 30


class Inertia:
    """How many eigenvalues lie above a shift, from the signs of the pivots of the shifted tridiagonal form."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.diagonal, off = _tridiagonal(matrix)
        self.squares = off * off
        reach = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
        self.low, self.high = float((self.diagonal - reach).min()), float((self.diagonal + reach).max())
        self.same = 1e-12 * max(abs(self.low), abs(self.high))
        self.tiny = np.finfo(float).tiny / np.finfo(float).eps

    def above(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for value, square in zip(self.diagonal.tolist(), [0.0, *self.squares.tolist()]):
            pivot = value - shift - square / pivot
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            count += pivot > 0
        return count

    def edge(self, count: int, low: float) -> tuple[float, int]:
        """(shift, eigenvalues above it): in the middle of the first gap below the `count` greatest, or `low`.

        Eigenvalues nearer to each other than `same` can't be told apart; no shift lies between them.
        """
        while self.above(low) > count:
            a, b = low, self.high
            while b - a > self.same:
                middle = (a + b) / 2
                n = self.above(middle)
                if n == count:
                    bottom, top = self._gap(count, middle, a, b)
                    if top - bottom > 2 * self.same:
                        return (bottom + top) / 2, count
                    a = bottom
                    break
                a, b = (middle, b) if n > count else (a, middle)
            count = max(self.above(max(a - 2 * self.same, low)), count + 1)
        return low, self.above(low)

    def clear(self, shift: float) -> float:
        """The least shift from `shift` on, in steps, that no eigenvalue is near to."""
        while self.above(shift - self.same) != self.above(shift + self.same):
            shift += 4 * self.same
        return shift

    def _gap(self, count: int, inside: float, low: float, high: float, steps: int = 20) -> list[float]:
        ends = []
        for outside in (low, high):
            near, far = inside, outside
            for _ in range(steps):
                middle = (near + far) / 2
                near, far = (middle, far) if self.above(middle) == count else (near, middle)
            ends.append(near)
        return ends


def _tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the tridiagonal matrix that Householder reflections turn `matrix` into."""
    a = np.array(matrix, np.float64)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ x
        p -= (x @ p) * x
        rest -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, a[k + 1, k])
    return np.diagonal(a).copy(), np.array([a[i + 1, i] for i in range(n - 1)])


def _filtered(matrix: np.ndarray, low: float, high: float, start: np.ndarray) -> np.ndarray:
    """`start` projected onto the eigenvectors with eigenvalues between `low` and `high`, as far as the quadrature tells."""
    points, weights = np.polynomial.legendre.leggauss(NODES)
    middle, radius = (low + high) / 2, (high - low) / 2
    eye, total = np.eye(len(matrix)), np.zeros_like(start)
    for point, weight in zip(points, weights):
        turn = radius * np.exp(-0.5j * np.pi * (point - 1))  # the upper half of the circle; the lower is its conjugate
        total += weight / 2 * (turn * np.linalg.solve((middle + turn) * eye - matrix, start)).real
    return total


def in_interval(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` eigenvalues between `low` and `high`, falling, and their unit eigenvectors as columns."""
    n = len(matrix)
    size = min(n, 2 * count + 2)
    rng = np.random.default_rng(0)
    scale = np.abs(matrix).sum(axis=1).max()
    while True:
        basis = rng.standard_normal((n, size))
        best = np.inf
        for _ in range(MOST_ROUNDS):
            span, _ = np.linalg.qr(_filtered(matrix, low, high, basis))
            values, turns = np.linalg.eigh(span.T @ matrix @ span)
            basis = span @ turns
            inside = np.flatnonzero((values > low) & (values <= high))
            apart = np.abs(matrix @ basis[:, inside] - basis[:, inside] * values[inside]).max(initial=0.0)
            # Rounds go on while they still gain: the vectors are wanted to the last digits.
            if len(inside) == count and apart <= 1e-11 * scale and apart >= best / 2:
                falling = inside[::-1]
                return values[falling], basis[:, falling]
            best = min(best, apart) if len(inside) == count else np.inf
        if size == n:
            raise RuntimeError(f"{count} eigenvalues lie between {low} and {high}, {len(inside)} were found")
        size = min(n, 2 * size)


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The up to `most` greatest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues within the rounding errors of the greatest (about 1e-11 of it), or negative, are left out.
    """
    n = len(matrix)
    if not n or not np.any(matrix):
        return np.zeros(0), np.zeros((n, 0))
    inertia = Inertia(matrix)
    top = inertia.high + abs(inertia.high) * 1e-6
    low = inertia.clear(max(16 * n * np.finfo(float).eps, 1e-11) * inertia.high)
    wanted, done, values, vectors = min(most, inertia.above(low)), 0, [], []
    while done < wanted:
        edge, above = inertia.edge(min(done + IN_AN_INTERVAL, wanted), low)
        found, basis = in_interval(matrix, edge, top, above - done)
        values.append(found)
        vectors.append(basis)
        top, done = edge, above
    return np.concatenate(values)[:wanted], np.concatenate(vectors, axis=1)[:, :wanted]
