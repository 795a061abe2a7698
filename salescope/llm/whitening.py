"""Embedding whitening: principal components scaled to unit variance.

A vector's components become whole numbers, ``floor(SCALE * c)``.  The fit list has
every distinct vector of whole numbers once; its sums are exact, and its covariance
(divisor: their number) is added up by partitions from centred vectors.  A task and
the driver hold ``length ** 2`` sums for each length that occurs, whatever the number
of vectors; a mean, the components and their scales go back with the tasks.

The components come from QDWH spectral divide and conquer: the polar factor ``U``
of the covariance minus a shift has eigenvalues 1 and -1, on the sides of the
shift, so ``(U + I) / 2`` projects on the components above it.  Orthonormal bases
of its range and of what is left turn the covariance into two smaller ones, which
are split again until one direction is left.  Parts that hold none of the wanted
components are not split.  The polar factor is found by the QR form of the
dynamically weighted Halley iteration.  Components of very different sizes come from
several covariances, each without the components found before.

Vectors of different lengths are different tables: each length has a fit list and
components of its own.

Defined results: vectors that are null or hold null or non-finite entries give no
rows, nor do empty ones; repeated rows count once in the fit list and all come back;
a component whose variance is no more than rounding (a fit list of one vector, for
instance) comes back with a null ``whitened`` and no part in ``identity_error``, with
``explained`` 0 (null if there is no variance at all); fewer dimensions than wanted
components give as many components; sums that don't fit a long come back as null
``deviation``; entries beyond a long's range become its bounds; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
SCALE = 256
COMPONENTS = 4
# ---- end of fixed values ----
ROUNDS = 40  # of the Halley iteration; six are enough at any condition
SHIFTS = 12  # tried before a part counts as one multiple eigenvalue
EPSILON = float(np.finfo(float).eps)
GRADE = 1e-8  # of the largest eigenvalue: what one matrix in double precision can tell


# ---- spectral divide and conquer ----


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    n = len(a)
    x = a / np.linalg.norm(a)
    low = EPSILON  # a lower bound of the smallest singular value; a wrong one only costs rounds
    eye = np.eye(n)
    for _ in range(ROUNDS):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        first = np.sqrt(1 + d)
        wa = first + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * first), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        change = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if 1 - low < 10 * EPSILON and change < np.cbrt(EPSILON):
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None for a multiple of the identity."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n))
    size = max(np.linalg.norm(a), abs(mean))
    if spread <= 4 * n * EPSILON * size:
        return None
    rng = np.random.default_rng(1)
    best = None
    for attempt in range(SHIFTS):
        # The mean lies between the eigenvalues; if one of them is too near, the next shift is beside it.
        shift = mean + (rng.uniform(-0.5, 0.5) * spread / n if attempt else 0.0)
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        basis, _ = np.linalg.qr(projector @ rng.normal(size=(n, k)))
        basis, _ = np.linalg.qr(np.hstack([projector @ basis, rng.normal(size=(n, n - k))]))
        above, below = basis[:, :k], basis[:, k:]
        left_over = np.linalg.norm(below.T @ a @ above)
        if best is None or left_over < best[0]:
            best = left_over, above, below
        if left_over <= 10 * n * EPSILON * size:
            break
    return best and best[1:]


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    wanted = min(wanted, len(a))
    scale = np.abs(a).max() if a.size else 0.0
    work = a / scale if scale else a
    found = []
    # Bases of parts still to split, the one with the largest eigenvalues last.
    parts = [np.eye(len(a))]
    while parts and len(found) < wanted:
        basis = parts.pop()
        own = basis.T @ work @ basis
        halves = split((own + own.T) / 2) if basis.shape[1] > 1 else None
        if halves is None:
            found += list(basis.T)
        else:
            parts += [basis @ halves[1], basis @ halves[0]]
    rows = np.array(found[:wanted]).reshape(-1, len(a))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    most = np.abs(rows).argmax(axis=1)
    rows *= np.sign(rows[np.arange(len(rows)), most])[:, None]
    values = np.einsum("ki,ij,kj->k", rows, work, rows) * (scale or 1.0)
    order = np.argsort(-values, kind="stable")
    return values[order], rows[order]


# ---- sums on Spark ----


def whole(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the usable rows."""
    v = vectors["embedding"].cast("array<double>")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(vectors["vec_id"].alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & (F.size("v") > 0))
    return rows.filter(~bad).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


@dataclass(frozen=True)
class Fit:
    """What the tasks know of one vector length."""

    n: int
    sums: list[int]
    values: np.ndarray  # largest eigenvalues, falling
    rows: np.ndarray  # their eigenvectors
    trace: float | None = None

    @property
    def real(self) -> np.ndarray:
        """Which components have a variance above rounding, that of a length of ``sqrt(n * trace)``."""
        return self.values > self.n * max(self.trace, 0.0) * (8 * len(self.sums) * EPSILON) ** 2

    def centred(self, x: np.ndarray) -> np.ndarray:
        # The whole part of the mean is taken off exactly.
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        return (x - whole).astype(float) - np.array([s % self.n / self.n for s in self.sums])

    def rest(self, x: np.ndarray) -> np.ndarray:
        """The centred vectors without their part along the components known."""
        away = self.centred(x)
        for _ in range(2):  # twice leaves no rounding of the first
            away = away - (away @ self.rows.T) @ self.rows
        return away

    def joined(self, matrix: np.ndarray, wanted: int) -> Fit:
        """With the largest components of ``matrix``, the covariance of the rest.

        Components below ``GRADE`` of its largest wait for a matrix of their own,
        without the large numbers that hide their digits.
        """
        values, rows = components(matrix, min(wanted, len(matrix)) - len(self.values))
        trace = float(np.trace(matrix)) if self.trace is None else self.trace
        use = values >= GRADE * values[0] if values[0] > 0 else values <= values[0]
        more = Fit(self.n, self.sums, np.r_[self.values, values[use]], np.vstack([self.rows, rows[use]]), trace)
        if more.real.all():
            return more
        # Nothing but rounding is left.
        return Fit(self.n, self.sums, np.r_[self.values, values], np.vstack([self.rows, rows]), trace)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scale = np.sqrt(np.where(self.real, self.values, 1.0))
        return self.centred(x) @ self.rows.T / scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact; in 64 bits where they surely fit."""
        most = self.n * max(int(x.max()), -int(x.min())) + max(abs(s) for s in self.sums)
        kind = np.int64 if len(self.sums) * most * most < 1 << 62 else object
        away = x.astype(kind) * self.n - np.array(self.sums, dtype=kind)
        return [int(d) if d < 1 << 63 else None for d in (away * away).sum(axis=1)]


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        own = batch.take(pa.array(np.flatnonzero(lengths == length)))
        yield own, own.column(column).flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)


def _moments(unique: DataFrame, prepared, width) -> dict[int, np.ndarray]:
    """Per vector length the summed products of what ``prepared(length, x)`` gives, as a square matrix.

    Every task adds up its rows; the tasks' sums are added on Spark by place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for _, x in _by_length(batch, 0):
                rows = prepared(x.shape[1], x)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + rows.T @ rows
        for length, matrix in sums.items():
            i, j = np.triu_indices(len(matrix))
            columns = [np.full(len(i), length), i, j, matrix[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["length", "i", "j", "s"])

    sums = unique.select("x").mapInArrow(run, "length long, i long, j long, s double")
    out = {}
    for length, i, j, s in sums.groupBy("length", "i", "j").agg(F.sum("s").alias("s")).collect():
        size = width(length)
        out.setdefault(length, np.zeros((size, size)))[i, j] = s
    return {length: m + np.triu(m, 1).T for length, m in out.items()}


def fit(unique: DataFrame, wanted: int = COMPONENTS) -> dict[int, Fit]:
    """The components of every vector length of the fit list ``(x)``."""
    places = unique.select(F.size("x").alias("length"), F.posexplode("x").alias("i", "c"))
    sums = places.groupBy("length", "i").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    totals: dict[int, dict[int, int]] = {}
    counts = {}
    for length, i, s, n in sums.collect():
        totals.setdefault(length, {})[i] = int(s)
        counts[length] = n
    out = {}
    for length, t in totals.items():
        out[length] = Fit(counts[length], [t[i] for i in range(length)], np.empty(0), np.empty((0, length)))
    while open_lengths := [length for length, known in out.items() if len(known.values) < min(wanted, length)]:
        known = dict(out)
        own = unique.filter(F.size("x").isin(open_lengths))
        for length, matrix in _moments(own, lambda length, x: known[length].rest(x), lambda length: length).items():
            out[length] = out[length].joined(matrix / counts[length], wanted)
    return out


def identity_errors(unique: DataFrame, fits: dict[int, Fit]) -> dict[int, float | None]:
    """Per vector length, how far the covariance of the whitened fit list is from the identity."""

    def prepared(length: int, x: np.ndarray) -> np.ndarray:
        # A column of ones adds up the means.
        return np.hstack([fits[length].whitened(x), np.ones((len(x), 1))])

    found = _moments(unique, prepared, lambda length: len(fits[length].values) + 1)
    out = {}
    for length, m in found.items():
        use = np.flatnonzero(fits[length].real)
        mean = m[use, -1] / fits[length].n
        # The means are rounding errors, so centring afterwards loses nothing.
        covariance = m[np.ix_(use, use)] / fits[length].n - np.outer(mean, mean)
        out[length] = float(np.abs(covariance - np.eye(len(use))).max()) if len(use) else None
    return out


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every usable row and component."""
    rows = durable(whole(vectors))
    unique = durable(rows.select("x").distinct())
    fits = fit(unique, wanted)
    errors = identity_errors(unique, fits)
    kind = rows.schema["vec_id"].dataType.simpleString()
    arrow = pa.schema(
        [
            ("component", pa.int32()),
            ("n", pa.int64()),
            ("deviation", pa.int64()),
            ("whitened", pa.float64()),
            ("explained", pa.float64()),
            ("identity_error", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, x in _by_length(batch, 1):
                known = fits[x.shape[1]]
                white, size = known.whitened(x), len(known.values)
                deviation = known.deviations(x)
                ids = own.column(0).take(pa.array(np.repeat(np.arange(len(own)), size)))
                share = [
                    (float(e / known.trace) if real else 0.0) if known.trace > 0 else None
                    for e, real in zip(known.values, known.real)
                ]
                columns = [
                    np.tile(np.arange(1, size + 1), len(own)),
                    np.full(len(own) * size, known.n),
                    [d for d in deviation for _ in range(size)],
                    pa.array(white.ravel(), mask=np.tile(~known.real, len(own))),
                    share * len(own),
                    [errors[x.shape[1]]] * (len(own) * size),
                ]
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays([ids, *arrays], ["vec_id", *arrow.names])

    return rows.mapInArrow(
        run,
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
