"""Whitening of embeddings: blockwise QR, then singular values and vectors of a small matrix.

An entry c is taken as the integer floor(64 c) + 1,000,000. One pass sums the
integers per dimension; a second centres every row on their mean (the exact
integer n x - S, then one division), reduces blocks of rows to their triangular
factor R, and merges these factors a few at a time. The rows' covariance is
R^T R / n, but is never formed: R is made bidiagonal by Householder
reflections, its singular values come from the differential qd transform and
its right singular vectors from twisted factorisations (``bidiagonal``). The
driver holds one d x d factor whatever the rows; a row is then projected on the
components and divided by the square roots of their eigenvalues.

Components are numbered by falling eigenvalue, their largest entry positive. A
singular value under RANK times the largest is rounding noise of a dependent
direction: it has no component, so fewer may come out than asked for.

Defined cases: rows whose vector is null, or holds a null, NaN or infinite
entry, take no part; entries missing against the longest vector count as null;
a row with a null id is a row like any other; repeated rows count as often as
they stand there; equal eigenvalues get some orthogonal basis of their space,
the same on every run; extra columns are ignored, whatever their names; an
empty table, empty vectors, or vectors that are all equal give no components
and no rows. Vectors may have any length that leaves a d x d matrix in memory.
Entries must stay below 2^46 in size (an error otherwise). A squared deviation
beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bidiagonal
from .vectors import finite_vectors, list_column, matrix, merged

COMPONENTS = 32
STEPS = 64
SHIFT = 1_000_000
RANK = 1e-11
#: Rows that are reduced to a triangular factor together, as a multiple of the dimensions.
BLOCK = 16
LIMIT = 2.0**46
MAX_LONG = 2**63 - 1


@dataclass
class Whitening:
    """Rows, integer sums, and the components (as columns) with their eigenvalues."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.eigenvalues]


def _integers(column: pa.Array, d: int) -> np.ndarray:
    values = matrix(column, d)
    if np.abs(values).max(initial=0) >= LIMIT:
        raise OverflowError("an entry of an embedding is 2^46 or more")
    return np.floor(STEPS * values).astype(np.int64) + SHIFT


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: 64-bit integers where they hold it, else Python's."""
    if n * int(np.abs(x).max(initial=0)) < 2**61:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _column_sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension's integers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = _integers(batch.column(0), d)
            n += len(x)
            # A batch's sums stay in 64 bits: its rows times 2^52.
            high, low = (x >> 26).sum(axis=0), (x & (2**26 - 1)).sum(axis=0)
            total = [t + (int(h) << 26) + int(s) for t, h, s in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "sums": [[str(t) for t in total]]})

    tasks = vectors.select("vector").mapInArrow(sums, "n long, sums array<string>")
    by_place = tasks.select("n", F.posexplode("sums")).groupBy("pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s")
    )
    found = sorted((r["pos"], r["n"], int(r["s"])) for r in by_place.collect())
    return (found[0][1] if found else 0), [s for _, _, s in found]


def _triangle(rows: np.ndarray, d: int) -> np.ndarray:
    """The d x d triangular factor of the rows, zero rows below where there are fewer."""
    r = np.linalg.qr(rows, mode="r")
    return r if len(r) == d else np.vstack([r, np.zeros((d - len(r), d))])


def _centred_factor(vectors: DataFrame, d: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows: a factor per task, merged a few at a time."""

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, waiting, held = np.zeros((0, d)), [], 0
        for batch in batches:
            rows = _deviations(_integers(batch.column(0), d), n, sums).astype(np.float64) / n
            for start in range(0, len(rows), BLOCK * d):
                waiting.append(rows[start : start + BLOCK * d])
                held += len(waiting[-1])
                if held >= BLOCK * d:
                    r, waiting, held = _triangle(np.vstack([r, *waiting]), d), [], 0
        if held:
            r = _triangle(np.vstack([r, *waiting]), d)
        if len(r):
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "state": [r.tobytes()]}
            )

    def stacked(states: list[np.ndarray]) -> np.ndarray:
        return _triangle(np.vstack([s.reshape(d, d) for s in states]), d)

    tasks = vectors.select("vector").mapInArrow(factors, "part int, state binary")
    return merged(tasks, stacked, "whitening-factors").reshape(d, d)


def fit(vectors: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of (vector of length d) rows; None where they have no component."""
    if d == 0:
        return None
    n, sums = _column_sums(vectors, d)
    r = _centred_factor(vectors, d, n, sums)
    squares, directions = bidiagonal.right_singular(r, RANK)
    if not len(squares):
        return None
    k = min(components, len(squares))
    return Whitening(n, sums, directions[:, :k], squares[:k] / n, float((r * r).sum()) / n)


def apply(vectors: DataFrame, d: int, fitted: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array): every row on the components."""
    n, sums = fitted.n, fitted.sums
    scaled = fitted.components / np.sqrt(fitted.eigenvalues)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = _deviations(_integers(batch.column(1), d), n, sums)
            if moved.dtype != object and np.abs(moved).max(initial=0) >= 2**31 // d:
                moved = moved.astype(object)
            squared = (moved * moved).sum(axis=1).tolist()
            whitened = (moved.astype(np.float64) / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s if s <= MAX_LONG else None for s in squared], pa.int64()),
                    list_column(np.ascontiguousarray(whitened)),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    return vectors.select(F.col("vec_id").cast("long"), "vector").mapInArrow(
        project, "vec_id long, deviation long, whitened array<double>"
    )


def identity_error(whitened: DataFrame, k: int) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity.

    Each batch is centred before it is multiplied; means and products of two
    parts are merged with the part that the means' distance adds.
    """

    def moments(rows: np.ndarray) -> np.ndarray:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return np.concatenate([[len(rows)], mean, (centred.T @ centred).ravel()])

    def together(states: list[np.ndarray]) -> np.ndarray:
        total = states[0]
        for other in states[1:]:
            na, nb = total[0], other[0]
            gap = other[1 : k + 1] - total[1 : k + 1]
            mean = total[1 : k + 1] + gap * (nb / (na + nb))
            products = total[k + 1 :] + other[k + 1 :] + np.outer(gap, gap).ravel() * (na * nb / (na + nb))
            total = np.concatenate([[na + nb], mean, products])
        return total

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                own = moments(matrix(batch.column(0), k))
                state = own if state is None else together([state, own])
        if state is not None:
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "state": [state.tobytes()]}
            )

    total = merged(whitened.select("whitened").mapInArrow(tasks, "part int, state binary"), together, "whitening-moments")
    if total is None:
        return None
    return float(np.abs(total[k + 1 :].reshape(k, k) / total[0] - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """Every row of (vec_id, embedding) whitened, and the fit; see ``fit`` and ``apply``."""
    vectors, d = finite_vectors(rows, "vec_id")
    fitted = fit(vectors, d, components)
    if fitted is None:
        empty = "vec_id long, deviation long, whitened array<double>"
        return rows.sparkSession.createDataFrame([], empty), None
    return apply(vectors, d, fitted), fitted
