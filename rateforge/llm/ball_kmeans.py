"""Vector code compression: product codebooks trained by ball k-means in whole numbers.

A component x is taken as floor(256 x). Vectors are cut into equal parts, and
each part position has a codebook of ENTRIES integer entries. All distances
are integer squares and all comparisons of distances are between integers, so
the assignment is that of a full search, ties to the lower index included.

After the first, full assignment every part knows its entry. An entry and the
parts assigned to it form a ball: its radius r is the largest distance of
these parts to the (moved) entry c. Only an entry j with |c - c_j| <= 2 r can
take a part from the ball: the neighbours. A part nearer to c than half the
way to the nearest neighbour stays (the stable core). The others lie in rings
between the half distances to the neighbours in rising order, and a part is
compared with the neighbours up to its ring only. Balls are those of the rows
of one batch, with their own, smaller radii: what holds for the ball of all
parts of an entry holds for each of them, and no second pass is needed.

Entries move to the componentwise floor of their parts' mean. Sums are added
per task before they are shuffled, one row a task and codebook cell; the driver
gets one row per cell, whatever the rows.

Defined cases: rows whose vector is null, or holds a null, NaN or infinite
component, are dropped; components missing against the longest vector count as
null; the first codebooks come from the rows with the smallest ids (equal ids
in the order of their vectors, null ids last), fewer entries where there are
fewer rows; an entry that no part chose stays; repeated rows count as often as
they stand there; null labels are one group; a length that does not divide by
the parts is cut as evenly as can be; extra columns are ignored, whatever
their names; an empty table, or vectors that are all empty, give no rows.
Components must stay below 2^16 in size (an error otherwise), which keeps all
squares in 64 bits up to 2,048 components a part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .vectors import finite_vectors, matrix

PARTS = 16
ENTRIES = 64
ROUNDS = 2
STEPS = 256
LIMIT = 2.0**16
#: Distances computed together.
CHUNK = 1 << 18

Codebooks = list[np.ndarray]


def bounds(d: int, parts: int) -> list[int]:
    return [d * i // parts for i in range(parts + 1)]


def _squares(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    gap = rows - entries
    return (gap * gap).sum(axis=-1)


def full_search(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each point by comparing it with all of them."""
    best = np.empty(len(points), dtype=np.int64)
    least = np.empty(len(points), dtype=np.int64)
    step = max(1, CHUNK // max(1, len(entries)))
    for s in range(0, len(points), step):
        distance = _squares(points[s : s + step, None, :], entries[None])
        best[s : s + step] = distance.argmin(axis=1)
        least[s : s + step] = distance.min(axis=1)
    return best, least


def ball_search(points: np.ndarray, own: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """As ``full_search``, from each point's present entry; and the distances computed.

    All bounds are kept squared and times four, so that they are exact.
    """
    k = len(entries)
    between = _squares(entries[:, None, :], entries[None])
    distance = _squares(points, entries[own])
    radius = np.zeros(k, dtype=np.int64)
    np.maximum.at(radius, own, distance)
    # Neighbours by rising distance; those beyond the ball's reach are never compared.
    np.fill_diagonal(between, -1)
    order = np.argsort(between, axis=1, kind="stable")[:, 1:]
    np.fill_diagonal(between, 0)
    gaps = np.take_along_axis(between, order, axis=1)
    n_neighbours = (gaps <= 4 * radius[:, None]).sum(axis=1)
    best, least, computed = own.astype(np.int64), distance.copy(), len(points)
    for ball in np.flatnonzero(np.bincount(own, minlength=k)):
        n = n_neighbours[ball]
        if n == 0:
            continue
        members = np.flatnonzero(own == ball)
        # How many neighbours a point must be compared with: none in the stable core.
        ring = np.searchsorted(gaps[ball, :n], 4 * distance[members], side="right")
        members, ring = members[ring > 0], ring[ring > 0]
        step = max(1, CHUNK // int(n))
        for s in range(0, len(members), step):
            some, reach = members[s : s + step], ring[s : s + step]
            starts = np.cumsum(reach) - reach
            near = order[ball, np.arange(reach.sum()) - np.repeat(starts, reach)]
            found = _squares(points[np.repeat(some, reach)], entries[near])
            computed += len(near)
            shortest = np.minimum.reduceat(found, starts)
            first = np.minimum.reduceat(np.where(found == np.repeat(shortest, reach), near, k), starts)
            better = (shortest < least[some]) | ((shortest == least[some]) & (first < best[some]))
            best[some[better]], least[some[better]] = first[better], shortest[better]
    return best, least, computed


def _integers(column: pa.Array, d: int) -> np.ndarray:
    values = matrix(column, d)
    if np.abs(values).max(initial=0) >= LIMIT:
        raise OverflowError("a component of an embedding is 2^16 or more")
    return np.floor(STEPS * values).astype(np.int64)


def _codes(batch: pa.RecordBatch, name: str, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=np.uint8).reshape(-1, parts)


def _assigned(vectors: DataFrame, d: int, books: Codebooks) -> DataFrame:
    """``vectors`` with code (a byte per part) and error; from the code that they have, where they have one."""
    cut, parts, coded = bounds(d, len(books)), len(books), "code" in vectors.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch.column("vector"), d)
            present = _codes(batch, "code", parts) if coded else None
            code = np.empty((len(x), parts), dtype=np.uint8)
            error = np.zeros(len(x), dtype=np.int64)
            for p, entries in enumerate(books):
                points = x[:, cut[p] : cut[p + 1]]
                if present is None:
                    chosen, squares = full_search(points, entries)
                else:
                    chosen, squares, _ = ball_search(points, present[:, p].astype(np.int64), entries)
                code[:, p] = chosen
                error += squares
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    batch.column("vector"),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(error),
                ],
                names=["vec_id", "label", "vector", "code", "error"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(assign, f"vec_id long, label {label}, vector array<double>, code binary, error long")


def _moved(assigned: DataFrame, d: int, books: Codebooks) -> Codebooks:
    """The codebooks with each used entry at the floor of its parts' mean."""
    cut, parts, k = bounds(d, len(books)), len(books), len(books[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, k), dtype=np.int64)
        total = np.zeros((d, k), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, code = _integers(batch.column("vector"), d), _codes(batch, "code", parts)
            for p in range(parts):
                count[p] += np.bincount(code[:, p], minlength=k)
                for j in range(cut[p], cut[p + 1]):
                    np.add.at(total[j], code[:, p], x[:, j])
        part, entry = np.nonzero(count)
        if len(part):
            cells = [total[cut[p] : cut[p + 1], e].tolist() for p, e in zip(part, entry)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(part, pa.int32()),
                    "entry": pa.array(entry, pa.int32()),
                    "n": pa.array(count[part, entry]),
                    "sums": pa.array(cells, pa.list_(pa.int64())),
                }
            )

    widest = max(b - a for a, b in zip(cut, cut[1:]))
    tasks = assigned.select("vector", "code").mapInArrow(sums, "part int, entry int, n long, sums array<long>")
    cells = tasks.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(widest)]).alias("sums")
    )
    moved = [b.copy() for b in books]
    for row in cells.collect():
        width = cut[row["part"] + 1] - cut[row["part"]]
        moved[row["part"]][row["entry"]] = [s // row["n"] for s in row["sums"][:width]]
    return moved


def first_codebooks(vectors: DataFrame, d: int, parts: int, entries: int) -> Codebooks:
    """The parts of the rows with the smallest ids (at most ``entries`` of them reach the driver)."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    x = np.floor(STEPS * np.array([r[0] for r in rows], dtype=np.float64).reshape(len(rows), d)).astype(np.int64)
    cut = bounds(d, parts)
    return [x[:, cut[p] : cut[p + 1]] for p in range(parts)]


def digest(books: Codebooks) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()


def compress(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks]:
    """((vec_id, label, vector, code binary, error long), codebooks) of the rows (vec_id, embedding, label)."""
    if entries > 256:
        raise ValueError("a code has one byte per part")
    found, d = finite_vectors(rows, "vec_id", "label")
    vectors = found.withColumn("vec_id", F.col("vec_id").cast("long"))
    books = first_codebooks(vectors, d, parts, entries)
    if not d or not len(books[0]):
        label = rows.schema["label"].dataType.simpleString()
        schema = f"vec_id long, label {label}, vector array<double>, code binary, error long"
        return rows.sparkSession.createDataFrame([], schema), books
    coded = vectors
    for n in range(rounds):
        coded = materialize(_assigned(coded, d, books).drop("error"), f"codes-{n}")
        books = _moved(coded, d, books)
    return materialize(_assigned(coded, d, books).drop("vector"), "codes"), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error: the error summed over the rows of an equal label."""
    sums = materialize(
        coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors"
    )
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "inner").drop("_label")
