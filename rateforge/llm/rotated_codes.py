"""Nearest neighbours by inner product through randomly rotated one-bit codes.

Vectors are centred on their mean c, rotated by a random orthogonal matrix and
reduced to the signs of their coordinates: with o = c + |o - c| u, the code x
(entries +-1 / sqrt d) and the scalar f = <x, u>, the estimate of an inner
product is <q, c> + |o - c| <q, x> / f. The rotation makes its error lie within
``EPSILON |q| |o - c| sqrt((1 - f^2) / f^2 / (d - 1))`` for all but about three
vectors in a hundred on either side; the scalars kept beside the packed bits
are |o - c|, f and <c, o>. A vector is reranked by its exact inner product only
if its estimate plus this bound reaches the k-th best score that the query is
known to have, from exact scores found so far or from the estimates less their
bounds.

The index (code, scalars and vector of every row) is written once. Queries are
dealt into blocks of QUERY_BLOCK and the index into groups of rows; a task
reads its block of queries, then streams the group past it and keeps k results
per query. No row meets a query outside such a block, intermediate results are
k per query and group, and the number of groups follows the rows only beyond
GROUPS groups of GROUP_ROWS, so it is the same for all smaller tables. Every
row is indexed and every query compared with every code, so a group of copies
costs no more than other rows. Exact scores are summed from the first component
to the last, so equal vectors have equal scores.

Recall against the exact search is what the bound leaves: 0.99 and more on
vectors without structure (``tests/llm/test_embeddings.py`` measures it).

Defined cases: a vector that is null, zero, empty, or holds a null, NaN or
infinite entry takes no part, nor does a row without an id; entries missing
against the longest vector count as null; ties go to the smaller id, and among
equal ids to the row written first; repeated rows are candidates of their own,
also for each other; extra columns are ignored, whatever their names; an empty
table gives no rows; a table of fewer than k others gives them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .vectors import finite_vectors, matrix, merged

K = 20
EPSILON = 1.9
SEED = 42
QUERY_BLOCK = 8192
GROUPS = 16
GROUP_ROWS = 1 << 23
#: Estimates, and pairs reranked, that are in memory together.
ESTIMATES = 1 << 21
PAIRS = 1 << 16


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diagonal(r))


def _mean(vectors: DataFrame, d: int) -> np.ndarray:
    """The mean vector: the point that codes are taken from, so its last bits do not matter."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d + 1)
        for batch in batches:
            total += np.append(matrix(batch.column(0), d).sum(axis=0), batch.num_rows)
        if total[-1]:
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_pydict({"part": part, "state": [total.tobytes()]})

    tasks = vectors.select("vector").mapInArrow(sums, "part int, state binary")
    total = merged(tasks, lambda states: np.sum(states, axis=0), "mean-vector")
    return total[:-1] / total[-1]


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, |o - c|, f) of the rows of ``x``; f is 1 for a row at the centre."""
    turned = (x - centre) @ turn.T
    length = np.linalg.norm(turned, axis=1)
    signs = turned > 0
    f = np.abs(turned).sum(axis=1) / math.sqrt(x.shape[1])
    return np.packbits(signs, axis=1), length, np.where(length > 0, f / np.where(length > 0, length, 1.0), 1.0)


def _index(vectors: DataFrame, d: int, centre: np.ndarray, turn: np.ndarray) -> DataFrame:
    """(vec_id, vector, bits binary, length, factor, offset): ``offset`` is <c, o>."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("vector"), d)
            bits, length, f = encode(x, centre, turn)
            packed = pa.array([b.tobytes() for b in bits], pa.binary())
            columns = [*batch.columns, packed, pa.array(length), pa.array(f), pa.array(x @ centre)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "bits", "length", "factor", "offset"])

    schema = "vec_id long, vector array<double>, bits binary, length double, factor double, offset double"
    coded = vectors.mapInArrow(code, schema)
    # Written, every row has a number that stays, also among repeated ids.
    return materialize(coded.withColumn("row", F.monotonically_increasing_id()), "one-bit-index")


def exact_scores(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (q, v), summed from the first component to the last."""
    scores = np.empty(len(q))
    for s in range(0, len(q), PAIRS):
        left, right = queries[q[s : s + PAIRS]], vectors[v[s : s + PAIRS]]
        total = np.zeros(len(left))
        for j in range(left.shape[1]):
            total += left[:, j] * right[:, j]
        scores[s : s + PAIRS] = total
    return scores


class _Nearest:
    """A block of queries with the k best exact scores found for each."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int):
        self.rows, self.vectors, self.k = rows, vectors, k
        self.turned = (vectors @ turn.T).astype(np.float32)
        self.base = vectors @ centre
        self.length = np.linalg.norm(vectors, axis=1)
        self.scores = np.full((len(rows), k), -np.inf)
        self.ids = np.zeros((len(rows), k), dtype=np.int64)
        self.found = np.full((len(rows), k), -1, dtype=np.int64)

    def meet(self, rows, ids, vectors, bits, length, factor, epsilon: float) -> None:
        """Take in some rows of the index."""
        d = vectors.shape[1]
        signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
        scale = length / (factor * math.sqrt(d))
        spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(d - 1, 1)) * length
        estimate = (self.turned @ signs.T) * scale + self.base[:, None]
        # Single precision estimates: a bound is never less than their rounding.
        bound = epsilon * self.length[:, None] * spread + 1e-5 * self.length[:, None] * (length + 1e-30)
        own = self.rows[:, None] == rows[None]
        estimate[own] = -np.inf
        known = self.scores[:, -1]
        if len(rows) >= self.k:
            surely = np.partition(estimate - bound, len(rows) - self.k, axis=1)[:, len(rows) - self.k]
            known = np.maximum(known, surely)
        # A row's lower and upper ends round alike; equality is kept.
        q, v = np.nonzero((estimate + bound >= known[:, None]) & ~own)
        if len(q):
            self._keep(q, exact_scores(self.vectors, vectors, q, v), ids[v], rows[v])

    def _keep(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        better = scores >= self.scores[q, -1]
        q, scores, ids, rows = q[better], scores[better], ids[better], rows[better]
        old_q, old_at = np.nonzero(self.found >= 0)
        touched = np.isin(old_q, q)
        old_q, old_at = old_q[touched], old_at[touched]
        q = np.concatenate([old_q, q])
        scores = np.concatenate([self.scores[old_q, old_at], scores])
        ids = np.concatenate([self.ids[old_q, old_at], ids])
        rows = np.concatenate([self.found[old_q, old_at], rows])
        order = np.lexsort((rows, ids, -scores, q))
        q, scores, ids, rows = q[order], scores[order], ids[order], rows[order]
        first = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - first
        top = rank < self.k
        at = (q[top], rank[top])
        self.scores[at], self.ids[at], self.found[at] = scores[top], ids[top], rows[top]

    def batch(self) -> pa.RecordBatch:
        q, at = np.nonzero(self.found >= 0)
        columns = [self.rows[q], self.found[q, at], self.ids[q, at], self.scores[q, at]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_row", "row", "vec_id", "score"])


def _search(met: DataFrame, d: int, centre: np.ndarray, turn: np.ndarray, k: int, epsilon: float) -> DataFrame:
    """(query_row, row, vec_id, score): k results per query and group of index rows.

    Within a partition each (block, group) brings its queries first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, block = None, [], None

        def opened() -> _Nearest:
            rows = np.concatenate([r for r, _ in waiting])
            return _Nearest(rows, np.concatenate([v for _, v in waiting]), centre, turn, k)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "part", "indexed")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)]):
                here, indexed = tuple(keys[start, :2]), keys[start, 2]
                if here != key:
                    if block is not None:
                        yield block.batch()
                    key, waiting, block = here, [], None
                run_of = batch.slice(start, end - start)
                x, rows = matrix(run_of.column("vector"), d), run_of.column("row").to_numpy()
                if not indexed:
                    waiting.append((rows, x))
                    continue
                if not waiting:
                    continue
                block = block or opened()
                ids, length, factor = (run_of.column(c).to_numpy() for c in ("vec_id", "length", "factor"))
                bits = np.frombuffer(b"".join(run_of.column("bits").to_pylist()), dtype=np.uint8).reshape(len(x), -1)
                step = max(k, ESTIMATES // len(block.rows))
                for s in range(0, len(x), step):
                    part = slice(s, s + step)
                    block.meet(rows[part], ids[part], x[part], bits[part], length[part], factor[part], epsilon)
        if block is not None:
            yield block.batch()

    return met.mapInArrow(run, "query_row long, row long, vec_id long, score double")


def nearest(rows: DataFrame, is_query: Column, k: int = K, epsilon: float = EPSILON) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows found nearest to each query among all other rows.

    ``rows`` are (vec_id, embedding); ``is_query`` tells queries by vec_id.
    """
    spark = rows.sparkSession
    found, d = finite_vectors(rows.where(F.col("vec_id").isNotNull()), "vec_id")
    vectors = found.where(F.exists("vector", lambda x: x != 0)).withColumn("vec_id", F.col("vec_id").cast("long"))
    if not d or vectors.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    centre, turn = _mean(vectors, d), rotation(d)
    index = _index(vectors, d, centre, turn)
    n, n_queries = index.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks = math.ceil(n_queries / QUERY_BLOCK)
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    groups = max(GROUPS, math.ceil(n / GROUP_ROWS))

    each_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    queries = index.where(is_query).select(
        "row", "vec_id", "vector", "bits", "length", "factor", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
        each_group, F.lit(0).alias("indexed"),
    )
    indexed = index.select(
        "row", "vec_id", "vector", "bits", "length", "factor", each_block,
        F.pmod(F.xxhash64(F.col("row"), F.lit(1)), F.lit(groups)).cast("int").alias("part"), F.lit(1).alias("indexed"),
    )
    met = (
        queries.unionByName(indexed)
        .repartition(blocks * groups, "block", "part")
        .sortWithinPartitions("block", "part", "indexed")
    )
    partial = materialize(_search(met, d, centre, turn, k, epsilon), "nearest-in-groups")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    asked = index.where(is_query).select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return ranked.join(asked, "query_row").select("query_id", "rank", "vec_id", "score")
