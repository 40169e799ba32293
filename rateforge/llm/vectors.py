"""Rows of finite vectors of one length, as the embedding operators take them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize

#: Partial results that one task merges.
FAN_IN = 32


def _finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def finite_vectors(rows: DataFrame, *others: str) -> tuple[DataFrame, int]:
    """(``others``, vector as doubles) of the rows whose vector is whole, and the vectors' length.

    A vector that is null, or holds a null, NaN or infinite entry, goes. The
    length is that of the longest vector left; the entries that a shorter one
    lacks count as null, so it goes too.
    """
    vectors = rows.where(F.coalesce(_finite(F.col("embedding")), F.lit(False))).select(
        *others, F.col("embedding").cast("array<double>").alias("vector")
    )
    d = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    return vectors.where(F.size("vector") == d), d


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of an Arrow batch as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def list_column(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow list column."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def merged(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray], label: str) -> np.ndarray | None:
    """One array from the partial results (part int, state binary of doubles), or None without any.

    Parts are merged FAN_IN at a time, in the order of their numbers, until one
    is left; no task holds more than FAN_IN of them.
    """
    left = materialize(parts, label)
    top = left.agg(F.max("part")).first()[0]
    if top is None:
        return None

    def together(group: pd.DataFrame) -> pd.DataFrame:
        states = [np.frombuffer(s, dtype=np.float64) for s in group.sort_values("part")["state"]]
        return pd.DataFrame({"part": [int(group["part"].iloc[0]) // FAN_IN], "state": [merge(states).tobytes()]})

    while True:
        left = left.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(together, "part int, state binary")
        if top < FAN_IN:
            return np.frombuffer(left.first()["state"], dtype=np.float64)
        top //= FAN_IN
