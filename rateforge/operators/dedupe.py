"""Last-wins reduction: one row per key, the row with the greatest order value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keep, for every key, the row whose ``order`` column is greatest.

    Expressed as a grouped ``max_by`` over a struct of the other columns, so
    Spark aggregates partially before the shuffle: a key holding a large share
    of all rows is reduced map-side and never gathered into one task or one
    window partition. ``order`` must be unique within a key for a repeatable
    result (file position, or a timestamp plus an id).
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    if not rest:
        return df.select(*keys).distinct()
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order)).alias("_last")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_last")[c].alias(c) for c in rest])
