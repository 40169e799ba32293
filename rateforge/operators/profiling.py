"""Data profiling: attribute key frequency, attribute values, missing features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURES


def attribute_frequency(items: DataFrame) -> DataFrame:
    """Number of items carrying each attribute key (ascending when ordered)."""
    return (
        items.select(F.explode(F.map_keys("attributes")).alias("attribute"))
        .groupBy("attribute")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("n", "attribute")
    )


def attribute_values(items: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """D2 (+P8): distinct non-null values of every attribute key in one pass,
    or of the given keys only."""
    pairs = items.select(F.explode("attributes").alias("attribute", "value")).where(F.col("value").isNotNull())
    if keys:
        pairs = pairs.where(F.col("attribute").isin(keys))
    return pairs.distinct()


def missing_profile(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """M2: number of missing values (null or NaN) per feature, in one aggregation pass."""
    cols = columns or FEATURES
    counts = features.agg(*[F.count_if(F.isnull(c) | F.isnan(F.col(c).cast("double"))).alias(c) for c in cols])
    return counts.unpivot([], cols, "feature", "n_missing")
