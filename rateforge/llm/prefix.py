"""Distributed prefix sums over a range-sorted table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_partitions
from ..sources.shared import materialize


def _running(batches: Iterator[pa.RecordBatch], group: int, value: int) -> Iterator[pa.RecordBatch]:
    """Each row's sum of the rows before it in its part of the group."""
    part, current, total = TaskContext.get().partitionId(), object(), 0
    for batch in batches:
        before = []
        for g, v in zip(batch.column(group).to_pylist(), batch.column(value).to_pylist()):
            if g != current:
                current, total = g, 0
            before.append(total)
            total += v
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(before), type=pa.int32()), pa.array(before, type=pa.int64())],
            names=[*batch.schema.names, "_part", "_run"],
        )


def prefix_sums(rows: DataFrame, group: str, order: list[Column], value: str, label: str) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the rows of the group that come earlier.

    Rows are range-partitioned by (group, order), so a group that holds a
    third of the table spreads over a third of the partitions. Each partition
    sums its own run of a group; the runs' totals (at most partitions plus
    groups of them) are summed over the parts of a group and added back.
    The order is ascending, a null group last; it must tell rows apart as far
    as the caller cares.
    """
    spark = rows.sparkSession
    keys = [F.col(group).asc_nulls_last(), *order]
    ordered = rows.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    g, v = rows.columns.index(group), rows.columns.index(value)
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_run", T.LongType())])
    runs = materialize(ordered.mapInArrow(lambda batches: _running(batches, g, v), schema), label)
    totals = runs.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(
        F.max(F.col("_run") + F.col(value)).alias("_total")
    )
    earlier = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        totals.select("_g", "_p", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")), f"{label}-offsets"
    )
    return (
        runs.join(offsets, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "inner")
        .withColumn("before", F.col("_run") + F.col("_offset"))
        .drop("_part", "_run", "_g", "_p", "_offset")
    )
