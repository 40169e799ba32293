"""Tables written to the shared folder and read back.

A frame that several jobs read is written once as Parquet under the folder
named by ``spark.checkpoint.dir``. Unlike a row checkpoint the copy keeps
column pruning, has a true size for the planner (which then broadcasts it
only below its threshold) and outlives a lost executor.
"""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the frame that reads it back."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    Spark drops them once the driver's garbage collector finds their plans
    unused, which may take long on an idle driver. For jobs whose shuffles are
    large against their result. The scheduler holds the job just ended until it
    is given another, hence the small one; Python's handles of the plans stand
    in reference cycles; and the JVM drops some of what hangs together only
    with a second collection.
    """
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(1)
    spark.sparkContext._jvm.System.gc()
