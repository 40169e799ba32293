"""Session helpers: defaults for local runs and a shared checkpoint folder."""

from __future__ import annotations

import math
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library relies on. AQE re-plans joins at run
# time (broadcast when a shuffled side turns out small, split skewed partitions)
# and coalesces small shuffle partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once their frames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rateforge") -> SparkSession:
    """A local session for tests, the bench and the smoke entry point."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.ansi.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared, fault-tolerant folder and is used
    as is. Only a session on one machine (master local or local[...]) without it
    gets a scratch folder; any other session without it is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns its checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared, fault-tolerant folder (HDFS, object store)")
        configured = tempfile.mkdtemp(prefix="rateforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Shuffle sizing: the largest shuffles carry the feature rows, a few times
# wider than the compressed input. Partitions of about TARGET_PARTITION_BYTES
# fit executor memory with room to spare; AQE coalesces what turns out small.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
EXPANSION = 4
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def size_shuffles(spark: SparkSession, nbytes: int) -> int:
    """Raise AQE's initial shuffle partition count to fit ``nbytes`` of input.

    The count is input x EXPANSION / TARGET_PARTITION_BYTES, at any size; a
    larger setting already in the session is kept. Returns the count in effect.
    """
    wanted = math.ceil(nbytes * EXPANSION / TARGET_PARTITION_BYTES)
    current = shuffle_partitions(spark)
    if wanted > current:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
        return wanted
    return current


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions a shuffle starts with, for operators that deal rows themselves."""
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
