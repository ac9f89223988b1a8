"""Settings and shared folders, all read from the Spark session."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A key with at least this many rows is joined apart from the others.
HEAVY_ROWS = "spark.acreage.heavyRows", 1_000_000
# A table is broadcast only when it is known to have no more rows and bytes than this.
BROADCAST_ROWS = "spark.acreage.broadcastRows", 50_000
BROADCAST_BYTES = "spark.acreage.broadcastBytes", 32 << 20
# Rows of one key that share a block in the two-level windows.
BLOCK_ROWS = "spark.acreage.blockRows", 4_096


def setting(spark: SparkSession, entry: tuple[str, int]) -> int:
    name, default = entry
    return int(spark.conf.get(name, str(default)))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one is made only where driver and executors are one process."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="acreage-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path for tables written by this run."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back.

    For results that several branches need: they are computed once, survive the loss of executors, and come back
    with column pruning and with a size that the optimizer knows.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, with its partitions and their row order fixed."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
