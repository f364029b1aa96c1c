"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a task where rows are dealt by a key.
DEALT = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session without it gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quillon-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in that folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in that folder: its lineage is cut, and a lost executor costs nothing of it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str, n: int) -> DataFrame:
    """df, of about n rows, by key: in the tasks that a shuffle has by itself, or in as many as leave each
    DEALT rows, so that what a task sorts and groups does not grow with the table."""
    tasks = -(-n // DEALT)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(key)
    return df.repartition(tasks, key)
