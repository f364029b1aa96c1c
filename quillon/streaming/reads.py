"""The reads as a stream: the same operators with watermarks. State is freed behind the
watermark; a finished table that is drained in one batch keeps that batch's state until its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillon.sources.shared import shared_path
from quillon.sources.sinks import write_partitions

#: Later reads than this are dropped and their state is freed.
DELAY = "1 hour"


def stream(spark: SparkSession, path: str, columns: StructType, files: int | None = None) -> DataFrame:
    """A Parquet table as a stream of its files. path: a folder or a pattern; a single file has
    to be given as a pattern. columns: those that are read. files: at most so many in a batch,
    only where no watermark follows: files come in no order of their times, so after a first
    batch the watermark would drop most rows of the others. Without it all files that are there
    make one batch, and the watermark moves only after it."""
    source = spark.readStream.schema(columns)
    return (source if files is None else source.option("maxFilesPerTrigger", files)).parquet(path)


def windowed(reads: DataFrame, at: str, width: str, *keys: str) -> DataFrame:
    """Reads of each closed window."""
    late = reads.withWatermark(at, DELAY)
    return late.groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def bursts(reads: DataFrame, at: str, gap: str, key: str) -> DataFrame:
    """Bursts that are over: reads of a key with no longer gap between neighbours."""
    late = reads.withWatermark(at, DELAY)
    return late.groupBy(F.session_window(at, gap).alias("burst"), key).agg(F.count("*").alias("n")).select(key, F.col("burst.start").alias("start"), "n")


def first_seen(reads: DataFrame, at: str, *keys: str) -> DataFrame:
    """Reads without those whose keys came before, within DELAY."""
    return reads.withWatermark(at, DELAY).dropDuplicatesWithinWatermark(list(keys))


def drain(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Runs the stream over all that is there, into a table in the shared folder."""
    path = shared_path(spark, name)
    query = rows.writeStream.format("parquet").option("checkpointLocation", f"{path}-log").option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def into_store(rows: DataFrame, store: str, by: str, log: str) -> None:
    """Runs the stream into a store of partitions by batch and column. A batch that is
    repeated after a failure replaces its own partitions and no others."""
    write = lambda batch, number: write_partitions(batch.withColumn("batch", F.lit(number)), store, "batch", by)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", log).trigger(availableNow=True).start()
    query.awaitTermination()
