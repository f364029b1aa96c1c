"""Helpers shared by the operators: shared folder, lineage cuts, table paths."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and RE2 pattern of the white space that separates words in the contracts.
SPACE = "[ \\t-\\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session
    where nothing is set (tests) gets a temporary folder of this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quillon-"))
    return sc.getCheckpointDir()


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffles of the jobs run inside as soon as each has ended; else
    they stay on disk until the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: cuts the
    lineage, an executor lost later costs nothing of it, and its shuffles go."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with swept(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts(*tables: DataFrame) -> None:
    """Deletes tables of cut() of which no plan that is still to run reads."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Slots of a table of bits, six in a byte; the driver holds this table and no more.
BITS, IN_BYTE = 1 << 19, 6


def bits_of(rows: DataFrame, h: Column) -> Column:
    """A table with a bit set at the slots of the hashes of all rows, for has_bit(). Hashes
    without their bit are none of these; others may be. Bytes are ASCII: 64 and the bits."""
    slot = h.bitwiseAND(F.lit(BITS - 1)) + 1
    parts = rows.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    whole = 0
    with swept(rows.sparkSession):
        found = parts.collect()
    for part, bits in found:
        whole |= int.from_bytes(bits, "little") << 8 * len(bits) * (part - 1)
    digits = format(whole, f"0{BITS}b")[::-1]
    return F.lit(bytes(64 + int(digits[i : i + IN_BYTE][::-1], 2) for i in range(0, BITS, IN_BYTE)))


def has_bit(bits: Column, h: Column) -> Column:
    slot = h.bitwiseAND(F.lit(BITS - 1)).cast("int")
    byte = F.ascii(F.substring(bits, F.floor(slot / IN_BYTE).cast("int") + 1, 1).cast("string"))
    return F.call_function("shiftright", byte, slot % IN_BYTE).bitwiseAND(F.lit(1)) == 1


def ascii_lower(c: Column) -> Column:
    """A-Z only, unlike lower()."""
    return F.translate(c, UPPER, LOWER)


def fold(column: str = "doc_id", parts: int = 4) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
