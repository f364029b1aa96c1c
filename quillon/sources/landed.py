"""Landed files: raw JSON dumps, listings of frames, token sheets, and what is derived from
them before any parsing. The downloads themselves are not part of this library; it reads
what they leave behind, with Spark's own readers, from any store that Spark can reach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.sources.shared import shared_folder

#: An upload as the listing API describes it.
RAW = (
    "id string, channel string, title string, description string, publishedAt string, durationSec int, "
    "viewCount bigint, liveBroadcastContent string, tags array<string>"
)
#: Fixed value: ids in one request.
PER_REQUEST = 50


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, asked of the file system that it names."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def scan(spark: SparkSession, path: str, schema: str = RAW, multi_line: bool = False) -> DataFrame:
    """JSON with a declared schema. A record that does not parse is an error, not a null."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line).json(path)


def scan_if_there(spark: SparkSession, path: str, schema: str = RAW, multi_line: bool = False) -> DataFrame:
    """No rows if nothing lies at path; a broken file is an error all the same."""
    return scan(spark, path, schema, multi_line) if exists(spark, path) else spark.createDataFrame([], schema)


def scan_or(spark: SparkSession, path: str, default: list[tuple], schema: str = RAW, multi_line: bool = False) -> DataFrame:
    """As scan_if_there, with the rows of default where nothing lies at path or its records do not parse: for
    readers that must go on, as a page that shows what there is. Parsing is tried on every record first."""
    if exists(spark, path):
        read = spark.read.schema(schema + ", _broken string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").option("multiLine", multi_line).json(path)
        if not read.agg(F.count_if(F.col("_broken").isNotNull()).alias("n"), F.max(F.xxhash64(*read.columns)).alias("all")).first()["n"]:
            return read.drop("_broken")
    return spark.createDataFrame(default, schema)


def roster(spark: SparkSession, path: str, schema: str = "id string, name string, aliases array<string>") -> DataFrame:
    """The registry, one JSON array. An empty one is an error, and so are ids or names that are missing or appear twice."""
    rows = scan(spark, path, schema, multi_line=True)
    if rows.isEmpty():
        raise ValueError(f"no one is in the roster at {path}")
    for column in ("id", "name"):
        odd = rows.groupBy(column).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(column).isNull()).first()
        if odd:
            raise ValueError(f"roster: {column} {odd[column]} {'is missing' if odd[column] is None else 'appears twice'}")
    return rows


def missing(rows: DataFrame, channels: DataFrame, key: str = "channel") -> DataFrame:
    """The channels without a row: each is an error in a raw dump."""
    return channels.select(key).distinct().join(rows.select(key).distinct(), key, "left_anti")


def uploads_playlist(channel_id: Column) -> Column:
    """The playlist of all uploads: UU and the channel's id without its first two characters."""
    return F.concat(F.lit("UU"), F.substr(channel_id, F.lit(3)))


def requests(ids: DataFrame, channel: str, key: str, per: int = PER_REQUEST) -> DataFrame:
    """One row for each request of a channel: number, ids in order. The parts of a channel
    are numbered by range, so no channel has to fit into one task. Ranges are drawn from a
    sample, so they are cut by a checkpoint before they are used twice."""
    shared_folder(ids.sparkSession)
    ranged = ids.select(channel, key).repartitionByRange(channel, key).withColumn("part", F.spark_partition_id()).checkpoint()
    sized = ranged.groupBy(channel, "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(channel).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sized.select(channel, "part", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy(channel, "part").orderBy(key)) - 1
    placed = ranged.withColumn("inside", inside).join(starts, [channel, "part"])
    number = F.floor((F.col("before") + F.col("inside")) / per).alias("request")
    return placed.groupBy(channel, number).agg(F.array_sort(F.collect_list(key)).alias("ids"))


def spaced(duration: Column, n: int, low: float, high: float) -> Column:
    """n whole seconds, evenly from low to high shares of a duration; halves go up."""
    step = lambda i: F.floor(duration * (F.lit(low) + (F.lit(high) - F.lit(low)) * i / F.lit(max(1, n - 1))) + 0.5)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), step)


def single_plan(duration: Column, n: int = 12) -> Column:
    return spaced(duration, n, 0.08, 0.94)


def burst_plan(duration: Column, n: int = 12) -> Column:
    return spaced(duration, n, 0.06, 0.90)


def recon_plan(duration: Column) -> Column:
    """Windows (start, length, frames a second): the beginning, one from 45 %, single seconds."""
    window = lambda start, length, fps: F.struct(start.cast("long").alias("start"), F.lit(length).alias("length"), F.lit(fps).alias("fps"))
    wide = F.array(window(F.lit(0), 120, 0.5), window(F.floor(duration * 0.45), 60, 0.5))
    return F.concat(wide, F.transform(single_plan(duration), lambda s: window(s, 1, 1.0)))


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """video, sec and path of the frames <folder>/<video>/<six digits>.png; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").option("recursiveFileLookup", True).load(folder).select("path")
    part = lambda k: F.regexp_extract("path", r"([^/]+)/(\d{6})\.png$", k)
    return found.where(part(2) != "").select(part(1).alias("video"), part(2).cast("int").alias("sec"), "path")


def frames_at(listed: DataFrame, seconds: DataFrame) -> DataFrame:
    """Only the frames at the given (video, sec), so that no other is decoded."""
    return listed.join(seconds.select("video", "sec"), ["video", "sec"], "left_semi")


def tokens(sheet: Column, prefix: str = "--char-") -> Column:
    """(id, color) of all tokens of a style sheet, colors in lower case."""
    pattern = prefix + r"([a-z0-9-]+)\s*:\s*(#[0-9a-fA-F]{3,8})"
    pairs = F.arrays_zip(F.regexp_extract_all(sheet, F.lit(pattern), F.lit(1)).alias("id"), F.regexp_extract_all(sheet, F.lit(pattern), F.lit(2)).alias("color"))
    return F.transform(pairs, lambda p: F.struct(p["id"].alias("id"), F.lower(p["color"]).alias("color")))
