"""Order statistics, accuracy measures and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.operators.ordering import null_safe
from quillon.sources.shared import stored


def ranked_value(df: DataFrame, keys: list[str], value: str, place: Column, name: str) -> DataFrame:
    """keys and the value at the given place (from 0; `n` is the group's size) of each sorted
    group. Equal values are counted first and places found by sums of counts, so a group is
    never gathered in one array."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    upto = counts.withColumn("_to", F.sum("_c").over(Window.partitionBy(*keys).orderBy(value))).withColumn("n", F.sum("_c").over(Window.partitionBy(*keys)))
    return upto.where((F.col("_to") > place) & (F.col("_to") - F.col("_c") <= place)).select(*keys, F.col(value).alias(name))


def ranged_value(df: DataFrame, keys: list[str], value: str, place: Column, name: str) -> DataFrame:
    """As ranked_value, for groups of any size: counts by value are cut into ranges, sums by range say which
    one holds the place, and that range alone is summed up in order. No group is in one task."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    parts = stored(counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = parts.groupBy(*keys, "_part").agg(F.sum("_c").alias("_own"))
    group = Window.partitionBy(*keys)
    sums = sums.withColumn("_to", F.sum("_own").over(group.orderBy("_part"))).withColumn("n", F.sum("_own").over(group)).withColumn("_place", place)
    held = sums.where((F.col("_to") > F.col("_place")) & (F.col("_to") - F.col("_own") <= F.col("_place")))
    rows = parts.alias("r").join(held.alias("h"), null_safe("r", "h", [*keys, "_part"]))
    rows = rows.select(*(F.col(f"r.{k}") for k in keys), F.col(f"r.{value}").alias(name), "r._c", (F.col("h._place") - F.col("h._to") + F.col("h._own")).alias("_left"))
    rows = rows.withColumn("_sum", F.sum("_c").over(Window.partitionBy(*keys).orderBy(name)))
    return rows.where((F.col("_sum") > F.col("_left")) & (F.col("_sum") - F.col("_c") <= F.col("_left"))).select(*keys, name)


def upper_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return ranked_value(df, keys, value, F.floor(F.col("n") / 2), "median")


def floor_quantile(df: DataFrame, keys: list[str], value: str, p: float) -> DataFrame:
    return ranked_value(df, keys, value, F.least(F.col("n") - 1, F.floor(F.lit(p) * F.col("n"))), "quantile")


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of a share; 0 and 1 for no observations."""
    p = k / n
    centre = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    low = F.when(n == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), centre - half))
    return low, F.when(n == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), centre + half))


def accuracy(df: DataFrame, claimed: Column, true: Column, *keys: str) -> DataFrame:
    """accepted, correct, wanted, precision and recall by keys, with a row for all (null keys)."""
    out = df.rollup(*keys).agg(F.count_if(claimed).alias("accepted"), F.count_if(claimed & true).alias("correct"), F.count_if(true).alias("wanted"))
    return out.withColumn("precision", F.round(F.col("correct") / F.nullif(F.col("accepted"), F.lit(0)), 6)).withColumn("recall", F.round(F.col("correct") / F.nullif(F.col("wanted"), F.lit(0)), 6))


def bucket(value: Column, edges: list[float]) -> Column:
    """Number of edges at or below the value."""
    out = F.lit(0)
    for i, edge in enumerate(edges, 1):
        out = F.when(value >= edge, i).otherwise(out)
    return out.cast("long")
