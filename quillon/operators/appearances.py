"""Sides, the entities on them and how often each was fielded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_order(position: str, value: str) -> Column:
    """Aggregate: the distinct values in order of their first position."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(position), F.col(value))))
    return F.array_distinct(F.transform(listed, lambda s: s[value]))


def usage(sides: DataFrame, *keys: str, entities: str = "characters") -> DataFrame:
    """Appearances of each entity by keys: an entity on both sides counts twice."""
    return sides.select(*keys, F.explode(entities).alias("entity")).groupBy(*keys, "entity").agg(F.count("*").alias("n"))


def usage_gap(sides: DataFrame, entities: str = "characters") -> DataFrame:
    """One row: total usage minus the sum of side sizes. Anything but 0 is an error."""
    exploded = usage(sides, entities=entities).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("used"))
    sizes = sides.agg(F.coalesce(F.sum(F.size(entities).cast("long")), F.lit(0)).alias("sized"))
    return exploded.join(sizes, F.lit(True)).select((F.col("used") - F.col("sized")).alias("gap"))


def oversize(limit: int = 4, entities: str = "characters") -> Column:
    return F.count_if(F.size(entities) > limit)

