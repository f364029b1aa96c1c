"""Who owns a point: joins on membership, and elimination of the other side.

Members are one row each, so "the one set that contains it" is a join on (keys, member) and a count; no array
is searched and no set meets another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.ordering import null_safe


def owned(points: DataFrame, members: DataFrame, keys: list[str], member: str, side: str, name: str = "owner") -> DataFrame:
    """points with the one side of its keys whose set contains its member; null where none or several do."""
    held = members.groupBy(*keys, member).agg(F.min(side).alias("_side"), F.count_distinct(side).alias("_n"))
    both = points.alias("p").join(held.alias("m"), null_safe("p", "m", keys) & (F.col(f"p.{member}") == F.col(f"m.{member}")), "left")
    return both.select(*(F.col(f"p.{c}") for c in points.columns), F.when(F.col("m._n") == 1, F.col("m._side")).alias(name))


def placed(seen: DataFrame, titled: DataFrame, key: str, member: str, screen: str, side: str) -> DataFrame:
    """key, left and right: the record's side (0 or 1) of either screen side (L or R). It is the one side with a
    titled member seen there; where only one screen side has such a side, the other has the other one. Every key of seen or titled has a row."""
    hits = seen.select(key, member, screen).join(titled.select(key, member, side), [key, member]).select(key, screen, side).distinct()
    one = lambda s: F.when(F.count_if(F.col(screen) == s) == 1, F.max(F.when(F.col(screen) == s, F.col(side))))
    found = hits.groupBy(key).agg(one("L").alias("_l"), one("R").alias("_r"))
    every = seen.select(key).unionByName(titled.select(key)).distinct()
    both = every.join(found, key, "left")
    return both.select(key, F.coalesce("_l", 1 - F.col("_r")).cast("long").alias("left"), F.coalesce("_r", 1 - F.col("_l")).cast("long").alias("right"))


def settled(characters: Column, title: Column, full: int) -> Column:
    """A side with all its members, the titled ones among them."""
    return (F.size(characters) >= full) & (F.size(F.array_except(title, characters)) == 0)
