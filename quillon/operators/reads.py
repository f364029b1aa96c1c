"""Timed noisy reads of a side, folded into a confidence-scored union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the fold.
Q0, DECAY, MEMBER_MIN, BURST_SHARE, BURST_GAP = 0.55, 0.8, 0.6, 0.5, 3


def bursts(reads: DataFrame, keys: list[str], sec: str, gap: float = BURST_GAP) -> DataFrame:
    """reads with burst, from 0: a new one where more than gap has passed since the last read."""
    w = Window.partitionBy(*keys).orderBy(sec)
    new = F.when(F.col(sec) - F.lag(sec).over(w) > gap, 1).otherwise(0)
    return reads.withColumn("_new", new).withColumn("burst", F.sum("_new").over(w).cast("long")).drop("_new")


def runs(reads: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """keys, value, first (its place among all reads) and the longest run of it among the reads
    that are not null."""
    every = reads.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    some = every.where(F.col(value).isNotNull())
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    own = F.row_number().over(Window.partitionBy(*keys, value).orderBy(*order))
    islands = some.withColumn("_run", place - own).groupBy(*keys, value, "_run").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    return islands.groupBy(*keys, value).agg(F.max("n").alias("longest"), F.min("first").cast("long").alias("first"))


def weight(distance: Column) -> Column:
    return F.lit(Q0) * F.pow(F.lit(DECAY), distance)


def none_of(weights: Column) -> Column:
    """Product of 1 - w."""
    return F.aggregate(weights, F.lit(1.0), lambda a, w: a * (1 - w))


def fold(reads: DataFrame, keys: list[str], value: str, w: str) -> DataFrame:
    """keys, value, bursts, confidence, member. Within a burst the best read counts in full and
    the others' evidence by half; bursts count as independent."""
    listed = reads.where(F.col(value).isNotNull()).groupBy(*keys, value, "burst").agg(F.max(w).alias("best"), F.array_sort(F.collect_list(w)).alias("ws"))
    each = listed.withColumn("bw", F.col("best") + BURST_SHARE * ((1 - none_of(F.col("ws"))) - F.col("best")))
    out = each.groupBy(*keys, value).agg(F.count("*").alias("bursts"), F.array_sort(F.collect_list("bw")).alias("bws"))
    return out.withColumn("confidence", F.round(1 - none_of(F.col("bws")), 3)).withColumn("member", F.col("confidence") >= MEMBER_MIN).drop("bws")


def side_confidence(folded: DataFrame, keys: list[str]) -> DataFrame:
    """keys, members, confidence (the least member's, 0 without any) and saturation: the share
    of bursts not by values seen in one burst only."""
    return folded.groupBy(*keys).agg(
        F.count_if("member").alias("members"),
        F.coalesce(F.min(F.when(F.col("member"), F.col("confidence"))), F.lit(0.0)).alias("confidence"),
        F.round(F.coalesce(1 - F.count_if(F.col("bursts") == 1) / F.sum("bursts"), F.lit(0.0)), 3).alias("saturation"),
    )


def votes(left: DataFrame, right: DataFrame, keys: list[str], sec: str, value: str) -> DataFrame:
    """keys, seconds, votes: +1 where left's value is the larger at a second, -1 where right's
    is, and the side they decide for, null for none. Of several right reads of a second the
    largest counts."""
    r = right.groupBy(*keys, sec).agg(F.max(value).alias("_r"))
    both = left.join(r, [*keys, sec], "left")
    sign = F.when(F.col(value) > F.col("_r"), 1).when(F.col(value) < F.col("_r"), -1).otherwise(0)
    out = both.groupBy(*keys).agg(F.count("*").alias("seconds"), F.sum(sign).cast("long").alias("votes"))
    return out.withColumn("decided", F.when(F.col("votes") > 0, "left").when(F.col("votes") < 0, "right"))


def ensemble(variants: DataFrame, keys: list[str], value: str, distance: str, margin: str) -> DataFrame:
    """keys, value, dist, votes, of: the variant with the smallest distance, then the largest
    margin, then the first value; votes counts variants that agree with it."""
    best = F.min_by(value, F.struct(F.col(distance), -F.col(margin), F.col(value))).over(Window.partitionBy(*keys))
    return variants.withColumn("_best", best).groupBy(*keys).agg(F.first("_best").alias("value"), F.min(distance).alias("dist"), F.count_if(F.col(value) == F.col("_best")).alias("votes"), F.count(value).alias("of"))
