"""Perceptual hashes: distance, majority, templates and leader clusters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.operators.ordering import null_safe
from quillon.sources.shared import stored


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("long")


def sign_hash(vector: Column) -> Column:
    """Signed long whose bit i says that element i (from 0) is positive."""
    return F.aggregate(F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def majority(df: DataFrame, keys: list[str], hash_: str) -> DataFrame:
    """keys, n and hash: bit i is 1 where at least half of the group's hashes have it. One sum
    for each bit, combined before the shuffle."""
    bit = lambda i: F.shiftrightunsigned(F.col(hash_), i).bitwiseAND(F.lit(1).cast("bigint"))
    sums = df.groupBy(*keys).agg(F.count("*").alias("n"), *(F.sum(bit(i)).alias(f"_b{i}") for i in range(64)))
    out = F.lit(0).cast("bigint")
    for i in range(64):
        out = out.bitwiseOR(F.when(F.col(f"_b{i}") * 2 >= F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return sums.select(*keys, "n", out.alias("hash"))


def nearest(df: DataFrame, hash_: str, templates: DataFrame, limit: int = 1_000) -> DataFrame:
    """df with label, dist and margin (runner-up's distance less the best) of its nearest
    template (label, hash). Templates are one row a class: at most limit of them, in one array
    beside each row, so that no row meets another in a join."""
    rows = templates.select("label", "hash").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError("too many templates")
    listed = F.array(*(F.struct(hamming(F.col(hash_), F.lit(r["hash"])).alias("d"), F.lit(r["label"]).alias("label")) for r in sorted(rows, key=lambda r: r["label"])))
    out = df.withColumn("_d", F.array_sort(listed))
    first, second = F.get("_d", F.lit(0)), F.get("_d", F.lit(1))
    return out.withColumn("near_label", first["label"]).withColumn("dist", first["d"]).withColumn("margin", second["d"] - first["d"]).drop("_d")


def leaders(df: DataFrame, keys: list[str], order: str, hash_: str, within: int, batch: int = 256) -> DataFrame:
    """Greedy clusters: in order, a row joins the first leader within reach or leads itself. Equal
    hashes of a group are one from the start. A round lets the first batch of open hashes of each group find their
    leaders among themselves, an array of at most batch, and gives every open hash to the first of these within its reach;
    what is open after that meets later leaders only, so the result is that of one row after the other.
    A round is a pass over the open hashes wherever they lie; no group is brought into one task.
    Rows without a hash have no leader."""
    c = F.col
    rows = df.select(*keys, c(order).alias("_at"), c(hash_).alias("_h"))
    open_ = rows.where("_h is not null").groupBy(*keys, "_h").agg(F.min("_at").alias("_at"))
    found: list[DataFrame] = []
    while True:
        open_ = stored(open_, "open")
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("_at", "_h"))
        head = open_.withColumn("_n", place).where(c("_n") <= batch).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_n", c("_at").alias("at"), c("_h").alias("h")))).alias("_rows"))
        near = lambda x, h: hamming(x["h"], h) <= within
        led = F.aggregate("_rows", F.slice("_rows", 1, 0), lambda s, x: F.when(F.exists(s, lambda y: near(y, x["h"])), s).otherwise(F.array_append(s, x)))
        lists = head.select(*keys, led.alias("_led"))
        met = open_.alias("o").join(lists.alias("l"), null_safe("o", "l", keys))
        first = F.get(F.filter("l._led", lambda x: near(x, c("o._h"))), F.lit(0))["at"]
        met = stored(met.select(*(c(f"o.{k}") for k in keys), "o._at", "o._h", first.alias("leader")), "met")
        found.append(met.where("leader is not null"))
        open_ = met.where("leader is null").drop("leader")
        if open_.isEmpty():
            break
    settled = reduce(DataFrame.unionByName, found)
    both = rows.alias("r").join(settled.alias("s"), null_safe("r", "s", [*keys, "_h"]), "left")
    return both.select(*(c(f"r.{k}") for k in keys), c("r._at").alias(order), c("s.leader"))
