"""The best subset of readers of each size, from one count by mask.

A plate is a mask of the readers that resolve it. A subset resolves a plate unless the mask lies in its
complement, so the scores of all 2^k subsets are sums over sub-masks of one table of counts: half of the bits
are summed, then the other half, in two groupings over at most 2^k masks, whatever the number of plates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_READERS = 16


def sub_sums(counts: DataFrame, k: int) -> DataFrame:
    """mask and n: for each mask of k bits the sum of n over all masks that lie in it."""
    every = counts.groupBy("mask").agg(F.sum("n").alias("n"))
    half = k // 2
    for first, width in ((0, half), (half, k - half)):
        if not width:
            continue
        own = F.shiftrightunsigned(F.col("mask"), first).bitwiseAND(F.lit((1 << width) - 1))
        over = F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda m: m.bitwiseAND(own) == own)
        wider = every.select((F.col("mask") - F.shiftleft(own, first)).alias("rest"), "n", F.explode(over).alias("m"))
        every = wider.groupBy((F.col("rest") + F.shiftleft(F.col("m"), first)).alias("mask")).agg(F.sum("n").alias("n"))
    return every


def best_subsets(plates: DataFrame, mask: str, readers: list[str], most: int, slack: float) -> DataFrame:
    """size, readers, resolved, rate and chosen: for each size up to most the subset that resolves
    most plates (of equal ones the first in order of readers), and whether it is the first within slack of all."""
    k = len(readers)
    if k > MAX_READERS:
        raise ValueError(f"over {MAX_READERS} readers")
    counts = plates.groupBy(F.coalesce(F.col(mask), F.lit(0)).cast("int").alias("mask")).agg(F.count("*").alias("n"))
    full = (1 << k) - 1
    sums = sub_sums(counts, k)
    unresolved = sums.select((F.lit(full) - F.col("mask")).alias("keep"), "n")
    subsets = plates.sparkSession.range(full + 1).select(F.col("id").cast("int").alias("m")).where(F.bit_count("m").between(1, most) | (F.col("m") == full))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    scored = subsets.join(unresolved, F.col("m") == F.col("keep"), "left").crossJoin(F.broadcast(total)).select("m", "total", (F.col("total") - F.coalesce("n", F.lit(0))).alias("resolved"))
    # the first reader weighs most, so that of equal subsets the larger number is the first in order
    turned = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.lit(0), lambda a, i: a * 2 + F.call_function("shiftright", F.col("m"), i).bitwiseAND(F.lit(1)))
    best = scored.groupBy(F.bit_count("m").alias("size")).agg(F.max(F.struct("resolved", turned.alias("turned"), "m", "total")).alias("b"))
    listed = best.agg(F.array_sort(F.collect_list(F.struct("size", "b"))).alias("all"))
    rate = lambda x: F.try_divide(x["b"]["resolved"], x["b"]["total"])
    close = F.filter("all", lambda x: (x["size"] <= most) & (rate(F.element_at("all", -1)) - rate(x) <= slack))
    names = F.array(*map(F.lit, readers))
    rows = listed.select(F.inline(F.transform(F.filter("all", lambda x: x["size"] <= most), lambda x: F.struct(
        x["size"].alias("size"), F.array_join(F.filter(names, lambda _, i: F.call_function("shiftright", x["b"]["m"], i).bitwiseAND(F.lit(1)) == 1), " ").alias("readers"),
        x["b"]["resolved"].alias("resolved"), rate(x).alias("rate"), F.coalesce(x["size"] == F.get(close, F.lit(0))["size"], F.lit(False)).alias("chosen")))))
    return rows
