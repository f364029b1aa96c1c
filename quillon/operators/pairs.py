"""Statistics over all pairs of rows, from counts: no pair is ever made.

Distances. In a group of n hashes of which o have bit b, o * (n - o) pairs differ in that bit, so the sum
of all distances is a sum over bits. Pairs of equal label in different videos are those of the label less
those of the label in each video, and so on by subtraction: every figure comes from the counts of bits by
(video, label), which are added up before they are shuffled.

L1 distances. In a sorted column of n numbers, the differences of all pairs add up to the sum of (2 i - n + 1) times
the i-th one, so ranks by element take the place of pairs; ranks come from ranges, in no group's own task.

Sets. Pairs whose sets both hold X are counted by how many sets hold X; how many pairs share exactly one
member, or exactly k, follows by inclusion and exclusion over the few subsets of each small set."""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.ordering import ordinals
from quillon.sources.shared import stored

BITS = 64
#: Members of a set whose subsets are counted; a larger one is refused.
MAX_SET = 12
_WIDE = "decimal(38,0)"
#: Kinds of pairs from sums over all rows (0), by video (1), by label (2) and by both (3).
KINDS = {"same label, one video": "{c}3", "other label, one video": "{c}1 - {c}3", "same label, two videos": "{c}2 - {c}3", "other label, two videos": "{c}0 - {c}1 - {c}2 + {c}3"}


def bit(hash_: Column, i: int) -> Column:
    return F.shiftrightunsigned(hash_, i).bitwiseAND(F.lit(1).cast("bigint"))


def bit_counts(df: DataFrame, keys: list[str], hashes: dict[str, Column]) -> DataFrame:
    """keys, n and for each name of hashes an array of how many rows have each bit."""
    sums = df.groupBy(*keys).agg(F.count("*").alias("n"), *(F.sum(bit(h, i)).alias(f"_{name}{i}") for name, h in hashes.items() for i in range(BITS)))
    return sums.select(*keys, "n", *(F.array(*(f"_{name}{i}" for i in range(BITS))).alias(name) for name in hashes))


def _added(each: Column) -> Column:
    return F.aggregate(each, F.lit(0).cast(_WIDE), lambda s, x: (s + x).cast(_WIDE))


def within(n: Column, ones: Column) -> tuple[Column, Column]:
    """(pairs, summed distance) of all pairs of a group with these counts."""
    wide = n.cast(_WIDE)
    return (wide * (wide - 1) / 2).cast(_WIDE), _added(F.transform(ones, lambda o: (o.cast(_WIDE) * (wide - o.cast(_WIDE))).cast(_WIDE)))


def across(n: Column, ones: Column, m: Column, others: Column) -> tuple[Column, Column]:
    """(pairs, summed distance) of all pairs with one row of either group."""
    a, b = n.cast(_WIDE), m.cast(_WIDE)
    each = F.zip_with(ones, others, lambda o, p: (o.cast(_WIDE) * (b - p.cast(_WIDE)) + (a - o.cast(_WIDE)) * p.cast(_WIDE)).cast(_WIDE))
    return (a * b).cast(_WIDE), _added(each)


def rolled(counts: DataFrame, levels: list[list[str]], arrays: list[str]) -> DataFrame:
    """The counts added up at each level (columns of counts): level is its number."""
    out = None
    for k, level in enumerate(levels):
        sums = counts.groupBy(*level).agg(*(F.sum(c).alias(c) for c in counts.columns if c not in arrays and c not in {x for y in levels for x in y}), *(F.sum(F.col(a)[i]).alias(f"_{a}{i}") for a in arrays for i in range(BITS)))
        packed = sums.select(F.lit(k).alias("level"), *(c for c in sums.columns if not c.startswith("_") and c not in level), *(F.array(*(f"_{a}{i}" for i in range(BITS))).alias(a) for a in arrays))
        out = packed if out is None else out.unionByName(packed)
    return out


def mean_distances(df: DataFrame, video: str, label: str, hash_: str) -> DataFrame:
    """kind, pairs and mean distance of the pairs of one kind: equal or other label, in one video or
    in two. Rows without a hash are left out; null videos and labels are values of their own."""
    counts = bit_counts(df.where(F.col(hash_).isNotNull()), [video, label], {"ones": F.col(hash_)})
    sums = rolled(counts, [[], [video], [label], [video, label]], ["ones"])
    pairs, total = within(F.col("n"), F.col("ones"))
    level = sums.groupBy("level").agg(F.sum(pairs).alias("p"), F.sum(total).alias("d"))
    at = lambda c, k: F.coalesce(F.sum(F.when(F.col("level") == k, F.col(c))), F.lit(0))
    one = level.agg(*(at(c, k).alias(f"{c}{k}") for c in "pd" for k in range(4)))
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), F.expr(e.format(c="p")).cast(_WIDE).alias("p"), F.expr(e.format(c="d")).cast(_WIDE).alias("d")) for k, e in KINDS.items()))
    return one.select(F.inline(rows)).select("kind", F.col("p").cast("bigint").alias("pairs"), F.try_divide(F.col("d").cast("double"), F.col("p").cast("double")).alias("mean"))


def mean_l1(df: DataFrame, video: str, label: str, vector: str) -> DataFrame:
    """As mean_distances, by the L1 distance of arrays of one length. Arrays that are null or hold a null are left out."""
    whole = F.col(vector).isNotNull() & ~F.coalesce(F.exists(vector, lambda x: x.isNull()), F.lit(False))
    rows = df.where(whole).withColumn("_row", F.monotonically_increasing_id())
    each = stored(rows.select("_row", F.col(video).alias("video"), F.col(label).alias("label"), F.posexplode(F.col(vector).cast("array<double>")).alias("element", "x")), "elements")
    level = None
    for k, keys in enumerate(([], ["video"], ["label"], ["video", "label"])):
        placed = ordinals(each, [F.col("x"), F.col("_row")], ["element", *keys], "_rank")
        sums = placed.groupBy("element", *keys).agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("_rank")).alias("r"))
        total = 2 * F.col("r") - (F.col("n") - 1) * F.col("s")
        wide = F.col("n").cast(_WIDE)
        p = F.when(F.col("element") == 0, (wide * (wide - 1) / 2).cast(_WIDE)).otherwise(F.lit(0).cast(_WIDE))
        one = sums.agg(F.lit(k).alias("level"), F.coalesce(F.sum(p), F.lit(0)).cast(_WIDE).alias("p"), F.coalesce(F.sum(total), F.lit(0.0)).alias("d"))
        level = one if level is None else level.unionByName(one)
    at = lambda c, k: F.sum(F.when(F.col("level") == k, F.col(c)))
    one = level.agg(*(at(c, k).alias(f"{c}{k}") for c in "pd" for k in range(4)))
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), F.expr(e.format(c="p")).cast(_WIDE).alias("p"), F.expr(e.format(c="d")).alias("d")) for k, e in KINDS.items()))
    return one.select(F.inline(rows)).select("kind", F.col("p").cast("bigint").alias("pairs"), F.try_divide(F.col("d"), F.col("p").cast("double")).alias("mean"))


def mirrored(df: DataFrame, video: str, label: str, left: str, plain: str, flipped: str) -> DataFrame:
    """kind, pairs and mean distance of pairs of one label in two videos: both left, both right, and one
    of each side, as they are and with the right one flipped. left is a boolean column."""
    rows = df.where(F.col(plain).isNotNull() & F.col(flipped).isNotNull() & F.col(left).isNotNull())
    counts = bit_counts(rows, [video, label, left], {"plain": F.col(plain), "turned": F.col(flipped)})
    side = lambda c, on: F.sum(F.when(F.col(left) == on, F.col(c)).otherwise(F.lit(0)))
    arrays = [(f"{a}{s}", a, on) for a, s, on in (("plain", "L", True), ("plain", "R", False), ("turned", "R", False))]
    out = []
    for keys in ([label], [video, label]):
        sums = counts.groupBy(*keys).agg(side("n", True).alias("nL"), side("n", False).alias("nR"), *(F.sum(F.when(F.col(left) == on, F.col(a)[i]).otherwise(F.lit(0))).alias(f"_{name}{i}") for name, a, on in arrays for i in range(BITS)))
        held = sums.select("nL", "nR", *(F.array(*(f"_{name}{i}" for i in range(BITS))).alias(name) for name, _, _ in arrays))
        c = F.col
        kinds = {"L-L": within(c("nL"), c("plainL")), "R-R": within(c("nR"), c("plainR")), "L-R plain": across(c("nL"), c("plainL"), c("nR"), c("plainR")), "L-R flipped": across(c("nL"), c("plainL"), c("nR"), c("turnedR"))}
        listed = F.array(*(F.struct(F.lit(k).alias("kind"), p.alias("p"), d.alias("d")) for k, (p, d) in kinds.items()))
        sign = 1 if len(keys) == 1 else -1
        out.append(held.select(F.inline(listed)).select("kind", (F.col("p") * sign).alias("p"), (F.col("d") * sign).alias("d")))
    both = out[0].unionByName(out[1]).groupBy("kind").agg(F.sum("p").alias("p"), F.sum("d").alias("d"))
    return both.select("kind", F.col("p").cast("bigint").alias("pairs"), F.try_divide(F.col("d").cast("double"), F.col("p").cast("double")).alias("mean"))


def subsets(members: Column, most: int = MAX_SET) -> Column:
    """All subsets of an array of distinct members, but for the empty one, in order of members."""
    n = F.when(F.size(members) > most, F.raise_error(F.lit(f"a set has over {most} members"))).otherwise(F.size(members))
    masks = F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), n) - 1)
    every = F.when(F.size(members) > 0, masks).otherwise(F.array().cast("array<int>"))
    return F.transform(every, lambda m: F.filter(members, lambda x, i: F.call_function("shiftright", m, i).bitwiseAND(F.lit(1)) == 1))


def _sharing(sets: DataFrame, video: str, members: str) -> DataFrame:
    """subset and p, the pairs of sets in different videos that both hold it."""
    distinct = F.array_sort(F.array_distinct(F.filter(members, lambda x: x.isNotNull())))
    each = sets.select(F.col(video).alias("_v"), F.explode(subsets(distinct)).alias("subset"))
    own = each.groupBy("subset", "_v").agg(F.count("*").cast(_WIDE).alias("n"))
    held = own.groupBy("subset").agg(F.sum("n").cast(_WIDE).alias("n"), F.sum((F.col("n") * (F.col("n") - 1) / 2).cast(_WIDE)).cast(_WIDE).alias("inside"))
    return held.select("subset", ((F.col("n") * (F.col("n") - 1) / 2).cast(_WIDE) - F.col("inside")).cast(_WIDE).alias("p"))


def sharing_one(sets: DataFrame, video: str, members: str) -> DataFrame:
    """entity and pairs: how many pairs of sets in different videos share it and nothing else."""
    each = _sharing(sets, video, members).select(F.explode("subset").alias("entity"), F.size("subset").alias("size"), "p")
    sign = F.when(F.col("size") % 2 == 1, F.col("p")).otherwise(-F.col("p"))
    return each.groupBy("entity").agg(F.sum(sign).cast("bigint").alias("pairs"))


def sharing_counts(sets: DataFrame, video: str, members: str, most: int = MAX_SET) -> DataFrame:
    """k and pairs: how many pairs of sets in different videos share exactly k members."""
    by_size = _sharing(sets, video, members).groupBy(F.size("subset").alias("size")).agg(F.sum("p").alias("p"))
    own = sets.groupBy(video).agg(F.count("*").cast(_WIDE).alias("n"))
    every = own.agg(((F.sum("n") * (F.sum("n") - 1) - F.sum(F.col("n") * (F.col("n") - 1))) / 2).cast(_WIDE).alias("p")).select(F.lit(0).alias("size"), "p")
    sums = every.unionByName(by_size.select("size", F.col("p").cast(_WIDE).alias("p")))
    shares = sums.select("size", "p", F.explode(F.sequence(F.lit(0), F.col("size"))).alias("k"))
    ways = F.element_at(F.array(*(F.lit(comb(s, k) * (-1) ** (s - k)) for s in range(most + 1) for k in range(most + 1))), F.col("size") * (most + 1) + F.col("k") + 1)
    return shares.groupBy("k").agg(F.sum(ways * F.col("p")).cast("bigint").alias("pairs")).where("pairs != 0")
