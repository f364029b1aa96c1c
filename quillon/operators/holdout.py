"""Templates of classes that have not seen the group that they score, radii and caps.

A template is the majority of its class's hashes by bit, and counts of bits can be taken back: what a class
is without a video is its counts less its counts in that video. So there is one grouping by
(video, class), and each video gets the few templates that it changes; rows meet those of their video in one join.
Classes are at most MAX_CLASSES, which is checked; ties go to the lesser class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.hashing import hamming
from quillon.operators.pairs import BITS, bit_counts
from quillon.sources.shared import stored

#: The largest radius, and what it is for classes of fewer rows.
CAP, THIN = 16, ((12, 16), (6, 12), (0, 8))
CAPS = (6, 8, 10, 12, 14, 16, 20, 24)
MAX_CLASSES = 1_000


def template(n: Column, ones: Column) -> Column:
    """Bits that at least half of n rows have."""
    one = lambda x, i: F.when(x * 2 >= n, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))
    return F.aggregate(F.transform(ones, one), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def with_radius(templates: Column, cap: int = CAP) -> Column:
    """templates (structs label, n, hash) with nearest, the distance of the next template, and radius:
    at most half of it, less for classes of few rows."""
    def one(x: Column) -> Column:
        apart = F.array_min(F.transform(F.filter(templates, lambda y: y["label"] != x["label"]), lambda y: hamming(y["hash"], x["hash"])))
        nearest = F.coalesce(apart, F.lit(BITS).cast("bigint"))
        thin = F.lit(THIN[-1][1] - CAP + cap)
        for least, radius in reversed(THIN[:-1]):
            thin = F.when(x["n"] >= least, F.lit(radius - CAP + cap)).otherwise(thin)
        half = F.greatest(F.lit(0), F.floor((nearest - 1) / 2))
        return F.struct(x["label"].alias("label"), x["n"].alias("n"), x["hash"].alias("hash"), nearest.alias("nearest"), F.least(F.lit(cap), half, thin).cast("bigint").alias("radius"))

    return F.transform(templates, one)


def _whole(counts: DataFrame, label: str) -> DataFrame:
    sums = counts.groupBy(label).agg(F.sum("n").alias("n"), *(F.sum(F.col("ones")[i]).alias(f"_{i}") for i in range(BITS)))
    return sums.select(label, "n", F.array(*(f"_{i}" for i in range(BITS))).alias("ones"))


def classes(df: DataFrame, label: str, hash_: str, cap: int = CAP) -> DataFrame:
    """label, n, hash, nearest and radius of each class."""
    whole = _whole(bit_counts(df.where(F.col(label).isNotNull() & F.col(hash_).isNotNull()), [label], {"ones": F.col(hash_)}), label)
    rows = whole.select(F.col(label).alias("label"), "n", template(F.col("n"), F.col("ones")).alias("hash")).limit(MAX_CLASSES + 1)
    return rows.agg(F.array_sort(F.collect_list(F.struct("label", "n", "hash"))).alias("t")).select(F.inline(with_radius(_bounded(F.col("t")), cap)))


def _bounded(templates: Column) -> Column:
    return F.when(F.size(templates) > MAX_CLASSES, F.raise_error(F.lit(f"over {MAX_CLASSES} classes"))).otherwise(templates)


def held_out(df: DataFrame, video: str, label: str, hash_: str) -> DataFrame:
    """df's video, label and hash with templates: what the classes are without the row's video (structs
    label, n, hash, nearest, radius). Rows without a label, video or hash are left out."""
    rows = df.select(F.col(video).alias("video"), F.col(label).alias("label"), F.col(hash_).alias("hash")).dropna()
    counts = stored(bit_counts(rows, ["video", "label"], {"ones": F.col("hash")}), "counts")
    whole = stored(_whole(counts, "label"), "classes")
    every = whole.select("label", "n", template(F.col("n"), F.col("ones")).alias("hash")).limit(MAX_CLASSES + 1).agg(_bounded(F.array_sort(F.collect_list(F.struct("label", "n", "hash")))).alias("every"))
    less = counts.alias("c").join(whole.alias("w"), F.col("c.label") == F.col("w.label"))
    n, ones = F.col("w.n") - F.col("c.n"), F.zip_with("w.ones", "c.ones", lambda a, b: a - b)
    changed = less.select("c.video", "c.label", n.alias("n"), template(n, ones).alias("hash")).groupBy("video").agg(F.collect_list(F.struct("label", "n", "hash")).alias("own"))
    kept = F.filter("every", lambda x: ~F.exists("own", lambda y: y["label"] == x["label"]))
    both = F.array_sort(F.concat(kept, F.filter("own", lambda y: y["n"] > 0)))
    templates = changed.crossJoin(F.broadcast(every)).select(F.col("video").alias("_v"), both.alias("t"))
    templates = stored(templates.select("_v", with_radius(F.col("t")).alias("templates")), "templates")
    return rows.join(templates, F.col("video") == F.col("_v")).drop("_v")


def _nearest(templates: Column, hash_: Column, within: bool) -> Column:
    """Struct d, label of the nearest template, of those that reach the hash if within."""
    known = F.transform(templates, lambda x: F.struct(hamming(x["hash"], hash_).alias("d"), x["label"].alias("label"), x["radius"].alias("radius")))
    return F.array_min(F.filter(known, lambda x: x["d"] <= x["radius"]) if within else known)


def judged(scored: DataFrame) -> DataFrame:
    """label, wanted, hit, wrong and abstained: a row takes the nearest template within its radius."""
    best = scored.select("label", _nearest(F.col("templates"), F.col("hash"), True).alias("best"))
    right = F.col("best.label") == F.col("label")
    return best.groupBy("label").agg(F.count("*").alias("wanted"), F.count_if(right).alias("hit"), F.count_if(~right).alias("wrong"), F.count_if(F.col("best").isNull()).alias("abstained"))


def cap_sweep(scored: DataFrame, caps: tuple[int, ...] = CAPS) -> DataFrame:
    """cap, accepted, correct and rows: the nearest template at a distance of at most cap is taken. All
    caps come from one histogram of distances."""
    best = scored.select("label", _nearest(F.col("templates"), F.col("hash"), False).alias("best"))
    hist = best.groupBy("best.d", F.coalesce(F.col("best.label") == F.col("label"), F.lit(False)).alias("right")).agg(F.count("*").alias("n"))
    sums = hist.agg(*(F.coalesce(F.sum(F.when(F.expr(c), F.col("n"))), F.lit(0)).alias(f"{name}{cap}") for cap in caps for name, c in (("a", f"d <= {cap}"), ("c", f"d <= {cap} and right"))), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(cap).alias("cap"), F.col(f"a{cap}").alias("accepted"), F.col(f"c{cap}").alias("correct"), F.col("rows").alias("rows")) for cap in caps))))
