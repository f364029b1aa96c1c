"""Places in a total order, seeded shuffles and turns, without one task that holds an order.

Rows are cut into ranges of their order; a row's place is its place in its range and the number of rows in
the ranges before. Counts by range are all that meets in one place, so a key with a third of all rows is
as many ranges as it needs. Orders must be total: name a unique column last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.sources.shared import stored

#: Fixed values of the generator: the step of its counter and the size of its words.
STEP, WORD = 0x6D2B79F5, 1 << 32


def null_safe(left: str, right: str, names: list[str]) -> Column:
    """Equality of the columns names under two aliases, nulls being equal."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return out


def ordinals(df: DataFrame, order: list[Column], keys: list[str] | None = None, name: str = "ordinal") -> DataFrame:
    """df with the place (from 0) of each row among the rows of its keys, in the given order."""
    keys = keys or []
    by = [*(F.col(k) for k in keys), *order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = stored(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ordered")
    starts = rows.groupBy("_part", *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    both = rows.alias("r").join(starts.alias("s"), null_safe("r", "s", ["_part", *keys]))
    return both.select(*(F.col(f"r.{c}") for c in df.columns), (F.col("s._base") + F.col("r._at")).alias(name))


def systematic(df: DataFrame, order: list[Column], keys: list[str], k: int) -> DataFrame:
    """The first k of every floor(n / k)-th row of each group of n."""
    placed = ordinals(df, order, keys, "_place")
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    both = placed.alias("r").join(sizes.alias("s"), null_safe("r", "s", keys))
    step = F.greatest(F.lit(1), F.floor(F.col("s._size") / k))
    return both.where((F.col("r._place") % step == 0) & (F.col("r._place") < step * k)).select(*(F.col(f"r.{c}") for c in df.columns))


def middle(df: DataFrame, order: list[Column], keys: list[str]) -> DataFrame:
    """The row at floor(n / 2), from 0, of each group of n."""
    placed = ordinals(df, order, keys, "_place")
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    both = placed.alias("r").join(sizes.alias("s"), null_safe("r", "s", keys))
    return both.where(F.col("r._place") == F.floor(F.col("s._size") / 2)).select(*(F.col(f"r.{c}") for c in df.columns))


def _product(x: Column, y: Column) -> Column:
    """x * y in words, without a product beyond a long."""
    low, high = y.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(y, 16)
    return (x * low + F.shiftleft((x * high).bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(WORD - 1))


def drawn(seed: int, draw: Column) -> Column:
    """The draw-th (from 1) number in [0, 1) of the 32-bit counter generator with that seed. A
    draw is a function of its number, so draws need no order."""
    state = (F.lit(seed % WORD).cast("bigint") + (draw.cast("bigint") % WORD) * F.lit(STEP)) % WORD
    mixed = _product(state.bitwiseXOR(F.shiftrightunsigned(state, 15)), state.bitwiseOR(F.lit(1)))
    again = _product(mixed.bitwiseXOR(F.shiftrightunsigned(mixed, 7)), mixed.bitwiseOR(F.lit(61)))
    last = ((mixed + again) % WORD).bitwiseXOR(mixed)
    return last.bitwiseXOR(F.shiftrightunsigned(last, 14)) / F.lit(float(WORD))


def shuffled(df: DataFrame, order: list[Column], seed: int, name: str = "place") -> DataFrame:
    """df with the place that each row has after a shuffle by swaps from the last place down, place i
    with place floor(draw * (i + 1)), draws being taken in turn.

    No swap is made. A place that step i takes from holds what the last earlier step that swapped into it
    has left there, which is what that step's own place held: each place points to at most one larger
    one, and the rows are the ends of these chains. Pointers are doubled until none moves; chains
    are about as long as the logarithm of the number of rows."""
    rows = stored(ordinals(df, order, name="_from"), "rows")
    n = rows.count()
    taken = F.floor(drawn(seed, F.lit(n) - F.col("_from")) * (F.col("_from") + 1))
    steps = stored(rows.select(F.col("_from").alias("i"), F.when(F.col("_from") == 0, 0).otherwise(taken).cast("bigint").alias("j")), "steps")
    links = stored(steps.where("i > j").groupBy("j").agg(F.min("i").alias("up")), "links")
    while True:
        further = links.alias("a").join(links.alias("b"), F.col("a.up") == F.col("b.j"), "left")
        doubled = stored(further.select("a.j", F.coalesce("b.up", "a.up").alias("up"), F.col("b.up").isNotNull().alias("moved")), "links")
        links = doubled.drop("moved")
        if doubled.where("moved").isEmpty():
            break
    later = F.lead("i").over(Window.partitionBy("j").orderBy("i"))
    ends = steps.select("i", "j", later.alias("next")).alias("s").join(links.alias("l"), F.col("s.next") == F.col("l.j"), "left")
    came = ends.select(F.col("s.i").alias("_to"), F.coalesce("l.up", "s.next", "s.j").alias("_came"))
    return rows.join(came, F.col("_from") == F.col("_came")).select(*(F.col(c) for c in df.columns), F.col("_to").alias(name))


def interleaved(df: DataFrame, outer: str, inner: str, order: list[Column], name: str = "place") -> DataFrame:
    """df in turns: one row of each outer group after the other, and within an outer group one of each
    inner group after the other, groups that are used up being passed over."""
    turn = ordinals(df, order, [outer, inner], "_turn")
    own = ordinals(turn, [F.col("_turn"), F.col(inner), *order], [outer], "_own")
    return ordinals(own, [F.col("_own"), F.col(outer)], name=name).drop("_turn", "_own")
