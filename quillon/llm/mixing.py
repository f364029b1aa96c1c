"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Slot k of the schedule goes to the source in whose stretch of the cumulative target weights
the k-th golden-ratio point falls. The slots of a source are ranked, and slot r of a source
takes the r-th block of equally many words of that source's documents, laid end to end in a
shuffled order and, where the target asks for more than there is, repeated.

All cumulative sums are in two steps, over many small groups and then over their sums, so
that a source with a third of all rows is no single group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import cut, text_or_empty

#: Fixed by the contract.
WEIGHTS, LIMIT = (5, 2, 1), 3
#: Words of a block; slots ranked together; documents put in order together, about.
BLOCK, CHUNK, GROUP = 256, 65_536, 10_000
#: 2^31 over the golden ratio, made odd: multiples modulo 2^31 are evenly spread.
MODULUS, STEP = 1 << 31, 1_327_217_885


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source_key (never null; keeps the order with null last), source, size, h."""
    size = F.coalesce(F.regexp_count(text_or_empty(), F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    return docs.select("doc_id", key.alias("source_key"), size.alias("size"), F.xxhash64("doc_id", F.xxhash64("text"), F.lit(11)).alias("h"))


def targets(sized: DataFrame) -> DataFrame:
    """source_key, source_size, n_docs, target and the stretch [low, low + target) of the
    sources in order. The weights share the total; a source stops at LIMIT times its size.
    With the sources ordered by the level at which they stop, those below the common level
    are a prefix, so the level is found by sums over that order."""
    by = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    # sources, not documents: one row each, already aggregated
    place = F.row_number().over(Window.orderBy("source_key")) - 1
    weighted = by.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int")))
    stop = Window.orderBy((F.col("source_size") / F.col("weight")), "source_key")
    before, everywhere = stop.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    levels = weighted.withColumns(
        {
            "full": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * LIMIT,
            "left": F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "total": F.sum("source_size").over(everywhere),
        }
    )
    levels = levels.withColumn("level", (F.col("total") - F.col("full")) / F.col("left"))
    # the first source in order that does not stop sets the level of all after it
    levels = levels.withColumn("common", F.min(F.when(F.col("level") * F.col("weight") <= LIMIT * F.col("source_size"), F.struct(F.col("source_size") / F.col("weight"), F.col("source_key"), F.col("level").alias("level")))).over(everywhere)["level"])
    target = F.least(F.col("weight") * F.col("common"), F.col("source_size") * F.lit(float(LIMIT)))
    done = levels.withColumn("target", F.coalesce(F.greatest(target, F.lit(0.0)), F.lit(0.0)))
    low = F.coalesce(F.sum("target").over(Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return done.select("source_key", "source_size", "n_docs", "target", low.alias("low"), F.round("target").cast("long").alias("words"))


def schedule(goals: DataFrame) -> DataFrame:
    """source_key, rank, slot: the slots in which the mix takes blocks 0, 1, .. of each source."""
    spark = goals.sparkSession
    total = goals.agg(F.sum("words").alias("words"), F.sum("target").alias("target"), F.count_if(F.col("words") > 0).alias("sources")).first()
    n = -(-(total["words"] or 0) // BLOCK)
    slots = spark.range(n).select(F.col("id").alias("slot"), ((F.col("id") % MODULUS) * STEP % MODULUS / F.lit(float(MODULUS)) * F.lit(float(total["target"] or 0))).alias("point"))
    # the sources' stretches lie side by side, so each point falls in one: both are dealt to as
    # many buckets of equal width as there are sources, so that stretches meet two each, about
    stretch = goals.where("words > 0").select("source_key", "low", "words")
    width = F.lit(float(total["target"] or 1) / max(1, total["sources"]))
    # what is too small for a word leaves a gap, which goes to the stretch before
    order = Window.orderBy("low", "source_key")
    edges = stretch.select("source_key", F.when(F.lag("low").over(order).isNull(), F.lit(0.0)).otherwise(F.col("low")).alias("from"), F.coalesce(F.lead("low").over(order), F.lit(float("inf"))).alias("to"))
    last = F.floor(F.least("to", F.lit(float(total["target"] or 0))) / width)
    edges = edges.select("source_key", "from", "to", F.explode(F.sequence(F.floor(F.col("from") / width), last)).alias("bucket"))
    dealt = slots.withColumn("at", F.floor(F.col("point") / width)).join(edges, (F.col("at") == F.col("bucket")) & (F.col("from") <= F.col("point")) & (F.col("point") < F.col("to")))
    placed = cut(dealt.select("slot", "source_key", F.floor(F.col("slot") / CHUNK).alias("chunk")), "placed")
    counts = placed.groupBy("source_key", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source_key", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source_key", "chunk").orderBy("slot")
    ranked = placed.join(offsets, ["source_key", "chunk"]).select("source_key", (F.col("offset") + F.row_number().over(within) - 1).alias("rank"), "slot")
    # a source whose points fall short of its blocks by the discrepancy gets the rest at the end
    needed = F.ceil(F.col("words") / F.lit(float(BLOCK)))
    wanted = stretch.join(counts.groupBy("source_key").agg(F.sum("n").alias("has")), "source_key", "left").select("source_key", needed.alias("needed"), F.coalesce("has", F.lit(0)).alias("has"))
    rest = wanted.where("needed > has").select("source_key", F.explode(F.sequence(F.col("has"), F.col("needed") - 1)).alias("rank")).withColumn("slot", F.lit(n) + F.col("rank"))
    return ranked.join(wanted, "source_key").where("rank < needed").select("source_key", "rank", "slot").unionByName(rest)


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and first_slot (null if nothing is taken) of
    every document; needs columns doc_id, text and source. Null and empty texts have no words
    and are taken 0 times; sources with only such texts have target 0; a null source comes
    last; rows that repeat are documents of their own. No table, no rows."""
    sized = cut(sizes(docs), "sizes")
    goals = cut(targets(sized), "targets")
    count = goals.agg(F.sum("n_docs").alias("n")).first()["n"] or 0
    groups = max(1, -(-count // GROUP))
    sized = sized.withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(groups)))
    sums = sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_key", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source_key", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = sized.join(offsets, ["source_key", "bucket"]).withColumn("at", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    full = cut(laid.join(goals.select("source_key", "source_size", "target", "words"), "source_key").select("doc_id", "source_key", "size", "source_size", "target", "words", "at"), "laid")

    # where each document lies in each round of its source, and which blocks those words meet
    rounds = full.where("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(LIMIT - 1))).alias("round"))
    rounds = rounds.withColumn("first", F.col("at") + F.col("round") * F.col("source_size")).withColumn("last", F.least(F.col("first") + F.col("size"), F.col("words")))
    met = rounds.where("first < last").select("*", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("last") - 1) / BLOCK))).alias("rank"))
    words = F.least(F.col("last"), (F.col("rank") + 1) * BLOCK) - F.greatest(F.col("first"), F.col("rank") * BLOCK)
    joined = met.join(schedule(goals), ["source_key", "rank"]).select("source_key", "at", words.alias("words_taken"), "slot")
    # documents of a source that have words start at places of their own
    taken = joined.groupBy("source_key", "at").agg(F.sum("words_taken").alias("taken"), F.min("slot").alias("first_slot"))
    some = full.where("size > 0").join(taken, ["source_key", "at"], "left")
    none = full.where("size = 0").withColumn("taken", F.lit(0).cast("long")).withColumn("first_slot", F.lit(None).cast("long"))
    columns = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot"]
    return some.select(*columns).unionByName(none.select(*columns))
