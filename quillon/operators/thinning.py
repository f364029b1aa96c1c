"""Selections whose every choice depends on the earlier ones, at scale.

Thinning keeps a read that is more than a gap after the last kept one. The line of reads is cut into
cells of gap + 1, in each of which at most one read is kept: the first that the last kept one before does not reach.
All that a cell must know of what came before is by how much that reaches into it, one of gap + 1 amounts, and all that it
hands on is such an amount again. So a cell is a map of amounts, with a step for each of its reads; maps
follow each other by composition, WIDTH cells and then FAN nodes at a time in a tree, and a composed map has the steps of
its first cell. On the way down each cell learns what really reaches into it. No map has more steps than a cell
has reads, so no group is ever in one task, and sparse reads make small maps. An absent cell lets nothing through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.operators.ordering import null_safe
from quillon.sources.shared import stored

#: Cells of a lowest node, and children of a node above.
WIDTH, FAN = 64, 64


def _through(m: Column, amount: Column) -> Column:
    """What map m hands on of an amount: outs of the first of its ends that is not less, else rest."""
    return F.coalesce(F.get(m["outs"], F.size(F.filter(m["ends"], lambda e: e < amount))), m["rest"])


def _table(m: Column, gap: int) -> Column:
    """Map m as an array of what it hands on of 0, 1, ... gap + 1."""
    runs = F.flatten(F.transform(m["ends"], lambda e, i: F.array_repeat(F.get(m["outs"], i), (e - F.coalesce(F.get(m["ends"], i - 1), F.lit(-1))).cast("int"))))
    return F.concat(runs, F.array_repeat(m["rest"], F.lit(gap + 1) - F.coalesce(F.try_element_at(m["ends"], F.lit(-1)), F.lit(-1))))


def _followed(children: Column, first: Column, fan: int, gap: int) -> Column:
    """Composition of the maps of a node's children (structs idx, ends, outs, rest in order of idx): a map with the ends
    of the child in the slot first. Slots without a child let nothing through, nor does a last slot."""
    head = F.get(children, F.lit(0))
    ends = F.when(head["idx"] == first, head["ends"]).otherwise(F.array().cast("array<int>"))
    # an amount of each step, and one after the last
    begin = F.concat(ends, F.array(F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(-1)) + 1))
    blank = lambda at: F.transform(at, lambda _: F.lit(0))

    def passed(c: Column, at: Column) -> Column:
        few = F.size(at).cast("long") * F.size(c["ends"]) <= 4 * gap
        return F.when(few, F.transform(at, lambda x: _through(c, x))).otherwise(F.transform(F.array(_table(c, gap)), lambda t: F.transform(at, lambda x: F.get(t, x)))[0])

    step = lambda s, c: F.struct(passed(c, F.when(c["idx"] == s["next"], s["at"]).otherwise(blank(s["at"]))).alias("at"), (c["idx"] + 1).alias("next"))
    done = F.aggregate(children, F.struct(begin.alias("at"), first.alias("next")), step)
    outs = F.when(done["next"] == first + fan, done["at"]).otherwise(blank(done["at"]))
    return F.struct(ends.alias("ends"), F.slice(outs, 1, F.size(ends)).alias("outs"), F.element_at(outs, F.lit(-1)).alias("rest"))


def thinned(reads: DataFrame, keys: list[str], at: str, gap: int) -> DataFrame:
    """keys and at (distinct) of the reads that are kept: the first one, and each that is more than gap
    after the last kept. at is a whole number; nulls are left out. Equal reads are one."""
    width = gap + 1
    rows = reads.select(*keys, F.col(at).cast("bigint").alias("_at")).where("_at is not null")
    own = rows.select(*keys, F.floor(F.col("_at") / width).alias("_idx"), F.pmod("_at", F.lit(width)).cast("int").alias("_off"))
    cells = own.groupBy(*keys, "_idx").agg(F.array_sort(F.collect_set("_off")).alias("_offs"))
    # what is kept reaches as far into the next cell as it lies in its own
    nodes = stored(cells.select(*keys, "_idx", F.struct(F.col("_offs").alias("ends"), F.col("_offs").alias("outs"), F.lit(0).alias("rest")).alias("_map")), "cells")
    span = nodes.agg(F.max("_idx") - F.min("_idx")).first()[0] or 0

    inner = F.struct(F.col("_idx").alias("idx"), F.col("_map.ends").alias("ends"), F.col("_map.outs").alias("outs"), F.col("_map.rest").alias("rest"))
    levels, fan = [], WIDTH
    while span > 1:
        # no node of one slot, which would leave the span as it is
        fan = max(2, fan)
        held = nodes.groupBy(*keys, F.floor(F.col("_idx") / fan).alias("_up")).agg(F.array_sort(F.collect_list(inner)).alias("_children"))
        nodes = stored(held.select(*keys, F.col("_up").alias("_idx"), "_children", _followed(F.col("_children"), F.col("_up") * fan, fan, gap).alias("_map")), "nodes")
        levels.append((nodes, fan))
        span, fan = span // fan + 1, FAN
    # at the top a group is one node or two: nothing reaches into the first
    held = nodes.groupBy(*keys).agg(F.array_sort(F.collect_list(inner)).alias("_children"))
    carried = held.select(*keys, F.explode(_handed(F.col("_children"), F.get("_children", F.lit(0))["idx"], F.lit(0))).alias("_c")).select(*keys, "_c.*")
    for level, fan in reversed(levels):
        met = level.alias("n").join(carried.alias("c"), null_safe("n", "c", keys) & (F.col("n._idx") == F.col("c.idx")))
        inside = _handed(F.col("n._children"), F.col("n._idx") * fan, F.col("c.carry"))
        carried = met.select(*(F.col(f"n.{k}") for k in keys), F.explode(inside).alias("_c")).select(*keys, "_c.*")
    return carried.where("hit is not null").select(*keys, (F.col("idx") * width + F.col("hit")).alias(at))


def _handed(children: Column, first: Column, carry: Column) -> Column:
    """(idx, carry, hit) of each child: what reaches into it if carry reaches into the slot first, and the first of
    its ends that is not less, in a cell the place of the read that is kept."""
    held = lambda c, own: F.get(c["ends"], F.size(F.filter(c["ends"], lambda e: e < own)))
    step = lambda s, c: F.transform(F.array(F.when(c["idx"] == s["next"], s["carry"]).otherwise(F.lit(0))), lambda own: F.struct(F.array_append(s["out"], F.struct(c["idx"].alias("idx"), own.alias("carry"), held(c, own).alias("hit"))).alias("out"), _through(c, own).alias("carry"), (c["idx"] + 1).alias("next")))[0]
    begin = F.struct(F.array().cast("array<struct<idx:bigint,carry:int,hit:int>>").alias("out"), carry.cast("int").alias("carry"), first.cast("bigint").alias("next"))
    return F.aggregate(children, begin, step, lambda s: s["out"])


def first_thinned(reads: DataFrame, keys: list[str], at: str, gap: int, most: int) -> DataFrame:
    """At most `most` kept reads of each group, the earliest, with their place from 0."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(at))
    return thinned(reads, keys, at, gap).withColumn("place", place - 1).where(F.col("place") < most)


def peaks(df: DataFrame, keys: list[str], at: str, value: str, apart: int, take: int) -> DataFrame:
    """keys, at and value of at most take rows of each group: the highest positive one, then the
    highest that is apart or more from all taken, and so on; the smaller at where values tie.

    A round is one maximum by group, combined before the shuffle, over rows that carry the group's few
    picks; take rounds are exact, since a pick depends on earlier picks alone."""
    rows = stored(df.where(F.col(value) > 0).groupBy(*keys, F.col(at).alias("_at")).agg(F.max(value).alias("_v")), "heights")
    kind = f"array<struct<v:{dict(rows.dtypes)['_v']},less:{dict(rows.dtypes)['_at']}>>"
    picks = rows.select(*keys).distinct().withColumn("_picks", F.array().cast(kind))
    for _ in range(take):
        both = rows.alias("r").join(picks.alias("p"), null_safe("r", "p", keys))
        free = ~F.exists("p._picks", lambda x: F.abs(F.col("r._at") + x["less"]) < apart)
        best = F.max(F.when(free, F.struct(F.col("r._v").alias("v"), (-F.col("r._at")).alias("less"))))
        found = both.groupBy(*(F.col(f"r.{k}") for k in keys)).agg(best.alias("_best"), F.first("p._picks").alias("_picks"))
        picks = stored(found.select(*keys, F.when(F.col("_best").isNull(), F.col("_picks")).otherwise(F.array_append("_picks", F.col("_best"))).alias("_picks")), "picks")
    return picks.select(*keys, F.explode("_picks").alias("_p")).select(*keys, (-F.col("_p.less")).alias(at), F.col("_p.v").alias(value))
