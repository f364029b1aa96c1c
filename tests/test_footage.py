"""Selections that depend on earlier ones, places and shuffles, against plain versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillon.operators import ordering, thinning


def plain_thinned(values, gap):
    kept = []
    for v in sorted({v for v in values if v is not None}):
        if not kept or v - kept[-1] > gap:
            kept.append(v)
    return kept


@pytest.mark.parametrize("gap, width, fan", [(20, 64, 64), (3, 2, 3), (0, 1, 3), (7, 3, 4)])
def test_thinned(spark, monkeypatch, gap, width, fan):
    """Dense, sparse and negative values, a group with most rows, nulls, repeats and a null key."""
    monkeypatch.setattr(thinning, "WIDTH", width)
    monkeypatch.setattr(thinning, "FAN", fan)
    r = random.Random(gap)
    groups = {"hot": [r.randrange(4_000 if fan == 64 else 40 * (gap + 1)) for _ in range(3_000)], "far": [r.randrange(-10**6, 10**6) if fan == 64 else r.randrange(-90, 90) for _ in range(50)], "step": list(range(0, 40 * (gap + 1), max(1, gap))), "one": [5, 5, 5], "none": [None], None: [1, 2, 40, None], "edge": [-1, 0, width * (gap + 1) - 1, width * (gap + 1)]}
    rows = [(k, v, "x") for k, vs in groups.items() for v in vs]
    r.shuffle(rows)
    found = {}
    for row in thinning.thinned(spark.createDataFrame(rows, "key string, sec bigint, _idx string").repartition(7), ["key"], "sec", gap).collect():
        found.setdefault(row["key"], []).append(row["sec"])
    assert {k: sorted(v) for k, v in found.items()} == {k: plain_thinned(vs, gap) for k, vs in groups.items() if k != "none"}
    first = thinning.first_thinned(spark.createDataFrame(rows, "key string, sec bigint, _idx string"), ["key"], "sec", gap, 2).where("key = 'hot'").collect()
    assert sorted((x["place"], x["sec"]) for x in first) == list(enumerate(plain_thinned(groups["hot"], gap)[:2]))


def test_thinned_empty(spark):
    assert thinning.thinned(spark.createDataFrame([], "key string, sec bigint"), ["key"], "sec", 3).collect() == []
    assert thinning.peaks(spark.createDataFrame([], "key string, sec bigint, v double"), ["key"], "sec", "v", 3, 2).collect() == []


def test_thinned_small_maps(spark, monkeypatch):
    """A wide gap: what is stored has no more steps than a cell has reads, and no Python makes it."""
    rows = [(k, k * 1_000 + v) for k in range(40) for v in (0, 5, 1_999, 2_001, 4_100, 150_000)]
    plans, maps, stored = [], [], thinning.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().toString())
        out = stored(df, name)
        maps.extend(x["_map"]["ends"] for x in out.select("_map").collect())
        return out

    monkeypatch.setattr(thinning, "stored", seen)
    found = {}
    for row in thinning.thinned(spark.createDataFrame(rows, "key int, sec bigint"), ["key"], "sec", 2_000).collect():
        found.setdefault(row["key"], []).append(row["sec"])
    assert {k: sorted(v) for k, v in found.items()} == {k: plain_thinned([v for q, v in rows if q == k], 2_000) for k in range(40)}
    assert len(plans) > 1 and not any("Python" in p or "Pandas" in p for p in plans)
    assert max(map(len, maps)) <= 4


def test_peaks(spark):
    r = random.Random(2)
    groups = {"hot": [(r.randrange(2_000), r.randrange(-5, 40)) for _ in range(2_000)], "ramp": [(k, k) for k in range(30)], "flat": [(k, 1) for k in range(0, 60, 4)], "low": [(1, 0), (2, -1)], None: [(1, 3), (9, 2)]}

    def plain(rows):
        taken = []
        for at, v in sorted(rows, key=lambda x: (-x[1], x[0])):
            if v > 0 and all(abs(at - t) >= 8 for t, _ in taken) and len(taken) < 6:
                taken.append((at, v))
        return sorted(taken)

    df = spark.createDataFrame([(k, at, v) for k, rows in groups.items() for at, v in rows], "key string, sec bigint, v int").repartition(5)
    found = {}
    for row in thinning.peaks(df, ["key"], "sec", "v", 8, 6).collect():
        found.setdefault(row["key"], []).append((row["sec"], row["v"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: plain(rows) for k, rows in groups.items() if k != "low"}


def plain_draws(seed):
    """The 32-bit counter generator, one draw after the other."""
    word = 2**32
    state = seed % word
    while True:
        state = (state + 0x6D2B79F5) % word
        t = (state ^ state >> 15) * (state | 1) % word
        t ^= (t + (t ^ t >> 7) * (t | 61)) % word
        yield (t ^ t >> 14) / word


@pytest.mark.parametrize("seed", [0, 20260816, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 2, 777])
def test_shuffled(spark, seed, n):
    expected, draws = list(range(n)), plain_draws(seed)
    for i in range(n - 1, 0, -1):
        j = int(next(draws) * (i + 1))
        expected[i], expected[j] = expected[j], expected[i]
    df = spark.createDataFrame([(k, "x") for k in range(n)], "id bigint, place string").repartition(3)
    found = ordering.shuffled(df, [F.col("id")], seed, "to").collect()
    assert [r["id"] for r in sorted(found, key=lambda r: r["to"])] == expected


def test_places(spark):
    r = random.Random(4)
    rows = [(r.choice(["hot", "hot", "a", None]), r.choice(["p", "q", None]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "outer string, inner string, id bigint").repartition(6)
    lead = lambda x: (x is not None, x or "")
    by = {}
    for outer, inner, k in sorted(rows, key=lambda x: x[2]):
        by.setdefault(outer, []).append(k)
    found = {row["id"]: row["ordinal"] for row in ordering.ordinals(df, [F.col("id")], ["outer"]).collect()}
    assert found == {k: n for ks in by.values() for n, k in enumerate(ks)}
    queues: dict = {}
    for outer, inner, k in sorted(rows, key=lambda x: x[2]):
        queues.setdefault(outer, {}).setdefault(inner, []).append(k)
    turns = {o: [k for n in range(500) for i in sorted(q, key=lead) for k in q[i][n : n + 1]] for o, q in queues.items()}
    expected = [k for n in range(500) for o in sorted(turns, key=lead) for k in turns[o][n : n + 1]]
    found = sorted(ordering.interleaved(df, "outer", "inner", [F.col("id")]).collect(), key=lambda row: row["place"])
    assert [row["id"] for row in found] == expected and [row["place"] for row in found] == list(range(500))
    picked = ordering.systematic(df.where("outer = 'hot'"), [F.col("id")], ["outer"], 10).collect()
    step = max(1, len(by["hot"]) // 10)
    assert sorted(row["id"] for row in picked) == by["hot"][::step][:10]
