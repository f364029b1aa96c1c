"""Statistics without pairs, held-out templates, subsets, clusters, owners and moments against plain versions,
with nulls, ties, repeats, empty tables and a group that holds most rows."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import hashing, holdout, moments, ownership, pairs, reach, subsets

WORD = (1 << 64) - 1


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def apart(a: int, b: int) -> int:
    return ((a ^ b) & WORD).bit_count()


@pytest.fixture(scope="module")
def crops():
    """(video, label, left, hash, flip): most rows in one video and label, repeats, hashes of both signs."""
    r = random.Random(9)
    rows = []
    for k in range(160):
        label, video = ("hot", "v0") if k % 3 == 0 else (r.choice("abc"), f"v{r.randrange(5)}")
        h = r.getrandbits(64) if k % 7 else WORD
        rows.append((video, label, k % 2 == 0, signed(h), signed(r.getrandbits(64))))
    return rows + rows[:5]


@pytest.fixture(scope="module")
def frame(spark, crops):
    df = spark.createDataFrame([*crops, ("v1", "a", True, None, None)], "video string, label string, left boolean, hash bigint, flip bigint")
    return df.repartition(4).cache()


def test_mean_distances(frame, crops):
    sums = defaultdict(list)
    for a, b in itertools.combinations(crops, 2):
        sums[f"{'same' if a[1] == b[1] else 'other'} label, {'one video' if a[0] == b[0] else 'two videos'}"].append(apart(a[3], b[3]))
    found = {r["kind"]: (r["pairs"], r["mean"]) for r in pairs.mean_distances(frame, "video", "label", "hash").collect()}
    assert {k: v[0] for k, v in found.items()} == {k: len(v) for k, v in sums.items()}
    assert all(abs(found[k][1] - np.mean(v)) < 1e-9 for k, v in sums.items())
    none = pairs.mean_distances(frame.where("false"), "video", "label", "hash").collect()
    assert {(r["pairs"], r["mean"]) for r in none} == {(0, None)}


def test_mean_l1(spark):
    r = random.Random(21)
    rows = [("v0" if k % 3 else f"v{k % 4}", r.choice("ab") if k % 2 else None, [r.gauss(0, 1), float(r.randrange(3)), 5.0]) for k in range(90)]
    sums = defaultdict(list)
    for a, b in itertools.combinations(rows, 2):
        sums[f"{'same' if a[1] == b[1] else 'other'} label, {'one video' if a[0] == b[0] else 'two videos'}"].append(sum(abs(x - y) for x, y in zip(a[2], b[2])))
    df = spark.createDataFrame([*rows, ("v0", "a", None), ("v0", "a", [1.0, None, 2.0])], "video string, label string, v array<double>").repartition(5)
    found = {x["kind"]: (x["pairs"], x["mean"]) for x in pairs.mean_l1(df, "video", "label", "v").collect()}
    assert {k: v[0] for k, v in found.items()} == {k: len(v) for k, v in sums.items()}
    assert all(abs(found[k][1] - np.mean(v)) < 1e-9 for k, v in sums.items())
    assert {x["pairs"] for x in pairs.mean_l1(df.where("false"), "video", "label", "v").collect()} == {0}


def test_mirrored(frame, crops):
    sums = defaultdict(list)
    for a, b in itertools.combinations(crops, 2):
        if a[1] != b[1] or a[0] == b[0]:
            continue
        if a[2] == b[2]:
            sums["L-L" if a[2] else "R-R"].append(apart(a[3], b[3]))
        else:
            left, right = (a, b) if a[2] else (b, a)
            sums["L-R plain"].append(apart(left[3], right[3]))
            sums["L-R flipped"].append(apart(left[3], right[4]))
    found = {r["kind"]: (r["pairs"], r["mean"]) for r in pairs.mirrored(frame, "video", "label", "left", "hash", "flip").collect()}
    assert {k: v[0] for k, v in found.items()} == {k: len(v) for k, v in sums.items()}
    assert all(abs(found[k][1] - np.mean(v)) < 1e-9 for k, v in sums.items())


def test_sharing(spark):
    r = random.Random(1)
    sets = [(f"v{r.randrange(20)}", r.sample("abcdefg", r.randint(0, 4)) + (["a"] if k % 2 else [])) for k in range(120)] + [("v1", None), ("v2", ["a", None, "a"])]
    one, by_k = Counter(), Counter()
    for (v, x), (w, y) in itertools.combinations(sets, 2):
        if v != w:
            both = ({*(x or [])} & {*(y or [])}) - {None}
            by_k[len(both)] += 1
            if len(both) == 1:
                one[both.pop()] += 1
    df = spark.createDataFrame(sets, "video string, members array<string>").repartition(3)
    assert {r["entity"]: r["pairs"] for r in pairs.sharing_one(df, "video", "members").collect() if r["pairs"]} == one
    assert {r["k"]: r["pairs"] for r in pairs.sharing_counts(df, "video", "members").collect()} == by_k
    assert pairs.sharing_one(df.where("false"), "video", "members").collect() == []
    with pytest.raises(Exception, match="over 12 members"):
        pairs.sharing_one(spark.createDataFrame([("v", [str(k) for k in range(13)])], "video string, members array<string>"), "video", "members").collect()


def plain_classes(rows):
    by = defaultdict(list)
    for _, label, _, h, _ in rows:
        by[label].append(h & WORD)
    tpl = {f: (sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) >= len(hs)), len(hs)) for f, hs in by.items()}
    out = {}
    for f, (t, n) in tpl.items():
        nearest = min([apart(t, u) for g, (u, _) in tpl.items() if g != f], default=64)
        out[f] = (t, n, nearest, min(16, max(0, (nearest - 1) // 2), 16 if n >= 12 else 12 if n >= 6 else 8))
    return out


def test_classes_and_held_out(frame, crops):
    found = {r["label"]: (r["hash"] & WORD, r["n"], r["nearest"], r["radius"]) for r in holdout.classes(frame, "label", "hash").collect()}
    assert found == plain_classes(crops)
    wanted = defaultdict(Counter)
    caps = Counter()
    for video, label, _, h, _ in crops:
        known = sorted((apart(t, h), f, radius) for f, (t, _, _, radius) in plain_classes([c for c in crops if c[0] != video]).items())
        best = next((f for d, f, radius in known if d <= radius), None)
        wanted[label]["abstained" if best is None else "hit" if best == label else "wrong"] += 1
        for cap in holdout.CAPS:
            caps[cap, "accepted"] += known[0][0] <= cap
            caps[cap, "correct"] += known[0][0] <= cap and known[0][1] == label
    scored = holdout.held_out(frame, "video", "label", "hash")
    for r in holdout.judged(scored).collect():
        assert {k: r[k] for k in ("hit", "wrong", "abstained") if r[k]} == wanted[r["label"]] and r["wanted"] == sum(wanted[r["label"]].values())
    for r in holdout.cap_sweep(scored).collect():
        assert (r["accepted"], r["correct"], r["rows"]) == (caps[r["cap"], "accepted"], caps[r["cap"], "correct"], len(crops))
    assert holdout.judged(holdout.held_out(frame.where("false"), "video", "label", "hash")).collect() == []


@pytest.mark.parametrize("k", [1, 2, 7, 10])
def test_subsets(spark, k):
    r = random.Random(k)
    masks = [sum(1 << i for i in range(k) if r.random() < 0.25) for _ in range(90)] + [0] * 5 + [(1 << k) - 1] * 40
    df = spark.createDataFrame([(m,) for m in masks] + [(None,)], "mask int").repartition(3)
    total = len(masks) + 1
    rate = lambda keep: sum(1 for m in masks if m & keep) / total
    expected, chosen = [], None
    for size in range(1, min(4, k) + 1):
        best = max(itertools.combinations(range(k), size), key=lambda c: (rate(sum(1 << i for i in c)), [-i for i in c]))
        own = rate(sum(1 << i for i in best))
        chosen = size if chosen is None and rate((1 << k) - 1) - own <= 0.05 else chosen
        expected.append((size, " ".join(f"r{i}" for i in best), round(own * total), own))
    found = sorted(tuple(x) for x in subsets.best_subsets(df, "mask", [f"r{i}" for i in range(k)], 4, 0.05).collect())
    assert [f[:4] for f in found] == expected and [f[0] for f in found if f[4]] == [chosen] * (chosen is not None)


@pytest.mark.parametrize("batch", [1, 3, 256])
def test_leaders(spark, batch):
    r = random.Random(6)
    middles = [r.getrandbits(64) for _ in range(6)]
    rows = []
    for k in range(300):
        h = middles[k % 6]
        for _ in range(r.randrange(0, 9)):
            h ^= 1 << r.randrange(64)
        rows.append(("hot" if k % 4 else r.choice(["a", None]), k, signed(h)))
    rows += [("hot", 1_000 + k, signed(middles[0])) for k in range(200)] + [("hot", 5_000, None)]
    found = defaultdict(list)
    expected = {}
    for key, at, h in rows:
        if h is not None:
            lead = next((i for i, x in found[key] if apart(x, h) <= 8), None)
            if lead is None:
                found[key].append((at, h))
                lead = at
            expected[key, at] = lead
    expected["hot", 5_000] = None
    df = spark.createDataFrame(rows, "key string, at bigint, h bigint").repartition(5)
    got = {(x["key"], x["at"]): x["leader"] for x in hashing.leaders(df, ["key"], "at", "h", 8, batch).collect()}
    assert got == expected
    assert hashing.leaders(df.where("false"), ["key"], "at", "h", 8).collect() == []


def test_owners(spark):
    members = spark.createDataFrame([("v", 0, "a"), ("v", 0, "b"), ("v", 0, "b"), ("v", 1, "b"), ("v", 1, "c"), (None, 1, "a")], "video string, side int, id string")
    points = spark.createDataFrame([("v", "a"), ("v", "b"), ("v", "c"), ("v", "z"), ("v", None), (None, "a"), ("w", "a")], "video string, id string")
    found = {(r["video"], r["id"]): r["owner"] for r in ownership.owned(points, members, ["video"], "id", "side").collect()}
    assert found == {("v", "a"): 0, ("v", "b"): None, ("v", "c"): 1, ("v", "z"): None, ("v", None): None, (None, "a"): 1, ("w", "a"): None}
    titled = spark.createDataFrame([(v, k, i) for v in "pqrst" for k, i in ((0, "a"), (1, "b"))], "video string, side int, id string")
    seen = spark.createDataFrame([("p", "L", "a"), ("p", "R", "b"), ("q", "L", "b"), ("r", "L", "a"), ("r", "L", "b"), ("r", "R", "a"), ("s", "L", "z"), ("u", "L", "a")], "video string, screen string, id string")
    placed = {r["video"]: (r["left"], r["right"]) for r in ownership.placed(seen, titled, "video", "id", "screen", "side").collect()}
    assert placed == {"p": (0, 1), "q": (1, 0), "r": (1, 0), "s": (None, None), "t": (None, None), "u": (None, None)}


def test_moments(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [("hot" if k % 3 else f"k{k % 7}", (1e8 + r.normal(size=3)).tolist()) for k in range(500)] + [(None, [1.0, 2.0, 3.0]), ("hot", None), ("hot", [1.0, None, 2.0])]
    df = spark.createDataFrame(rows, "key string, v array<double>").repartition(6)
    for held in (1_000, 2):
        monkeypatch.setattr(moments, "HELD", held)
        found = {(x["key"], x["element"]): (x["n"], x["mean"], x["variance"]) for x in moments.element_moments(df, "key", "v").collect()}
        for key in {k for k, _ in rows}:
            own = np.array([v for k, v in rows if k == key and v and None not in v])
            for i in range(3):
                n, mean, variance = found[key, i]
                assert n == len(own) and abs(mean - own[:, i].mean()) < 1e-6 and abs(variance - own[:, i].var()) < 1e-6 * max(1, own[:, i].var())
    assert moments.element_moments(df.where("false"), "key", "v").collect() == []


@pytest.mark.parametrize("bits, radius", [(64, 7), (64, 0), (32, 3), (40, 10)])
def test_close_pairs(spark, bits, radius):
    r = random.Random(bits + radius)
    hashes = []
    for _ in range(25):
        h = r.getrandbits(bits)
        for n in range(6):
            hashes.append(h)
            for _ in range(n):
                h ^= 1 << r.randrange(bits)
    hashes += hashes[:1] * 500 + [0, (1 << bits) - 1]
    rows = [(f"g{k % 2}" if k % 5 else None, signed(h)) for k, h in enumerate(hashes)]
    df = spark.createDataFrame([*rows, ("g0", None)], "g string, h bigint").repartition(5)
    close = reach.close_pairs(df, "h", radius, bits)
    distinct = sorted({h for _, h in rows})
    expected = {(a, b, apart(a, b)) for a, b in itertools.combinations(distinct, 2) if apart(a, b) <= radius}
    assert {tuple(x) for x in close.collect()} == expected and close.count() == len(expected)
    counts = Counter(g for (g, a), (f, b) in itertools.combinations(rows, 2) if g == f and apart(a, b) <= radius)
    assert {x["g"]: x["pairs"] for x in reach.close_counts(df, ["g"], "h", close).collect() if x["pairs"]} == counts


def test_labelled_votes(spark):
    r = random.Random(12)
    middles = [r.getrandbits(32) for _ in range(4)]
    rows = []
    for k in range(150):
        h = middles[k % 4]
        for _ in range(r.randrange(4)):
            h ^= 1 << r.randrange(32)
        rows.append((k, f"v{r.randrange(6)}" if k % 9 else None, h, r.sample(["a", "b", "c", "d", "e", None], r.randint(0, 4))))
    rows += [(1_000 + k, f"w{k % 3}", middles[0], ["a", "b"]) for k in range(60)] + [(2_000, "v1", None, ["a"]), (2_001, "v1", middles[0], None)]
    votes = defaultdict(Counter)
    for (i, v, a, x), (j, w, b, y) in itertools.permutations([q for q in rows if q[2] is not None], 2):
        both = ({*(x or [])} & {*(y or [])}) - {None}
        if v != w and len(both) == 1 and apart(a, b) <= 5:
            votes[i][both.pop()] += 1 - apart(a, b) / 6
    expected = {}
    for i, c in votes.items():
        ranked = sorted((-round(n, 9), f) for f, n in c.items())
        expected[i] = (ranked[0][1], round(-ranked[0][0], 6), round((ranked[1][0] if len(ranked) > 1 else 0) - ranked[0][0], 6))
    df = spark.createDataFrame(rows, "id int, video string, h bigint, m array<string>").repartition(4)
    found = reach.labelled_votes(df, "id", "video", "h", "m", reach.close_pairs(df, "h", 5, 32), 5).collect()
    assert {x["id"]: (x["label"], round(x["votes"], 6), round(x["margin"], 6)) for x in found} == expected


def test_pairs_block_by_block(spark, monkeypatch):
    """Pairs within a block and over blocks, wide hashes, copies, nulls, sets of several sizes: against all pairs."""
    monkeypatch.setattr(reach, "BLOCK", 16)
    r = random.Random(31)
    rows = []
    for k in range(140):
        h = [0, (1 << 64) - 1, 0x0F0F << 40][k % 3]
        for _ in range(r.randrange(5)):
            h ^= 1 << r.randrange(64)
        rows.append((k, r.randrange(4) if k % 9 else None, r.randrange(3) if k % 7 else None, signed(h), [x for x in r.sample([-5, 2, 7, 10**15, None], r.randint(0, 4))]))
    rows += [(500, 1, 1, None, [2]), (501, 1, 1, 0, None)] + [(600 + k, 0, 1, 0, [7, 2]) for k in range(5)]
    df = spark.createDataFrame(rows, "id int, v int, l int, h bigint, m array<bigint>").repartition(3)
    held = [x for x in rows if x[3] is not None]
    near = [(a, b, apart(a[3], b[3])) for a, b in itertools.combinations(held, 2) if apart(a[3], b[3]) <= 6]
    distinct = sorted({x[3] for x in held})
    by = Counter(apart(a, b) for a, b in itertools.combinations(distinct, 2) if apart(a, b) <= 6)
    assert {x["dist"]: x["n"] for x in reach.close_distances(df, "h", 6).collect()} == by
    inside = [(a, b) for a, b, _ in near if a[1] == b[1]]
    assert tuple(reach.close_kinds(df, "v", "l", "h", 6).first()) == (sum(a[2] == b[2] for a, b in inside), len(inside), len(near))
    votes = defaultdict(float)
    for a, b, d in near:
        both = ({*(a[4] or [])} & {*(b[4] or [])}) - {None}
        if a[1] != b[1] and len(both) == 1:
            label = both.pop()
            votes[a[0], label] += 1 - d / 7
            votes[b[0], label] += 1 - d / 7
    found = reach.near_votes(df, "id", "v", "h", "m", 6).collect()
    best = {i: min((-round(n, 9), f) for (j, f), n in votes.items() if j == i) for i in {i for i, _ in votes}}
    assert {x["id"]: (x["label"], round(x["votes"], 6)) for x in found} == {i: (f, round(-n, 6)) for i, (n, f) in best.items()}
    none = df.where("false")
    assert reach.near_votes(none, "id", "v", "h", "m", 6).collect() == [] and tuple(reach.close_kinds(none, "v", "l", "h", 6).first()) == (0, 0, 0)
