"""Operators on vectors against plain versions, on small tables that hold the hard cases."""

from __future__ import annotations

import hashlib
import math
import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from compare import duck_bag, spark_bag
from conftest import SF
from pyspark.sql import functions as F

from quillon.llm import ball_tree, pivot_search, queries, whitening

#: Names that the operators use themselves, beside the columns that they read.
SCHEMA = "vec_id bigint, embedding array<float>, id string, v string, block int, cluster int, rank int, n int, wanted boolean, label int"
NAN, INF = float("nan"), float("inf")


def rows_of(n: int = 400, dimensions: int = 64) -> list[tuple[int | None, list | None]]:
    """Groups of vectors, copies, ties, a null id, repeated rows and rows that take no part."""
    r = random.Random(11)
    middles = [[r.gauss(0, 1) for _ in range(dimensions)] for _ in range(6)]
    out: list[tuple[int | None, list | None]] = [(k, [m + r.gauss(0, 0.05 + k % 3) for m in middles[k % 6]]) for k in range(n)]
    out += [(1_000 + k, list(middles[0])) for k in range(60)]
    out += [(50, list(middles[1])), (50, list(middles[1])), (None, list(middles[2])), (2_000, [0.0] * dimensions), (2_050, [-0.25] * dimensions)]
    out += [(3_000, None), (3_050, [None] + [1.0] * (dimensions - 1)), (3_100, [NAN] * dimensions), (3_150, [INF] + [0.0] * (dimensions - 1))]
    return [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in out]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 1, 2, 3, 4, True, 5) for i, v in rows], SCHEMA).repartition(5)


def whole(v: list | None) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain_clusters(rows, k=16, rounds=3, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if whole(v) and len(v) == 64]
    hashed = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v, x) for (i, x), v in zip(kept, [v for _, v in rows if whole(v) and len(v) == 64]) if i is not None)
    centroids = [x for _, _, x in hashed[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        at = [near(x)[1] for _, x in kept]
        for j in range(len(centroids)):
            own = [x for (_, x), a in zip(kept, at) if a == j]
            if own:
                centroids[j] = [sum(e) // len(own) for e in zip(*own)]
    last = [near(x) for _, x in kept]
    sums = [sum(d for d, a in last if a == j) for j in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, sums[j], sum(sums), names[j]) for (i, _), (d, j) in zip(kept, last)]


def plain_top(rows, k=5, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if whole(v)]
    out = []
    for i, q in kept:
        if i is not None and i % 50 == 0:
            others = sorted((-sum(a * b for a, b in zip(q, x)), c is None, c or 0) for c, x in kept if c != i)
            out += [(i, rank, None if null else c, -score) for rank, (score, null, c) in enumerate(others[:k], 1)]
    return out


def bag(found) -> list[tuple]:
    return sorted((tuple(r) for r in found), key=repr)


@pytest.mark.parametrize("tree", [30, 4096])
def test_clusters(spark, tree):
    rows = rows_of() + [(4_000, [1.0] * 63), (4_001, [])]
    found, centroids = ball_tree.cluster(frame(spark, rows), "vec_id", "embedding", tree=tree)
    expected = plain_clusters(rows)
    assert bag(found.collect()) == bag([r[:3] for r in expected])
    assert {hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()} >= {r[5] for r in expected}
    assert bag(ball_tree.digest(frame(spark, rows)).collect()) == bag(expected)


def test_whole_balls_are_used(spark):
    """Tight groups far apart go to their centroid as balls, and nothing else changes."""
    r = random.Random(3)
    rows = [(k, [float(100 * (k % 8 == j)) + r.random() for j in range(64)]) for k in range(800)]
    df = frame(spark, rows)
    centroids = np.floor(64 * np.array([v for _, v in rows[:8]])).astype(np.int64)
    trees = ball_tree.cut(ball_tree.plant(df, "vec_id", "embedding"), "trees")
    _, balls = ball_tree.moved(trees, centroids)
    assert balls > 300
    assert bag(ball_tree.digest(df).collect()) == bag(plain_clusters([(i, [float(np.float32(x)) for x in v]) for i, v in rows]))


def test_few_and_no_vectors(spark):
    few = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-1.0] * 64)]
    assert bag(ball_tree.digest(frame(spark, few)).collect()) == bag(plain_clusters(few))
    for none in ([], [(1, None)], [(1, [1.0])]):
        assert ball_tree.digest(frame(spark, none)).collect() == []
    with pytest.raises(Exception, match="beyond"):
        ball_tree.digest(frame(spark, [(1, [3e38] * 64)])).collect()


@pytest.mark.parametrize("block, asked, pivots", [(1024, 256, 64), (7, 3, 5), (50, 2, 1)])
def test_top(spark, block, asked, pivots):
    rows = rows_of(300)
    found = pivot_search.search(frame(spark, rows), "vec_id", "embedding", F.col("vec_id") % 50 == 0, block=block, queries=asked, pivots=pivots)
    assert bag(found.collect()) == bag(plain_top(rows))


def test_top_of_few_uneven_and_no_vectors(spark):
    few = [(0, [1.0, 2.0]), (1, [0.5]), (2, []), (50, [-1.0, 0.25, 8.0]), (None, [0.5])]
    padded = [(i, v + [0.0] * (3 - len(v))) for i, v in few]
    assert bag(pivot_search.digest(frame(spark, few)).collect()) == bag(plain_top(padded))
    for none in ([], [(1, [1.0])], [(0, None)], [(0, [])]):
        assert pivot_search.digest(frame(spark, none)).collect() == []


def test_bounds_leave_out_but_never_too_much(spark):
    """Far groups are not scored, and every bound is at least the true score."""
    r = np.random.default_rng(5)
    x = np.floor(256 * (r.normal(size=(500, 16)) * 0.1 + np.repeat(np.eye(5, 16) * 9, 100, axis=0))).astype(np.int64)
    pivots = x[::25]

    class Rows(pivot_search.Block):
        def __init__(self, own):
            self.ids, self.nulls, self.x, self.number = own, np.zeros(len(own), bool), x[own], 0
            self.squares, self.away = (self.x**2).sum(axis=1), pivot_search.distances_to(self.x, pivots)

    queries_, candidates = Rows(np.arange(0, 500, 50)), Rows(np.arange(500))
    high, true = pivot_search.bounds(queries_, candidates), queries_.x @ candidates.x.T
    own = queries_.ids[:, None] == candidates.ids[None, :]
    assert (high >= true)[~own].all() and np.isinf(high[own]).all()
    best = pivot_search.Best(queries_, pivot_search.first_bars(queries_, pivots, list(range(0, 500, 25)), 5), 5)
    assert best.meet(candidates) < 0.5 * true.size


def plain_whitening(rows, components=8):
    x = np.array([[math.floor(1024 * e) + 100_000 for e in v] for _, v in rows if whole(v)])
    n, sums = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ vectors[:, :components] / np.sqrt(values[:components]), values[:components] / values.sum()


@pytest.mark.parametrize("block, parts", [(2048, 5), (3, 40), (1, 9)])
def test_whitening(spark, block, parts):
    """Merging in any cut gives the components of the whole table."""
    rows = [r for r in rows_of(150) if r[0] is not None]
    df = frame(spark, rows).repartition(parts)
    held = df.select("vec_id", F.col("embedding").alias("v")).where(whitening.whole(F.col("v")))
    model = whitening.fit(held.select("v"), 64, block=block)
    n, deviation, whitened, explained = plain_whitening(rows)
    assert model.n == n and np.allclose(model.explained, explained, rtol=1e-10)
    found = {}
    for r in whitening.whiten(held, "vec_id", "v", model, 64).collect():
        found.setdefault(r["id"], []).append((r["deviation"], np.array(r["whitened"])))
    turned = None
    for (i, _), d, w in zip([r for r in rows if whole(r[1])], deviation.tolist(), whitened):
        assert all(f[0] == d for f in found[i]) or i == 50
        if i != 50:
            signs = np.sign(found[i][0][1] * w)
            turned = signs if turned is None else turned
            assert np.allclose(found[i][0][1], turned * w, atol=1e-9)


def test_whitening_rows(spark):
    rows = rows_of(100)
    found = whitening.digest(frame(spark, rows)).collect()
    n, deviation, whitened, explained = plain_whitening(rows)
    assert len(found) == 8 * n and {r["n"] for r in found} == {n}
    assert max(r["identity_error"] for r in found) < 1e-9 and len({r["identity_error"] for r in found}) == 1
    assert sorted(r["deviation"] for r in found if r["component"] == 1) == sorted(deviation.tolist())
    for c in range(1, 9):
        assert np.allclose(sorted(abs(r["whitened"]) for r in found if r["component"] == c), sorted(np.abs(whitened[:, c - 1])), atol=1e-9)
        assert all(abs(r["explained"] - explained[c - 1]) < 1e-12 for r in found if r["component"] == c)


def test_whitening_of_flat_few_and_no_vectors(spark):
    for none in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])]):
        assert whitening.digest(frame(spark, none)).collect() == []
    uneven = whitening.digest(frame(spark, [(1, [1.0, 2.0]), (2, [1.0]), (None, [1.0, 5.0])])).collect()
    assert {r["component"] for r in uneven} == {1} and len(uneven) == 3
    with pytest.raises(Exception):
        whitening.digest(frame(spark, [(1, [1e6] * 64), (2, [-1e6] * 64)] * 40)).collect()


@pytest.mark.parametrize("name", ["op11_centroids", "op12_top_k"])
def test_whole_tables(spark, name):
    assert spark_bag(queries.queries()[name](spark, SF)) == duck_bag(SF, queries.oracle_sql()[name])


def test_whole_table_whitening(spark):
    found = queries.op13_whitening(spark, SF).toPandas()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()]
    n, deviation, whitened, explained = plain_whitening(rows)
    got = found.sort_values(["vec_id", "component"])["whitened"].to_numpy().reshape(n, 8)
    assert np.allclose(got * np.sign((got * whitened).sum(axis=0)), whitened, atol=1e-9)
    assert (found.sort_values(["vec_id", "component"])["deviation"].to_numpy()[::8] == deviation).all()
