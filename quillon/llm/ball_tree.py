"""Centroid clustering with ball trees.

Every task builds trees over its own vectors, TREE of them at a time: a node holds the
number, the integer sum and the radius of its ball. The trees are written once; a round reads
them with the centroids of that round. From the root down, a centroid is out of the question for
a ball where even the ball's nearest point is farther from it than the ball's farthest point is
from another centroid (the triangle inequality with centre and radius). A ball with one
centroid left goes there whole, by its number and sum; the others are opened, and in leaves the exact
integer distances decide. Sums of whole balls and of single vectors are added up per task and
then per centroid in Spark, so a round moves a row for each task and centroid.

Bounds: a tree is TREE vectors, a round's centroids and sums are k vectors. Nothing is dealt by a
vector's or a cluster's key, so equal vectors and large clusters are no hot spot.

Cases: vectors that are null, of another number of dimensions, or with a null or non-finite
component are left out; components beyond vectors.largest() are refused. Rows that repeat count
as often as they are there. Null ids start no centroid, but are assigned. With fewer vectors than k
there are as many centroids; without any, no rows. Equal distances go to the smaller number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import cut, drop_cuts
from quillon.llm.vectors import array_of, blocks_of, integers, largest, packed, unpacked, whole

#: The contract's numbers.
CLUSTERS, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64
#: Vectors of a tree and of a leaf.
TREE, LEAF = 4096, 8
#: Distances of centres are rounded; what differs by less than this share is not told apart.
SLACK = 1e-9

TREE_SCHEMA = "ids array<bigint>, data binary, width int, nodes binary, sums binary, radii binary"


def build(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, nodes, sums, radii). A node is (first, end, left, right) over the vectors in
    order; left and right are node numbers, 0 in a leaf. A ball is cut at the median along the line
    between a point far from its centre and the point farthest from that one."""
    order, nodes, sums, radii = np.arange(len(x)), [[0, len(x), 0, 0]], [], []
    for node in nodes:
        first, end = node[:2]
        own = x[order[first:end]]
        total = own.sum(axis=0)
        away = np.sqrt(((own - total / len(own)) ** 2).sum(axis=1))
        sums.append(total)
        radii.append(away.max() * (1 + SLACK) + SLACK)
        far = own[away.argmax()]
        other = own[((own - far) ** 2).sum(axis=1).argmax()]
        if len(own) <= leaf or (far == other).all():
            continue
        along = (own @ (other - far)).astype(np.float64)
        half = len(own) // 2
        order[first:end] = order[first:end][np.argpartition(along, half)]
        node[2:] = len(nodes), len(nodes) + 1
        nodes += [[first, first + half, 0, 0], [first + half, end, 0, 0]]
    return order, np.array(nodes, np.int32), np.array(sums), np.array(radii)


def plant(df: DataFrame, id_: str, vector: str, dimensions: int = DIMENSIONS, scale: float = SCALE, tree: int = TREE) -> DataFrame:
    """The trees of the vectors that take part, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, tree):
            x = integers(array_of(block, "v"), scale, dimensions)
            order, nodes, sums, radii = build(x)
            data, width = packed(x[order])
            row = [array_of(block, "id").take(pa.array(order)).to_pylist(), data, width, nodes.tobytes(), sums.astype("<i8").tobytes(), radii.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.list_(pa.int64())), pa.array([data], pa.binary()), pa.array([width], pa.int32()), *(pa.array([r], pa.binary()) for r in row[3:])], names=["ids", "data", "width", "nodes", "sums", "radii"])

    return taking_part(df, id_, vector, dimensions).mapInArrow(run, TREE_SCHEMA)


def taking_part(df: DataFrame, id_: str, vector: str, dimensions: int) -> DataFrame:
    named = df.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("v"))
    return named.where(F.col("v").isNotNull() & (F.size("v") == dimensions)).where(whole(F.col("v")))


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row for each vector."""
    return (x**2).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids**2).sum(axis=1)[None, :]


class Tree:
    """A row of plant(), read again."""

    def __init__(self, data: bytes, width: int, nodes: bytes, sums: bytes, radii: bytes, dimensions: int):
        self.x = unpacked(data, width, dimensions)
        self.nodes = np.frombuffer(nodes, np.int32).reshape(-1, 4)
        self.sums = np.frombuffer(sums, "<i8").reshape(-1, dimensions)
        self.radii = np.frombuffer(radii, np.float64)
        self.sizes = self.nodes[:, 1] - self.nodes[:, 0]

    def settle(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(balls, their centroid, vectors, their centroid): balls that go whole, and the
        vectors of the leaves that had to be opened. Together they are every vector once."""
        places, far = centroids.astype(np.float64), np.iinfo(np.int64).max
        front, left = np.zeros(1, np.int64), np.ones((1, len(places)), bool)
        balls, ball_at, opened, open_at = [], [], [], []
        while front.size:
            centres = self.sums[front] / self.sizes[front, None]
            away = np.sqrt(((centres[:, None, :] - places[None, :, :]) ** 2).sum(axis=2))
            reach = self.radii[front, None]
            nearest = np.where(left, away, np.inf).min(axis=1, keepdims=True)
            left = left & (away - reach <= nearest + reach + SLACK * (1 + away))
            one = left.sum(axis=1) == 1
            balls.append(front[one])
            ball_at.append(left[one].argmax(axis=1))
            leaf = ~one & (self.nodes[front, 2] == 0)
            if leaf.any():
                sizes = self.sizes[front[leaf]]
                own = np.repeat(self.nodes[front[leaf], 0] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
                opened.append(own)
                open_at.append(np.where(np.repeat(left[leaf], sizes, axis=0), distances(self.x[own], centroids), far).argmin(axis=1))
            down = ~one & ~leaf
            front, left = self.nodes[front[down], 2:].reshape(-1).astype(np.int64), np.repeat(left[down], 2, axis=0)
        put = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return put(balls), put(ball_at), put(opened), put(open_at)

    def labels(self, centroids: np.ndarray) -> np.ndarray:
        balls, ball_at, opened, open_at = self.settle(centroids)
        out = np.empty(len(self.x), np.int64)
        for ball, at in zip(balls, ball_at):
            out[self.nodes[ball, 0] : self.nodes[ball, 1]] = at
        out[opened] = open_at
        return out


def _trees(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.Scalar, Tree]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.column("ids")[k], Tree(*(batch.column(c)[k].as_py() for c in ("data", "width", "nodes", "sums", "radii")), dimensions)


def moved(trees: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """Each centroid's exact floor(sum / count) over its vectors (an empty one stays), and how
    many vectors went there in whole balls."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, whole_ = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for _, tree in _trees(batches, dimensions):
            balls, ball_at, opened, open_at = tree.settle(centroids)
            np.add.at(sums, ball_at, tree.sums[balls])
            np.add.at(sums, open_at, tree.x[opened])
            np.add.at(whole_, ball_at, tree.sizes[balls])
            counts += np.bincount(open_at, minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(sums.tolist(), pa.list_(pa.int64())), pa.array(counts + whole_), pa.array(whole_)], names=["cluster", "sums", "n", "whole"])

    parts = trees.mapInArrow(run, "cluster int, sums array<bigint>, n bigint, whole bigint")
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dimensions)))
    out, balls = centroids.copy(), 0
    for row in added.collect():
        balls += row["whole"]
        if row["n"]:
            out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dimensions)]
    return out, balls


def first_centroids(df: DataFrame, id_: str, vector: str, k: int = CLUSTERS, seed: str = "1", dimensions: int = DIMENSIONS, scale: float = SCALE) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes; of equal ids the smaller vector first."""
    known = taking_part(df, id_, vector, dimensions).where("id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    rows = known.orderBy("h", "v").limit(k).collect()
    x = np.array([np.floor(np.array(r["v"], np.float64) * scale) for r in rows]).reshape(-1, dimensions)
    if x.size and np.abs(x).max() > largest(dimensions):
        raise ValueError(f"a component is beyond {largest(dimensions) / scale:g}")
    return x.astype(np.int64)


def cluster(df: DataFrame, id_: str, vector: str, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: float = SCALE, tree: int = TREE) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector that takes part, as a table of the shared
    folder, and the centroids."""
    centroids = first_centroids(df, id_, vector, k, dimensions=dimensions, scale=scale)
    schema = "id bigint, cluster int, distance bigint"
    if not len(centroids):
        return df.sparkSession.createDataFrame([], schema), centroids
    trees = cut(plant(df, id_, vector, dimensions, scale, tree), "trees")
    for _ in range(rounds):
        centroids, _ = moved(trees, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tree_ in _trees(batches, dimensions):
            at = tree_.labels(centroids)
            apart = ((tree_.x - centroids[at]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([ids.values, pa.array(at.astype(np.int32)), pa.array(apart)], names=["id", "cluster", "distance"])

    assigned = cut(trees.mapInArrow(run, schema), "assigned")
    drop_cuts(trees)
    return assigned, centroids


def digest(df: DataFrame) -> DataFrame:
    """The contract's rows. The inertias are sums over the assigned rows, one for each centroid."""
    assigned, centroids = cluster(df, "vec_id", "embedding")
    sums = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    by_cluster = F.array(*(F.lit(sums.get(j, 0)).cast("bigint") for j in range(max(1, len(centroids)))))
    names = F.array(*(F.sha2(F.lit(",".join(map(str, c))), 256) for c in centroids.tolist()), *([F.lit("")] if not len(centroids) else []))
    return assigned.select(
        F.col("id").alias("vec_id"), "cluster", "distance", F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"), F.get(names, F.col("cluster")).alias("centroid_sha256"),
    )


def _assigned(round_: int) -> str:
    return f"""
    a{round_} AS (SELECT row, v, x, c.cluster, d FROM (SELECT row, v, x, unnest(list_transform(list_zip(range(len(cs)), cs), lambda p: {{'j': p[1], 'd': (list_inner_product(x, x) - 2 * list_inner_product(x, p[2]) + list_inner_product(p[2], p[2]))::BIGINT}})) AS q
        FROM kept CROSS JOIN (SELECT list(c ORDER BY cluster) AS cs FROM c{round_})), LATERAL (SELECT q.j::INT AS cluster, q.d AS d) c
        QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c.cluster) = 1)"""


def _moved(round_: int) -> str:
    return f"""
    c{round_ + 1} AS (SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{round_} o LEFT JOIN (
        SELECT cluster, list(m ORDER BY i) AS c FROM (SELECT cluster, i, floor_div AS m FROM (
            SELECT cluster, i, ((s - ((s % n) + n) % n) // n)::DOUBLE AS floor_div FROM (
                SELECT cluster, i, sum(e::HUGEINT) AS s, count(*) AS n FROM (SELECT cluster, unnest(x) AS e, unnest(range(len(x))) AS i FROM a{round_}) GROUP BY cluster, i))) GROUP BY cluster) m USING (cluster))"""


#: Sums of integers in doubles are exact here: products stay far below 2^53.
SQL = f"""
WITH kept AS (SELECT row_number() OVER () AS row, vec_id AS v, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMENSIONS}),
    c0 AS (SELECT (row_number() OVER (ORDER BY h) - 1)::INT AS cluster, x AS c FROM (SELECT x, sha256('1:' || v::VARCHAR) AS h FROM kept WHERE v IS NOT NULL ORDER BY h LIMIT {CLUSTERS})),
    {",".join(_assigned(r) + "," + _moved(r) for r in range(ROUNDS))},
    {_assigned(ROUNDS)}
SELECT v AS vec_id, a.cluster, d AS distance, sum(d) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(list_transform(c.c, lambda e: e::BIGINT), ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)"""
