"""Exact top-k by inner product with a pivot table.

The score is tied to distance by 2qx = |q|^2 + |x|^2 - d(q, x)^2, and with a pivot p the triangle
inequality says d(q, x) >= |d(q, p) - d(x, p)|. Distances of all vectors to PIVOTS pivots are
computed once and lie in the blocks with the vectors; for a block of queries and a block of candidates the
largest of the lower bounds over all pivots gives each pair's highest possible score. A
query takes its candidates in order of these bounds and stops at the first that cannot enter its
best k any more, so what is left out is exactly what could not have been returned. The pivots are
rows themselves: their scores are the query's first bar.

Queries are a stated set (ids divisible by `every`); blocks of them meet blocks of all rows in
tasks that each hold one block of either side and the best k of at most HELD query blocks. A
task returns the best k of each query over all its candidates, and Spark merges these by query, keeping k a task
(the rank limit is applied before the shuffle).

Cases: vectors that are null or hold a null or non-finite component take no part; a shorter vector
goes on with zeros; components beyond vectors.largest() are refused. A query's own are all rows
with its id. Rows that repeat are candidates each, and a repeated query row has its own result. Null ids are
never queries; as candidates they come after all others of their score. No rows: no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import cut, drop_cuts
from quillon.llm.vectors import array_of, blocks_of, integers, largest, numbered, packed, unpacked, whole

#: The contract's numbers.
EVERY, TOP, SCALE = 50, 5, 256
PIVOTS = 64
#: Candidates and queries of a block, candidates scored at once, query blocks kept in a task.
BLOCK, QUERIES, STEP, HELD = 1024, 256, 32, 64
#: Share by which rounded bounds may be wrong: pivot distances are kept in single precision.
ROUNDED, EXACT = 2.0**-22, 1e-9
#: A bar below every score.
NONE = np.iinfo(np.int64).min

BLOCK_SCHEMA = "block bigint, ids binary, nulls binary, data binary, width int, away binary"
FOUND_SCHEMA = "block bigint, place int, query_id bigint, id bigint, score bigint"


def distances_to(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From exact integer squares, a row for each vector."""
    squares = (x**2).sum(axis=1)[:, None] - 2 * (x @ pivots.T) + (pivots**2).sum(axis=1)[None, :]
    return np.sqrt(squares.astype(np.float64)).astype(np.float32)


def blocks(rows: DataFrame, pivots: np.ndarray, scale: float, size: int) -> DataFrame:
    """rows (id, v) as blocks of at most size vectors with their distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, block in enumerate(blocks_of(batches, size)):
            x, ids = integers(array_of(block, "v"), scale, pivots.shape[1]), array_of(block, "id")
            data, width = packed(x)
            row = [ids.fill_null(0).to_numpy().astype("<i8").tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes(), data]
            yield pa.RecordBatch.from_arrays([pa.array([numbered(k)], pa.int64()), *(pa.array([r], pa.binary()) for r in row), pa.array([width], pa.int32()), pa.array([distances_to(x, pivots).tobytes()], pa.binary())], names=["block", "ids", "nulls", "data", "width", "away"])

    return rows.mapInArrow(run, BLOCK_SCHEMA)


class Block:
    """A row of blocks(), read again."""

    def __init__(self, batch: pa.RecordBatch, row: int, prefix: str, dimensions: int):
        get = lambda name: batch.column(prefix + name)[row].as_py()
        self.number = get("block")
        self.ids, self.nulls = np.frombuffer(get("ids"), "<i8"), np.frombuffer(get("nulls"), bool)
        self.x = unpacked(get("data"), get("width"), dimensions)
        self.squares = (self.x**2).sum(axis=1)
        self.away = np.frombuffer(get("away"), np.float32).reshape(len(self.x), -1)


def bounds(queries: Block, rows: Block) -> np.ndarray:
    """Each pair's highest possible score; own rows have none."""
    least = np.zeros((len(queries.x), len(rows.x)), np.float32)
    apart = np.empty_like(least)
    for p in range(queries.away.shape[1]):
        np.subtract.outer(queries.away[:, p], rows.away[:, p], out=apart)
        np.maximum(least, np.abs(apart, out=apart), out=least)
    least = np.maximum(least.astype(np.float64) - ROUNDED * (queries.away.max(initial=0) + rows.away.max(initial=0)), 0)
    squares = (queries.squares[:, None] + rows.squares[None, :]).astype(np.float64)
    out = (squares - least**2) / 2 + EXACT * (squares + 1)
    out[(queries.ids[:, None] == rows.ids[None, :]) & ~rows.nulls[None, :]] = -np.inf
    return out


class Best:
    """The best k so far of each query of a block: scores, ids and whether the id is null."""

    def __init__(self, queries: Block, bars: np.ndarray, k: int):
        self.queries, self.k, self.bars = queries, k, bars.copy()
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(queries.x)

    def meet(self, rows: Block) -> int:
        """Takes in a block of candidates; returns how many were scored."""
        high, scored = bounds(self.queries, rows), 0
        for q in np.flatnonzero((high >= self.bars[:, None]).any(axis=1)):
            own = np.flatnonzero(high[q] >= self.bars[q])
            own = own[np.isfinite(high[q, own])]
            own = own[np.argsort(-high[q, own], kind="stable")]
            for at in range(0, len(own), STEP):
                some = own[at : at + STEP]
                if high[q, some[0]] < self.bars[q]:
                    break
                scored += len(some)
                scores, ids, nulls = (np.concatenate(x) for x in zip(self.found[q], (rows.x[some] @ self.queries.x[q], rows.ids[some], rows.nulls[some])))
                first = np.lexsort((ids, nulls, -scores))[: self.k]
                self.found[q] = scores[first], ids[first], nulls[first]
                if len(first) == self.k:
                    self.bars[q] = max(self.bars[q], scores[first[-1]])
        return scored

    def rows(self) -> pa.RecordBatch:
        sizes = [len(f[0]) for f in self.found]
        scores, ids, nulls = (np.concatenate(x) for x in zip(*self.found))
        places = np.repeat(np.arange(len(sizes)), sizes)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(places), self.queries.number)), pa.array(places.astype(np.int32)), pa.array(self.queries.ids[places]), pa.array(ids, mask=nulls), pa.array(scores)], names=["block", "place", "query_id", "id", "score"])


def first_bars(queries: Block, pivots: np.ndarray, pivot_ids: list[int | None], k: int) -> np.ndarray:
    """The k-th best score among the pivots, which are rows of the table."""
    scores = queries.x @ pivots.T
    scores[np.array([[q == p for p in pivot_ids] for q in queries.ids.tolist()])] = NONE
    return np.sort(scores, axis=1)[:, -k] if k <= len(pivots) else np.full(len(scores), NONE)


def search(df: DataFrame, id_: str, vector: str, wanted: Column, k: int = TOP, scale: float = SCALE, pivots: int = PIVOTS, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, id, score) for the rows of wanted, a condition on df's columns."""
    rows = df.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("v"), F.coalesce(wanted, F.lit(False)).alias("wanted")).where(whole(F.col("v")))
    dimensions, n = rows.agg(F.greatest(F.max(F.size("v")), F.lit(1)), F.count_if("wanted")).first()
    # bounded by the number of pivots; whole vectors decide between equal ids
    chosen = rows.orderBy(F.xxhash64("id"), "id", "v").limit(pivots).collect()
    at = np.zeros((len(chosen), dimensions), np.int64)
    for p, row in enumerate(chosen):
        at[p, : len(row["v"])] = np.floor(np.array(row["v"], np.float64) * scale)
    if at.size and np.abs(at).max() > largest(dimensions):
        raise ValueError(f"a component is beyond {largest(dimensions) / scale:g}")
    pivot_ids = [r["id"] for r in chosen]

    asked = rows.where("wanted and id is not null").select("id", "v").repartition(max(1, -(-n // (4 * queries))))
    asked = cut(blocks(asked, at, scale, queries), "queries")
    held = cut(blocks(rows.select("id", "v"), at, scale, block), "rows")
    left = asked.select(*(F.col(c).alias(f"q_{c}") for c in asked.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, Best] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column("q_block")[row].as_py()
                if number not in open_:
                    if len(open_) == HELD:
                        yield from (b.rows() for b in open_.values())
                        open_ = {}
                    own = Block(batch, row, "q_", dimensions)
                    open_[number] = Best(own, first_bars(own, at, pivot_ids, k), k)
                open_[number].meet(Block(batch, row, "", dimensions))
        yield from (b.rows() for b in open_.values())

    # block by block: a stated query set against all rows
    found = left.hint("shuffle_replicate_nl").crossJoin(held).mapInArrow(run, FOUND_SCHEMA)
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = cut(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
    drop_cuts(asked, held)
    return best.select("query_id", "rank", "id", "score")


def digest(df: DataFrame) -> DataFrame:
    found = search(df, "vec_id", "embedding", F.col("vec_id") % EVERY == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


#: Products of such integers are exact in doubles.
SQL = f"""
WITH kept AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding))
SELECT query_id, rank, vec_id, score FROM (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score,
        row_number() OVER (PARTITION BY q.row ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id NULLS LAST)::INT AS rank
    FROM kept q JOIN kept c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % {EVERY} = 0)
WHERE rank <= {TOP}"""
