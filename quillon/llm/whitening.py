"""Whitening by hierarchical SVD merging.

A task keeps of its vectors their number, exact integer sums, mean and the singular values and
right singular vectors of the centred rows, all of them. Two such states are merged by stacking their
values times vectors and one row more, sqrt(n1 n2 / (n1 + n2)) times the difference of the means, and
taking the SVD of that: its squares are the squares of the union about its own mean, so nothing is
lost and no covariance is ever squared up. Within a task blocks of BLOCK rows are merged one after
another, then the tasks' states in Spark, FAN at a time, until one is left: d values and d
vectors of d numbers, the only thing that the driver holds.

Cases: vectors that are null or hold a null or non-finite component are left out; a shorter vector goes on
with zeros; more than MAX_DIMENSIONS are refused. Rows that repeat count each, ids may be null. Directions
in which the vectors do not differ (a share of the variance below FLAT) have no component; so a single
vector, or equal ones, give no rows, as an empty table does. A deviation beyond a long is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import cut
from quillon.llm.vectors import array_of, blocks_of, integers, whole

#: The contract's numbers.
SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
BLOCK, FAN, MAX_DIMENSIONS, FLAT = 2048, 8, 2048, 1e-13

STATE_SCHEMA = "part bigint, n bigint, sums array<bigint>, mean array<double>, values array<double>, vectors array<double>"


@dataclass
class State:
    """n rows: sums, mean and what the centred rows' SVD keeps. vectors are rows."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> State:
        sums = x.sum(axis=0)
        mean = sums / len(x)
        _, values, vectors = np.linalg.svd(x - mean, full_matrices=False)
        return State(len(x), sums, mean, values, vectors)

    def merged(self, other: State) -> State:
        n, sums = self.n + other.n, self.sums + other.sums
        correction = np.sqrt(self.n / n * other.n) * (self.mean - other.mean)
        stacked = np.vstack([self.values[:, None] * self.vectors, other.values[:, None] * other.vectors, correction])
        _, values, vectors = np.linalg.svd(stacked, full_matrices=False)
        return State(n, sums, sums / n, values, vectors)

    def row(self) -> list:
        return [self.n, self.sums.tolist(), self.mean.tolist(), self.values.tolist(), self.vectors.reshape(-1).tolist()]

    @staticmethod
    def read(n, sums, mean, values, vectors) -> State:
        return State(int(n), np.array(sums, np.int64), np.array(mean), np.array(values), np.array(vectors).reshape(len(values), len(mean)))


def states(rows: DataFrame, dimensions: int, scale: float, block: int) -> DataFrame:
    """One state a task that has rows; rows is a column v."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for held in blocks_of(batches, block):
            own = State.of(integers(array_of(held, "v"), scale, dimensions))
            state = state.merged(own) if state else own
        if state:
            yield pa.RecordBatch.from_pylist([dict(zip(["part", "n", "sums", "mean", "values", "vectors"], [TaskContext.get().partitionId(), *state.row()]))])

    return rows.mapInArrow(run, STATE_SCHEMA)


def merge(parts: DataFrame, fan: int = FAN) -> State | None:
    """All states as one, fan at a time."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame, state = frame.sort_values("part"), None
        for row in frame[["n", "sums", "mean", "values", "vectors"]].itertuples(index=False):
            own = State.read(*row)
            state = state.merged(own) if state else own
        return pd.DataFrame([[int(frame["part"].iloc[0]) // fan, *state.row()]], columns=frame.columns)

    left = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while left > 1:
        parts, left = parts.groupBy(F.floor(F.col("part") / fan)).applyInPandas(run, STATE_SCHEMA), -(-left // fan)
    found = parts.collect()
    return State.read(*found[0][1:]) if found else None


@dataclass
class Model:
    """n, sums and mean of x without the offset; components as rows, with their variances."""

    n: int
    sums: np.ndarray
    variances: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return (self.variances / self.trace).tolist()


def fit(rows: DataFrame, dimensions: int, scale: float = SCALE, components: int = COMPONENTS, block: int = BLOCK) -> Model | None:
    """The model of all rows (a column v of whole vectors)."""
    if dimensions > MAX_DIMENSIONS:
        raise ValueError(f"more than {MAX_DIMENSIONS} dimensions")
    state = merge(cut(states(rows, dimensions, scale, block), "states"))
    if state is None:
        return None
    variances = state.values**2 / state.n
    trace = float(variances.sum())
    keep = min(components, int((variances > FLAT * trace).sum()))
    return Model(state.n, state.sums, variances[:keep], state.vectors[:keep], trace)


def whiten(rows: DataFrame, id_: str, vector: str, model: Model, dimensions: int, scale: float = SCALE) -> DataFrame:
    """(id, deviation, whitened) of each row, an entry of whitened for each component."""
    n, sums = model.n, model.sums
    turn = model.components.T / np.sqrt(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column("v"), scale, dimensions)
            if x.size and dimensions * (float(n) * (float(np.abs(x).max()) + float(np.abs(sums).max()) / n)) ** 2 >= 2**63:
                apart = np.array([[n * e - s for e, s in zip(row, sums.tolist())] for row in x.tolist()], object)
            else:
                apart = n * x - sums
            deviation = pa.array((apart**2).sum(axis=1).tolist(), pa.int64())
            out = (apart.astype(np.float64) / n) @ turn
            yield pa.RecordBatch.from_arrays([batch.column("id"), deviation, pa.array(list(out), pa.list_(pa.float64()))], names=["id", "deviation", "whitened"])

    return rows.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("v")).mapInArrow(run, "id bigint, deviation bigint, whitened array<double>")


def identity_error(rows: DataFrame, components: int) -> float:
    """The largest absolute entry of the covariance of whitened (divisor n, centred) minus the identity."""
    at = lambda i: F.col("whitened")[i]
    entries = [F.abs(F.covar_pop(at(i), at(j)) - float(i == j)) for i in range(components) for j in range(i + 1)]
    return rows.agg(F.greatest(*entries, F.lit(0.0))).first()[0]


def digest(df: DataFrame) -> DataFrame:
    """The contract's rows. Deviations do not change with the offset, nor does any covariance."""
    rows = df.select("vec_id", F.col("embedding").alias("v")).where(whole(F.col("v")))
    dimensions = rows.agg(F.greatest(F.max(F.size("v")), F.lit(1))).first()[0]
    model = fit(rows.select("v"), dimensions)
    if model is None or not len(model.variances):
        return df.sparkSession.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    found = cut(whiten(rows, "vec_id", "v", model, dimensions), "whitened")
    error = identity_error(found, len(model.variances))
    shares = F.array(*map(F.lit, model.explained))
    each = found.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
