"""Vectors of a table: which of them take part, and their components as integers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(vector: Column) -> Column:
    """Neither the vector nor a component is null, and every component is finite."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(wrong, F.lit(True))


def largest(dimensions: int) -> int:
    """Components up to this size have squared distances and products that fit a long."""
    return math.isqrt((1 << 62) // (4 * max(1, dimensions)))


def integers(column: pa.Array, scale: float, dimensions: int) -> np.ndarray:
    """floor(scale * component), a row for each vector; a shorter vector goes on with zeros.
    Components beyond largest() are refused, since no result with them fits a long."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if values.size and np.abs(values).max() > largest(dimensions):
        raise ValueError(f"a component is beyond {largest(dimensions) / scale:g}")
    out = np.zeros((len(column), dimensions), np.int64)
    out[np.arange(dimensions) < column.value_lengths().to_numpy(zero_copy_only=False)[:, None]] = values.astype(np.int64)
    return out


def packed(values: np.ndarray) -> tuple[bytes, int]:
    """Integers in the fewest bytes that hold them all, and that width."""
    most = int(np.abs(values).max()) if values.size else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return values.astype(f"<i{width}").tobytes(), width


def unpacked(data: bytes, width: int, dimensions: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").reshape(-1, dimensions).astype(np.int64)


def numbered(known: int) -> int:
    """The number of a task's known-th row (from 0), unlike that of any other task's rows."""
    return (TaskContext.get().partitionId() << 33) + known


def blocks_of(batches, size: int):
    """Batches of a task as tables of exactly size rows, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = size - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) == size:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def array_of(table: pa.Table, name: str) -> pa.Array:
    """A column of blocks_of() as one array."""
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)
