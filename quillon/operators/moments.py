"""Mean and variance of arrays by element, from partial results that merge.

A task keeps for each group the number of rows, the mean and the summed squares about the mean of every
element, and merges its batches into them; Spark adds up the tasks' results about the common mean. No array is exploded
before it has become one row a task and group, and no sum of squares is taken about zero."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators.ordering import null_safe
from quillon.sources.shared import stored

#: Groups that a task keeps before it hands them on.
HELD = 1_000


def merged(one: tuple, two: tuple) -> tuple:
    """(n, mean, squares) of both together."""
    n = one[0] + two[0]
    apart = two[1] - one[1]
    return n, one[1] + apart * (two[0] / n), one[2] + two[2] + apart**2 * (one[0] / n * two[0])


def element_moments(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key, element (from 0), n, mean and variance (by n) of the arrays of each key. Arrays
    that are null or hold a null are left out; arrays of different lengths in one batch are refused. Null keys
    are a group."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & ~F.coalesce(F.exists("v", lambda x: x.isNull()), F.lit(False)))
    schema = f"key {kind}, n bigint, mean array<double>, squares array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), key_type), pa.array([h[0] for h in held.values()], pa.int64()), *(pa.array([h[i].tolist() for h in held.values()], pa.list_(pa.float64())) for i in (1, 2))], names=["key", "n", "mean", "squares"])

        held: dict = {}
        key_type = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key_type = batch.column("key").type
            lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            if (lengths != lengths[0]).any():
                raise ValueError("arrays of different lengths")
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(lengths), -1)
            groups: dict = {}
            for row, k in enumerate(batch.column("key").to_pylist()):
                groups.setdefault(k, []).append(row)
            for k, own in groups.items():
                part = x[own]
                mean = part.mean(axis=0)
                new = len(own), mean, ((part - mean) ** 2).sum(axis=0)
                held[k] = merged(held[k], new) if k in held else new
            if len(held) > HELD:
                yield out()
                held = {}
        if held:
            yield out()

    parts = stored(rows.mapInArrow(run, schema), "moments")
    each = parts.select("key", "n", F.posexplode(F.arrays_zip("mean", "squares")).alias("element", "s")).select("key", "element", "n", "s.mean", "s.squares")
    total = each.groupBy("key", "element").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"))
    both = each.alias("e").join(total.alias("t"), null_safe("e", "t", ["key", "element"]))
    off = F.col("e.mean") - F.col("t.mean")
    sums = both.groupBy("t.key", "t.element").agg(F.first("t.n").alias("n"), F.first("t.mean").alias("mean"), F.sum(F.col("e.squares") + F.col("e.n") * off * off).alias("squares"))
    return sums.select(F.col("key").alias(key), "element", "n", "mean", (F.col("squares") / F.col("n")).alias("variance"))
