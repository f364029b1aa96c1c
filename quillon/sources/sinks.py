"""Writers: keyed merges, guarded publication, contract files and incremental stores."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A contract file is one JSON array and so one task's work; more rows are refused.
MAX_CONTRACT_ROWS = 100_000


def upsert(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Fields of new that are not null take the place of old ones; other rows stay."""
    values = [c for c in old.columns if c not in keys]
    fresh = new.select(*keys, *(F.col(c).alias(f"_{c}") for c in values))
    return old.join(fresh, list(keys), "full").select(*keys, *(F.coalesce(f"_{c}", c).alias(c) for c in values)).select(*old.columns)


def delete(old: DataFrame, gone: DataFrame, *keys: str) -> DataFrame:
    return old.join(gone.select(*keys), list(keys), "left_anti")


def replace_side(sides: Column, at: Column, side: Column) -> Column:
    """The side at a position (from 0) replaced, the other one as it was."""
    return F.transform(sides, lambda s, i: F.when(i == at, side).otherwise(s))


def append_member(sides: Column, at: Column, member: Column) -> Column:
    """One more member of the side at a position; none that is there is added or displaced."""
    return F.transform(sides, lambda s, i: F.when(i == at, F.array_union(s, F.array(member))).otherwise(s))


def identity(row: dict[str, Column], when: str = "at") -> Column:
    """JSON of a label's fields by name, without the day it was written: equal labels are equal."""
    return F.to_json(F.struct(*(c.alias(k) for k, c in sorted(row.items()) if k != when)))


def merge_labels(live: DataFrame, snapshot: DataFrame, *keys: str) -> DataFrame:
    """Both label sets: live rows, and those of the snapshot whose key is not live."""
    return live.unionByName(snapshot.join(live.select(*keys), list(keys), "left_anti"))


def write_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Overwrites the partitions that rows has, and no other: an interrupted run loses no more
    than the partitions it was at. Rows of one value are spread by size, not by value."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def publish(tables: dict[str, DataFrame], guards: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Writes all tables to a new version below path, or nothing: a guard with a row raises
    before the first write. Returns the tables' paths."""
    tripped = [name for name, rows in guards.items() if not rows.isEmpty()]
    if tripped:
        raise ValueError(f"not written: {', '.join(sorted(tripped))}")
    version = f"{path}/{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.parquet(f"{version}/{name}")
    return {name: f"{version}/{name}" for name in tables}


def write_array(rows: DataFrame, path: str, *order: str) -> None:
    """One JSON array in one text file, absent fields left out; at most MAX_CONTRACT_ROWS."""
    if rows.limit(MAX_CONTRACT_ROWS + 1).count() > MAX_CONTRACT_ROWS:
        raise ValueError("too many rows for a contract file; write a table")
    one = F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order)), F.to_json(F.struct(*rows.columns)).alias("json"))
    listed = F.transform(F.array_sort(F.collect_list(one)), lambda s: s["json"])
    rows.agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("value")).write.text(path)
