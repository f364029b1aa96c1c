"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is cut into five segments on a ring. Two fingerprints with at most four
differing bits have a segment from which every chain of consecutive segments keeps to its
share of the differences: none in the first, at most one in the first two, two in three,
three in four. Keys hold two consecutive segments: one key of a fingerprint as it is, and 13
with one bit of the second segment turned, so equal keys are exactly the chains of two that
keep to their share; the longer chains and then the whole distance are checked on the pairs.

Equal fingerprints are one node from the start. Members of a key are first linked to its
smallest fingerprint only; full comparison is left to keys whose members are not yet all in
one component, and there to the members outside of the key's largest component. So a group
of n near copies makes about n links, not n squared, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import cut
from quillon.llm.components import components

#: Fixed by the contract.
SEED, BITS, DISTANCE, SHINGLE = 42, 64, 4, 4
#: Segments' first bits and widths, 64 bits in all.
SEGMENTS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: Shingles hashed at once; a longer text is taken in pieces.
PIECE = 50_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half the shingles' hashes. Null and empty texts: 0. bytes.split()
    parts words at exactly the contract's characters."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, PIECE):
        last = min(n, at + PIECE)
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(at, last)), np.uint64, last - at)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    value = 0
    for bit in (2 * ones > n).tolist():
        value = value << 1 | bit
    return value


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """docs without the text, with fp, the fingerprint as a signed long."""
    own = [f for f in docs.schema if f.name not in (text, "fp")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own), "fp bigint"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = np.array([fingerprint(x if isinstance(x, str) else None, shingle) for x in frame[text]], np.uint64)
            yield frame.drop(columns=[text]).assign(fp=values.view(np.int64))

    return docs.select(*(F.col(f"`{f.name}`") for f in own), F.col(f"`{text}`")).mapInPandas(run, schema)


def segment(c: Column, k: int) -> Column:
    first, width = SEGMENTS[k % len(SEGMENTS)]
    return F.shiftrightunsigned(c, first).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fp: Column, turned: bool) -> list[Column]:
    """The ring's five keys of two segments; turned: with one bit of the second turned."""
    out = []
    for k in range(len(SEGMENTS)):
        width = SEGMENTS[(k + 1) % len(SEGMENTS)][1]
        base = F.lit(k << 26) + F.shiftleft(segment(fp, k), 13) + segment(fp, k + 1)
        out += [base.bitwiseXOR(F.lit(1 << j)) for j in range(width)] if turned else [base]
    return out


def _near(x: Column, y: Column, key: Column) -> Column:
    """The chains of three and four segments from the key's first keep to their shares, and
    the whole distance is within bounds."""
    d = x.bitwiseXOR(y)
    total = F.bit_count(d) <= DISTANCE
    first = F.shiftrightunsigned(key, 26)
    chains = F.lit(False)
    for k in range(len(SEGMENTS)):
        three = sum((F.bit_count(segment(d, k + i)) for i in range(1, 3)), F.lit(0))
        chains = chains | ((first == k) & (three <= 2) & (three + F.bit_count(segment(d, k + 3)) <= 3))
    return chains & total


def components_of(nodes: DataFrame) -> DataFrame:
    """(fp, c) of distinct fingerprints (column fp): c is the smallest fingerprint reachable
    by pairs with at most DISTANCE differing bits. The key with the smallest fingerprint
    of each bucket is a table of its own, so that the joins can split hot keys."""
    c = F.col
    held = nodes.select("fp", F.explode(F.array(*_keys(c("fp"), False))).alias("key"))
    every = F.explode(F.array(*_keys(c("fp"), False), *_keys(c("fp"), True))).alias("key")
    pivots = cut(held.groupBy("key").agg(F.min("fp").alias("pivot")).withColumnRenamed("key", "pivot_key"), "pivots")
    near = nodes.select("fp", every).join(pivots, c("key") == c("pivot_key")).where((c("fp") != c("pivot")) & _near(c("fp"), c("pivot"), c("key")))
    roots = components(near.select(c("fp").alias("a"), c("pivot").alias("b")))
    placed = cut(nodes.select("fp").join(roots, c("fp") == c("node"), "left").select("fp", F.coalesce("root", "fp").alias("c")), "placed")

    # keys as they are only: a pair's chain of two is equal, or turned by one bit on one side.
    # A bucket of one has met all that ask it already: it was its own pivot.
    held = placed.select("fp", "c", F.explode(F.array(*_keys(c("fp"), False))).alias("key"))
    sizes = held.groupBy("key", "c").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("size"))
    main = cut(main.where("size > 1").drop("size").withColumnRenamed("key", "main_key"), "main")
    # a member of another component than a bucket's main one asks all of the bucket; a member
    # of the main one need ask only the others, which its own part has asked unless it is turned
    asked = cut(placed.select("fp", "c", every).join(main, c("key") == c("main_key")).where("parts > 1 or c != main").select("key", "fp", "c", "main"), "asked")
    outside, inside = asked.where("c != main"), asked.where("c = main")
    keep = held.join(main, c("key") == c("main_key")).select(c("key").alias("k2"), c("fp").alias("fp2"), c("c").alias("c2"), (c("c") != c("main")).alias("other"))

    def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
        met = left.join(right, (c("key") == c("k2")) & (c("c") != c("c2")) & _near(c("fp"), c("fp2"), c("key")))
        return met.select(c("c").alias("a"), c("c2").alias("b"))

    # what is left links whole components, so the second search is over these alone
    merged = components(pairs(outside, keep).unionByName(pairs(inside, keep.where("other"))))
    return placed.join(merged, c("c") == c("node"), "left").select("fp", F.coalesce("root", "c").alias("c"))


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fp and component_id, the smallest id that links of fingerprints reach. Null and
    empty texts have fingerprint 0 and are linked like others. Null ids come after all others:
    a component of null ids alone has none. Rows that repeat keep their number."""
    known = cut(fingerprints(docs.select("doc_id", text), text), "fingerprints")
    nodes = cut(known.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    placed = components_of(nodes).withColumnRenamed("fp", "placed_fp")
    placed = nodes.join(placed, F.col("fp") == F.col("placed_fp")).select("fp", "first", "c")
    smallest = placed.groupBy("c").agg(F.min("first").alias("component_id")).withColumnRenamed("c", "c2")
    named = cut(placed.join(smallest, F.col("c") == F.col("c2")).select(F.col("fp").alias("named"), "component_id"), "named")
    return known.join(named, F.col("fp") == F.col("named")).select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component with its own columns: that of the smallest id. Rows that
    repeat the smallest id, and rows without an id in a component without one, stay."""
    found = near_duplicates(docs).where("doc_id is null or doc_id = component_id").where("doc_id is not null or component_id is null").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.select(F.struct("*").alias("row")).join(found, F.col("row.doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")
