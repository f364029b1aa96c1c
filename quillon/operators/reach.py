"""Pairs of hashes within a few bits of each other, block by block.

Which hashes are close is a question to all pairs: segments that are narrow for their radius meet most pairs in a
join, at the price of a row each. So rows are packed into blocks, Spark deals every block to every block, and a task
compares two of them at once: a few machine instructions a pair, and only close pairs are made. The work is
quadratic, memory is that of two blocks. Equal hashes are one, with a count, where only hashes matter."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators.ordering import null_safe
from quillon.operators.pairs import subsets
from quillon.sources.shared import stored

#: Rows of a block, and how many of them meet a whole block at a time.
BLOCK, STEP = 8192, 64


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """Rows in blocks of at most BLOCK: a number and the rows as an Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some, sink = batch.slice(at, BLOCK), pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, some.schema) as out:
                    out.write_batch(some)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["data"])

    return stored(rows.mapInArrow(run, "data binary").withColumn("number", F.monotonically_increasing_id()), name)


class _Block:
    """Rows of a block; h are the hashes, wide if they need 64 bits."""

    def __init__(self, data: bytes):
        self.rows = pa.ipc.open_stream(data).read_all()
        self.read: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.h = self.ints("h")
        self.bits = self.h.view(np.uint64)
        self.wide = bool((self.bits >> np.uint64(32)).any())

    def array(self, name: str) -> pa.Array:
        return self.rows.column(name).chunk(0)

    def column(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers, 0 for null, and which are null."""
        if name not in self.read:
            values = self.array(name)
            self.read[name] = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), values.is_null().to_numpy(zero_copy_only=False)
        return self.read[name]

    def ints(self, name: str) -> np.ndarray:
        return self.column(name)[0]

    def same(self, name: str, other: _Block, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Whether a column is equal in these rows of both blocks, nulls being equal."""
        (x, no), (y, none) = self.column(name), other.column(name)
        return (x[mine] == y[theirs]) & (no[mine] == none[theirs])


def _near(a: _Block, b: _Block, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a, rows of b and distance of the pairs that are close, some at a time."""
    kind = np.uint64 if a.wide or b.wide else np.uint32
    mine, theirs = a.bits.astype(kind), b.bits.astype(kind)
    for at in range(0, len(mine), STEP):
        apart = np.bitwise_count(mine[at : at + STEP, None] ^ theirs[None, :])
        found = np.flatnonzero(apart <= radius)
        yield at + found // len(theirs), found % len(theirs), apart.ravel()[found].astype(np.int64)


def _met(blocks: DataFrame, use: Callable[[_Block, Iterator[_Block]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What use makes of a block and of the blocks that it meets in a task; every block meets every block, itself too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((n, a, b) for batch in batches for n, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)))
        held = next(pairs, None)
        while held is not None:
            number, own = held[0], _Block(held[1].as_py())

            def others() -> Iterator[_Block]:
                nonlocal held
                while held is not None and held[0] == number:
                    yield _Block(held[2].as_py())
                    held = next(pairs, None)

            yield from use(own, others())

    left = blocks.select("number", F.col("data").alias("own")).repartition(max(1, blocks.count()), "number")
    return left.hint("shuffle_replicate_nl").crossJoin(blocks.select("data")).select("number", "own", "data").mapInArrow(run, schema)


def close_pairs(hashes: DataFrame, hash_: str, radius: int, bits: int = 64) -> DataFrame:
    """(one, two, dist) of distinct hashes, one < two, that differ in at most radius bits. Nulls are left out."""
    own = hashes.select(F.col(hash_).cast("bigint").alias("h")).where("h is not null").distinct()

    def use(a: _Block, others: Iterator[_Block]) -> Iterator[pa.RecordBatch]:
        for b in others:
            for mine, theirs, dist in _near(a, b, radius):
                one, two = a.h[mine], b.h[theirs]
                up = one < two
                yield pa.RecordBatch.from_arrays([pa.array(x[up]) for x in (one, two, dist)], names=["one", "two", "dist"])

    return _met(_blocks(own, "hashes"), use, "one bigint, two bigint, dist bigint")


def close_distances(hashes: DataFrame, hash_: str, radius: int) -> DataFrame:
    """dist and n: how many pairs of distinct hashes are at each distance of at most radius."""
    own = hashes.select(F.col(hash_).cast("bigint").alias("h")).where("h is not null").distinct()

    def use(a: _Block, others: Iterator[_Block]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(radius + 1, np.int64)
        for b in others:
            for mine, theirs, dist in _near(a, b, radius):
                n += np.bincount(dist[a.h[mine] < b.h[theirs]], minlength=radius + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], names=["dist", "n"])

    return _met(_blocks(own, "hashes"), use, "dist bigint, n bigint").groupBy("dist").agg(F.sum("n").alias("n"))


def close_kinds(df: DataFrame, video: str, label: str, hash_: str, radius: int) -> DataFrame:
    """One row: pairs of rows within radius of each other, of one video and label (stable), of one video
    (inside) and all (every). Equal rows are one with a count; video and label are whole numbers, nulls being equal."""
    rows = df.select(F.col(video).cast("bigint").alias("v"), F.col(label).cast("bigint").alias("l"), F.col(hash_).cast("bigint").alias("h")).where("h is not null")
    each = rows.groupBy("v", "l", "h").agg(F.count("*").alias("n"))

    def use(a: _Block, others: Iterator[_Block]) -> Iterator[pa.RecordBatch]:
        sums = [0, 0, 0]
        for b in others:
            na, nb = a.ints("n"), b.ints("n")
            for mine, theirs, _ in _near(a, b, radius):
                n, one = na[mine] * nb[theirs], a.same("v", b, mine, theirs)
                for k, held in enumerate((one & a.same("l", b, mine, theirs), one, np.ones(len(n), bool))):
                    sums[k] += int(n[held].sum())
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()) for s in sums], names=["stable", "inside", "every"])

    # each pair has been met from either side, each row by itself
    blocks = _blocks(each, "kinds")
    own = rows.agg(F.count("*").alias("own"))
    sums = _met(blocks, use, "stable bigint, inside bigint, every bigint").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("stable", "inside", "every")))
    return sums.crossJoin(own).select(*(F.expr(f"({c} - own) div 2").alias(c) for c in ("stable", "inside", "every")))


def near_votes(reps: DataFrame, id_: str, video: str, hash_: str, members: str, radius: int) -> DataFrame:
    """As labelled_votes, with the close pairs found and used block by block: none is stored. id, video and
    members are whole numbers; ids are unique."""
    listed = F.array_sort(F.array_distinct(F.filter(F.col(members).cast("array<bigint>"), lambda x: x.isNotNull())))
    rows = reps.select(F.col(id_).alias("id"), F.col(video).cast("bigint").alias("v"), F.col(hash_).cast("bigint").alias("h"), listed.alias("m")).where("h is not null and size(m) > 0")

    def sets(block: _Block, pad: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct members of a block, and each row's as places among them."""
        lists = block.array("m")
        sizes = lists.value_lengths().to_numpy()
        known, places = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        out = np.full((len(sizes), sizes.max()), pad)
        out[np.arange(out.shape[1]) < sizes[:, None]] = places
        return known, out

    def use(a: _Block, others: Iterator[_Block]) -> Iterator[pa.RecordBatch]:
        known, own = sets(a, 0)
        held = np.arange(own.shape[1]) < a.array("m").value_lengths().to_numpy()[:, None]
        votes = np.zeros(own.shape)
        for b in others:
            theirs_known, other = sets(b, -2)
            at = np.minimum(np.searchsorted(theirs_known, known), len(theirs_known) - 1)
            mapped = np.where(held, np.where(theirs_known[at] == known, at, -1)[own], -1)
            for mine, theirs, dist in _near(a, b, radius):
                apart = ~a.same("v", b, mine, theirs)
                mine, theirs, weight = mine[apart], theirs[apart], 1 - dist[apart] / (radius + 1)
                hits = np.stack([(mapped[mine, k][:, None] == other[theirs]).any(axis=1) for k in range(own.shape[1])], axis=1)
                one = hits.sum(axis=1) == 1
                np.add.at(votes, (mine[one], hits[one].argmax(axis=1)), weight[one])
        row, slot = np.nonzero(votes)
        yield pa.RecordBatch.from_arrays([a.array("id").take(pa.array(row)), pa.array(known[own[row, slot]]), pa.array(votes[row, slot])], names=["id", "label", "x"])

    kind = dict(rows.dtypes)["id"]
    parts = _met(_blocks(rows, "representatives"), use, f"id {kind}, label bigint, x double")
    return _first(parts.groupBy("id", "label").agg(F.round(F.sum("x"), 9).alias("votes")).where("votes > 0"))


def _first(votes: DataFrame) -> DataFrame:
    """Of each id the label with most votes, the lesser where they tie, and its lead."""
    ranked = votes.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("less"), "label"))).alias("r"))
    first = F.col("r")[0]
    return ranked.select("id", first["label"].alias("label"), (-first["less"]).alias("votes"), F.round(F.coalesce(F.get("r", F.lit(1))["less"], F.lit(0.0)) - first["less"], 9).alias("margin"))


def close_counts(df: DataFrame, keys: list[str], hash_: str, close: DataFrame) -> DataFrame:
    """keys and pairs: how many pairs of rows of equal keys are of equal hash or of a close pair. Rows are
    counted by hash first and multiplied by the pairs of hashes."""
    n = df.where(F.col(hash_).isNotNull()).groupBy(*keys, F.col(hash_).alias("_h")).agg(F.count("*").alias("_n"))
    equal = n.select(*keys, (F.col("_n") * (F.col("_n") - 1) / 2).cast("bigint").alias("p"))
    a = close.join(n, F.col("one") == F.col("_h")).select(*keys, "two", F.col("_n").alias("_na"))
    both = a.alias("a").join(n.alias("b"), null_safe("a", "b", keys) & (F.col("a.two") == F.col("b._h")))
    apart = both.select(*(F.col(f"a.{k}") for k in keys), (F.col("a._na") * F.col("b._n")).alias("p"))
    return equal.unionByName(apart).groupBy(*keys).agg(F.sum("p").alias("pairs"))


def labelled_votes(reps: DataFrame, id_: str, video: str, hash_: str, members: str, close: DataFrame, radius: int) -> DataFrame:
    """id, label, votes and margin of the representatives (rows, one a side) that get a vote. Two sides of different videos whose
    sets share exactly one member vote for it, the more the closer their hashes are: 1 - d / (radius + 1). The label is
    the member with most votes, the lesser where they tie; margin is what it leads the next one by.

    How many sides of a hash share exactly one member with a set follows from how many hold each of its few
    subsets, so sides are counted by hash and subset and no side meets another."""
    rows = reps.select(F.col(id_).alias("id"), F.col(video).alias("v"), F.col(hash_).alias("h"), F.array_sort(F.array_distinct(F.filter(members, lambda x: x.isNotNull()))).alias("m")).where("h is not null")
    each = rows.select("id", "v", "h", F.explode(subsets(F.col("m"))).alias("y"))
    own = each.groupBy("h", "y", "v").agg(F.count("*").alias("n"))
    every = own.groupBy("h", "y").agg(F.sum("n").alias("n"))
    weight = 1 - F.col("dist") / (radius + 1)
    near = close.select(F.col("one").alias("from"), F.col("two").alias("to"), weight.alias("w")).unionByName(close.select(F.col("two").alias("from"), F.col("one").alias("to"), weight.alias("w")))
    near = near.unionByName(rows.select("h").distinct().select(F.col("h").alias("from"), F.col("h").alias("to"), F.lit(1.0).alias("w")))
    # what a set of a video gets is the same for all its rows of a hash
    asked = own.select("h", "y", "v").join(near, F.col("h") == F.col("from")).select("h", "v", "y", "to", "w")
    met = asked.alias("a").join(every.alias("e"), (F.col("a.to") == F.col("e.h")) & (F.col("a.y") == F.col("e.y")))
    met = met.select("a.h", "a.v", "a.y", "a.to", "a.w", "e.n")
    same = met.alias("m").join(own.alias("o"), (F.col("m.to") == F.col("o.h")) & (F.col("m.y") == F.col("o.y")) & F.col("m.v").eqNullSafe(F.col("o.v")), "left")
    of = same.select("m.h", "m.v", "m.y", (F.col("m.w") * (F.col("m.n") - F.coalesce("o.n", F.lit(0)))).alias("x")).groupBy("h", "v", "y").agg(F.sum("x").alias("x"))
    signed = each.alias("r").join(of.alias("f"), (F.col("r.h") == F.col("f.h")) & (F.col("r.y") == F.col("f.y")) & F.col("r.v").eqNullSafe(F.col("f.v")))
    share = F.when(F.size("r.y") % 2 == 1, F.col("f.x")).otherwise(-F.col("f.x"))
    votes = signed.select("r.id", F.explode("r.y").alias("label"), share.alias("x")).groupBy("id", "label").agg(F.round(F.sum("x"), 9).alias("votes")).where("votes > 0")
    return _first(votes)
