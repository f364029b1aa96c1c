"""Repeated byte strings by bucket-pointer refinement over a sparse suffix array.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else. Suffixes
start at anchors: in every window of LENGTH bytes the leftmost q-gram with the smallest hash,
so equal windows have equal anchors at equal offsets.

Initial buckets are the anchors' q-grams; a bucket with one member is done. The others are
refined by the identifiers (hashes) of the strings around the anchor, in cells of START
offsets: a cell has the core that all its windows share (its bucket) and the whole that they
cover (its identifier). A whole that occurs twice settles its cell; a core that occurs once
ends it; what lies between goes to the next level, with cells of 1/16 of the offsets whose
buckets are the identifiers found before, and at last to single windows. A settled whole
stays with one member, for others to be compared with.

The number of levels is fixed. Bucket and identifier have 64 bits each, from different
polynomials; their pairs are taken for the strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import cut

#: Fixed by the contract.
LENGTH = 400
#: Offsets of windows around an anchor (a power of two), and of a cell at the next level.
START, CELL = 256, 16
GRAM = LENGTH - START + 1
#: Window starts of a text that are looked at together.
PIECE = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
        _powers[base] = (out[0], out[1])
    return _powers[base]


class Names:
    """Identifiers of a text's substrings, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray, which: int):
        self.up, self.down = _powers_of(_BASES[which], len(data) + 1)
        codes = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * which)) * _ODD)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * self.up[: len(data)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mix((self.sums[length:] - self.sums[:n]) * self.down[:n])

    def of(self, first: np.ndarray, last: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Of data[first:last], told apart by salt too."""
        return _mix(((self.sums[last] - self.sums[first]) * self.down[first]) ^ _mix(salt.astype(np.uint64) * _ODD + np.uint64(1)))


def anchors(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Per piece of the text: anchors m, first and last start s, e of the windows that have
    them, the q-gram's name and the name of the whole [m - START + 1, m + LENGTH), cut to the
    text. An anchor whose windows lie in several pieces comes once, with all of them."""
    n = len(data)
    open_: tuple[np.ndarray, ...] | None = None
    for at in range(0, max(0, n - LENGTH + 1), PIECE):
        low, high = max(0, at - START), min(n, at + PIECE + 2 * LENGTH)
        part = data[low:high]
        first, last = at - low, min(at + PIECE, n - LENGTH + 1) - low
        grams = Names(part, 0).all(GRAM)
        least = (grams[first : last + START - 1] & ~np.uint64(0xFFFFFF)) | np.arange(first, min(last + START - 1, len(grams)), dtype=np.uint64)
        step = 1
        while step < START:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        chosen = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        turns = np.flatnonzero(np.diff(chosen)) + 1
        begins = np.concatenate(([0], turns))
        ends = np.concatenate((turns, [len(chosen)])) - 1
        m = chosen[begins]
        left, right = np.maximum(0, m + low - START + 1) - low, np.minimum(n, m + low + LENGTH) - low
        salt = (m - left) * 1024 + (right - m)
        found = (m + low, begins + first + low, ends + first + low, grams[m].view(np.int64), Names(part, 1).of(left, right, salt).view(np.int64))
        if open_ is not None:
            if open_[0][0] == found[0][0]:
                found[1][0] = open_[1][0]
            else:
                found = tuple(np.concatenate(x) for x in zip(open_, found, strict=True))
        # the next piece may go on with the last anchor
        open_ = tuple(x[-1:] for x in found)
        if len(found[0]) > 1:
            yield tuple(x[:-1] for x in found)
    if open_ is not None:
        yield open_


def _bytes(text: object) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b"", np.uint8)


def _grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct q-grams at anchors of some texts at a time and how often they occur there."""
    for frame in frames:
        waiting, size = [], 0
        for text in frame["text"]:
            for _, _, _, grams, _ in anchors(_bytes(text)):
                waiting.append(grams)
                size += len(grams)
            if size > 100_000:
                gram, n = np.unique(np.concatenate(waiting), return_counts=True)
                yield pd.DataFrame({"gram": gram, "n": n})
                waiting, size = [], 0
        if waiting:
            gram, n = np.unique(np.concatenate(waiting), return_counts=True)
            yield pd.DataFrame({"gram": gram, "n": n})


def _merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted disjoint runs [first, last) that do not touch."""
    if not len(first):
        return first, last
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate(([True], first[1:] > reach[:-1]))
    starts = np.flatnonzero(new)
    return first[starts], reach[np.concatenate((starts[1:], [len(first)])) - 1]


_ANCHOR = "doc_id bigint, th bigint, m bigint, s bigint, e bigint, hi bigint, gram bigint, name bigint, n bigint"


def _frame_of(doc_ids: list, ths: list, parts: list[dict[str, np.ndarray]]) -> pd.DataFrame:
    """Parts of several texts under one another, each with its text's doc_id and th. The ids
    stay Python integers or None, for pandas has no nulls among plain integers."""
    if not parts:
        return pd.DataFrame()
    sizes = [len(next(iter(x.values()))) for x in parts]
    out = pd.DataFrame({k: np.concatenate([x[k] for x in parts]) for k in parts[0]})
    out.insert(0, "doc_id", pd.array(np.repeat(np.array([0 if d is None or pd.isna(d) else int(d) for d in doc_ids], np.int64), sizes), dtype="Int64"))
    if missing := [d is None or pd.isna(d) for d in doc_ids]:
        out.loc[np.repeat(np.array(missing), sizes), "doc_id"] = pd.NA
    out.insert(1, "th", np.repeat(np.array(ths, np.int64), sizes))
    return out


def _rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One anchor for each distinct whole of a text piece, with its number there as n; where
    n > 1, its places are known to repeat and come as runs [s, e) with n = 0."""
    for frame in frames:
        ids, ths, parts, size = [], [], [], 0
        for doc_id, th, text in zip(frame["doc_id"], frame["th"], frame["text"], strict=True):
            data = _bytes(text)
            for m, s, e, gram, name in anchors(data):
                _, firsts, where, n = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
                again = n[where] > 1
                a, b = _merged(np.maximum(0, m[again] - START + 1), np.minimum(len(data), m[again] + LENGTH))
                zero, m, s, e = np.zeros(len(a), np.int64), m[firsts], s[firsts], e[firsts]
                columns = {"m": (m, a), "s": (s, a), "e": (e, b), "hi": (np.minimum(len(data), m + LENGTH), b), "gram": (gram[firsts], zero), "name": (name[firsts], zero), "n": (n, zero)}
                parts.append({k: np.concatenate(v) for k, v in columns.items()})
                ids.append(doc_id)
                ths.append(th)
                size += len(m) + len(a)
            if size > 50_000:
                yield _frame_of(ids, ths, parts)
                ids, ths, parts, size = [], [], [], 0
        if parts:
            yield _frame_of(ids, ths, parts)


def _settle(rows: DataFrame, bucket: list[str], label: str) -> DataFrame:
    """rows with settled (their name occurs twice in the bucket) and next (they go to the next
    level: the bucket has several names, and they are not settled or stand for their name)."""
    names = rows.groupBy(*bucket, "name").agg(F.sum("n").alias("count"), F.min(F.struct("doc_id", "th", "m", "p")).alias("stands"))
    names = cut(names, f"{label}-names")
    kinds = names.groupBy(*bucket).agg(F.count("*").alias("kinds")).where("kinds > 1")
    known = cut(names.join(kinds, bucket, "left").select(*(F.col(b).alias(f"{b}_") for b in bucket), F.col("name").alias("name_"), "count", "kinds", "stands"), f"{label}-known")
    same = F.col("name") == F.col("name_")
    for b in bucket:
        same = same & (F.col(b) == F.col(f"{b}_"))
    stands = F.struct("doc_id", "th", "m", "p").eqNullSafe(F.col("stands"))
    out = rows.join(known, same).withColumn("settled", F.col("count") > 1).withColumn("next", F.col("kinds").isNotNull() & (~F.col("settled") | stands))
    return cut(out.select(*rows.columns, "settled", "next").where("settled or next"), label)


def _joined(docs: DataFrame, by: DataFrame, how: str = "inner") -> DataFrame:
    return docs.join(by.withColumnsRenamed({"doc_id": "d_", "th": "t_"}), (F.col("th") == F.col("t_")) & F.col("doc_id").eqNullSafe(F.col("d_")), how).drop("d_", "t_")


def _contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for doc_id, th, text, of in zip(frame["doc_id"], frame["th"], frame["text"], frame["of"], strict=True):
            data = _bytes(text).tobytes()
            rows = [(doc_id, th, x["m"], x["s"], x["e"], x["gram"], data[max(0, x["m"] - START + 1) : x["m"] + LENGTH]) for x in of]
            yield pd.DataFrame(rows, columns=["doc_id", "th", "m", "s", "e", "gram", "context"])


_CELL = "doc_id bigint, th bigint, m bigint, p bigint, q bigint, gram bigint, cell bigint, core bigint, name bigint, n bigint"


def _blocks(frames: Iterator[pd.DataFrame], rows: int = 1_500) -> Iterator[tuple[pd.DataFrame, list[Names], np.ndarray, np.ndarray, np.ndarray]]:
    """Rows with contexts, some at a time: the names over all their contexts end to end, where
    each starts in that, its length, and its first byte's place in the text."""
    for frame in frames:
        for at in range(0, len(frame), rows):
            part = frame.iloc[at : at + rows]
            data = np.frombuffer(b"".join(part["context"]), np.uint8)
            sizes = part["context"].map(len).to_numpy(np.int64)
            low = np.maximum(0, part["m"].to_numpy(np.int64) - START + 1)
            yield part, [Names(data, 0), Names(data, 1)], np.cumsum(sizes) - sizes, sizes, low


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place within the row of each of counts[row] elements."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells of CELL offsets that the anchor's windows meet: starts p to q, the core's and the
    whole's name. The core is the same wherever the text ends; the whole is cut to the text."""
    for part, names, base, sizes, low in _blocks(frames):
        m, s, e = (part[c].to_numpy(np.int64) for c in ("m", "s", "e"))
        row, k = _spread((m - s) // CELL - (m - e) // CELL + 1)
        cell, m, low, shift = k + ((m - e) // CELL)[row], m[row], low[row], (base - low)[row]
        p = np.maximum(low, m - cell * CELL - CELL + 1)
        q = np.minimum(low + sizes[row] - LENGTH, m - cell * CELL)
        core = names[0].of(m - cell * CELL + shift, m - cell * CELL - CELL + 1 + LENGTH + shift, cell)
        name = names[1].of(p + shift, q + LENGTH + shift, (m - p) * 1024 + (m - q))
        out = part[["doc_id", "th", "gram"]].iloc[row]
        yield out.assign(m=m, p=p, q=q, cell=cell, core=core.view(np.int64), name=name.view(np.int64), n=1)


def _windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The single windows of cells."""
    for part, names, base, _, low in _blocks(frames):
        m, p, q = (part[c].to_numpy(np.int64) for c in ("m", "p", "q"))
        row, k = _spread(q - p + 1)
        first, m, at = p[row] + k, m[row], p[row] + k + (base - low)[row]
        core, name = (names[i].of(at, at + LENGTH, m - first) for i in (0, 1))
        out = part[["doc_id", "th", "gram"]].iloc[row]
        yield out.assign(m=m, p=first, q=first, cell=m - first, core=core.view(np.int64), name=name.view(np.int64), n=1)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, th, first, last): bytes [first, last) that repeated strings cover; runs may
    overlap. th is the hash of the text; documents are told apart by both."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").where(F.octet_length("text") >= LENGTH)
    grams = texts.select("text").mapInPandas(_grams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    shared = cut(grams.where("n > 1").select(F.col("gram").alias("shared")), "grams")
    found = texts.mapInPandas(_rows, _ANCHOR)
    kept = cut(found.join(shared, F.col("gram") == F.col("shared"), "left").where("n = 0 or shared is not null").drop("shared"), "anchors")
    local = kept.where("n = 0").select("doc_id", "th", F.col("s").alias("first"), F.col("e").alias("last"))
    level = _settle(kept.where("n > 0").withColumn("p", F.col("m")), ["gram"], "level0")
    runs = local.unionByName(level.where("settled").select("doc_id", "th", F.greatest(F.lit(0), F.col("m") - START + 1).alias("first"), F.col("hi").alias("last")))

    asked = level.where("next").groupBy("doc_id", "th").agg(F.collect_set(F.struct("m", "s", "e", "gram")).alias("of"))
    contexts = cut(_joined(texts, asked).mapInPandas(_contexts, "doc_id bigint, th bigint, m bigint, s bigint, e bigint, gram bigint, context binary"), "contexts")
    cells = _settle(cut(contexts.mapInPandas(_cells, _CELL), "cells"), ["gram", "cell", "core"], "level1")
    runs = runs.unionByName(cells.where("settled").select("doc_id", "th", F.col("p").alias("first"), (F.col("q") + LENGTH).alias("last")))

    open_ = cells.where("next").select("doc_id", "th", "m", "p", "q", "gram").distinct()
    same = (F.col("th") == F.col("t2")) & F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("m") == F.col("m2"))
    beside = contexts.select(F.col("doc_id").alias("d2"), F.col("th").alias("t2"), F.col("m").alias("m2"), "context").dropDuplicates(["d2", "t2", "m2"])
    windows = cut(open_.join(beside, same).select("doc_id", "th", "m", "p", "q", "gram", "context").mapInPandas(_windows, _CELL), "windows")
    twice = windows.groupBy("gram", "cell", "core", "name").agg(F.count("*").alias("k")).where("k > 1")
    twice = cut(twice.select(F.col("gram").alias("g2"), F.col("cell").alias("c2"), F.col("core").alias("w2"), F.col("name").alias("n2")), "twice")
    single = windows.join(twice, (F.col("gram") == F.col("g2")) & (F.col("cell") == F.col("c2")) & (F.col("core") == F.col("w2")) & (F.col("name") == F.col("n2")), "left_semi")
    return runs.unionByName(single.select("doc_id", "th", F.col("p").alias("first"), (F.col("p") + LENGTH).alias("last")))


def _cut_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        n_bytes, removed, spans, digests, kept = [], [], [], [], []
        for text, runs in zip(frame["text"], frame["runs"], strict=True):
            data = _bytes(text).tobytes()
            pairs = np.array([] if runs is None else [(x["first"], x["last"]) for x in runs], np.int64).reshape(-1, 2)
            a, b = _merged(pairs[:, 0], pairs[:, 1])
            edges = [0, *np.stack([a, b], axis=1).reshape(-1).tolist(), len(data)]
            rest = b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
            n_bytes.append(len(data))
            removed.append(len(data) - len(rest))
            spans.append([{"first": int(x), "last": int(y)} for x, y in zip(a, b, strict=True)])
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        yield frame.drop(columns=["text", "runs"]).assign(n_bytes=n_bytes, n_removed=removed, spans=spans, kept_sha256=digests, kept=kept)


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (the maximal removed runs), kept_sha256 and kept (the
    bytes that stay, which may cut a character) of every document. Null is empty; texts under
    LENGTH bytes keep all; rows that repeat a text, id or not, repeat each other."""
    runs = repeated_runs(docs).groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<first:bigint,last:bigint>>, kept_sha256 string, kept binary"
    return _joined(texts, runs, "left").select("doc_id", "text", "runs").mapInPandas(_cut_out, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document, and has_removed: whether it loses a byte."""
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", (F.col("n_removed") > 0).alias("has_removed"))
