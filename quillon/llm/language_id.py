"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 drawn from its code point. A trigram binds
its letters: the first vector rotated twice, the second once, the third not at all,
multiplied element by element. A text bundles (sums) its trigrams, a language bundles
its training texts, and a text gets the language with the largest cosine.

Bundles are exact integers, so the prototypes do not depend on the order of the rows. A very long text
is bundled in pieces that lose no trigram. Rows that repeat count as often in learning and are judged alike; an empty table
has no language and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import fold

DIMENSIONS = 512
#: Characters that are turned into trigrams at once; longer texts are taken in pieces
#: of this length, each with what the trigrams over its start need of the one before.
PIECE = 250_000
#: Largest alphabet of a batch whose trigrams are counted in a direct table.
DIRECT = 160
#: More languages than this are refused: the prototypes travel through the driver.
MAX_LANGUAGES = 2_000
#: Cosines of unrelated vectors deviate from 0 by 1 / sqrt(DIMENSIONS): a text of so many letters
#: below four such deviations is in no language learned. Shorter texts may be as low by chance.
LETTERS, LEAST = 200, 4 / DIMENSIONS**0.5

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """For each code point: itself if it is a letter, else 0."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((i if chr(i).isalpha() else 0 for i in range(0x110000)), dtype=np.int32, count=0x110000)
    return _letters


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Rows of +1 and -1, drawn by a splitmix64 generator seeded by the code point."""
    with np.errstate(over="ignore"):
        words = np.arange(1, dimensions // 64 + 1, dtype=np.uint64)
        z = (points.astype(np.uint64)[:, None] * np.uint64(0x10001) + words) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    bits = np.unpackbits(z.astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1)
    return bits.astype(np.int8) * 2 - 1


def _trigram_counts(texts: list[str], owners: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts (n x trigrams) and the bound vectors (trigrams x dimensions) of the texts."""
    raw = np.frombuffer("\0".join(texts).lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points, piece = _letter_table()[raw], np.cumsum(raw == 0)
    # NUL only parts the pieces; of neighbours that are no letters the first stays, in its own piece
    points, piece = points[raw != 0], piece[raw != 0]
    keep = (points != 0) | (np.concatenate(([1], points[:-1])) != 0) | (np.diff(piece, prepend=-1) != 0)
    points, piece = points[keep], piece[keep]
    if len(points) < 3:
        return np.zeros((n, 0), np.float32), np.zeros((0, DIMENSIONS), np.float32)
    present = np.flatnonzero(np.bincount(points, minlength=1))
    local = np.zeros(int(present[-1]) + 1, np.int64)
    local[present] = np.arange(len(present))
    symbols, size = local[points], len(present)
    codes = (symbols[:-2] * size + symbols[1:-1]) * size + symbols[2:]
    inside = piece[:-2] == piece[2:]
    codes, piece = codes[inside], piece[:-2][inside]
    if not len(codes):
        return np.zeros((n, 0), np.float32), np.zeros((0, DIMENSIONS), np.float32)
    if size <= DIRECT:
        seen = np.zeros(size**3, bool)
        seen[codes] = True
        found = np.flatnonzero(seen)
        place = np.zeros(size**3, np.int32)
        place[found] = np.arange(len(found), dtype=np.int32)
        index = place[codes]
    else:
        found, index = np.unique(codes, return_inverse=True)
    owner = np.asarray(owners, np.int64)[piece]
    counts = np.bincount(owner * len(found) + index, minlength=n * len(found)).reshape(n, len(found)).astype(np.float32)
    vectors = letter_vectors(present)
    bound = np.roll(vectors, 2, 1)[found // (size * size)] * np.roll(vectors, 1, 1)[found // size % size] * vectors[found % size]
    return counts, bound.astype(np.float32)


def _pieces(text: str, chars: int) -> Iterator[str]:
    """A text in pieces with the same trigrams, each once: a piece begins with the last two
    points (a letter, or a run of others) before it."""
    if len(text) <= chars:
        yield text
        return
    text = text.lower()  # as a whole, for a final sigma is one by what follows
    begin = 0
    for end in range(chars, len(text) + chars, chars):
        end = min(end, len(text))
        yield text[begin:end]
        begin = end - 1
        while begin > 0 and not text[begin].isalpha() and not text[begin - 1].isalpha():
            begin -= 1
        begin = max(0, begin - 1)


def _batches(texts: list[str | None], rows: int = 64, chars: int = PIECE) -> Iterator[tuple[int, int, list[str], list[int]]]:
    """(first row, one past the last, pieces, each piece's row from the first on): every text has
    a boundary of its own at both ends, whatever its neighbours; a batch has no more than so
    many rows and pieces of so many characters, but for one long text."""
    start, pieces, owners, total = 0, [], [], 0
    for i, text in enumerate(texts):
        text = " " + (text or "").replace("\0", " ") + " "
        if i > start and (i - start >= rows or total + len(text) > chars):
            yield start, i, pieces, owners
            start, pieces, owners, total = i, [], [], 0
        for piece in _pieces(text, chars):
            pieces.append(piece)
            owners.append(i - start)
        total += len(text)
    if start < len(texts):
        yield start, len(texts), pieces, owners


def bundles(texts: list[str | None]) -> np.ndarray:
    """One vector for each text: the sum of its trigrams' vectors."""
    out = np.zeros((len(texts), DIMENSIONS), np.float64)
    for first, last, pieces, owners in _batches(texts):
        for k in range(0, len(pieces), 128):
            counts, bound = _trigram_counts(pieces[k : k + 128], owners[k : k + 128], last - first)
            out[first:last] += counts @ bound
    return out


def _profiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for frame in frames:
        for lang, own in frame.groupby("lang", sort=True):
            sums[lang] = sums.get(lang, 0) + bundles(list(own["text"])).sum(axis=0)
    for lang, vector in sums.items():
        yield pd.DataFrame({"lang": [lang], "vector": [np.rint(vector).astype(np.int64)]})


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, from all rows with text and lang.
    A table without such rows gives no language."""
    spark = docs.sparkSession
    partial = docs.where("text is not null and lang is not null").select("text", "lang").mapInPandas(_profiles, "lang string, vector array<bigint>")
    sums = partial.select("lang", F.posexplode("vector").alias("pos", "value")).groupBy("lang", "pos").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("vector")).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = sorted(rows, key=lambda r: r["lang"])
    matrix = np.array([r["vector"] for r in rows], np.float64).reshape(len(rows), DIMENSIONS)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return [r["lang"] for r in rows], matrix / np.where(norms == 0, 1, norms)


def verdict(text: Column, model: tuple[list[str], np.ndarray]) -> Column:
    """lang_pred and score, the cosine cut to 0..1. Texts that are null, without a letter or
    without any learned language get `und` and 0; any other text has a trigram, if only of its
    ends and a letter. Ties go to the first in order. Only texts go to Python."""
    langs, prototypes = model

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [x if isinstance(x, str) else None for x in batch]
            has = np.array([x is not None and any(c.isalpha() for c in x) for x in texts], bool)
            if langs and len(texts):
                v = bundles(texts)
                norm = np.linalg.norm(v, axis=1)
                cosine = (v @ prototypes.T) / np.where(norm == 0, 1, norm)[:, None]
                best = cosine.argmax(axis=1)
                score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
                pred = np.array(langs, object)[best]
            else:
                has, score, pred = np.zeros(len(texts), bool), np.zeros(len(texts)), np.full(len(texts), "und", object)
            yield pd.DataFrame({"lang_pred": np.where(has, pred, "und"), "score": np.where(has, score, 0.0)})

    return judge(text)


def known(text: Column, found: Column) -> Column:
    """Whether a verdict names a language, as far as the text's length lets it be told."""
    short = F.coalesce(F.regexp_count(text, F.lit("\\p{L}")), F.lit(0)) < LETTERS
    return (found["lang_pred"] != "und") & (short | (found["score"] >= LEAST))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from the documents that
    are not held out (crc32 of the id as text, modulo 4, is 2; a null id is not held out)."""
    held = F.coalesce(fold(parts=4) == 2, F.lit(False))
    model = learn(docs.where(~held))
    return docs.select("doc_id", held.alias("held_out"), verdict(F.col("text"), model).alias("v")).select("doc_id", "held_out", "v.lang_pred", "v.score")
