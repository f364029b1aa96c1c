"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words is trained with numpy on confirmed toxic examples
and unlabelled documents. With class prior p the risk is p R+(positives) plus the larger
of 0 and R-(unlabelled) - p R-(positives); where that difference is negative, the step
goes against it. Labels of 0 serve only to estimate the prior. Features are words commoner in
positives, so a word of clean text alone carries no weight.

A very long text is read whole, as its distinct words. A score of exactly 0.5 is predicted toxic. Rows that repeat
are scored alike; of different texts under one id of the fitted sample one is fitted, whichever comes first. An
empty table gives no rows, empty labels the prior as every score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import fold

BUCKETS = 1 << 18
#: The classifier is fitted on samples of at most so many documents, those with the
#: smallest hash of their id; the prior counts all labels, and all rows are scored.
MAX_POSITIVE, MAX_UNLABELLED = 4_000, 8_000
#: A word enters the classifier only if it is commoner in the positive sample than in the
#: unlabelled one by so many standard deviations, and in this share of the positive sample.
MIN_Z, MIN_SHARE, MIN_DOCUMENTS = 6.0, 0.01, 3
EPOCHS, RATE, DECAY = 400, 0.05, 1e-4

_WORD = re.compile(r"[^\W\d_]+")


def word_ids(text: str | None, memo: dict[str, int]) -> list[int]:
    """Hashed distinct words of the whole text, lower-cased."""
    out = []
    for word in set(_WORD.findall((text or "").lower())):
        if (i := memo.get(word)) is None:
            if len(memo) > 500_000:
                memo.clear()
            i = memo[word] = crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        out.append(i)
    return sorted(set(out))


def _features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo: dict[str, int] = {}
    for frame in frames:
        yield pd.DataFrame({"doc_id": frame["doc_id"], "words": [word_ids(x if isinstance(x, str) else None, memo) for x in frame["text"]]})


class Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.columns = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
        self.owner = np.repeat(np.arange(self.n), [len(r) for r in rows]) if rows else np.zeros(0, np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, w[self.columns], minlength=self.n)

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.columns, g[self.owner], minlength=size)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the intercept, by Adam on the non-negative risk with the
    logistic loss. Without positives every text scores by the prior alone."""
    weights = np.zeros(BUCKETS)
    prior = float(min(max(prior, 1e-4), 0.95))
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return weights, start
    in_p, in_u = (np.bincount(np.concatenate(rows).astype(np.int64), minlength=BUCKETS) for rows in (positive, unlabelled))
    share = np.maximum(in_u, 1) / len(unlabelled)
    z = (in_p / len(positive) - in_u / len(unlabelled)) / np.sqrt(share / len(positive))
    used = np.flatnonzero((z >= MIN_Z) & (in_p >= max(MIN_DOCUMENTS, MIN_SHARE * len(positive))))
    place = np.full(BUCKETS, -1, np.int64)
    place[used] = np.arange(len(used))
    p, u = (Rows([(x := place[np.asarray(r, np.int64)])[x >= 0] for r in rows]) for rows in (positive, unlabelled))
    w = np.zeros(len(used) + 1)
    w[-1] = start
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, EPOCHS + 1):
        zp, zu = p.times(w[:-1]) + w[-1], u.times(w[:-1]) + w[-1]
        up, uu = _sigmoid(zp), _sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp_plus, gp_minus, gu = prior * (up - 1) / p.n, -prior * up / p.n, uu / u.n
        if negative >= 0:
            gp, gu = gp_plus + gp_minus, gu
        else:
            gp, gu = -gp_minus, -gu
        g = np.append(p.back(gp, len(used)) + u.back(gu, len(used)), gp.sum() + gu.sum())
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights[used] = w[:-1]
    return weights, float(w[-1])


def _sample(ids: DataFrame, n: int) -> DataFrame:
    """The n ids with the smallest hash: the same at every run."""
    return ids.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(n)


def learn(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Fits on documents of the training fold (crc32 of the id as text, modulo 5, not 0).
    A document with several labels counts as toxic if one says so; null labels count as none."""
    train = (fold(parts=5) != 0) & F.col("doc_id").isNotNull()
    marked = labels.where(train & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = marked.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("k")).first()
    prior = (counts["k"] or 0) / counts["n"] if counts["n"] else 0.01

    def gather(ids: DataFrame) -> list[np.ndarray]:
        rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").mapInPandas(_features, "doc_id bigint, words array<int>")
        got = sorted(((r["doc_id"], r["words"]) for r in rows.dropDuplicates(["doc_id"]).collect()), key=lambda r: r[0])
        return [np.array(w, np.int64) for _, w in got]

    positive = gather(_sample(marked.where("toxic = 1").select("doc_id"), MAX_POSITIVE))
    unlabelled = gather(_sample(docs.where(train).select("doc_id"), MAX_UNLABELLED).distinct())
    return fit(positive, unlabelled, prior)


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """docs with score and predicted. Null and empty texts have no words and get the
    intercept's score."""
    weights, intercept = model
    kept = np.flatnonzero(weights)
    small = (kept.astype(np.int32), weights[kept])
    names = [f.name for f in docs.schema if f.name not in ("score", "predicted")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names), "score double", "predicted int"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = np.zeros(BUCKETS)
        w[small[0]] = small[1]
        memo: dict[str, int] = {}
        for frame in frames:
            z = np.array([w[word_ids(x if isinstance(x, str) else None, memo)].sum() for x in frame["text"]], float) + intercept
            out = frame[names].copy()
            out["score"] = _sigmoid(z)
            out["predicted"] = (out["score"] >= 0.5).astype("int32")
            yield out

    return docs.select(*(F.col(f"`{n}`") for n in names)).mapInPandas(run, schema)


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    held = F.coalesce(fold(parts=5) == 0, F.lit(False))
    model = learn(docs, labels)
    return score(docs.select("doc_id", held.alias("held_out"), "text"), model).select("doc_id", "held_out", "score", "predicted")
