"""Quality rules by weak supervision, in DataFrame functions only.

Rules look at each whole text and vote good, bad or abstain. Expectation-maximisation over
the counts of vote patterns (at most 3 to the number of rules, so a bounded table) estimates
each rule's accuracy and the share of good documents, and the posterior probability of
`good`, not the demand that all rules pass, decides. A small base of hard rules comes first.

A very long text is one row whose words are arrays of hashes in its task; nothing crosses rows but the counts of patterns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import SPACE, cut, text_or_empty

#: Fixed by the contract.
SYMBOLS = "#*$%&|<>"
NGRAM = 5
#: A rule: (bad if, good if) over the columns of features(); else it abstains. The
#: thresholds stand apart so that a text between them gets no vote from the rule.
RULES: list[tuple[str, str, str]] = [
    ("length", "n_words < 20", "n_words >= 40"),
    ("word_length", "word_chars < 2.5 * n_words or word_chars > 14 * n_words", "word_chars >= 3.0 * n_words and word_chars <= 11 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words", "20 * n_symbols <= n_words"),
    ("symbol_share", "25 * n_symbols > word_chars", "100 * n_symbols <= word_chars"),
    ("repeated_lines", "2 * n_dup_lines > n_lines", "10 * n_dup_lines <= 4 * n_lines"),
    ("repeated_words", "20 * n_repeat_words > 3 * n_words", "100 * n_repeat_words <= 12 * n_words"),
    ("variety", "5 * n_distinct < n_words and n_words < 400", "5 * n_distinct >= 2 * n_words or n_words >= 400"),
]
#: The largest share of good documents, the bounds of a rule's errors, and rounds of EM.
PRIOR, WRONG, FOUND, ROUNDS = 0.9, 0.03, 0.2, 50


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words and n_distinct. Null and empty texts have no words. Five-word windows
    and words are compared by 64-bit hashes within one text."""
    t = text_or_empty(text)
    # the words' hashes are an own step, so that no expression makes them again
    words = docs.select("*", F.filter(F.split(t, SPACE), lambda w: w != "").alias("_words"), F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("_lines"))
    hashed = words.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("bigint"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    h = F.col("_h")
    spans = hashed.select(
        "*",
        F.size(F.array_distinct(h)).cast("long").alias("n_distinct"),
        F.when(F.size(h) < NGRAM, F.array().cast("array<bigint>"))
        .otherwise(F.transform(F.arrays_zip(*(F.slice(h, k + 1, F.greatest(F.size(h) - (NGRAM - 1), F.lit(1))).alias(f"w{k}") for k in range(NGRAM))), lambda x: F.xxhash64(*(x[f"w{k}"] for k in range(NGRAM)))))
        .alias("_g"),
    )
    again = spans.withColumn("_repeats", F.size("_g") > F.size(F.array_distinct("_g")))
    # windows by hash, then place; one is repeated if a neighbour has its hash
    ordered = again.withColumn("_s", F.when(F.col("_repeats"), F.array_sort(F.transform("_g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    s = F.col("_s")
    places = ordered.withColumn("_p", F.when(F.col("_repeats"), F.array_sort(F.transform(F.filter(F.transform(s, lambda e, k: F.struct(e["i"].alias("i"), ((k > 0) & (e["x"] == F.get(s, k - 1)["x"]) | F.coalesce(e["x"] == F.get(s, k + 1)["x"], F.lit(False))).alias("r"))), lambda e: e["r"]), lambda e: e["i"]))))
    p = F.col("_p")
    covered = F.aggregate(p, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-NGRAM).alias("at")), lambda a, i: F.struct((a["n"] + F.least(F.lit(NGRAM), i - a["at"])).alias("n"), i.alias("at")), lambda a: a["n"])
    return places.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_repeats"), covered), F.lit(0).cast("bigint"))).drop(text, "_words", "_lines", "_h", "_g", "_s", "_p", "_repeats")


def vote(bad: str, good: str) -> Column:
    return F.expr(f"case when {bad} then -1 when {good} then 1 else 0 end")


Model = tuple[float, list[dict[int, tuple[float, float]]]]


def estimate(patterns: dict[tuple[int, ...], int], rules: int) -> Model:
    """The share of good documents and, for each rule and vote, its probability given a good
    and given a bad document, by EM from counts of vote patterns. A rule is never taken to
    mislead: it votes bad on at most WRONG of the good and at least FOUND of the bad."""

    def held(table: dict[int, list[float]]) -> dict[int, tuple[float, float]]:
        out = {}
        for side in (0, 1):
            p = {v: max(table[v][side], 1e-3) for v in (-1, 0, 1)}
            total = sum(p.values())
            bad = p[-1] / total
            bad = min(bad, WRONG) if side == 0 else max(bad, FOUND)
            rest = (1 - bad) / (p[0] + p[1])
            out[side] = {-1: bad, 0: p[0] * rest, 1: p[1] * rest}
        return {v: (out[0][v], out[1][v]) for v in (-1, 0, 1)}

    prior = PRIOR
    tables = [held({-1: [WRONG, FOUND], 0: [0.1, 0.2], 1: [0.87, 0.4]}) for _ in range(rules)]
    total = sum(patterns.values())
    for _ in range(ROUNDS if total else 0):
        good = 0.0
        seen = [{v: [1.0, 1.0] for v in (-1, 0, 1)} for _ in range(rules)]
        for votes, n in sorted(patterns.items()):
            q = posterior(votes, (prior, tables))
            good += n * q
            for j, v in enumerate(votes):
                seen[j][v][0] += n * q
                seen[j][v][1] += n * (1 - q)
        prior = min(max(good / total, 0.05), PRIOR)
        tables = [held(x) for x in seen]
    return prior, tables


def log_odds(model: Model) -> tuple[float, list[dict[int, float]]]:
    prior, tables = model
    return math.log(prior / (1 - prior)), [{v: math.log(g / b) for v, (g, b) in t.items()} for t in tables]


def posterior(votes: tuple[int, ...], model: Model) -> float:
    start, weights = log_odds(model)
    return 1 / (1 + math.exp(-start - sum(w[v] for v, w in zip(votes, weights, strict=True))))


def judge(docs: DataFrame, text: str = "text", rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """docs without the text, with the features, base_failed, p_good and kept. An empty
    table gives an empty result; rows that repeat are judged alike."""
    rules = RULES if rules is None else rules
    votes = [f"vote_{name}" for name, _, _ in rules]
    seen = features(docs, text)
    seen = seen.withColumns({v: vote(bad, good) for v, (_, bad, good) in zip(votes, rules, strict=True)})
    seen = cut(seen.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")), "quality")
    patterns = {tuple(r[v] for v in votes): r["count"] for r in seen.groupBy(*votes).count().collect()}
    start, weights = log_odds(estimate(patterns, len(rules)))
    odds = F.lit(start)
    for v, w in zip(votes, weights, strict=True):
        odds = odds + F.when(F.col(v) < 0, F.lit(w[-1])).when(F.col(v) > 0, F.lit(w[1])).otherwise(F.lit(w[0]))
    return seen.withColumn("p_good", 1 / (1 + F.exp(-odds))).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def digest(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
