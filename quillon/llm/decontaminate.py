"""Benchmark decontamination with one Aho-Corasick automaton over benchmark windows.

Words are runs of ASCII digits, letters (A-Z lower-cased) and all non-ASCII characters.
Every 13 consecutive words of a benchmark item are a pattern; an item of fewer words is
one pattern. Each document's normalised words are scanned once, and hits are mapped back
to offsets in the original text.

The benchmark travels to the executors in blocks of bounded size: one block, and so one
automaton, in the usual case. A larger one is searched block after block, each in a job of its own over the
texts, of which only texts with hits come back, as a table; so a worker and the driver never hold more than one block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import cut, text_or_empty

WINDOW = 13
#: Bytes of benchmark text that one automaton holds: about 560 MB of memory in a worker.
BLOCK_BYTES = 4 << 20

#: Fixed by the contract: word characters, before and after A-Z are lower-cased.
WORD = re.compile("[0-9A-Za-z\x80-\U0010FFFF]+")
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_HITS = "array<struct<first:bigint,last:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Machine:
    """An automaton over numbered words. A word costs a node for each window that it is in, so
    memory goes by words, not by characters: about 140 bytes for a byte of benchmark text."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            known = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text))
            for at in range(max(1, len(known) - window + 1) if known else 0):
                found.setdefault(known[at : at + window], set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, ids in found.items():
            self.automaton.add_word(key, (tuple(sorted(ids)), len(key)))
        if found:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs (first word, last word) covered by windows, and the items found."""
        if not words or not self.numbers:
            return [], set()
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        for last, (ids, n) in self.automaton.iter(tuple(self.numbers.get(w, 0) for w in words)):
            items.update(ids)
            runs.append((last - n + 1, last))
        return merged(runs), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


_machines: dict[str, Machine] = {}


def _machine(items: list[tuple[str, str]], window: int) -> Machine:
    key = hashlib.sha256(repr((window, items)).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _machines:
        _machines.clear()
        _machines[key] = Machine(items, window)
    return _machines[key]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """Items as (id as text, text) in blocks of about BLOCK_BYTES at most, dealt by a hash
    of the id; repeated and null items, and items without an id (as ''), included."""
    items = benchmark.where("text is not null").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = -(-total // BLOCK_BYTES) or 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id"), F.lit(n)) == k)
        yield sorted((r["id"], r["text"]) for r in part.collect())


def _searched(text: Column, items: list[tuple[str, str]], window: int, once: bool = False) -> Column:
    """n_words, hits and ids of a text. Only texts go to Python and only this comes back. once: a
    filter on it must not make a second evaluation."""

    @F.pandas_udf(f"n_words bigint, hits {_HITS}, ids array<string>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = _machine(items, window)
        for batch in batches:
            rows = []
            for t in batch:
                words = words_of(t if isinstance(t, str) else None)
                runs, found = machine.scan(words)
                rows.append((len(words), [{"first": x, "last": y} for x, y in runs], sorted(found)))
            yield pd.DataFrame(rows, columns=["n_words", "hits", "ids"])

    return (search.asNondeterministic() if once else search)(text)


def _elsewhere(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    """key (a hash of the text), hits and ids of the texts that a further block hits."""
    found = docs.select(_key("text"), _searched(F.col("text"), items, window, once=True).alias("b")).where(F.size("b.hits") > 0)
    return cut(found.select("key", "b.hits", "b.ids").dropDuplicates(["key"]), "hits")


def _key(text: str) -> Column:
    return F.sha2(text_or_empty(text), 256).alias("key")


def _joined(hits: pd.Series) -> pd.Series:
    """The runs of several blocks of the benchmark as one list."""
    return pd.Series([[{"first": a, "last": b} for a, b in merged([(x["first"], x["last"]) for x in h])] for h in hits])


def _places(texts: pd.Series, hits: pd.Series) -> pd.Series:
    """Offsets of the runs in the original text, in code points."""
    out = []
    for t, h in zip(texts, hits, strict=True):
        at = [m.span() for m in WORD.finditer(t)] if len(h) else []
        out.append([{"start": at[x["first"]][0], "end": at[x["last"]][1]} for x in h])
    return pd.Series(out)


def _found(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """row (all of the document), n_words, hits, items, n_hit and contaminated."""
    blocks = _blocks(benchmark)
    found = docs.select(F.struct("*").alias("row")).select("row", _searched(F.col("row.text"), next(blocks), window).alias("b"))
    hits, items = F.col("b.hits"), F.col("b.ids")
    more = [_elsewhere(docs, block, window) for block in blocks]
    if more:
        rest = reduce(DataFrame.unionByName, more).groupBy("key").agg(F.flatten(F.collect_list("hits")).alias("more_hits"), F.flatten(F.collect_list("ids")).alias("more_ids"))
        found = found.withColumn("key", _key("row.text")).join(rest, "key", "left")
        also = lambda one, other, kind: F.concat(one, F.coalesce(F.col(other), F.array().cast(kind)))
        hits = F.pandas_udf(_joined, _HITS)(also(hits, "more_hits", _HITS))
        items = F.array_sort(F.array_distinct(also(items, "more_ids", "array<string>")))
    found = found.select("row", F.col("b.n_words").alias("n_words"), hits.alias("hits"), items.alias("items"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["last"] - x["first"] + 1)
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with n_words, n_hit, items (sorted ids), spans (start, end offsets of the hit runs
    in the original text, in code points) and contaminated (at least 5 % of the words are hit),
    in place of own columns of these names. Null and empty texts have no words; an empty
    benchmark hits nothing. A text beyond Python's surrogates is not expected: Spark strings
    are valid UTF-8. Rows that repeat are marked alike, and an empty table gives none."""
    spans = F.pandas_udf(_places, "array<struct<start:bigint,end:bigint>>")(F.coalesce("row.text", F.lit("")), "hits")
    new = ["n_words", "n_hit", "items", "spans", "contaminated"]
    out = _found(docs, benchmark, window).withColumn("spans", spans)
    return out.select(*(F.col("row").getField(c).alias(c) for c in docs.columns if c not in new), *new)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    items = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return _found(docs.select("doc_id", "text"), benchmark).select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items, "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns, whatever their names."""
    return _found(docs, benchmark).where(~F.col("contaminated")).select("row.*")


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id COLLATE C) AS s FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r)
"""
