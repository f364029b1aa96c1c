"""Rows that repeat id and text by the thousand cost about as much as they are."""

from __future__ import annotations

import re
import time

from pyspark.sql import functions as F

from quillon.llm import line_dedup, quality
from quillon.llm.common import cut


def test_repeated_rows_do_not_square(spark):
    said = "\n".join(f"line {k} of a text that says a few words more and ends in {k}" for k in range(5))
    near = said.replace("few", "lot")
    rows = [(7, said)] * 2_000 + [(None, near)] * 2_000 + [(8, near), (9, said)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    began = time.perf_counter()
    found = [(r["doc_id"], r["n_lines"], tuple(r["removed_lines"])) for r in line_dedup.digest(docs).collect()]
    assert time.perf_counter() - began < 45
    assert len(found) == len(rows)
    assert {f for f in found if f[0] == 9} == {(9, 5, (0, 1, 2, 3, 4))} and {f for f in found if f[0] == 7} == {(7, 5, (1, 2, 3, 4))}
    assert {f[2] for f in found if f[0] in (8, None)} == {(0, 1, 2, 3, 4)}


def test_quality_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l " * 3)] * 1_000 + [(2, None)] * 500, "doc_id bigint, text string")
    found = quality.digest(docs).collect()
    assert len(found) == 1_500 and len({tuple(r) for r in found}) == 2


def test_few_variants_are_compared(spark):
    """Of 60 lines that differ in their commonest word each is compared with its likest ones only; 59 go."""
    rows = [(k, f"one rare long line of a few more words that all of the texts here share but for a last w{k % 3}x{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    pairs = line_dedup._variants(line_dedup._nodes(docs)).count()
    assert 59 <= pairs <= 60 * 2 * 2
    found = {r["doc_id"]: r["n_removed"] for r in line_dedup.digest(docs).collect()}
    assert found == {k: int(k > 0) for k in range(60)}


def test_cut_leaves_no_shuffle(spark):
    blocks = lambda: set(re.findall(r"shuffle_\d+_\d+", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")))
    before = blocks()
    out = cut(spark.range(100_000).groupBy((F.col("id") % 1_000).alias("k")).count(), "swept")
    for _ in range(50):
        if not blocks() - before:
            break
        time.sleep(0.1)
    assert not blocks() - before and out.count() == 1_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_filters_in_whole_numbers_are_exact(spark):
    """The filter by differing bits keeps what may share 4/9 of n words, rounded up, and nothing else."""
    cases = [(n, d) for n in range(2, 200) for d in range(n % 2, n + 1, 2)]
    rows = spark.createDataFrame(cases, "n int, d int").select("n", "d", line_dedup._alike(F.col("d"), F.col("n")).alias("kept")).collect()
    assert len(rows) == len(cases) and all(r["kept"] == (r["d"] <= r["n"] - 2 * -(-4 * r["n"] // 9)) for r in rows)
