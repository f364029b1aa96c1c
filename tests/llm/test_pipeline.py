"""The corpus pipeline, stage by stage, on a whole small table."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute

import corpus_pipeline
from quillon.llm import decontaminate

SMALL = "/root/testdata/sf0.001"


def test_each_stage_does_its_work(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{tmp_path}/{k}")
        held = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "mix":
            assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
        if name == "near_copies":
            want = {root for _, _, root in brute.simhash(list(held.items()))}
            assert {r["doc_id"] for r in docs.collect()} == want
        if name == "lines":
            removed = brute.line_dedup(list(held.items()))
            got = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert got == {d: "\n".join(x for i, x in enumerate(held[d].split("\n")) if i not in gone) for d, _, gone in removed}
        if name == "benchmark":
            assert decontaminate.mark(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).where("contaminated").count() == 0


def test_run_gives_the_last_stages_rows(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(got.columns)
    assert got.count() > 0
