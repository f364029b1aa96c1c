"""Queries of the core library beyond what SQL compares."""

from __future__ import annotations

from quillon.plans import archive, reading


def test_token_set_pairs(spark, tmp_path):
    body = "\n".join(f"line {k} of a text" for k in range(20))
    rows = [
        (1, "src5", "head one two\n" + body, 100), (2, "src1", body + "\ntwo one head", 101),  # other first line, other order
        (3, "src5", "same first\n" + body, 50), (4, "src6", "same first\nbut another rest", 50),  # one first line, other texts
        (5, "src0", "x y", 7), (6, "src0", "y x", 7), (7, "src9", "y  x x", 8),  # 6 is of 5's source
        (8, "src0", "alone", 5), (9, "src1", "alone", 5), (10, "src0", "", 0), (11, "src1", "", 0), (12, "src0", None, None),  # not keyable
        (13, "src8", "p q", 20), (14, "src7", "q p", 20), (15, None, "p q", 21), (16, "src1", "p q", 23),  # both 99: the first; 16 is too long
    ]
    spark.createDataFrame(rows, "doc_id bigint, source string, text string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in archive.dupe_token_set_pairs(spark, str(tmp_path)).collect())
    assert got == [(2, 1, 1, 2, "src1"), (7, 6, 1, 6, "src0"), (14, 13, 0, 13, "src8"), (15, 14, 1, 14, "src7")]


def test_names_are_decoded_from_their_trims(spark):
    keys = ["HULK", "MAGIK", "LOKI", "WOLVERINE"]
    names = ["HULK", "JLOKI", "MAGIKY", "WOLVERINEN", "- MAGIK TB", "WLOVERINE", "HU", "SOMETHING ELSE", "LOXX"]
    seen = spark.createDataFrame([(x,) for x in names], "seen string")
    got = {r["seen"]: (r["key"], r["dist"], r["margin"]) for r in reading.decoded(seen, keys).collect()}

    def plain(text):
        if len(text) < 3:
            return None, None, None
        trims = list(dict.fromkeys(x for i in range(4) for j in range(5) if len(x := text[i : max(i, len(text) - j)].strip()) >= 3))
        scored = sorted((*min((reading.osa_distance(x, k), n) for n, x in enumerate(trims)), k) for k in keys)
        (d, n, k), second = min(scored, key=lambda s: (s[0], s[2])), sorted(s[0] for s in scored)[1]
        radius = (min(reading.osa_distance(k, o) for o in keys if o != k) - 1) // 2
        return (k, d, second - d) if d <= min(radius, max(1, int(len(trims[n]) / 4 + 0.5))) else (None, None, None)

    assert got == {x: plain(x) for x in names}
    assert [got[x][0] for x in names] == ["HULK", "LOKI", "MAGIK", "WOLVERINE", "MAGIK", "WOLVERINE", None, None, None]


def test_tasks_grow_with_the_rows_that_are_dealt(spark, monkeypatch):
    """However many lines there are, a task gets a bounded number; the rows stay those of the SQL."""
    from compare import duck_bag, spark_bag
    from conftest import SF
    from quillon.plans import evaluation
    from quillon.sources import shared

    assert shared.dealt(spark.range(10), "id", 5_000 * shared.DEALT).rdd.getNumPartitions() == 5_000
    monkeypatch.setattr(shared, "DEALT", 1_000)
    monkeypatch.setattr(archive, "DEALT", 1_000)
    for module, name in ((archive, "player_entity_matrix"), (archive, "usage_by_era"), (evaluation, "shared_entity_counts"), (evaluation, "sole_shared_entity")):
        found = module.QUERIES[name](spark, SF)
        assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
        assert spark_bag(found) == duck_bag(SF, module.SQL[name])
