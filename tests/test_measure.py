"""Places in sorted groups of any size, against plain sorting."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quillon.operators import measure


def test_ranged_and_ranked_values(spark):
    r = random.Random(8)
    rows = [("hot", float(r.randrange(500))) for _ in range(4_000)] + [(k, float(r.randrange(9))) for k in ("a", None) for _ in range(7)] + [("one", 3.0), ("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "key string, v double").repartition(6)
    groups: dict = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    for place, plain in ((F.floor(F.col("n") / 2), lambda n: n // 2), (F.least(F.col("n") - 1, F.floor(F.lit(0.9) * F.col("n"))), lambda n: min(n - 1, int(0.9 * n))), (F.lit(0), lambda n: 0)):
        expected = {k: sorted(vs)[plain(len(vs))] for k, vs in groups.items()}
        for f in (measure.ranged_value, measure.ranked_value):
            assert {x["key"]: x["m"] for x in f(df, ["key"], "v", place, "m").collect()} == expected
    assert measure.ranged_value(df.where("false"), ["key"], "v", F.lit(0), "m").collect() == []
