"""Queries of worklists and of labels under review. Orders stand for videos, the parities of line numbers for
record sides, those of suppliers for screen sides, brands for fighters, lines for reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators import ordering as od
from quillon.operators import ownership as ow
from quillon.sources.shared import stored

#: Members of a full bench.
FULL = 2


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def lines(spark: SparkSession, d: str) -> DataFrame:
    """video, side, line, screen, sec, id, dist and whether the line is on the record."""
    both = _t(spark, d, "lineitem").join(_t(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    screen = F.when(F.col("l_suppkey") % 2 == 0, "L").otherwise("R")
    return both.select(F.col("l_orderkey").alias("video"), (F.col("l_linenumber") % 2).cast("long").alias("side"), (F.col("l_linenumber").cast("long") * 10**9 + F.col("l_partkey")).alias("line"), screen.alias("screen"), (F.col("l_linenumber") * 20 + F.col("l_partkey") % 17).cast("long").alias("sec"), F.col("p_brand").alias("id"), (F.floor("l_quantity") % 3).alias("dist"), (F.col("l_discount") >= 0.03).alias("recorded"))


def titled(rows: DataFrame) -> DataFrame:
    """The entity that a title names on either side: that of the side's first line."""
    return rows.groupBy("video", "side").agg(F.min_by("id", "line").alias("id"))


def bench_owners(spark: SparkSession, d: str) -> DataFrame:
    """Exact reads by the side whose bench alone contains them."""
    rows = lines(spark, d)
    points = rows.where("dist = 0").select("video", "line", "screen", "id")
    return ow.owned(points, rows.select("video", "id", "side"), ["video"], "id", "side").groupBy("screen", "owner").agg(F.count("*").alias("n"))


def screen_sides(spark: SparkSession, d: str) -> DataFrame:
    """The record side of either screen side, by titles and by elimination."""
    rows = lines(spark, d)
    return ow.placed(rows.where("dist = 0"), titled(rows), "video", "id", "screen", "side")


def template_worklist(spark: SparkSession, d: str) -> DataFrame:
    """WL1 W13 J11 A44 O5: videos with two full benches; the middle exact read of either screen side, if one
    bench alone has it; the rest of that bench are the candidates. Rarest candidate first, in a total order."""
    rows = stored(lines(spark, d), "lines")
    benches = rows.groupBy("video", "side").agg(F.array_sort(F.collect_set("id")).alias("bench"))
    full = benches.groupBy("video").agg(F.count_if(F.size("bench") >= FULL).alias("n")).where("n = 2").select("video")
    exact = rows.where("dist = 0").select("video", "screen", "sec", "line", "id").join(full, "video", "left_semi")
    point = ow.owned(od.middle(exact, [F.col("sec"), F.col("line")], ["video", "screen"]), rows.select("video", "id", "side"), ["video"], "id", "side", "side").where("side is not null")
    work = stored(point.join(benches, ["video", "side"]).select("video", "screen", "sec", "id", F.array_remove("bench", F.col("id")).alias("candidates")), "work")
    freq = work.select(F.explode("candidates").alias("c")).groupBy("c").agg(F.count("*").alias("f"))
    rare = work.select("video", "screen", F.explode("candidates").alias("c")).join(freq, "c").groupBy("video", "screen").agg(F.min("f").alias("rarity"))
    out = work.join(rare, ["video", "screen"]).select("video", "screen", "sec", F.col("id").alias("point"), F.array_join("candidates", "|").alias("candidates"), "rarity")
    return od.ordinals(out, [F.col("rarity"), F.col("video"), F.col("screen")], name="place")


def bench_worklist(spark: SparkSession, d: str) -> DataFrame:
    """WL2 U8 J12 WL3 W14 J1: screen sides of videos that are incomplete or broken and not settled, with two seconds
    as far apart as there are, from exact reads if there are two of the side, else from all exact reads, else from any;
    and what a reviewer must be asked."""
    rows = stored(lines(spark, d), "lines")
    title = titled(rows)
    records = rows.groupBy("video", "side").agg(F.collect_set(F.when(F.col("recorded"), F.col("id"))).alias("characters")).join(title, ["video", "side"])
    records = records.withColumn("settled", ow.settled(F.col("characters"), F.array("id"), FULL)).withColumn("full", F.size("characters") >= FULL)
    at = lambda k, c: F.max(F.when(F.col("side") == k, F.col(c)))
    videos = records.groupBy("video").agg(F.count("*").alias("sides"), F.bool_and("full").alias("complete"), F.bool_or(F.col("full") & ~F.col("settled")).alias("broken"), *(at(k, c).alias(f"{c}{k}") for k in (0, 1) for c in ("settled", "full")))
    queued = videos.where("sides = 2 and (not complete or broken)").join(ow.placed(rows.where("dist = 0"), title, "video", "id", "screen", "side"), "video")
    both = queued.select("*", F.inline(F.array(F.struct(F.lit("L").alias("screen"), F.col("left").alias("side_index")), F.struct(F.lit("R").alias("screen"), F.col("right").alias("side_index")))))
    own = lambda c: F.when(F.col("side_index") == 0, F.col(f"{c}0")).when(F.col("side_index") == 1, F.col(f"{c}1"))
    open_ = both.where(~F.coalesce(own("settled"), F.col("settled0") & F.col("settled1"))).select("video", "screen", "side_index", F.coalesce(own("full") & ~own("settled"), F.lit(False)).alias("recheck"))
    pools = rows.groupBy("video").agg(F.count_distinct(F.when(F.col("dist") == 0, F.col("sec"))).alias("n"), *(f(F.when(c, F.col("sec"))).alias(a) for a, f, c in (("c0", F.min, F.col("dist") == 0), ("c1", F.max, F.col("dist") == 0), ("a0", F.min, F.lit(True)), ("a1", F.max, F.lit(True)))))
    mine = rows.where("dist = 0").groupBy("video", "screen").agg(F.count("*").alias("m"), F.min("sec").alias("m0"), F.max("sec").alias("m1"))
    put = open_.join(pools, "video").join(mine, ["video", "screen"], "left")
    pick = lambda k: F.when(F.coalesce("m", F.lit(0)) >= 2, F.col(f"m{k}")).when(F.col("n") >= 2, F.col(f"c{k}")).otherwise(F.col(f"a{k}"))
    put = put.select("video", "screen", "side_index", "recheck", pick(0).alias("first"), pick(1).alias("last")).where("first != last")
    # the point at either second: what the side's exact reads there say
    points = rows.where("dist = 0").groupBy("video", "screen", "sec").agg(F.min_by("id", "line").alias("id"))
    for name in ("first", "last"):
        put = put.join(points.select("video", "screen", F.col("sec").alias(name), F.col("id").alias(f"point_{name}")), ["video", "screen", name], "left")
    return put.select("video", "screen", "side_index", "recheck", "first", "last", F.col("side_index").isNull().alias("needs_side"), (F.col("point_first").isNull() | F.col("point_last").isNull()).alias("needs_point"))


def off_bench(spark: SparkSession, d: str) -> DataFrame:
    """Labels of an entity that is on neither of two full benches, by the side that owns what
    was read at that second (the first read of the screen side there); applied says whether the override, or
    else the record, has it by now."""
    rows = stored(lines(spark, d), "lines")
    l = _t(spark, d, "lineitem")
    labels = l.where("l_partkey % 3 = 0").select(F.col("l_orderkey").alias("video"), (F.col("l_linenumber") * 20 + F.col("l_partkey") % 17).cast("long").alias("sec"), F.when(F.col("l_suppkey") % 2 == 0, "L").otherwise("R").alias("screen"), F.col("l_linenumber").cast("long").alias("cell"), F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 25 + 1).cast("string")).alias("char"))
    full = rows.groupBy("video", "side").agg(F.count_distinct("id").alias("n")).where(F.col("n") >= FULL).groupBy("video").agg(F.count("*").alias("n")).where("n = 2").select("video")
    outside = labels.join(full, "video", "left_semi").join(rows.select("video", F.col("id").alias("char")), ["video", "char"], "left_anti")
    reads = rows.groupBy("video", "screen", "sec").agg(F.min_by("id", "line").alias("id"))
    found = ow.owned(outside.join(reads, ["video", "screen", "sec"]), rows.select("video", "id", "side"), ["video"], "id", "side", "side").where("side is not null")
    # overrides: every seventh video has, for side 1, the label's entity itself if its number is even
    overridden = (F.col("video") % 7 == 0) & (F.col("side") == 1)
    override_has = F.substring("char", 7, 2).cast("int") % 2 == 0
    on_record = rows.where("recorded").select("video", "side", F.col("id").alias("char")).distinct().withColumn("has", F.lit(True))
    out = found.join(on_record, ["video", "side", "char"], "left").select("video", "sec", "screen", "cell", "char", "side", F.when(overridden, override_has).otherwise(F.coalesce("has", F.lit(False))).alias("applied"))
    return out


_LINES = """r AS (SELECT l_orderkey AS video, CAST(l_linenumber % 2 AS BIGINT) AS side, l_linenumber * 1000000000::BIGINT + l_partkey AS line, CASE WHEN l_suppkey % 2 = 0 THEN 'L' ELSE 'R' END AS screen,
  CAST(l_linenumber * 20 + l_partkey % 17 AS BIGINT) AS sec, p_brand AS id, CAST(floor(l_quantity) AS BIGINT) % 3 AS dist, l_discount >= 0.03 AS recorded FROM lineitem JOIN part ON l_partkey = p_partkey),
  b AS (SELECT video, list(DISTINCT id) FILTER (side = 0) AS b0, list(DISTINCT id) FILTER (side = 1) AS b1, [arg_min(id, line) FILTER (side = 0)] AS t0, [arg_min(id, line) FILTER (side = 1)] AS t1,
    coalesce(list(DISTINCT id) FILTER (side = 0 AND recorded), []) AS c0, coalesce(list(DISTINCT id) FILTER (side = 1 AND recorded), []) AS c1, count(DISTINCT side) AS sides FROM r GROUP BY 1)"""
_OWNER = "CASE WHEN list_contains(b0, id) AND NOT coalesce(list_contains(b1, id), false) THEN 0 WHEN list_contains(b1, id) AND NOT coalesce(list_contains(b0, id), false) THEN 1 END"
_PLACED = f"""{_LINES}, ex AS (SELECT video, coalesce(list(id) FILTER (screen = 'L' AND dist = 0), []) AS l, coalesce(list(id) FILTER (screen = 'R' AND dist = 0), []) AS r FROM r GROUP BY 1),
  hit AS (SELECT video, coalesce(list_has_any(l, t0), false) AS l0, coalesce(list_has_any(l, t1), false) AS l1, coalesce(list_has_any(r, t0), false) AS r0, coalesce(list_has_any(r, t1), false) AS r1 FROM ex JOIN b USING (video)),
  one AS (SELECT video, CASE WHEN l0 != l1 THEN l1::BIGINT END AS l, CASE WHEN r0 != r1 THEN r1::BIGINT END AS r FROM hit), pl AS (SELECT video, coalesce(l, 1 - r) AS lft, coalesce(r, 1 - l) AS rgt FROM one)"""

QUERIES = {f.__name__: f for f in (bench_owners, screen_sides, template_worklist, bench_worklist, off_bench)}

SQL = {
    "bench_owners": f"WITH {_LINES} SELECT screen, CAST({_OWNER} AS BIGINT) AS owner, count(*) AS n FROM r JOIN b USING (video) WHERE dist = 0 GROUP BY ALL",
    "screen_sides": f'WITH {_PLACED} SELECT video, lft AS "left", rgt AS "right" FROM pl',
    "template_worklist": f"""WITH {_LINES}, e AS (SELECT * FROM r JOIN b USING (video) WHERE dist = 0 AND len(b0) >= {FULL} AND len(b1) >= {FULL}),
  m AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY video, screen ORDER BY sec, line) - 1 = count(*) OVER (PARTITION BY video, screen) // 2),
  w AS (SELECT video, screen, sec, id AS point, list_sort(list_filter(CASE {_OWNER} WHEN 0 THEN b0 ELSE b1 END, lambda x: x != id)) AS cs FROM m WHERE {_OWNER} IS NOT NULL),
  f AS (SELECT c, count(*) AS f FROM (SELECT unnest(cs) AS c FROM w) GROUP BY 1), x AS (SELECT video, screen, min(f) AS rarity FROM (SELECT video, screen, unnest(cs) AS c FROM w) JOIN f USING (c) GROUP BY ALL)
  SELECT video, screen, sec, point, array_to_string(cs, '|') AS candidates, rarity, row_number() OVER (ORDER BY rarity, video, screen) - 1 AS place FROM w JOIN x USING (video, screen)""",
    "bench_worklist": f"""WITH {_PLACED}, v AS (SELECT *, len(c0) >= {FULL} AS f0, len(c1) >= {FULL} AS f1, list_has_all(c0, t0) AS k0, list_has_all(c1, t1) AS k1 FROM b WHERE sides = 2),
  q AS (SELECT * FROM v JOIN pl USING (video) WHERE NOT (f0 AND f1) OR (f0 AND NOT k0) OR (f1 AND NOT k1)),
  s AS (SELECT *, 'L' AS screen, lft AS si FROM q UNION ALL SELECT *, 'R', rgt FROM q),
  o AS (SELECT *, coalesce(CASE si WHEN 0 THEN f0 AND NOT k0 WHEN 1 THEN f1 AND NOT k1 END, false) AS recheck FROM s WHERE NOT coalesce(CASE si WHEN 0 THEN f0 AND k0 WHEN 1 THEN f1 AND k1 END, f0 AND k0 AND f1 AND k1)),
  p AS (SELECT o.video, o.screen, si, recheck, (SELECT list_sort(list(sec)) FROM r WHERE r.video = o.video AND r.screen = o.screen AND dist = 0) AS mine, (SELECT list_sort(list(DISTINCT sec)) FROM r WHERE r.video = o.video AND dist = 0) AS clean, (SELECT list_sort(list(DISTINCT sec)) FROM r WHERE r.video = o.video) AS every FROM o),
  z AS (SELECT *, CASE WHEN len(mine) >= 2 THEN mine WHEN len(clean) >= 2 THEN clean ELSE every END AS pool FROM p),
  y AS (SELECT *, EXISTS (SELECT 1 FROM r WHERE r.video = z.video AND r.screen = z.screen AND r.sec = pool[1] AND dist = 0) AS p1, EXISTS (SELECT 1 FROM r WHERE r.video = z.video AND r.screen = z.screen AND r.sec = pool[-1] AND dist = 0) AS p2 FROM z WHERE pool[1] != pool[-1])
  SELECT video, screen, si AS side_index, recheck, pool[1] AS first, pool[-1] AS last, si IS NULL AS needs_side, NOT p1 OR NOT p2 AS needs_point FROM y""",
    "off_bench": f"""WITH {_LINES}, l AS (SELECT l_orderkey AS video, CAST(l_linenumber * 20 + l_partkey % 17 AS BIGINT) AS sec, CASE WHEN l_suppkey % 2 = 0 THEN 'L' ELSE 'R' END AS screen, CAST(l_linenumber AS BIGINT) AS cell, 'Brand#' || (l_suppkey % 25 + 1) AS char FROM lineitem WHERE l_partkey % 3 = 0),
  x AS (SELECT l.*, b.*, (SELECT arg_min(r.id, r.line) FROM r WHERE r.video = l.video AND r.screen = l.screen AND r.sec = l.sec) AS id FROM l JOIN b USING (video) WHERE len(b0) >= {FULL} AND len(b1) >= {FULL} AND NOT list_contains(b0, char) AND NOT list_contains(b1, char)),
  y AS (SELECT *, CAST({_OWNER} AS BIGINT) AS owner FROM x WHERE id IS NOT NULL)
  SELECT video, sec, screen, cell, char, owner AS side, CASE WHEN video % 7 = 0 AND owner = 1 THEN CAST(substr(char, 7) AS INT) % 2 = 0 ELSE list_contains(CASE owner WHEN 0 THEN c0 ELSE c1 END, char) END AS applied FROM y WHERE owner IS NOT NULL""",
}
