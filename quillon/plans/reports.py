"""Queries of reports: moments, presence, geometry, rates, densities, orientation, worklists' counters and the
Markdown report. Embeddings' signs stand for hashes, events for reads, lines and their orders for records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.vectorized import nfkd
from quillon.operators import hashing as hs
from quillon.operators import intervals as iv
from quillon.operators import measure as ms
from quillon.operators import moments as mo
from quillon.operators import ordering as od
from quillon.operators import ownership as ow
from quillon.operators import text as tx
from quillon.operators import thinning as th
from quillon.plans.archive import _DAY, _GATE, _SEASON, _WINDOWS, ERAS, PATCHES, gate, orders
from quillon.plans.labels import cosine
from quillon.plans.reading import _MAJORITY, _READS, hashes, reads
from quillon.plans.review import _LINES, _PLACED, lines, titled
from quillon.sources.shared import stored

#: What is added to the variance within classes, so that flat elements score nothing.
STEADY = 0.25
ACTIVE = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def element_scores(spark: SparkSession, d: str) -> DataFrame:
    """For each element its mean, the variance of class means, the mean variance in classes and their ratio."""
    m = mo.element_moments(_t(spark, d, "embeddings").select("label", "embedding"), "label", "embedding")
    by = m.groupBy("element").agg((F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("mean"), F.var_pop("mean").alias("between"), F.avg("variance").alias("within"))
    return by.select("element", F.round("mean", 6).alias("mean"), F.round("between", 6).alias("between"), F.round("within", 6).alias("within"), F.round(F.col("between") / (F.col("within") + STEADY), 6).alias("score"))


def presence(spark: SparkSession, d: str) -> DataFrame:
    """For each class the distances of its hashes to their majority (upper median, 0.9-quantile, shares
    within 24 and beyond 32 bits)."""
    h = hashes(spark, d)
    m = hs.majority(h, ["label"], "hash").select(F.col("label").alias("of"), F.col("hash").alias("mid"))
    far = stored(h.join(m, F.col("label") == F.col("of")).select("label", hs.hamming(F.col("hash"), F.col("mid")).alias("dist")), "distances")
    shares = far.groupBy("label").agg(F.count("*").alias("n"), F.round(F.count_if(F.col("dist") <= 24) / F.count("*"), 6).alias("near"), F.round(F.count_if(F.col("dist") > 32) / F.count("*"), 6).alias("far"))
    return shares.join(ms.upper_median(far, ["label"], "dist"), "label").join(ms.floor_quantile(far, ["label"], "dist", 0.9).withColumnRenamed("quantile", "p90"), "label")


def presence_cut(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of every vector to the mean of all; the upper median is the cut, and of each class the share above it
    counts as drawn."""
    e = _t(spark, d, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), "embedding").withColumn("one", F.lit(1))
    m = mo.element_moments(e, "one", "embedding")
    mean = m.agg(F.array_sort(F.collect_list(F.struct("element", "mean"))).alias("m")).select(F.transform("m", lambda x: x["mean"]).alias("mean"))
    sims = stored(e.crossJoin(F.broadcast(mean)).select("one", "label", F.round(cosine(F.col("embedding"), F.col("mean")), 5).alias("sim")), "similar")
    cut = ms.upper_median(sims, ["one"], "sim").select(F.col("median").alias("cut"))
    return sims.crossJoin(F.broadcast(cut)).groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("sim") > F.col("cut")).alias("drawn"), F.max("cut").alias("cut"))


def zero_read_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Days of users with at least three reads and no purchase among them; the upper median of their
    values decides."""
    r = reads(spark, d).withColumn("day", F.floor(F.col("sec") / 1440))
    none = r.groupBy("user_id", "day").agg(F.count("*").alias("reads"), F.count_if(F.col("id") == "purchase").alias("hits")).where("hits = 0 and reads >= 3").drop("hits")
    med = ms.upper_median(r.join(none, ["user_id", "day"], "left_semi").withColumn("whole", F.floor("value")), ["user_id", "day"], "whole")
    return none.join(med, ["user_id", "day"]).withColumn("verdict", F.when(F.col("median") <= 50, "standard").otherwise("different"))


def geometry_report(spark: SparkSession, d: str) -> DataFrame:
    """How far the two anchors of each record are from mirroring each other: least, upper median,
    0.95-quantile and most, how many are over the tolerance, how many right anchors can be trusted, and the six worst."""
    l = _t(spark, d, "lineitem").select("l_orderkey", F.round("l_tax", 2).alias("left"), F.round(1 - F.col("l_discount"), 2).alias("right"))
    both = ms.upper_median(l, ["l_orderkey"], "left").withColumnRenamed("median", "left").join(ms.upper_median(l, ["l_orderkey"], "right").withColumnRenamed("median", "right"), "l_orderkey")
    rows = stored(both.withColumn("residual", F.round(F.abs(F.col("left") - (1 - F.col("right"))), 6)).withColumn("one", F.lit(1)), "anchors")
    one = lambda df, kind, v: df.select(F.lit(kind).alias("kind"), F.lit(None).cast("bigint").alias("id"), v.cast("double").alias("value"))
    sums = rows.agg(F.min("residual").alias("least"), F.max("residual").alias("most"), F.count_if(F.col("residual") > 0.04).alias("over"), F.count_if(F.col("right").between(0.88, 0.92)).alias("trusted"))
    out = one(sums, "least", F.col("least"))
    for kind in ("most", "over", "trusted"):
        out = out.unionByName(one(sums, kind, F.col(kind)))
    out = out.unionByName(one(ms.upper_median(rows, ["one"], "residual"), "p50", F.col("median"))).unionByName(one(ms.floor_quantile(rows, ["one"], "residual", 0.95), "p95", F.col("quantile")))
    worst = rows.orderBy(F.desc("residual"), "l_orderkey").limit(6)
    return out.unionByName(worst.select(F.lit("worst").alias("kind"), F.col("l_orderkey").alias("id"), F.col("residual").alias("value")))


def resolved_rates(spark: SparkSession, d: str) -> DataFrame:
    """By channel and side and over all of either: reads, exact ones, resolved ones and what the
    difference adds, in points."""
    r = reads(spark, d).select((F.col("user_id") % 5).alias("channel"), (F.col("event_id") % 2).alias("side"), F.coalesce((F.col("dist") == 0) & F.col("id").isNotNull(), F.lit(False)).alias("exact"), F.coalesce((F.col("dist") <= 1) & F.col("id").isNotNull(), F.lit(False)).alias("resolved"))
    c = r.cube("channel", "side").agg(F.count("*").alias("reads"), F.count_if("exact").alias("exact"), F.count_if("resolved").alias("resolved"))
    return c.withColumn("uplift", F.round(100 * (F.col("resolved") - F.col("exact")) / F.col("reads"), 4))


def key_observations(spark: SparkSession, d: str) -> DataFrame:
    """Keys by name (the id where there is none), whether an exact read confirms each, and whether it was seen at all."""
    seen = _t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.max((F.col("l_quantity") == 50).cast("int")).alias("exact"))
    names = _t(spark, d, "nation").where("n_nationkey % 4 != 0").select("n_nationkey", "n_name")
    keys = _t(spark, d, "supplier").join(names, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return keys.join(seen, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", F.coalesce("n_name", F.col("s_nationkey").cast("string")).alias("name"), (F.coalesce("exact", F.lit(0)) == 1).alias("confirmed"), F.col("l_suppkey").isNotNull().alias("seen"))


def read_sets(spark: SparkSession, d: str) -> DataFrame:
    """video, what exact reads saw on either screen side, and what the record's sides hold."""
    rows = lines(spark, d)
    held = lambda c, on: F.coalesce(F.array_sort(F.collect_set(F.when(c, F.col("id")))), F.array().cast("array<string>")).alias(on)
    return rows.groupBy("video").agg(held((F.col("screen") == "L") & (F.col("dist") == 0), "left"), held((F.col("screen") == "R") & (F.col("dist") == 0), "right"), held(F.col("side") == 0, "first"), held(F.col("side") == 1, "second"))


def orientations(spark: SparkSession, d: str) -> DataFrame:
    """Which side the left screen side truly is, by the larger overlap (null where they tie), against
    what titles and elimination say of it."""
    rows = stored(lines(spark, d), "lines")
    said = ow.placed(rows.where("dist = 0"), titled(rows), "video", "id", "screen", "side").select(F.col("video").alias("v"), F.col("left").alias("said"))
    both = lambda a, b: F.size(F.array_intersect(a, b))
    straight = both("left", "first") + both("right", "second")
    crossed = both("left", "second") + both("right", "first")
    true = F.when(straight > crossed, 0).when(straight < crossed, 1).cast("long")
    return read_sets(spark, d).join(said, F.col("video") == F.col("v")).groupBy(true.alias("true"), "said").agg(F.count("*").alias("n"))


def union_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sides by the size of what was read, how many of them are exact, how many of records with both sides
    exact, and how many short ones were read with confidence (no read of the record missed)."""
    s = read_sets(spark, d)
    one, two = F.col("left") == F.col("first"), F.col("right") == F.col("second")
    short = (F.size("left") + F.size("right")) >= 2
    sides = s.select(F.inline(F.array(F.struct(F.size("left").alias("size"), one.alias("exact"), (one & two).alias("both"), short.alias("sure")), F.struct(F.size("right").alias("size"), two.alias("exact"), (one & two).alias("both"), short.alias("sure")))))
    return sides.groupBy("size").agg(F.count("*").alias("sides"), F.count_if("exact").alias("exact"), F.count_if("both").alias("both_exact"), F.count_if(F.col("sure") & (F.col("size") < 2)).alias("tail"))


def plate_densities(spark: SparkSession, d: str) -> DataFrame:
    """Distinct hashes of each class over all reads and over thinned ones (one in four ids): the upper median of
    their numbers, and classes with at least three and at least ten."""
    h = stored(hashes(spark, d), "hashes")
    thin = h.join(th.thinned(h, ["label"], "vec_id", 3), ["label", "vec_id"], "left_semi")
    out = None
    for name, rows in (("all", h), ("spread", thin)):
        groups = stored(hs.leaders(rows, ["label"], "vec_id", "hash", 24).groupBy("label").agg(F.count_distinct("leader").alias("groups")).withColumn("density", F.lit(name)), "groups")
        one = ms.upper_median(groups, ["density"], "groups").join(groups.groupBy("density").agg(F.count_if(F.col("groups") >= 3).alias("three"), F.count_if(F.col("groups") >= 10).alias("ten")), "density")
        out = one if out is None else out.unionByName(one)
    return out


def read_distances(spark: SparkSession, d: str) -> DataFrame:
    """Days of users by the least distance read: 0 to 3, 4 and more, none at all."""
    best = reads(spark, d).groupBy("user_id", F.floor(F.col("sec") / 1440).alias("day")).agg(F.min(F.when(F.col("id").isNotNull(), F.col("dist"))).alias("best"))
    bucket = F.when(F.col("best").isNull(), "none").when(F.col("best") >= 4, "4+").otherwise(F.col("best").cast("string"))
    return best.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def tally(counts: DataFrame, name: str, n: str) -> DataFrame:
    """One row: names with their counts, the most frequent first. Names are few: kinds and reasons."""
    listed = F.array_sort(F.collect_list(F.struct((-F.col(n)).alias("less"), F.col(name).alias("name"))))
    return counts.agg(F.array_join(F.transform(listed, lambda x: F.concat_ws(" ", x["name"], -x["less"])), " · ").alias("tally"))


def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a Markdown report: a row for each source with its share parsed, then the reasons of all misses."""
    g = stored(gate(spark, d).select(F.coalesce("source", F.lit("?")).alias("source"), "reason"), "gated")
    c = g.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("reason").isNull()).alias("parsed"))
    tenths = F.expr("(2000 * parsed + n) div (2 * n)")
    row = F.concat(F.lit("| "), "source", F.lit(" | "), F.col("n").cast("string"), F.lit(" | "), F.col("parsed").cast("string"), F.lit(" | "), F.expr("(2000 * parsed + n) div (2 * n) div 10").cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("% |"))
    head = spark.createDataFrame([(0, "", "# Coverage"), (1, "", "| source | uploads | parsed | share |"), (2, "", "| --- | ---: | ---: | ---: |"), (4, "", "## Misses")], "part int, key string, text string")
    missed = tally(g.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n")), "reason", "n").select(F.lit(5).alias("part"), F.lit("").alias("key"), F.col("tally").alias("text"))
    body = c.select(F.lit(3).alias("part"), F.col("source").alias("key"), row.alias("text"))
    return od.ordinals(head.unionByName(body).unionByName(missed), [F.col("part"), F.col("key")], name="line").select("line", "text")


def player_order(spark: SparkSession, d: str) -> DataFrame:
    """The place of every player by the slug of the name in the order of the root collation."""
    c = _t(spark, d, "customer").select("c_custkey", tx.slug(nfkd("c_name")).alias("slug"))
    return od.ordinals(c, [F.collate(F.col("slug"), "UNICODE"), F.col("c_custkey")], name="place")


def most_used(spark: SparkSession, d: str) -> DataFrame:
    """The eight entities fielded most, the lesser name where they tie."""
    used = _t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).join(_t(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return used.groupBy("p_brand").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "p_brand").limit(8)


def group_closure(spark: SparkSession, d: str) -> DataFrame:
    """V2: orders by token under a filter on a group that has children: the group stands for itself and all of them."""
    windows = iv.patch_windows(spark.createDataFrame([(p,) for p in PATCHES], "version string"), ERAS)
    children = windows.select(F.concat(F.lit("S"), F.col("season").cast("string")).alias("parent"), F.col("version").alias("token"))
    closure = children.where("parent = 'S2'").select("token").unionByName(spark.createDataFrame([("S2",)], "token string"))
    return iv.patch_token(orders(spark, d).select("day", "season"), "day", "season", windows).join(closure, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))


def fetch_worklist(spark: SparkSession, d: str) -> DataFrame:
    """Records of channels that are still fetched, without a read so far, newest first; the first fifty."""
    done = _t(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey").distinct()
    o = _t(spark, d, "orders").where(F.col("o_orderpriority").isin(ACTIVE)).join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    return o.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50).select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").cast("string").alias("day"))


def live_labels(spark: SparkSession, d: str) -> DataFrame:
    """Sampled documents with their snapshot label and what the live read says; a live read counts even where it
    is null, and a document of the unread stratum that has one by now changes its stratum."""
    sample = _t(spark, d, "documents").where("doc_id % 3 = 0").select("doc_id", F.when(F.col("n_chars") >= 400, "read").otherwise("unread").alias("stratum"))
    labels = _t(spark, d, "labels").select("doc_id", F.col("quality").alias("snapshot"))
    live = _t(spark, d, "labels").where("doc_id % 2 = 0").select("doc_id", F.when(F.col("toxic") == 0, F.col("quality")).alias("live"), F.lit(True).alias("is_live"))
    both = sample.join(labels, "doc_id").join(live, "doc_id", "left")
    now = F.coalesce("is_live", F.lit(False))
    return both.select("doc_id", F.when(now & (F.col("stratum") == "unread"), "now-read").otherwise(F.col("stratum")).alias("stratum"), F.when(now, F.col("live")).otherwise(F.col("snapshot")).alias("label"))


def saved_sides(spark: SparkSession, d: str) -> DataFrame:
    """J19 WL6: what was saved for a screen side: by that screen side, else by the record side it is, never another one of the record."""
    rows = stored(lines(spark, d), "lines")
    asked = rows.select("video", "screen").distinct()
    placed = ow.placed(rows.where("dist = 0"), titled(rows), "video", "id", "screen", "side")
    asked = asked.join(placed, "video").select("video", "screen", F.when(F.col("screen") == "L", F.col("left")).otherwise(F.col("right")).alias("side"))
    by_screen = rows.where("video % 3 = 0").groupBy("video", "screen").agg(F.min("id").alias("s"))
    by_side = rows.where("video % 2 = 0").groupBy("video", "side").agg(F.max("id").alias("r"))
    return asked.join(by_screen, ["video", "screen"], "left").join(by_side, ["video", "side"], "left").select("video", "screen", F.coalesce("s", "r").alias("saved"))


_SETS = f"""{_LINES}, x AS (SELECT video, coalesce(list_sort(list(DISTINCT id) FILTER (screen = 'L' AND dist = 0)), []) AS l, coalesce(list_sort(list(DISTINCT id) FILTER (screen = 'R' AND dist = 0)), []) AS r,
  coalesce(list_sort(list(DISTINCT id) FILTER (side = 0)), []) AS f, coalesce(list_sort(list(DISTINCT id) FILTER (side = 1)), []) AS s FROM r GROUP BY 1)"""
_GROUPS = """h AS (SELECT vec_id, CAST(label AS BIGINT) AS label, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END), '')::BIT AS h FROM embeddings),
  ids AS (SELECT label, list(vec_id ORDER BY vec_id) AS v FROM h GROUP BY 1), th AS (SELECT label, unnest(list_reduce(v, lambda a, s: CASE WHEN s > a[-1] + 3 THEN list_append(a, s) ELSE a END, [v[1]])) AS vec_id FROM ids),
  rows AS (SELECT 'all' AS density, * FROM h UNION ALL SELECT 'spread', h.* FROM h JOIN th USING (label, vec_id)),
  xs AS (SELECT density, label, list({'id': vec_id, 'h': h} ORDER BY vec_id) AS xs FROM rows GROUP BY ALL),
  g AS (SELECT density, label, len(list_reduce(xs, lambda a, x: CASE WHEN len(list_filter(a, lambda y: bit_count(xor(y.h, x.h)) <= 24)) > 0 THEN a ELSE list_append(a, x) END, [xs[1]])) AS groups FROM xs)"""
_DIST = f"{_MAJORITY}, d AS (SELECT h.label, list_sum(list_transform(list_zip(h.bits, tm.bits), lambda x: CASE WHEN x[1] != x[2] THEN 1 ELSE 0 END))::BIGINT AS dist FROM h JOIN tm USING (label))"

QUERIES = {f.__name__: f for f in (element_scores, presence, presence_cut, zero_read_verdicts, geometry_report, resolved_rates, key_observations, orientations, union_sizes, plate_densities, read_distances, coverage_report, player_order, most_used, group_closure, fetch_worklist, live_labels, saved_sides)}

SQL = {
    "element_scores": f"""WITH p AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS element FROM embeddings), m AS (SELECT label, element, count(*) AS n, avg(x) AS mean, var_pop(x) AS v FROM p GROUP BY ALL)
  SELECT CAST(element AS INT) AS element, round(sum(mean * n) / sum(n), 6) AS mean, round(var_pop(mean), 6) AS between, round(avg(v), 6) AS within, round(var_pop(mean) / (avg(v) + {STEADY}), 6) AS score FROM m GROUP BY 1""",
    "presence": f"""WITH {_DIST} SELECT label, count(*) AS n, round(count(*) FILTER (dist <= 24) / count(*), 6) AS near, round(count(*) FILTER (dist > 32) / count(*), 6) AS far,
  list_sort(list(dist))[count(*) // 2 + 1] AS median, list_sort(list(dist))[least(count(*) - 1, CAST(floor(0.9 * count(*)) AS BIGINT)) + 1] AS p90 FROM d GROUP BY 1""",
    "presence_cut": """WITH p AS (SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT i, avg(x) AS y FROM p GROUP BY 1),
  s AS (SELECT vec_id, any_value(label) AS label, round(sum(x * y) / sqrt(sum(x * x) * sum(y * y)), 5) AS sim FROM p JOIN m USING (i) GROUP BY 1), c AS (SELECT list_sort(list(sim))[count(*) // 2 + 1] AS cut FROM s)
  SELECT label, count(*) AS n, count(*) FILTER (sim > cut) AS drawn, any_value(cut) AS cut FROM s, c GROUP BY 1""",
    "zero_read_verdicts": f"""WITH {_READS}, x AS (SELECT user_id, CAST(floor(sec / 1440) AS BIGINT) AS day, count(*) AS reads, list_sort(list(CAST(floor(value) AS BIGINT)))[count(*) // 2 + 1] AS median FROM r GROUP BY ALL HAVING count(*) FILTER (id = 'purchase') = 0 AND count(*) >= 3)
  SELECT *, CASE WHEN median <= 50 THEN 'standard' ELSE 'different' END AS verdict FROM x""",
    "geometry_report": """WITH l AS (SELECT l_orderkey, list_sort(list(round(l_tax, 2)))[count(*) // 2 + 1] AS a, list_sort(list(round(1 - l_discount, 2)))[count(*) // 2 + 1] AS b FROM lineitem GROUP BY 1), r AS (SELECT *, round(abs(a - (1 - b)), 6) AS residual FROM l),
  s AS (SELECT min(residual) AS lo, max(residual) AS hi, count(*) FILTER (residual > 0.04) AS over, count(*) FILTER (b BETWEEN 0.88 AND 0.92) AS trusted, list_sort(list(residual)) AS q, count(*) AS n FROM r)
  SELECT k AS kind, NULL::BIGINT AS id, v AS value FROM s, LATERAL (VALUES ('least', lo), ('most', hi), ('over', over::DOUBLE), ('trusted', trusted::DOUBLE), ('p50', q[n // 2 + 1]), ('p95', q[least(n - 1, CAST(floor(0.95 * n) AS BIGINT)) + 1])) t(k, v)
  UNION ALL (SELECT 'worst', l_orderkey, residual FROM r ORDER BY residual DESC, l_orderkey LIMIT 6)""",
    "resolved_rates": f"""WITH {_READS}, x AS (SELECT user_id % 5 AS channel, event_id % 2 AS side, dist = 0 AND id IS NOT NULL AS e, dist <= 1 AND id IS NOT NULL AS s FROM r)
  SELECT channel, side, count(*) AS reads, count(*) FILTER (e) AS exact, count(*) FILTER (s) AS resolved, round(100 * (count(*) FILTER (s) - count(*) FILTER (e)) / count(*), 4) AS uplift FROM x GROUP BY CUBE (channel, side)""",
    "key_observations": """SELECT s_suppkey, coalesce((SELECT n_name FROM nation WHERE n_nationkey = s_nationkey AND n_nationkey % 4 != 0), s_nationkey::VARCHAR) AS name,
  EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity = 50) AS confirmed, EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey) AS seen FROM supplier""",
    "orientations": f"""WITH {_PLACED}, x AS (SELECT video, coalesce(list(DISTINCT id) FILTER (screen = 'L' AND dist = 0), []) AS l, coalesce(list(DISTINCT id) FILTER (screen = 'R' AND dist = 0), []) AS r, coalesce(list(DISTINCT id) FILTER (side = 0), []) AS f, coalesce(list(DISTINCT id) FILTER (side = 1), []) AS s FROM r GROUP BY 1),
  y AS (SELECT video, len(list_intersect(l, f)) + len(list_intersect(r, s)) AS st, len(list_intersect(l, s)) + len(list_intersect(r, f)) AS cr FROM x)
  SELECT CAST(CASE WHEN st > cr THEN 0 WHEN st < cr THEN 1 END AS BIGINT) AS "true", lft AS said, count(*) AS n FROM y JOIN pl USING (video) GROUP BY ALL""",
    "union_sizes": f"""WITH {_SETS}, z AS (SELECT len(l) AS size, l = f AS e, l = f AND r = s AS b, len(l) + len(r) >= 2 AS sure FROM x UNION ALL SELECT len(r), r = s, l = f AND r = s, len(l) + len(r) >= 2 FROM x)
  SELECT CAST(size AS INT) AS size, count(*) AS sides, count(*) FILTER (e) AS exact, count(*) FILTER (b) AS both_exact, count(*) FILTER (sure AND size < 2) AS tail FROM z GROUP BY 1""",
    "plate_densities": f"WITH {_GROUPS} SELECT density, list_sort(list(groups))[count(*) // 2 + 1] AS median, count(*) FILTER (groups >= 3) AS three, count(*) FILTER (groups >= 10) AS ten FROM g GROUP BY 1",
    "read_distances": f"""WITH {_READS}, x AS (SELECT user_id, floor(sec / 1440) AS day, min(dist) FILTER (id IS NOT NULL) AS best FROM r GROUP BY ALL)
  SELECT CASE WHEN best IS NULL THEN 'none' WHEN best >= 4 THEN '4+' ELSE best::VARCHAR END AS bucket, count(*) AS n FROM x GROUP BY 1""",
    "coverage_report": f"""WITH g AS (SELECT coalesce(source, '?') AS source, {_GATE} AS reason FROM documents), c AS (SELECT source, count(*) AS n, count(*) FILTER (reason IS NULL) AS parsed FROM g GROUP BY 1), m AS (SELECT reason, count(*) AS n FROM g WHERE reason IS NOT NULL GROUP BY 1),
  x AS (SELECT * FROM (VALUES (0, '', '# Coverage'), (1, '', '| source | uploads | parsed | share |'), (2, '', '| --- | ---: | ---: | ---: |'), (4, '', '## Misses')) t(part, key, text)
    UNION ALL SELECT 3, source, '| ' || source || ' | ' || n || ' | ' || parsed || ' | ' || ((2000 * parsed + n) // (2 * n)) // 10 || '.' || ((2000 * parsed + n) // (2 * n)) % 10 || '% |' FROM c
    UNION ALL SELECT 5, '', (SELECT string_agg(reason || ' ' || n, ' · ' ORDER BY n DESC, reason) FROM m))
  SELECT row_number() OVER (ORDER BY part, key) - 1 AS line, text FROM x""",
    "player_order": "WITH c AS (SELECT c_custkey, regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM customer) SELECT *, row_number() OVER (ORDER BY slug, c_custkey) - 1 AS place FROM c",
    "most_used": "SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 8",
    "group_closure": f"""WITH {_WINDOWS}, o AS (SELECT {_DAY} AS day, {_SEASON} AS season FROM orders), k AS (SELECT CASE WHEN w.season = o.season THEN version ELSE concat('S', o.season) END AS token FROM o LEFT JOIN w ON day >= s AND (e IS NULL OR day < e))
  SELECT token, count(*) AS n FROM k WHERE token = 'S2' OR token IN (SELECT version FROM w WHERE season = 2) GROUP BY 1""",
    "fetch_worklist": "SELECT o_orderkey, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ORDER BY o_orderdate DESC, o_orderkey LIMIT 50",
    "live_labels": """SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 AND n_chars < 400 THEN 'now-read' WHEN n_chars >= 400 THEN 'read' ELSE 'unread' END AS stratum,
  CASE WHEN d.doc_id % 2 = 0 THEN CASE WHEN toxic = 0 THEN quality END ELSE quality END AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id % 3 = 0""",
    "saved_sides": f"""WITH {_PLACED}, a AS (SELECT DISTINCT video, screen, CASE screen WHEN 'L' THEN lft ELSE rgt END AS si FROM r JOIN pl USING (video))
  SELECT video, screen, coalesce((SELECT min(id) FROM r WHERE r.video = a.video AND r.screen = a.screen AND r.video % 3 = 0), (SELECT max(id) FROM r WHERE r.video = a.video AND r.side = a.si AND r.video % 2 = 0)) AS saved FROM a""",
}
