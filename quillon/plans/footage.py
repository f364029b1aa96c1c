"""Queries that choose among timed reads: thinning, peaks, places, turns and shuffles. Events stand for
reads, users for videos, orders for records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.operators import ordering as od
from quillon.operators import thinning as th
from quillon.plans.reading import _READS, reads

SEED = 20260816


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def thinned_reads(spark: SparkSession, d: str) -> DataFrame:
    """Of each user's exact reads the first six of those that are over 2000 minutes from every kept one."""
    exact = reads(spark, d).where("id is not null and dist = 0")
    return th.first_thinned(exact, ["user_id"], "sec", 2000, 6)


def spread_reads(spark: SparkSession, d: str) -> DataFrame:
    """Of all reads of a kind, a hot key, one each four minutes after the last kept one: how many, first and last."""
    kept = th.thinned(reads(spark, d).select(F.coalesce("id", F.lit("blank")).alias("id"), "sec"), ["id"], "sec", 3)
    return kept.groupBy("id").agg(F.count("*").alias("kept"), F.sum("sec").alias("total"), F.min("sec").alias("first"), F.max("sec").alias("last"))


def top_peaks(spark: SparkSession, d: str) -> DataFrame:
    """The six highest values of each kind of event, a day or more apart."""
    return th.peaks(reads(spark, d).where("id is not null"), ["id"], "sec", "value", 1440, 6)


def middle_read(spark: SparkSession, d: str) -> DataFrame:
    """The middle one of each user's exact reads."""
    exact = reads(spark, d).where("id is not null and dist = 0").select("user_id", "sec", "event_id", "id")
    return od.middle(exact, [F.col("sec"), F.col("event_id")], ["user_id"])


def systematic_sample(spark: SparkSession, d: str) -> DataFrame:
    """Twenty reads of each kind, at even steps through its order."""
    some = reads(spark, d).where("id is not null").select("id", "sec", "event_id")
    return od.systematic(some, [F.col("sec"), F.col("event_id")], ["id"], 20)


def top_per_group(spark: SparkSession, d: str) -> DataFrame:
    """The three dearest orders of each customer, the lower key where prices tie."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return _t(spark, d, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).cast("long").alias("place")).where("place <= 3")


def newest_first(spark: SparkSession, d: str) -> DataFrame:
    """O1: the place of each record, newest first, then by source and by the record's own number."""
    o = _t(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderpriority")
    placed = od.ordinals(o, [F.col("at").desc(), F.col("o_orderpriority"), F.col("o_orderkey")], name="place")
    return placed.select("o_orderkey", "place")


def taken_in_turn(spark: SparkSession, d: str) -> DataFrame:
    """Sources in turn, languages in turn within a source."""
    docs = _t(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("?")).alias("source"), F.coalesce("lang", F.lit("?")).alias("lang"))
    return od.interleaved(docs, "source", "lang", [F.col("doc_id")])


def seeded_shuffle(spark: SparkSession, d: str) -> DataFrame:
    """All documents in the order of a shuffle with a recorded seed."""
    return od.shuffled(_t(spark, d, "documents").select("doc_id"), [F.col("doc_id")], SEED)


def runner_up_margin(spark: SparkSession, d: str) -> DataFrame:
    """For each user and day, how much the best other id is worse than the best id; null without another."""
    r = reads(spark, d).where("id is not null").groupBy("user_id", F.floor(F.col("sec") / 1440).alias("day"), "id").agg(F.min("dist").alias("dist"))
    return r.groupBy("user_id", "day").agg(F.array_sort(F.collect_list(F.struct("dist", "id"))).alias("r")).select("user_id", "day", F.col("r")[0]["id"].alias("best"), F.col("r")[0]["dist"].alias("dist"), (F.get("r", F.lit(1))["dist"] - F.col("r")[0]["dist"]).alias("margin"))


def legible_pool(spark: SparkSession, d: str) -> DataFrame:
    """WL4 W14: for each user and day, how many seconds have an exact read, or how many there are at all
    where fewer than two have one, and the first and the last of these."""
    r = reads(spark, d).withColumn("day", F.floor(F.col("sec") / 1440)).groupBy("user_id", "day", "sec").agg(F.max(((F.col("dist") == 0) & F.col("id").isNotNull()).cast("int")).alias("clean"))
    out = r.groupBy("user_id", "day").agg(*(f.alias(n) for n, f in (("clean", F.sum("clean")), ("every", F.count("*")), ("c0", F.min(F.when(F.col("clean") == 1, F.col("sec")))), ("c1", F.max(F.when(F.col("clean") == 1, F.col("sec")))), ("a0", F.min("sec")), ("a1", F.max("sec")))))
    pick = lambda one, two: F.when(F.col("clean") >= 2, F.col(one)).otherwise(F.col(two))
    return out.select("user_id", "day", pick("clean", "every").alias("seconds"), pick("c0", "a0").alias("first"), pick("c1", "a1").alias("last")).where("first != last")


def earliest_within(spark: SparkSession, d: str) -> DataFrame:
    """Each user's first purchase within 2880 minutes of the first read of all, null for none."""
    r = reads(spark, d)
    start = r.agg(F.min("sec").alias("start"))
    return r.crossJoin(F.broadcast(start)).groupBy("user_id").agg(F.min(F.when((F.col("id") == "purchase") & (F.col("sec") - F.col("start") <= 2880), F.col("sec"))).alias("first"))


def expected_rank(spark: SparkSession, d: str) -> DataFrame:
    """Kinds ranked by how often the user has them; the place (from 0) of the first that is expected."""
    n = reads(spark, d).where("id is not null").groupBy("user_id", "id").agg(F.count("*").alias("n"))
    ranked = n.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "id"))), lambda x: x["id"]).alias("r"))
    places = F.filter(F.array(F.array_position("r", "purchase"), F.array_position("r", "signup")), lambda x: x > 0)
    return ranked.select("user_id", (F.array_min(places) - 1).alias("rank"))


_EXACT = f"{_READS}, x AS (SELECT DISTINCT user_id, sec FROM r WHERE id IS NOT NULL AND dist = 0)"
_U32 = 4294967296


def _mul(x: str, y: str) -> str:
    return f"(({x})::HUGEINT * ({y})::HUGEINT % {_U32})::BIGINT"


def shuffle_sql(rows: str, seed: int) -> str:
    """CTEs, the last of them w (doc_id, place): the rows (doc_id) after the swaps, one after the other."""
    return f"""src AS ({rows}), n AS (SELECT count(*) AS n FROM src),
  d0 AS (SELECT i, ({seed} + i::HUGEINT * {od.STEP}) % {_U32} AS a FROM n, range(1, n.n) t(i)),
  d1 AS (SELECT i, {_mul('xor(a::BIGINT, a::BIGINT >> 15)', '(a::BIGINT | 1)')} AS t FROM d0),
  d2 AS (SELECT i, xor((t + {_mul('xor(t, t >> 7)', '(t | 61)')}) % {_U32}, t) AS t FROM d1),
  u AS (SELECT i, xor(t, t >> 14)::DOUBLE / {_U32} AS u FROM d2),
  s AS (SELECT (SELECT n FROM n) - i AS i, CAST(floor(u * ((SELECT n FROM n) - i + 1)) AS BIGINT) AS j FROM u),
  sw AS (SELECT (SELECT n FROM n) - 1 AS i, (SELECT list(doc_id ORDER BY doc_id) FROM src) AS a
    UNION ALL SELECT sw.i - 1, list_concat(a[:s.j], [a[sw.i + 1]], a[s.j + 2:sw.i], CASE WHEN s.j < sw.i THEN [a[s.j + 1]] ELSE [] END, a[sw.i + 2:]) FROM sw JOIN s ON s.i = sw.i),
  w AS (SELECT unnest(a) AS doc_id, generate_subscripts(a, 1) - 1 AS place FROM sw WHERE i = 0)"""


QUERIES = {f.__name__: f for f in (thinned_reads, spread_reads, top_peaks, middle_read, systematic_sample, top_per_group, newest_first, taken_in_turn, seeded_shuffle, runner_up_margin, legible_pool, earliest_within, expected_rank)}

SQL = {
    "thinned_reads": f"""WITH RECURSIVE {_EXACT}, k AS (SELECT user_id, min(sec) AS sec, 0 AS place FROM x GROUP BY 1
  UNION ALL SELECT k.user_id, (SELECT min(x.sec) FROM x WHERE x.user_id = k.user_id AND x.sec > k.sec + 2000), place + 1 FROM k WHERE place < 5 AND k.sec IS NOT NULL)
  SELECT user_id, sec, place FROM k WHERE sec IS NOT NULL""",
    "spread_reads": f"""WITH {_READS}, x AS (SELECT DISTINCT coalesce(id, 'blank') AS id, sec FROM r), l AS (SELECT id, list(sec ORDER BY sec) AS secs FROM x GROUP BY 1),
  f AS (SELECT id, list_reduce(secs, lambda a, s: CASE WHEN s > a[-1] + 3 THEN list_append(a, s) ELSE a END, [secs[1]]) AS k FROM l)
  SELECT id, len(k) AS kept, list_sum(k)::BIGINT AS total, k[1] AS first, k[-1] AS last FROM f""",
    "top_peaks": f"""WITH RECURSIVE {_READS}, h AS (SELECT id, sec, max(value) AS value FROM r WHERE id IS NOT NULL AND value > 0 GROUP BY ALL),
  k AS (SELECT id, [arg_max(sec, (value, -sec))] AS picks, 1 AS n FROM h GROUP BY id
  UNION ALL SELECT k.id, list_append(k.picks, (SELECT arg_max(h.sec, (h.value, -h.sec)) FROM h WHERE h.id = k.id AND list_min(list_transform(k.picks, lambda p: abs(p - h.sec))) >= 1440)), n + 1 FROM k WHERE n < 6),
  p AS (SELECT id, unnest(picks) AS sec FROM k WHERE n = 6) SELECT p.id, p.sec, h.value FROM p JOIN h USING (id, sec)""",
    "middle_read": f"WITH {_READS} SELECT user_id, sec, event_id, id FROM r WHERE id IS NOT NULL AND dist = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) - 1 = count(*) OVER (PARTITION BY user_id) // 2",
    "systematic_sample": f"""WITH {_READS}, x AS (SELECT id, sec, event_id, row_number() OVER (PARTITION BY id ORDER BY sec, event_id) - 1 AS p, greatest(1, count(*) OVER (PARTITION BY id) // 20) AS step FROM r WHERE id IS NOT NULL)
  SELECT id, sec, event_id FROM x WHERE p % step = 0 AND p < 20 * step""",
    "top_per_group": "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders QUALIFY place <= 3",
    "newest_first": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey) - 1 AS place FROM orders",
    "taken_in_turn": """WITH x AS (SELECT doc_id, coalesce(source, '?') AS source, coalesce(lang, '?') AS lang FROM documents), y AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS t FROM x),
  z AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY t, lang, doc_id) AS m FROM y) SELECT doc_id, source, lang, row_number() OVER (ORDER BY m, source) - 1 AS place FROM z""",
    "seeded_shuffle": f"WITH RECURSIVE {shuffle_sql('SELECT doc_id FROM documents', SEED)} SELECT doc_id, place FROM w",
    "runner_up_margin": f"""WITH {_READS}, x AS (SELECT user_id, CAST(floor(sec / 1440) AS BIGINT) AS day, id, min(dist) AS dist FROM r WHERE id IS NOT NULL GROUP BY ALL),
  y AS (SELECT *, row_number() OVER w AS k, lead(dist) OVER w - dist AS margin FROM x WINDOW w AS (PARTITION BY user_id, day ORDER BY dist, id)) SELECT user_id, day, id AS best, dist, margin FROM y WHERE k = 1""",
    "legible_pool": f"""WITH {_READS}, x AS (SELECT user_id, CAST(floor(sec / 1440) AS BIGINT) AS day, sec, bool_or(dist = 0 AND id IS NOT NULL) AS clean FROM r GROUP BY ALL),
  y AS (SELECT *, count(*) FILTER (clean) OVER (PARTITION BY user_id, day) >= 2 AS strict FROM x)
  SELECT user_id, day, count(*) AS seconds, min(sec) AS first, max(sec) AS last FROM y WHERE clean OR NOT strict GROUP BY ALL HAVING min(sec) != max(sec)""",
    "earliest_within": f"WITH {_READS} SELECT user_id, min(sec) FILTER (id = 'purchase' AND sec - (SELECT min(sec) FROM r) <= 2880) AS first FROM r GROUP BY 1",
    "expected_rank": f"""WITH {_READS}, n AS (SELECT user_id, id, count(*) AS n FROM r WHERE id IS NOT NULL GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, id) - 1 AS k FROM n)
  SELECT user_id, min(k) FILTER (id IN ('purchase', 'signup')) AS rank FROM k GROUP BY 1""",
}
