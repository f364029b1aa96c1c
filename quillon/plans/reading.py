"""Queries on timed reads, order statistics, accuracy and hashes; events stand for reads,
users for sides, event types for entities, embeddings' signs for perceptual hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.functions.vectorized import osa, osa_distance
from quillon.operators import hashing as hs
from quillon.operators import measure as ms
from quillon.operators import reads as rd
from quillon.operators import text as tx
from quillon.sources.shared import stored


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def reads(spark, d):
    """Reads of users, in whole minutes; errors stand for blanks, the value gives a distance."""
    e = t(spark, d, "events")
    sec = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000)
    return e.select("user_id", "event_id", sec.alias("sec"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("id"), (F.floor(F.col("value")).cast("long") % 5).alias("dist"), "value")


_READS = "r AS (SELECT user_id, event_id, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) AS sec, CASE WHEN event_type != 'error' THEN event_type END AS id, CAST(floor(value) AS BIGINT) % 5 AS dist, value FROM events)"
_BURST = f"{_READS}, l AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec) > 120 THEN 1 ELSE 0 END AS nw FROM r), b AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY user_id ORDER BY sec) AS BIGINT) AS burst FROM l)"
_FOLD = f"{_BURST}, w AS (SELECT *, 0.55::DOUBLE * power(0.8::DOUBLE, dist) AS w FROM b WHERE id IS NOT NULL), g AS (SELECT user_id, id, burst, max(w) AS best, product(1 - w) AS p FROM w GROUP BY ALL), f AS (SELECT user_id, id, count(*) AS bursts, round(1 - product(1 - (best + 0.5 * ((1 - p) - best))), 3) AS confidence FROM g GROUP BY ALL)"


def burst_sessions(spark, d):
    """W1"""
    b = rd.bursts(reads(spark, d), ["user_id"], "sec", 120)
    return b.groupBy("user_id").agg((F.max("burst") + 1).alias("bursts"), F.count("*").alias("reads"))


def longest_run(spark, d):
    """W2 W3"""
    return rd.runs(reads(spark, d), ["user_id"], ["sec", "event_id"], "id")


def folded(spark, d):
    r = rd.bursts(reads(spark, d), ["user_id"], "sec", 120).withColumn("w", rd.weight(F.col("dist")))
    return rd.fold(r, ["user_id"], "id", "w")


def noisy_or_fold(spark, d):
    """A17 A18 A20 F9"""
    return folded(spark, d).select("user_id", "id", "bursts", F.round("confidence", 2).alias("confidence"), "member")


def good_turing_saturation(spark, d):
    """A18 A19"""
    return rd.side_confidence(folded(spark, d), ["user_id"]).select("user_id", "members", F.round("saturation", 3).alias("saturation"))


def attribution_votes(spark, d):
    """A21 J4 Q17"""
    r = reads(spark, d).withColumn("hour", F.floor(F.col("sec") / 60)).select("user_id", "hour", "id", "value")
    return rd.votes(r.where("id in ('click', 'view')").select("user_id", "hour", "value"), r.where("id = 'purchase'").select("user_id", "hour", "value"), ["user_id"], "hour", "value")


def ensemble_resolve(spark, d):
    """A22"""
    r = reads(spark, d).withColumn("day", F.floor(F.col("sec") / 1440))
    return rd.ensemble(r, ["user_id", "day"], "id", "dist", "value")


def zero_read_groups(spark, d):
    """Groups with few hits (a part of A56: no median verdict)."""
    r = reads(spark, d).groupBy("user_id").agg(F.count("*").alias("reads"), F.count_if(F.col("id") == "purchase").alias("hits"), F.min(F.when(F.col("id") == "signup", F.col("sec"))).alias("first_signup"))
    return r.where("hits < 10").select("user_id", "reads", "hits", "first_signup")


def luma_rank(spark, d):
    """W7"""
    best = reads(spark, d).where("id is not null").groupBy("user_id", "id").agg(F.max("value").alias("top"))
    return best.select("user_id", "id", F.rank().over(Window.partitionBy("user_id").orderBy(F.desc("top"))).cast("long").alias("place"))


def far_apart_pair(spark, d):
    """First and last read (a part of W14: no least gap)."""
    return reads(spark, d).groupBy("user_id").agg(F.min("sec").alias("first"), F.max("sec").alias("second"))


def upper_median(spark, d):
    """A23"""
    return ms.ranged_value(t(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", F.floor(F.col("n") / 2), "median")


def floor_quantile(spark, d):
    """A24"""
    return ms.ranged_value(t(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", F.least(F.col("n") - 1, F.floor(F.lit(0.9) * F.col("n"))), "quantile")


def bucket_histogram(spark, d):
    """A35 A57"""
    return t(spark, d, "lineitem").groupBy(ms.bucket(F.col("l_extendedprice"), [1000.0, 5000.0, 20000.0, 50000.0]).alias("bucket")).agg(F.count("*").alias("n"), F.round(F.min("l_extendedprice"), 2).alias("least"))


def judged(spark, d):
    return t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "n_chars", "source"), "doc_id")


def precision_recall(spark, d):
    """A27 A28"""
    return ms.accuracy(judged(spark, d), F.col("n_chars") >= 400, F.col("quality") == 1, "source")


def threshold_sweep(spark, d):
    """Each row meets each threshold of a list that is a parameter."""
    j = judged(spark, d).withColumn("threshold", F.explode(F.array(*(F.lit(x).cast("long") for x in range(0, 2001, 250)))))
    return j.groupBy("threshold").agg(F.count_if(F.col("n_chars") >= F.col("threshold")).alias("accepted"), F.count_if((F.col("n_chars") >= F.col("threshold")) & (F.col("quality") == 1)).alias("correct"))


def rule_sweep(spark, d):
    """Accept rules side by side."""
    rules = {"long": F.col("n_chars") >= 1000, "short": F.col("n_chars") < 1000, "clean": F.col("toxic") == 0, "all": F.lit(True)}
    rows = judged(spark, d).select("quality", F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), v.alias("accept")) for k, v in rules.items()))).alias("r"))
    good = F.col("quality") == 1
    return rows.groupBy("r.rule").agg(F.count_if(F.col("r.accept") & good).alias("correct"), F.count_if(F.col("r.accept") & ~good).alias("wrong"), F.count_if(~F.col("r.accept") & good).alias("missed"))


def wilson_interval(spark, d):
    """A31 A33"""
    c = judged(spark, d).groupBy("source").agg(F.count_if(F.col("quality") == 1).alias("k"), F.count("*").alias("n"))
    low, high = ms.wilson(F.col("k"), F.col("n"))
    return c.select("source", "k", "n", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


def weighted_estimate(spark, d):
    """A32"""
    c = judged(spark, d).groupBy("toxic").agg(F.avg((F.col("quality") == 1).cast("double")).alias("p"), F.count("*").alias("n"))
    return c.agg(F.round(F.sum(F.col("p") * F.col("n")) / F.sum("n"), 6).alias("estimate"))


def stratified_sample(spark, d):
    """A fixed order in place of a shuffle, rounds over sources, a quota each."""
    w = Window.partitionBy("source").orderBy(F.col("doc_id") * 7919 % 10007, "doc_id")
    return t(spark, d, "documents").select("source", "doc_id", F.row_number().over(w).cast("long").alias("round")).where("round <= 5")


def hashes(spark, d):
    return t(spark, d, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), hs.sign_hash(F.col("embedding")).alias("hash"))


_HASH = "h AS (SELECT vec_id, CAST(label AS BIGINT) AS label, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings)"
_MAJORITY = f"{_HASH}, x AS (SELECT label, unnest(bits) AS bit, generate_subscripts(bits, 1) AS i FROM h), m AS (SELECT label, i, CASE WHEN 2 * sum(bit) >= count(*) THEN 1 ELSE 0 END AS bit FROM x GROUP BY ALL), tm AS (SELECT label, list(bit ORDER BY i) AS bits FROM m GROUP BY 1)"
_KEYS = "['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD']"
_NAMES = r"p AS (SELECT trim(regexp_replace(regexp_replace(upper(CASE p_size % 3 WHEN 0 THEN substr(p_type, 2, 1) || substr(p_type, 1, 1) || substr(p_type, 3) WHEN 1 THEN 'J' || p_type ELSE p_type END), '[^A-Z .\-]', '', 'g'), ' +', ' ', 'g')) AS seen FROM part)"
_LED = """h AS (SELECT vec_id, CAST(label AS BIGINT) AS label, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END), '')::BIT AS h FROM embeddings),
  x AS (SELECT label, list({'id': vec_id, 'h': h} ORDER BY vec_id) AS xs FROM h GROUP BY 1),
  l AS (SELECT label, list_reduce(xs, lambda a, x: CASE WHEN len(list_filter(a, lambda y: bit_count(xor(y.h, x.h)) <= 24)) > 0 THEN a ELSE list_append(a, x) END, [xs[1]]) AS ls FROM x),
  g AS (SELECT h.label, vec_id, list_filter(ls, lambda y: bit_count(xor(y.h, h.h)) <= 24)[1].id AS leader FROM h JOIN l USING (label))"""


def majority_hash(spark, d):
    """A25"""
    m = hs.majority(hashes(spark, d), ["label"], "hash")
    return m.select("label", "n", F.bit_count("hash").cast("long").alias("ones"))


def nearest_template(spark, d):
    """J13 F10"""
    h = stored(hashes(spark, d), "hashes")
    near = hs.nearest(h, "hash", hs.majority(h, ["label"], "hash"))
    return near.groupBy("label").agg(F.count_if(F.col("label") == F.col("near_label")).alias("right"), F.sum("dist").alias("dist"), F.sum("margin").alias("margin"))


def hamming_neighbours(spark, d):
    """Distance to the next vector of the label."""
    w = Window.partitionBy("label").orderBy("vec_id")
    return hashes(spark, d).select("vec_id", hs.hamming(F.col("hash"), F.lag("hash").over(w)).alias("dist")).where("dist is not null")


def leader_clusters(spark, d):
    """A26"""
    return hs.leaders(hashes(spark, d), ["label"], "vec_id", "hash", 24).groupBy("label").agg(F.count_distinct("leader").alias("groups"), F.count("*").alias("n"))


def leader_sizes(spark, d):
    """Each label's clusters, the share of its rows in the three largest and the largest one's
    leader (the first where sizes tie); labels of at least twelve rows."""
    sizes = hs.leaders(hashes(spark, d), ["label"], "vec_id", "hash", 24).groupBy("label", "leader").agg(F.count("*").alias("n"))
    placed = sizes.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "leader")))
    g = placed.groupBy("label").agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum(F.when(F.col("place") <= 3, F.col("n"))).alias("top"), F.min_by("leader", "place").alias("largest"))
    return g.where("n >= 12").select("label", "groups", "n", F.round(F.col("top") / F.col("n"), 6).alias("share"), "largest")


def decoded(seen: DataFrame, keys: list[str], lead: int = 3, trail: int = 4) -> DataFrame:
    """seen (distinct names) with key, dist and margin: each key is judged by the best of the
    name's end trims, the nearest key wins, margin is the runner-up's distance less its own. A
    distance beyond the key's radius or a quarter of the trim's length leaves all three null, as
    does a name under three characters. margin is null too where there is one key only."""
    nearest = {k: min((osa_distance(k, o) for o in keys if o != k), default=2 * len(k) + 1) for k in keys}
    listed = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(max(0, (n - 1) // 2)).alias("radius")) for k, n in nearest.items()))
    size = F.char_length("seen")
    trim = lambda i, j: F.trim(F.substring(F.col("seen"), F.lit(i + 1), F.greatest(F.lit(0), size - i - j)))
    trims = F.array_distinct(F.filter(F.array(*(trim(i, j) for i in range(lead + 1) for j in range(trail + 1))), lambda x: F.char_length(x) >= 3))
    # Swaps save at most half of plain edits, so these bound the distance from both sides: a trim, and then
    # a key, that cannot be among the best two is not tried, and up to one edit both agree.
    plain = F.levenshtein("trim", "key").cast("long")
    tried = seen.select("seen", F.posexplode(trims).alias("at", "trim")).select("*", F.inline(listed)).withColumn("plain", plain)
    tried = tried.withColumn("most", F.min("plain").over(Window.partitionBy("seen", "key"))).where(F.ceil(F.col("plain") / 2) <= F.col("most"))
    keys_ = tried.groupBy("seen", "key").agg(F.first("most").alias("most"), F.min(F.ceil(F.col("plain") / 2)).alias("least"))
    bar = keys_.groupBy(F.col("seen").alias("_seen")).agg(F.coalesce(F.get(F.array_sort(F.collect_list("most")), F.lit(1)), F.max("most")).alias("bar"))
    kept = keys_.join(bar, F.col("seen") == F.col("_seen")).where("least <= bar").select("seen", "key")
    tried = tried.join(kept, ["seen", "key"], "left_semi")
    near = tried.where("plain <= 1").withColumn("dist", F.col("plain"))
    tried = near.unionByName(tried.where("plain > 1").withColumn("dist", osa("trim", "key").cast("long")))
    best = tried.groupBy("seen", "key", "radius").agg(F.min(F.struct("dist", "at", F.char_length("trim").alias("len"))).alias("b"))
    ranked = best.groupBy("seen").agg(F.array_sort(F.collect_list(F.struct("b.dist", "key", "radius", "b.len"))).alias("r")).withColumns({"top": F.get("r", F.lit(0)), "next": F.get("r", F.lit(1))})
    within = ranked.where(F.col("top.dist") <= F.least(F.col("top.radius"), F.greatest(F.lit(1), F.floor(F.col("top.len") / 4 + 0.5))))
    return seen.join(within.select("seen", "top.key", "top.dist", (F.col("next.dist") - F.col("top.dist")).alias("margin")), "seen", "left")


def osa_fuzzy_match(spark, d):
    """Distinct corrupted names, each matched to the keys of a fixed list or to none."""
    keys = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    p = t(spark, d, "part")
    bad = F.when(F.col("p_size") % 3 == 0, F.concat(F.substring("p_type", 2, 1), F.substring("p_type", 1, 1), F.expr("substring(p_type, 3)"))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("J"), F.col("p_type"))).otherwise(F.col("p_type"))
    return decoded(p.groupBy(tx.plate(bad).alias("seen")).agg(F.count("*").alias("n")), keys)


SQL = {
    "burst_sessions": f"WITH {_BURST} SELECT user_id, max(burst) + 1 AS bursts, count(*) AS reads FROM b GROUP BY 1",
    "longest_run": f"WITH {_READS}, a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS pos FROM r), s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) - row_number() OVER (PARTITION BY user_id, id ORDER BY sec, event_id) AS run FROM a WHERE id IS NOT NULL), g AS (SELECT user_id, id, run, count(*) AS n, min(pos) AS first FROM s GROUP BY ALL) SELECT user_id, id, max(n) AS longest, min(first) AS first FROM g GROUP BY ALL",
    "noisy_or_fold": f"WITH {_FOLD} SELECT user_id, id, bursts, round(confidence, 2) AS confidence, confidence >= 0.6 AS member FROM f",
    "good_turing_saturation": f"WITH {_FOLD} SELECT user_id, count(*) FILTER (confidence >= 0.6) AS members, round(1 - count(*) FILTER (bursts = 1) / sum(bursts), 3) AS saturation FROM f GROUP BY 1",
    "attribution_votes": f"WITH {_READS}, x AS (SELECT user_id, CAST(floor(sec / 60) AS BIGINT) AS hour, id, value FROM r), rr AS (SELECT user_id, hour, max(value) AS rv FROM x WHERE id = 'purchase' GROUP BY ALL), v AS (SELECT user_id, count(*) AS seconds, CAST(sum(CASE WHEN value > rv THEN 1 WHEN value < rv THEN -1 ELSE 0 END) AS BIGINT) AS votes FROM x LEFT JOIN rr USING (user_id, hour) WHERE id IN ('click', 'view') GROUP BY 1) SELECT *, CASE WHEN votes > 0 THEN 'left' WHEN votes < 0 THEN 'right' END AS decided FROM v",
    "ensemble_resolve": f"WITH {_READS}, x AS (SELECT *, CAST(floor(sec / 1440) AS BIGINT) AS day FROM r), o AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY dist, value DESC, id NULLS FIRST) AS k FROM x), b AS (SELECT user_id, day, id AS best, dist FROM o WHERE k = 1) SELECT user_id, day, best AS value, min(b.dist) AS dist, count(*) FILTER (id = best) AS votes, count(id) AS of FROM x JOIN b USING (user_id, day) GROUP BY ALL",
    "zero_read_groups": f"WITH {_READS} SELECT user_id, count(*) AS reads, count(*) FILTER (id = 'purchase') AS hits, min(sec) FILTER (id = 'signup') AS first_signup FROM r GROUP BY 1 HAVING count(*) FILTER (id = 'purchase') < 10",
    "luma_rank": f"WITH {_READS}, x AS (SELECT user_id, id, max(value) AS top FROM r WHERE id IS NOT NULL GROUP BY ALL) SELECT user_id, id, rank() OVER (PARTITION BY user_id ORDER BY top DESC) AS place FROM x",
    "far_apart_pair": f'WITH {_READS} SELECT user_id, min(sec) AS "first", max(sec) AS "second" FROM r GROUP BY 1',
    "upper_median": "SELECT l_returnflag, list_sort(list(l_extendedprice))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median FROM lineitem GROUP BY 1",
    "floor_quantile": "SELECT l_returnflag, list_sort(list(l_quantity))[least(count(*) - 1, CAST(floor(0.9 * count(*)) AS BIGINT)) + 1] AS quantile FROM lineitem GROUP BY 1",
    "bucket_histogram": "SELECT CAST((l_extendedprice >= 1000)::INT + (l_extendedprice >= 5000)::INT + (l_extendedprice >= 20000)::INT + (l_extendedprice >= 50000)::INT AS BIGINT) AS bucket, count(*) AS n, round(min(l_extendedprice), 2) AS least FROM lineitem GROUP BY 1",
    "precision_recall": "WITH j AS (SELECT source, n_chars >= 400 AS c, quality = 1 AS q FROM labels JOIN documents USING (doc_id)), a AS (SELECT source, count(*) FILTER (c) AS accepted, count(*) FILTER (c AND q) AS correct, count(*) FILTER (q) AS wanted FROM j GROUP BY ROLLUP (source)) SELECT *, round(correct / nullif(accepted, 0), 6) AS precision, round(correct / nullif(wanted, 0), 6) AS recall FROM a",
    "threshold_sweep": "SELECT threshold, count(*) FILTER (n_chars >= threshold) AS accepted, count(*) FILTER (n_chars >= threshold AND quality = 1) AS correct FROM labels JOIN documents USING (doc_id), (SELECT unnest(range(0, 2001, 250)) AS threshold) GROUP BY 1",
    "rule_sweep": " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) FILTER (({v}) AND quality = 1) AS correct, count(*) FILTER (({v}) AND quality != 1) AS wrong, count(*) FILTER (NOT ({v}) AND quality = 1) AS missed FROM labels JOIN documents USING (doc_id)" for k, v in {"long": "n_chars >= 1000", "short": "n_chars < 1000", "clean": "toxic = 0", "all": "true"}.items()),
    "wilson_interval": "WITH c AS (SELECT source, count(*) FILTER (quality = 1) AS k, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1), x AS (SELECT *, k / n AS p, 1.96::DOUBLE AS z FROM c) SELECT source, k, n, round(greatest(0, ((p + z * z / (2 * n)) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)), 6) AS low, round(least(1, ((p + z * z / (2 * n)) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)), 6) AS high FROM x",
    "weighted_estimate": "WITH c AS (SELECT toxic, avg(CAST(quality = 1 AS DOUBLE)) AS p, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1) SELECT round(sum(p * n) / sum(n), 6) AS estimate FROM c",
    "stratified_sample": "WITH x AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id * 7919 % 10007, doc_id) AS round FROM documents) SELECT * FROM x WHERE round <= 5",
    "majority_hash": f"WITH {_MAJORITY} SELECT tm.label, (SELECT count(*) FROM h WHERE h.label = tm.label) AS n, CAST(list_sum(bits) AS BIGINT) AS ones FROM tm",
    "nearest_template": f"WITH {_MAJORITY}, d AS (SELECT vec_id, h.label AS label, tm.label AS tl, list_sum(list_transform(list_zip(h.bits, tm.bits), lambda x: CASE WHEN x[1] != x[2] THEN 1 ELSE 0 END)) AS dist FROM h, tm), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, tl) AS k FROM d) SELECT label, count(*) FILTER (k = 1 AND label = tl) AS right, CAST(sum(dist) FILTER (k = 1) AS BIGINT) AS dist, CAST(sum(dist) FILTER (k = 2) - sum(dist) FILTER (k = 1) AS BIGINT) AS margin FROM k GROUP BY 1",
    "hamming_neighbours": f"WITH {_HASH}, l AS (SELECT vec_id, bits, lag(bits) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM h) SELECT vec_id, CAST(list_sum(list_transform(list_zip(bits, before), lambda x: CASE WHEN x[1] != x[2] THEN 1 ELSE 0 END)) AS BIGINT) AS dist FROM l WHERE before IS NOT NULL",
    "osa_fuzzy_match": f"""WITH {_NAMES}, n AS (SELECT seen, count(*) AS n FROM p GROUP BY 1), k AS (SELECT unnest({_KEYS}) AS key), kr AS (SELECT a.key, greatest(0, (min(damerau_levenshtein(a.key, b.key)) - 1) // 2) AS radius FROM k a JOIN k b ON a.key != b.key GROUP BY 1),
  t AS (SELECT seen, tr, min(i * 5 + j) AS pos FROM (SELECT seen, i, j, trim(substr(seen, CAST(i + 1 AS BIGINT), CAST(greatest(0, length(seen) - i - j) AS BIGINT))) AS tr FROM n, range(4) a(i), range(5) b(j)) WHERE length(tr) >= 3 GROUP BY ALL),
  d AS (SELECT seen, key, radius, min([damerau_levenshtein(tr, key), pos, length(tr)]::BIGINT[]) AS b FROM t, kr GROUP BY ALL),
  r AS (SELECT *, row_number() OVER w AS place, lead(b[1]) OVER w - b[1] AS margin FROM d WINDOW w AS (PARTITION BY seen ORDER BY b[1], key))
  SELECT n.seen, n.n, r.key, r.b[1] AS dist, r.margin FROM n LEFT JOIN r ON r.seen = n.seen AND place = 1 AND r.b[1] <= least(radius, greatest(1, CAST(floor(r.b[3] / 4 + 0.5) AS BIGINT)))""",
    "leader_clusters": f"WITH {_LED} SELECT label, count(DISTINCT leader) AS groups, count(*) AS n FROM g GROUP BY 1",
    "leader_sizes": f"WITH {_LED}, c AS (SELECT label, leader, count(*) AS n FROM g GROUP BY ALL), s AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, leader) - 1 AS place FROM c) SELECT label, count(*) AS groups, CAST(sum(n) AS BIGINT) AS n, round(sum(n) FILTER (place < 3) / sum(n), 6) AS share, arg_min(leader, place) AS largest FROM s GROUP BY 1 HAVING sum(n) >= 12",
}

QUERIES = {name: globals()[name] for name in SQL}
