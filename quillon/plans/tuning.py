"""Queries that choose descriptors and readers: grids, refits, closeness, viability, anchors, colours and gaps, and the
samples and audits around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.functions.vectorized import osa
from quillon.operators import gates as gt
from quillon.operators import hashing as hs
from quillon.operators import measure as ms
from quillon.operators import ordering as od
from quillon.operators import pairs as pr
from quillon.operators import reach as rc
from quillon.operators import reads as rd
from quillon.operators import text as tx
from quillon.operators import thinning as th
from quillon.plans.archive import SQL as DUPES
from quillon.plans.archive import dupe_token_set_pairs
from quillon.plans.footage import shuffle_sql
from quillon.plans.reading import _KEYS, _NAMES, _READS, reads
from quillon.sources.shared import stored

RADIUS, BITS = 7, 32
KEYS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
CUTS = [-0.05, -0.02, 0.0, 0.02, 0.05]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def short_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of the first BITS elements, with label and video."""
    e = _t(spark, d, "embeddings")
    return e.select("vec_id", (F.col("vec_id") % 41).alias("video"), F.col("label").cast("long").alias("label"), hs.sign_hash(F.slice("embedding", 1, BITS)).alias("hash"))


def close_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of hashes within reach, by distance."""
    return rc.close_distances(short_hashes(spark, d), "hash", RADIUS)


def stable_minus_leaky(spark: SparkSession, d: str) -> DataFrame:
    """The share of pairs within reach among those of one label and video, less that among those of
    different videos. All pairs are counted, none is made but the close ones of hashes."""
    h = stored(short_hashes(spark, d), "hashes")
    pairs = pr.mean_distances(h, "video", "label", "hash").agg(F.sum(F.when(F.col("kind") == "same label, one video", F.col("pairs"))).alias("same"), F.sum(F.when(F.col("kind").endswith("two videos"), F.col("pairs"))).alias("cross"))
    both = rc.close_kinds(h, "video", "label", "hash", RADIUS).crossJoin(pairs)
    share = lambda n, of_: F.coalesce(F.try_divide(n, of_), F.lit(0.0))
    leaky = F.col("every") - F.col("inside")
    return both.select("stable", "same", leaky.alias("leaky"), "cross", F.round(share(F.col("stable"), F.col("same")) - share(leaky, F.col("cross")), 9).alias("score"))


def labelled_votes(spark: SparkSession, d: str) -> DataFrame:
    """Labels of crops from sides that share exactly one member and look alike."""
    e = stored(short_hashes(spark, d), "hashes")
    k, label = F.col("vec_id"), F.col("label")
    reps = e.withColumn("members", F.array(label, (label + k % 3 + 1) % 10, (k * 7) % 10))
    return rc.near_votes(reps, "vec_id", "video", "hash", "members", RADIUS).withColumnRenamed("id", "vec_id")


def descriptor_grid(spark: SparkSession, d: str) -> DataFrame:
    """How well each of a grid of descriptors (cut points of the signs) keeps labels apart in different
    videos, best first."""
    e = _t(spark, d, "embeddings").select((F.col("vec_id") % 41).alias("video"), F.col("label").cast("long").alias("label"), "embedding")
    out = None
    for cut in CUTS:
        h = e.select("video", "label", hs.sign_hash(F.transform("embedding", lambda x: x - F.lit(cut))).alias("hash"))
        m = pr.mean_distances(h, "video", "label", "hash")
        one = m.agg(F.max(F.when(F.col("kind") == "same label, two videos", F.col("mean"))).alias("within"), F.max(F.when(F.col("kind") == "other label, two videos", F.col("mean"))).alias("between")).withColumn("cut", F.lit(cut))
        out = one if out is None else out.unionByName(one)
    scored = out.select("cut", F.round("within", 6).alias("within"), F.round("between", 6).alias("between"), F.round(F.col("between") - F.col("within"), 6).alias("apart"))
    return od.ordinals(scored, [F.col("apart").desc(), F.col("cut")], name="place")


def ocr_viability(spark: SparkSession, d: str) -> DataFrame:
    """Of the distinct names, how many are a key as they are, within two edits of one, or blank, and whether that
    is at least 60 in 100. No budget: the least distance over all keys counts."""
    p = _t(spark, d, "part")
    bad = F.when(F.col("p_size") % 3 == 0, F.concat(F.substring("p_type", 2, 1), F.substring("p_type", 1, 1), F.expr("substring(p_type, 3)"))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("J"), F.col("p_type"))).otherwise(F.col("p_type"))
    seen = p.groupBy(tx.plate(bad).alias("seen")).agg(F.count("*").alias("n"))
    tried = seen.select("seen", "n", F.explode(F.array(*map(F.lit, KEYS))).alias("key")).withColumn("plain", F.levenshtein("seen", "key"))
    tried = tried.withColumn("most", F.min("plain").over(Window.partitionBy("seen"))).where(F.ceil(F.col("plain") / 2) <= F.col("most"))
    best = tried.groupBy("seen", "n").agg(F.min(osa("seen", "key")).alias("dist"))
    c = best.agg(F.sum("n").alias("plates"), *(F.coalesce(F.sum(F.when(w, F.col("n"))), F.lit(0)).alias(a) for a, w in (("exact", F.col("dist") == 0), ("within_two", F.col("dist").between(1, 2)), ("blank", F.col("seen") == ""))))
    return c.withColumn("viable", 10 * (F.col("exact") + F.col("within_two")) >= 6 * F.col("plates"))


def radius_table(spark: SparkSession, d: str) -> DataFrame:
    """Keys by radius, half of the distance to the next other key rounded down, and the least such distance."""
    keys = _t(spark, d, "part").select(tx.plate(F.concat_ws(" ", "p_type", F.substring("p_name", 1, 3))).alias("key")).distinct()
    other = keys.select(F.col("key").alias("other"))
    # the key table is checked: pairs of at most a thousand keys
    n = keys.count()
    if n > 1_000:
        raise ValueError("over 1000 keys")
    both = keys.join(F.broadcast(other), F.col("key") != F.col("other")).withColumn("plain", F.levenshtein("key", "other"))
    both = both.withColumn("most", F.min("plain").over(Window.partitionBy("key"))).where(F.ceil(F.col("plain") / 2) <= F.col("most"))
    nearest = both.groupBy("key").agg(F.min(osa("key", "other")).cast("long").alias("nearest"))
    return nearest.groupBy(F.greatest(F.lit(0), F.floor((F.col("nearest") - 1) / 2)).alias("radius")).agg(F.count("*").alias("keys"), F.min("nearest").alias("least"))


def anchor_scores(spark: SparkSession, d: str) -> DataFrame:
    """Two anchors (parities) by side (return flags): lines, exact ones, ones within two, the drift of
    the control and which anchor wins a side."""
    l = _t(spark, d, "lineitem").select((F.col("l_partkey") % 2).alias("anchor"), F.col("l_returnflag").alias("side"), F.floor(F.col("l_quantity") % 7).alias("dist"))
    c = l.groupBy("side").agg(*(F.count_if((F.col("anchor") == a) & w).alias(f"{n}_{a}") for a in (0, 1) for n, w in (("n", F.lit(True)), ("exact", F.col("dist") == 0), ("near", F.col("dist") <= 2))))
    rate = lambda a: F.try_divide(F.col(f"near_{a}"), F.col(f"n_{a}"))
    return c.select("*", F.round(rate(0) - rate(1), 6).alias("drift"), F.when(rate(0) > rate(1), 0).when(rate(1) > rate(0), 1).alias("winner"))


def state_gaps(spark: SparkSession, d: str) -> DataFrame:
    """By label, the gap between the most and the least of three cells of each crop (first, middle and last element):
    upper median, tenth and ninetieth of a hundred, and the share of crops whose first cell is the most."""
    e = _t(spark, d, "embeddings").select("label", F.array(*(F.round(F.col("embedding")[i].cast("double"), 4) for i in (0, 31, 63))).alias("cells"))
    g = stored(e.select("label", F.round(F.array_max("cells") - F.array_min("cells"), 4).alias("gap"), (F.array_position("cells", F.array_max("cells")) == 1).alias("first")), "gaps")
    out = g.groupBy("label").agg(F.count("*").alias("n"), F.round(F.count_if("first") / F.count("*"), 6).alias("first"))
    out = out.join(ms.upper_median(g, ["label"], "gap"), "label")
    for name, p in (("p10", 0.1), ("p90", 0.9)):
        out = out.join(ms.floor_quantile(g, ["label"], "gap", p).withColumnRenamed("quantile", name), "label")
    return out


def colour_bin(red, green, blue):
    """Bin 0 to 11 of the hue, or 12 for a colour with little of it, of three numbers up to 255."""
    most, least = F.greatest(red, green, blue), F.least(red, green, blue)
    span = most - least
    sixth = F.when(most == red, F.pmod((green - blue) / span, F.lit(6.0))).when(most == green, (blue - red) / span + 2).otherwise((red - green) / span + 4)
    return F.when((most == 0) | (span * 5 < most), 12).otherwise(F.floor(sixth * 2).cast("int"))


def colour_descriptors(spark: SparkSession, d: str) -> DataFrame:
    """shares of hue bins and of achromatic pixels; parts of a size stand for a crop's pixels."""
    x = F.col("p_partkey").cast("bigint") * 2654435 % 16777216
    part = lambda n: (F.floor(x / n) % 256).cast("double")
    pixels = _t(spark, d, "part").select("p_size", colour_bin(part(65536), part(256), part(1)).alias("bin"))
    n = pixels.groupBy("p_size", "bin").agg(F.count("*").alias("n"))
    return n.select("p_size", "bin", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("p_size")), 6).alias("share"))


def art_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Subjects read from file names, met with a roster by lower-cased name, and with listed identities beside."""
    p = _t(spark, d, "part")
    files = p.select("p_partkey", F.concat(F.lit("Poster "), "p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(").PNG")).alias("file"))
    subject = F.lower(F.regexp_extract("file", r"(?i)^poster\s+(.+?)\s*(?:\(\d+\))?\.png$", 1))
    roster = p.where("p_size <= 10").groupBy(F.lower("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    listed = p.where("p_size = 50").groupBy(F.lower("p_name").alias("alias")).agg(F.min("p_partkey").alias("identity"))
    got = files.select("p_partkey", subject.alias("subject")).join(roster, F.col("subject") == F.col("name"), "left").join(listed, F.col("subject") == F.col("alias"), "left")
    return got.select("p_partkey", "subject", "id", "identity")


def blind_sample(spark: SparkSession, d: str) -> DataFrame:
    """WL5: a sample in seeded order as its place and the reviewer's own verdict, and nothing that says what it is of."""
    docs = _t(spark, d, "documents").where("doc_id % 20 = 0").join(_t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    placed = od.shuffled(docs.select("doc_id", "quality", "source"), [F.col("doc_id")], 7)
    return gt.assert_public(gt.projected(placed, ["place", "quality"]), ["place", "quality"])


def crop_samples(spark: SparkSession, d: str) -> DataFrame:
    """WL7 W9: for each label at most eight crops, each over three ids after the last one taken."""
    e = _t(spark, d, "embeddings").select(F.col("label").cast("long").alias("label"), "vec_id")
    return th.first_thinned(e, ["label"], "vec_id", 3, 8)


def duplicate_audit(spark: SparkSession, d: str) -> DataFrame:
    """Candidates as the override that a person may paste, and how much of the archive could not be looked at."""
    pairs = dupe_token_set_pairs(spark, d)
    dropped = F.when(F.col("kept_id") == F.col("doc_id"), F.col("prev_id")).otherwise(F.col("doc_id"))
    lines = pairs.groupBy(dropped.alias("id")).agg(F.min("kept_id").alias("kept")).select(F.col("id").cast("string").alias("id"), F.to_json(F.struct(F.lit(True).alias("exclude"), F.concat(F.lit("dupe of "), F.col("kept").cast("string")).alias("why"))).alias("said"))
    words = F.size(F.array_distinct(F.filter(F.split("text", "[ \\t-\\r]+"), lambda x: x != "")))
    keyable = F.coalesce((F.col("n_chars") > 0) & (words >= 2), F.lit(False))
    unkeyable = _t(spark, d, "documents").agg(F.count_if(~keyable).alias("u"), F.count("*").alias("n")).select(F.lit("unkeyable").alias("id"), F.concat_ws(" of ", F.col("u").cast("string"), F.col("n").cast("string")).alias("said"))
    return lines.unionByName(unkeyable)


def freeze_pins(spark: SparkSession, d: str) -> DataFrame:
    """Frozen sources whose number of carried records is not the pinned one."""
    pins = spark.createDataFrame([("1-URGENT", 1), ("5-LOW", 0), ("9-GONE", 4)], "source string, pin bigint")
    n = _t(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_orderpriority").alias("source")).agg(F.count("*").alias("n"))
    both = pins.join(n, "source", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return gt.broken(both, "freeze", F.col("source"), [(F.col("n") < F.col("pin"), "carried records are missing"), (F.col("n") > F.col("pin"), "more records than are pinned")])


def bench_queue(spark: SparkSession, d: str) -> DataFrame:
    """Records with a side that is not full, with what is known of either, and the static fields of the
    records that are still parsed; how many are done, open and carried."""
    l = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey"))).alias("even"), F.count_distinct(F.when(F.col("l_linenumber") % 2 == 1, F.col("l_partkey"))).alias("odd"))
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderstatus") == "F")
    both = l.join(o.toDF("o_orderkey", "source", "carried"), F.col("l_orderkey") == F.col("o_orderkey"))
    open_ = F.exists(F.array("even", "odd"), lambda x: x < 2)
    return both.groupBy("source").agg(F.count_if(open_ & ~F.col("carried")).alias("open"), F.count_if(~open_).alias("done"), F.count_if(open_ & F.col("carried")).alias("carried"), F.count("*").alias("total"))


def listed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Ids of a listing that came in pages. A page counts if all pages before it are there; every seventh page was not landed."""
    pages = _t(spark, d, "conversations").where("(conv_id * 31 + turn) % 7 != 0").select("conv_id", "turn").distinct()
    first = _t(spark, d, "conversations").groupBy("conv_id").agg(F.min("turn").alias("start"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = pages.join(first, "conv_id").withColumn("gap", F.col("turn") - F.col("start") - F.row_number().over(w) + 1)
    return rows.where("gap = 0").groupBy("conv_id").agg(F.count("*").alias("pages"), F.max("turn").alias("last"))


def dropped_candidates(spark: SparkSession, d: str) -> DataFrame:
    """For each user and day the ids with evidence that are no members, the surest first."""
    keys = ["user_id", "day"]
    r = rd.bursts(reads(spark, d).withColumn("day", F.floor(F.col("sec") / 1440)), keys, "sec", 120).withColumn("w", rd.weight(F.col("dist")))
    f = rd.fold(r, keys, "id", "w").where("not member")
    listed = F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("less"), "id")))
    return f.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["id"]), "|").alias("dropped"), F.max("confidence").alias("surest"))


def input_gate(spark: SparkSession, d: str) -> DataFrame:
    """Requests with a malformed id, a second that is no whole number of a video, a member who is in no roster, or
    a path that leaves its folder. Orders stand for requests."""
    o, p = _t(spark, d, "orders"), _t(spark, d, "part").select("p_brand").distinct()
    k = F.col("o_orderkey")
    asked = o.select(k, F.when(k % 50 == 1, F.concat(F.lit("../"), k.cast("string"))).otherwise(F.lpad(k.cast("string"), 11, "0")).alias("id"), F.when(k % 40 == 2, F.lit("12.5")).when(k % 40 == 3, F.lit("9999")).otherwise((k % 600).cast("string")).alias("sec"), F.concat(F.lit("Brand#"), (k % 27 + 1).cast("string")).alias("member"), F.when(k % 30 == 4, F.lit("frames/../../etc/x")).otherwise(F.lit("frames/a/../b.png")).alias("path"))
    met = asked.join(p, F.col("member") == F.col("p_brand"), "left")
    parts = F.filter(F.split("path", "/"), lambda x: ~x.isin("", "."))
    depth = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")), lambda s, x: F.transform(F.array(s["at"] + F.when(x == "..", -1).otherwise(1)), lambda at: F.struct(at.alias("at"), F.least(s["least"], at).alias("least")))[0])
    second = F.when(F.col("sec").rlike(r"^\d{1,6}$"), F.col("sec").cast("int"))
    return gt.broken(met, "input", k, [
        (~F.col("id").rlike(r"^[A-Za-z0-9_-]{11}$"), "malformed id"), (F.coalesce(second, F.lit(-1)).between(0, 7200) == F.lit(False), "no second of a video"),
        (F.col("p_brand").isNull(), "no member of the roster"), (depth["least"] < 0, "path leaves its folder"), ((depth["least"] >= 0) & (F.get(parts, F.lit(0)) != "frames"), "path is in another folder"),
        ((depth["at"] < 2), "path names no file"),
    ])


def plated_frames(spark: SparkSession, d: str) -> DataFrame:
    """Of each video's frames those whose measurement found a plate on both sides, and the earliest of them."""
    e = _t(spark, d, "events").select("user_id", "event_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000).alias("sec"), F.col("value").between(20, 70).alias("left"), (F.col("event_type") != "error").alias("right"))
    return e.groupBy("user_id").agg(F.count("*").alias("frames"), F.count_if(F.col("left") & F.col("right")).alias("plated"), F.min(F.when(F.col("left") & F.col("right"), F.col("sec"))).alias("first"))


_SHORT = f"""e AS (SELECT vec_id, vec_id % 41 AS video, CAST(label AS BIGINT) AS label, array_to_string(list_transform(embedding[1:{BITS}], lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END), '')::BIT AS h FROM embeddings)"""
_GRID = " UNION ALL ".join(f"SELECT {c}::DOUBLE AS cut, vec_id, vec_id % 41 AS video, CAST(label AS BIGINT) AS label, array_to_string(list_transform(embedding, lambda x: CASE WHEN x::DOUBLE - ({c}::DOUBLE) > 0 THEN 1 ELSE 0 END), '')::BIT AS h FROM embeddings" for c in CUTS)

QUERIES = {f.__name__: f for f in (close_hashes, stable_minus_leaky, labelled_votes, descriptor_grid, ocr_viability, radius_table, anchor_scores, state_gaps, colour_descriptors, art_candidates, blind_sample, crop_samples, duplicate_audit, freeze_pins, bench_queue, listed_pages, dropped_candidates, input_gate, plated_frames)}

SQL = {
    "close_hashes": f"WITH {_SHORT}, u AS (SELECT DISTINCT h FROM e) SELECT bit_count(xor(a.h, b.h))::BIGINT AS dist, count(*) AS n FROM u a JOIN u b ON a.h < b.h WHERE bit_count(xor(a.h, b.h)) <= {RADIUS} GROUP BY 1",
    "stable_minus_leaky": f"""WITH {_SHORT}, p AS (SELECT a.video = b.video AS one, a.label = b.label AS same, bit_count(xor(a.h, b.h)) <= {RADIUS} AS close FROM e a JOIN e b ON a.vec_id < b.vec_id),
  c AS (SELECT count(*) FILTER (one AND same AND close) AS stable, count(*) FILTER (one AND same) AS same, count(*) FILTER (NOT one AND close) AS leaky, count(*) FILTER (NOT one) AS "cross" FROM p)
  SELECT *, round(coalesce(stable / nullif(same, 0), 0) - coalesce(leaky / nullif("cross", 0), 0), 9) AS score FROM c""",
    "labelled_votes": f"""WITH {_SHORT}, s AS (SELECT *, list_distinct([label, (label + vec_id % 3 + 1) % 10, (vec_id * 7) % 10]) AS m FROM e),
  p AS (SELECT a.vec_id, list_intersect(a.m, b.m) AS shared, 1 - bit_count(xor(a.h, b.h)) / {RADIUS + 1}::DOUBLE AS w FROM s a JOIN s b ON a.video != b.video AND bit_count(xor(a.h, b.h)) <= {RADIUS}),
  v AS (SELECT vec_id, shared[1] AS label, round(sum(w), 9) AS votes FROM p WHERE len(shared) = 1 GROUP BY ALL), r AS (SELECT *, row_number() OVER o AS place, round(votes - coalesce(lead(votes) OVER o, 0), 9) AS margin FROM v WINDOW o AS (PARTITION BY vec_id ORDER BY votes DESC, label))
  SELECT vec_id, label, votes, margin FROM r WHERE place = 1""",
    "descriptor_grid": f"""WITH g AS ({_GRID}), p AS (SELECT a.cut, a.label = b.label AS same, bit_count(xor(a.h, b.h)) AS d FROM g a JOIN g b ON a.cut = b.cut AND a.vec_id < b.vec_id AND a.video != b.video),
  s AS (SELECT cut, avg(d) FILTER (same) AS w, avg(d) FILTER (NOT same) AS b FROM p GROUP BY 1), r AS (SELECT cut, round(w, 6) AS within, round(b, 6) AS between, round(b - w, 6) AS apart FROM s)
  SELECT *, row_number() OVER (ORDER BY apart DESC, cut) - 1 AS place FROM r""",
    "ocr_viability": f"""WITH {_NAMES}, n AS (SELECT seen, count(*) AS n FROM p GROUP BY 1), d AS (SELECT seen, n, list_min(list_transform({_KEYS}, lambda k: damerau_levenshtein(seen, k))) AS dist FROM n)
  SELECT sum(n)::BIGINT AS plates, coalesce(sum(n) FILTER (dist = 0), 0)::BIGINT AS exact, coalesce(sum(n) FILTER (dist BETWEEN 1 AND 2), 0)::BIGINT AS within_two, coalesce(sum(n) FILTER (seen = ''), 0)::BIGINT AS blank,
    10 * coalesce(sum(n) FILTER (dist <= 2), 0) >= 6 * sum(n) AS viable FROM d""",
    "radius_table": r"""WITH k AS (SELECT DISTINCT trim(regexp_replace(regexp_replace(upper(p_type || ' ' || left(p_name, 3)), '[^A-Z .\-]', '', 'g'), ' +', ' ', 'g')) AS key FROM part),
  n AS (SELECT a.key, min(damerau_levenshtein(a.key, b.key)) AS nearest FROM k a JOIN k b ON a.key != b.key GROUP BY 1) SELECT greatest(0, (nearest - 1) // 2) AS radius, count(*) AS keys, min(nearest) AS least FROM n GROUP BY 1""",
    "anchor_scores": """WITH l AS (SELECT l_partkey % 2 AS anchor, l_returnflag AS side, floor(l_quantity % 7) AS dist FROM lineitem), c AS (SELECT side, count(*) FILTER (anchor = 0) AS n_0, count(*) FILTER (anchor = 0 AND dist = 0) AS exact_0, count(*) FILTER (anchor = 0 AND dist <= 2) AS near_0,
  count(*) FILTER (anchor = 1) AS n_1, count(*) FILTER (anchor = 1 AND dist = 0) AS exact_1, count(*) FILTER (anchor = 1 AND dist <= 2) AS near_1 FROM l GROUP BY 1)
  SELECT *, round(near_0 / n_0 - near_1 / n_1, 6) AS drift, CASE WHEN near_0 / n_0 > near_1 / n_1 THEN 0 WHEN near_1 / n_1 > near_0 / n_0 THEN 1 END AS winner FROM c""",
    "state_gaps": """WITH c AS (SELECT label, list_transform([embedding[1], embedding[32], embedding[64]], lambda x: round(x::DOUBLE, 4)) AS c FROM embeddings), g AS (SELECT label, round(list_max(c) - list_min(c), 4) AS gap, c[1] = list_max(c) AS first FROM c)
  SELECT label, count(*) AS n, round(count(*) FILTER (first) / count(*), 6) AS first, list_sort(list(gap))[count(*) // 2 + 1] AS median, list_sort(list(gap))[least(count(*) - 1, CAST(floor(0.1 * count(*)) AS BIGINT)) + 1] AS p10, list_sort(list(gap))[least(count(*) - 1, CAST(floor(0.9 * count(*)) AS BIGINT)) + 1] AS p90 FROM g GROUP BY 1""",
    "colour_descriptors": """WITH x AS (SELECT p_size, CAST(p_partkey AS BIGINT) * 2654435 % 16777216 AS x FROM part), c AS (SELECT p_size, (x // 65536 % 256)::DOUBLE AS r, (x // 256 % 256)::DOUBLE AS g, (x % 256)::DOUBLE AS b FROM x),
  m AS (SELECT *, greatest(r, g, b) AS hi, greatest(r, g, b) - least(r, g, b) AS sp FROM c),
  s AS (SELECT p_size, CASE WHEN hi = 0 OR sp * 5 < hi THEN 12 ELSE CAST(floor(2 * CASE WHEN hi = r THEN CASE WHEN g >= b THEN (g - b) / sp ELSE (g - b) / sp + 6 END WHEN hi = g THEN (b - r) / sp + 2 ELSE (r - g) / sp + 4 END) AS INT) END AS bin FROM m),
  n AS (SELECT p_size, bin, count(*) AS n FROM s GROUP BY ALL) SELECT p_size, bin, round(n / sum(n) OVER (PARTITION BY p_size), 6) AS share FROM n""",
    "art_candidates": """SELECT p_partkey, lower(p_name) AS subject, (SELECT min(r.p_partkey) FROM part r WHERE r.p_size <= 10 AND lower(r.p_name) = lower(p.p_name)) AS id,
  (SELECT min(r.p_partkey) FROM part r WHERE r.p_size = 50 AND lower(r.p_name) = lower(p.p_name)) AS identity FROM part p""",
    "blind_sample": f"WITH RECURSIVE {shuffle_sql('SELECT doc_id FROM documents WHERE doc_id % 20 = 0', 7)} SELECT place, quality FROM w LEFT JOIN labels USING (doc_id)",
    "duplicate_audit": f"""WITH d AS ({DUPES["dupe_token_set_pairs"]}), k AS (SELECT CASE WHEN kept_id = doc_id THEN prev_id ELSE doc_id END AS id, min(kept_id) AS kept FROM d GROUP BY 1),
  c AS (SELECT count(*) AS n, count(*) FILTER (n_chars > 0 AND len(list_distinct(list_filter(regexp_split_to_array(text, '[ \\t-\\r]+'), lambda x: x != ''))) >= 2) AS keyable FROM documents)
  SELECT id::VARCHAR AS id, '{{"exclude":true,"why":"dupe of ' || kept || '"}}' AS said FROM k UNION ALL SELECT 'unkeyable', (n - keyable) || ' of ' || n FROM c""",
    "crop_samples": """WITH ids AS (SELECT CAST(label AS BIGINT) AS label, list(DISTINCT vec_id ORDER BY vec_id) AS v FROM embeddings GROUP BY 1), k AS (SELECT label, list_reduce(v, lambda a, s: CASE WHEN s > a[-1] + 3 THEN list_append(a, s) ELSE a END, [v[1]])[1:8] AS k FROM ids)
  SELECT label, unnest(k) AS vec_id, CAST(generate_subscripts(k, 1) - 1 AS INT) AS place FROM k""",
    "freeze_pins": """SELECT 'freeze' AS gate, source AS id, CASE WHEN n < pin THEN 'carried records are missing' ELSE 'more records than are pinned' END AS why FROM (SELECT source, pin, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = source) AS n
  FROM (VALUES ('1-URGENT', 1), ('5-LOW', 0), ('9-GONE', 4)) p(source, pin)) WHERE n != pin""",
    "bench_queue": """WITH l AS (SELECT l_orderkey, count(DISTINCT l_partkey) FILTER (l_linenumber % 2 = 0) AS e, count(DISTINCT l_partkey) FILTER (l_linenumber % 2 = 1) AS o FROM lineitem GROUP BY 1)
  SELECT o_orderpriority AS source, count(*) FILTER (least(e, o) < 2 AND o_orderstatus != 'F') AS open, count(*) FILTER (least(e, o) >= 2) AS done, count(*) FILTER (least(e, o) < 2 AND o_orderstatus = 'F') AS carried, count(*) AS total FROM l JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "dropped_candidates": f"""WITH {_READS}, e AS (SELECT *, CAST(floor(sec / 1440) AS BIGINT) AS day FROM r), l AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id, day ORDER BY sec) > 120 THEN 1 ELSE 0 END AS nw FROM e),
  b AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY user_id, day ORDER BY sec) AS BIGINT) AS burst FROM l), w AS (SELECT *, 0.55::DOUBLE * power(0.8::DOUBLE, dist) AS w FROM b WHERE id IS NOT NULL),
  g AS (SELECT user_id, day, id, burst, max(w) AS best, product(1 - w) AS p FROM w GROUP BY ALL), f AS (SELECT user_id, day, id, round(1 - product(1 - (best + 0.5 * ((1 - p) - best))), 3) AS confidence FROM g GROUP BY ALL)
  SELECT user_id, day, string_agg(id, '|' ORDER BY confidence DESC, id) AS dropped, max(confidence) AS surest FROM f WHERE confidence < 0.6 GROUP BY ALL""",
    "input_gate": " UNION ALL ".join(f"SELECT 'input' AS gate, o_orderkey::VARCHAR AS id, '{why}' AS why FROM orders WHERE {rule}" for rule, why in (("o_orderkey % 50 = 1", "malformed id"), ("o_orderkey % 40 IN (2, 3)", "no second of a video"), ("'Brand#' || (o_orderkey % 27 + 1) NOT IN (SELECT p_brand FROM part)", "no member of the roster"), ("o_orderkey % 30 = 4", "path leaves its folder"), ("o_orderkey % 30 = 4", "path names no file"))),
    "plated_frames": "SELECT user_id, count(*) AS frames, count(*) FILTER (value BETWEEN 20 AND 70 AND event_type != 'error') AS plated, min(CAST(floor(epoch_us(ts) / 60000000) AS BIGINT)) FILTER (value BETWEEN 20 AND 70 AND event_type != 'error') AS first FROM events GROUP BY 1",
    "listed_pages": """WITH f AS (SELECT conv_id, min(turn) AS start FROM conversations GROUP BY 1), p AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE (conv_id * 31 + turn) % 7 != 0),
  g AS (SELECT conv_id, turn FROM p JOIN f USING (conv_id) WHERE NOT EXISTS (SELECT 1 FROM range(100000) r(i) WHERE i >= start AND i < turn AND (conv_id * 31 + i) % 7 = 0) AND (SELECT count(*) FROM p q WHERE q.conv_id = p.conv_id AND q.turn < p.turn) = turn - start)
  SELECT conv_id, count(*) AS pages, max(turn) AS last FROM g GROUP BY 1""",
}
