"""Queries that judge readers: statistics over pairs, templates held out, radii, caps and subsets.
Embeddings' signs stand for hashes, their labels for fighters, tens of ids for videos."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators import hashing as hs
from quillon.operators import holdout as ho
from quillon.operators import pairs as pr
from quillon.operators import subsets as sb
from quillon.plans.archive import with_parts
from quillon.sources.shared import dealt


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def crops(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of the vector and of the vector read backwards, video, label and whether the crop is of the left side."""
    e = _t(spark, d, "embeddings")
    return e.select("vec_id", (F.col("vec_id") % 41).alias("video"), F.col("label").cast("long").alias("label"), (F.col("vec_id") % 2 == 0).alias("left"), hs.sign_hash(F.col("embedding")).alias("hash"), hs.sign_hash(F.reverse("embedding")).alias("flip"))


def families(spark: SparkSession, d: str) -> DataFrame:
    """order and side with their sets of part sizes, in eight families."""
    lines = _t(spark, d, "lineitem")
    items = with_parts(spark, d, lines.select("l_orderkey", "l_partkey", (F.col("l_linenumber") % 2).alias("side")), (F.col("p_size") % 8).cast("bigint").alias("size"))
    return dealt(items, "l_orderkey", lines.count()).groupBy("l_orderkey", "side").agg(F.collect_set("size").alias("members"))


def separability(spark: SparkSession, d: str) -> DataFrame:
    """Mean distance of crops of equal and of other label, in one video and in two."""
    return pr.mean_distances(crops(spark, d), "video", "label", "hash").select("kind", "pairs", F.round("mean", 6).alias("mean"))


def separability_l1(spark: SparkSession, d: str) -> DataFrame:
    """As separability, with another descriptor: the L1 distance of the first eight elements."""
    e = _t(spark, d, "embeddings").select((F.col("vec_id") % 41).alias("video"), F.col("label").cast("long").alias("label"), F.slice("embedding", 1, 8).alias("v"))
    return pr.mean_l1(e, "video", "label", "v").select("kind", "pairs", F.round("mean", 6).alias("mean"))


def mirror_means(spark: SparkSession, d: str) -> DataFrame:
    """Mean distance by the sides of a pair, as it is and with one side flipped."""
    return pr.mirrored(crops(spark, d), "video", "label", "left", "hash", "flip").select("kind", "pairs", F.round("mean", 6).alias("mean"))


def sole_shared_entity(spark: SparkSession, d: str) -> DataFrame:
    """How many pairs of sides of different orders share exactly one entity, by entity."""
    return pr.sharing_one(families(spark, d), "l_orderkey", "members")


def shared_entity_counts(spark: SparkSession, d: str) -> DataFrame:
    """J15 A51 (the pairs): how many pairs of sides of different orders share k entities."""
    return pr.sharing_counts(families(spark, d), "l_orderkey", "members")


def class_radii(spark: SparkSession, d: str) -> DataFrame:
    """Each class's size, the distance of the next template and the radius that these allow."""
    return ho.classes(crops(spark, d), "label", "hash").select("label", "n", "nearest", "radius")


def leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    """Rows judged by templates that have not seen their video."""
    return ho.judged(ho.held_out(crops(spark, d), "video", "label", "hash"))


def cap_sweep(spark: SparkSession, d: str) -> DataFrame:
    """What each cap accepts and gets right, with templates that have not seen the row's video."""
    return ho.cap_sweep(ho.held_out(crops(spark, d), "video", "label", "hash"))


def crop_fit(spark: SparkSession, d: str) -> DataFrame:
    """For crops of several sizes (first elements of the vector) the cap with the best precision among those that accept at
    least one row in fifty, the lower cap where they tie; held out by video."""
    e = _t(spark, d, "embeddings")
    out = None
    for size in SIZES:
        rows = e.select((F.col("vec_id") % 41).alias("video"), F.col("label").cast("long").alias("label"), hs.sign_hash(F.slice("embedding", 1, size)).alias("hash"))
        one = ho.cap_sweep(ho.held_out(rows, "video", "label", "hash"), SIZE_CAPS).where(50 * F.col("accepted") >= F.col("rows")).withColumn("size", F.lit(size))
        out = one if out is None else out.unionByName(one)
    rate = F.round(F.col("correct") / F.col("accepted"), 6)
    best = out.groupBy("size").agg(F.max(F.struct(rate.alias("precision"), (-F.col("cap")).alias("less"), F.round(F.col("accepted") / F.col("rows"), 6).alias("coverage"))).alias("b"))
    return best.select("size", (-F.col("b.less")).alias("cap"), "b.precision", "b.coverage")


SIZES, SIZE_CAPS = (16, 32, 48), (2, 4, 6, 8, 10, 12, 16)
READERS = [f"v{i}" for i in range(10)]


def reader_subsets(spark: SparkSession, d: str) -> DataFrame:
    """Orders stand for plates, a line with a large quantity says that the reader of its supplier resolves them."""
    lines = _t(spark, d, "lineitem")
    reader = F.when(F.col("l_quantity") >= 30, F.call_function("shiftleft", F.lit(1), (F.col("l_suppkey") % len(READERS)).cast("int"))).otherwise(F.lit(0))
    plates = lines.groupBy("l_orderkey").agg(F.bit_or(reader).alias("mask"))
    return sb.best_subsets(plates, "mask", READERS, 5, 0.02).withColumn("rate", F.round("rate", 6))


_CROPS = """e AS (SELECT vec_id, vec_id % 41 AS video, CAST(label AS BIGINT) AS label, vec_id % 2 = 0 AS lft, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
  h AS (SELECT *, array_to_string(bits, '')::BIT AS hash, array_to_string(list_reverse(bits), '')::BIT AS flip FROM e)"""
def _held(crops: str) -> str:
    return f"""{crops}, l AS (SELECT label, video, unnest(bits) AS bit, generate_subscripts(bits, 1) AS i FROM h), lv AS (SELECT label, video, i, sum(bit) AS o, count(*) AS n FROM l GROUP BY ALL), la AS (SELECT label, i, sum(o) AS o, sum(n) AS n FROM lv GROUP BY ALL),
  vs AS (SELECT DISTINCT video FROM h),
  m AS (SELECT vs.video, la.label, la.i, la.o - coalesce(lv.o, 0) AS o, la.n - coalesce(lv.n, 0) AS n FROM la CROSS JOIN vs LEFT JOIN lv ON lv.label = la.label AND lv.i = la.i AND lv.video = vs.video),
  t AS (SELECT video, label, any_value(n) AS n, string_agg(CASE WHEN 2 * o >= n THEN '1' ELSE '0' END, '' ORDER BY i)::BIT AS hash FROM m WHERE n > 0 GROUP BY ALL),
  tn AS (SELECT a.video, a.label, any_value(a.n) AS n, any_value(a.hash) AS hash, coalesce(min(bit_count(xor(a.hash, b.hash))), 64) AS nearest FROM t a LEFT JOIN t b ON a.video = b.video AND a.label != b.label GROUP BY a.video, a.label),
  tr AS (SELECT *, least(16, greatest(0, (nearest - 1) // 2), CASE WHEN n >= 12 THEN 16 WHEN n >= 6 THEN 12 ELSE 8 END) AS radius FROM tn),
  s AS (SELECT h.vec_id, h.label, tr.label AS tl, tr.radius, bit_count(xor(h.hash, tr.hash)) AS d FROM h JOIN tr USING (video))"""


_HELD = _held(_CROPS)
_SETS = "s AS (SELECT l_orderkey, l_linenumber % 2 AS side, list_sort(list_distinct(list(CAST(p_size % 8 AS BIGINT)))) AS m FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), g AS (SELECT m, count(*) AS n FROM s GROUP BY 1)"
_PAIRED = f"""{_SETS}, p AS (SELECT list_intersect(a.m, b.m) AS shared, CASE WHEN a.m = b.m THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END AS n FROM g a JOIN g b ON a.m <= b.m
  UNION ALL SELECT list_intersect(a.m, b.m), -1 FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND a.side < b.side)"""
_MASKS = "p AS (SELECT l_orderkey, bit_or(CASE WHEN l_quantity >= 30 THEN (1::BIGINT << (l_suppkey % 10)::INT) ELSE 0 END) AS mask FROM lineitem GROUP BY 1), c AS (SELECT mask, count(*) AS n FROM p GROUP BY 1)"

QUERIES = {f.__name__: f for f in (separability, separability_l1, mirror_means, sole_shared_entity, shared_entity_counts, class_radii, leave_one_out, cap_sweep, crop_fit, reader_subsets)}

SQL = {
    "separability": f"""WITH {_CROPS} SELECT CASE WHEN a.label = b.label THEN 'same' ELSE 'other' END || ' label, ' || CASE WHEN a.video = b.video THEN 'one video' ELSE 'two videos' END AS kind, count(*) AS pairs,
  round(avg(bit_count(xor(a.hash, b.hash))), 6) AS mean FROM h a JOIN h b ON a.vec_id < b.vec_id GROUP BY 1""",
    "separability_l1": """WITH e AS (SELECT vec_id, vec_id % 41 AS video, label, embedding[1:8] AS v FROM embeddings)
  SELECT CASE WHEN a.label = b.label THEN 'same' ELSE 'other' END || ' label, ' || CASE WHEN a.video = b.video THEN 'one video' ELSE 'two videos' END AS kind, count(*) AS pairs,
  round(avg(list_sum(list_transform(list_zip(a.v, b.v), lambda p: abs(p[1]::DOUBLE - p[2]::DOUBLE)))), 6) AS mean FROM e a JOIN e b ON a.vec_id < b.vec_id GROUP BY 1""",
    "mirror_means": f"""WITH {_CROPS}, p AS (SELECT CASE WHEN a.lft AND b.lft THEN ['L-L'] WHEN NOT a.lft AND NOT b.lft THEN ['R-R'] ELSE ['L-R plain', 'L-R flipped'] END AS kinds,
  bit_count(xor(a.hash, b.hash)) AS plain, bit_count(xor(CASE WHEN a.lft THEN a.hash ELSE b.hash END, CASE WHEN a.lft THEN b.flip ELSE a.flip END)) AS turned FROM h a JOIN h b ON a.vec_id < b.vec_id AND a.label = b.label AND a.video != b.video)
  SELECT kind, count(*) AS pairs, round(avg(CASE WHEN kind = 'L-R flipped' THEN turned ELSE plain END), 6) AS mean FROM (SELECT unnest(kinds) AS kind, plain, turned FROM p) GROUP BY 1""",
    "sole_shared_entity": f"WITH {_PAIRED} SELECT shared[1] AS entity, CAST(sum(n) AS BIGINT) AS pairs FROM p WHERE len(shared) = 1 GROUP BY 1",
    "shared_entity_counts": f"WITH {_PAIRED} SELECT CAST(len(shared) AS INT) AS k, CAST(sum(n) AS BIGINT) AS pairs FROM p GROUP BY 1 HAVING sum(n) != 0",
    "class_radii": f"""WITH {_CROPS}, l AS (SELECT label, unnest(bits) AS bit, generate_subscripts(bits, 1) AS i FROM h), m AS (SELECT label, i, sum(bit) AS o, count(*) AS n FROM l GROUP BY ALL),
  t AS (SELECT label, any_value(n) AS n, string_agg(CASE WHEN 2 * o >= n THEN '1' ELSE '0' END, '' ORDER BY i)::BIT AS hash FROM m GROUP BY 1)
  SELECT a.label, any_value(a.n) AS n, min(bit_count(xor(a.hash, b.hash)))::BIGINT AS nearest, least(16, greatest(0, (min(bit_count(xor(a.hash, b.hash))) - 1) // 2), CASE WHEN any_value(a.n) >= 12 THEN 16 WHEN any_value(a.n) >= 6 THEN 12 ELSE 8 END)::BIGINT AS radius FROM t a JOIN t b ON a.label != b.label GROUP BY 1""",
    "leave_one_out": f"""WITH {_HELD}, b AS (SELECT vec_id, any_value(label) AS label, arg_min(tl, (d, tl)) FILTER (d <= radius) AS tl FROM s GROUP BY 1)
  SELECT label, count(*) AS wanted, count(*) FILTER (tl = label) AS hit, count(*) FILTER (tl != label) AS wrong, count(*) FILTER (tl IS NULL) AS abstained FROM b GROUP BY 1""",
    "cap_sweep": f"""WITH {_HELD}, b AS (SELECT vec_id, any_value(label) AS label, arg_min(tl, (d, tl)) AS tl, min(d) AS d FROM s GROUP BY 1)
  SELECT cap, count(*) FILTER (d <= cap) AS accepted, count(*) FILTER (d <= cap AND tl = label) AS correct, count(*) AS rows FROM b, (SELECT unnest([6, 8, 10, 12, 14, 16, 20, 24])::INT AS cap) GROUP BY 1""",
    "crop_fit": " UNION ALL ".join(f"""SELECT * FROM (WITH {_held(_CROPS.replace("embedding, lambda", f"embedding[1:{n}], lambda", 1))}, b AS (SELECT vec_id, any_value(label) AS label, arg_min(tl, (d, tl)) AS tl, min(d) AS d FROM s GROUP BY 1),
  c AS (SELECT cap, count(*) FILTER (d <= cap) AS accepted, count(*) FILTER (d <= cap AND tl = label) AS correct, count(*) AS rows FROM b, (SELECT unnest({list(SIZE_CAPS)})::INT AS cap) GROUP BY 1)
  SELECT {n} AS size, cap, round(correct / accepted, 6) AS precision, round(accepted / rows, 6) AS coverage FROM c WHERE 50 * accepted >= rows ORDER BY precision DESC, cap LIMIT 1)""" for n in SIZES),
    "reader_subsets": f"""WITH {_MASKS}, k AS (SELECT m, bit_count(m)::INT AS size, (SELECT sum(n) FROM c WHERE mask & m != 0)::BIGINT AS resolved, list_filter(range(10), lambda i: (m >> i) & 1 = 1) AS ids FROM range(1, 1024) t(m)),
  b AS (SELECT * FROM k WHERE size <= 5 QUALIFY row_number() OVER (PARTITION BY size ORDER BY resolved DESC, ids) = 1), f AS (SELECT resolved FROM k WHERE m = 1023), n AS (SELECT sum(n) AS n FROM c)
  SELECT size, array_to_string(list_transform(ids, lambda i: 'v' || i), ' ') AS readers, b.resolved, round(b.resolved / n.n, 6) AS rate,
    size = (SELECT min(size) FROM b, f, n WHERE f.resolved / n.n - b.resolved / n.n <= 0.02) IS TRUE AS chosen FROM b, f, n""",
}
