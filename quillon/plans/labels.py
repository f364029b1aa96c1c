"""Queries on firsts, tops, stamps, label keys and colours, without a window: each is one partial
aggregate or a projection. Orders stand for frames, customers for channels, parts for tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def first_resolved(spark: SparkSession, d: str) -> DataFrame:
    """The first resolved row of every channel; the lower key where days tie."""
    done = _t(spark, d, "orders").where("o_orderstatus = 'F'")
    first = F.min(F.struct(F.col("o_orderdate").cast("date").cast("string").alias("day"), "o_orderkey"))
    return done.groupBy("o_custkey").agg(first.alias("f")).select("o_custkey", F.col("f.day").alias("first_day"), F.col("f.o_orderkey").alias("first_key"))


def top_entity(spark: SparkSession, d: str) -> DataFrame:
    """The entity of highest usage in every type of part; the lesser name where counts tie."""
    used = _t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).join(_t(spark, d, "part").select("p_partkey", "p_brand", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    usage = used.groupBy("p_size", "p_brand").agg(F.sum("n").alias("n"))
    return usage.groupBy("p_size").agg(F.min(F.struct((-F.col("n")).alias("less"), "p_brand")).alias("f")).select("p_size", F.col("f.p_brand").alias("top_brand"), (-F.col("f.less")).alias("uses"))


def frame_stamps(spark: SparkSession, d: str) -> DataFrame:
    """seconds, rounded, as six digits; larger numbers keep all of theirs."""
    whole = F.round("o_totalprice").cast("bigint").cast("string")
    return _t(spark, d, "orders").select("o_orderkey", F.lpad(whole, F.greatest(F.lit(6), F.length(whole)), F.lit("0")).alias("stamp"))


def label_keys(spark: SparkSession, d: str) -> DataFrame:
    """a label's key of record, side and second, and its parts read back from the key."""
    key = F.concat_ws("/", "l_orderkey", F.col("l_linenumber") % 2, "l_partkey")
    parts = F.split("label_key", "/")
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", key.alias("label_key")).select("*", parts[0].cast("bigint").alias("record"), parts[1].cast("int").alias("side"), parts[2].cast("bigint").alias("second"))


def luminance(colour: Column) -> Column:
    """Relative luminance of six hexadecimal digits; null where they are none."""
    def part(at: int) -> Column:
        c = F.conv(F.substring(colour, at, 2), 16, 10).cast("double") / 255
        return F.when(c <= 0.03928, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))

    light = 0.2126 * part(1) + 0.7152 * part(3) + 0.0722 * part(5)
    return F.when(colour.rlike("^[0-9A-Fa-f]{6}$"), light)


def contrast(one: Column, two: Column) -> Column:
    """Contrast of two luminances, 1 to 21, in either order."""
    return (F.greatest(one, two) + 0.05) / (F.least(one, two) + 0.05)


def accent_contrast(spark: SparkSession, d: str) -> DataFrame:
    """luminance of a token's colour and its contrast with a dark ground."""
    colour = F.lpad(F.hex(F.col("p_partkey").cast("bigint") * 2654435 % 16777216), 6, "0")
    rows = _t(spark, d, "part").select("p_partkey", colour.alias("colour")).withColumn("light", luminance(F.col("colour")))
    return rows.select("p_partkey", "colour", F.round("light", 6).alias("luminance"), F.round(contrast(F.col("light"), luminance(F.lit("101418"))), 4).alias("contrast"))


def settled_shares(spark: SparkSession, d: str) -> DataFrame:
    """what part of a segment's orders is settled, as text with one decimal."""
    both = _t(spark, d, "orders").join(_t(spark, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    n = both.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("settled"))
    # tenths of a percent, rounded half up in whole numbers
    tenths = F.expr("(2000 * settled + n) div (2 * n)")
    return n.select("c_mktsegment", F.concat(F.expr("(2000 * settled + n) div (2 * n) div 10").cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%")).alias("share"))


def empty_sides(spark: SparkSession, d: str) -> DataFrame:
    """Records that break the contract of two sides with an entity each: `side` is the one that
    has none; a record without any has two rows."""
    held = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max((F.col("l_linenumber") % 2 == 0).cast("int")).alias("even"), F.max((F.col("l_linenumber") % 2 == 1).cast("int")).alias("odd"))
    records = _t(spark, d, "orders").select("o_orderkey").join(held, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("even").alias("has")), F.struct(F.lit(1).alias("side"), F.col("odd").alias("has")))
    return records.select("o_orderkey", F.explode(sides).alias("s")).where("coalesce(s.has, 0) = 0").select("o_orderkey", "s.side")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; null where one is all zeros."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def l1(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: F.abs(p.cast("double") - q)), F.lit(0.0), lambda s, v: s + v)


def profile_distance(spark: SparkSession, d: str) -> DataFrame:
    """cosine and L1 distance of every vector and the mean of its label. The means come
    from sums by label and place, so no vector of a label meets another one in a task."""
    rows = _t(spark, d, "embeddings")
    places = rows.select("label", F.posexplode("embedding").alias("at", "x")).groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    means = places.groupBy(F.col("label").alias("of")).agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("mean"))
    both = rows.join(means.select("of", F.col("mean.x").alias("mean")), F.col("label") == F.col("of"))
    return both.select("vec_id", F.round(cosine(F.col("embedding"), F.col("mean")), 5).alias("cosine"), F.round(l1(F.col("embedding"), F.col("mean")), 4).alias("l1"))


def _channel(x: str) -> str:
    return f"CASE WHEN {x} / 255.0::DOUBLE <= 0.03928 THEN {x} / 255.0::DOUBLE / 12.92 ELSE pow(({x} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) END"


def _light(x: str) -> str:
    red, green, blue = (_channel(f"({x} // {n} % 256)") for n in (65536, 256, 1))
    return f"(0.2126::DOUBLE * ({red}) + 0.7152::DOUBLE * ({green}) + 0.0722::DOUBLE * ({blue}))"


_GROUND = _light("1053720")

QUERIES = {f.__name__: f for f in (first_resolved, top_entity, frame_stamps, label_keys, accent_contrast, settled_shares, empty_sides, profile_distance)}

SQL = {
    "first_resolved": """SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS first_day, o_orderkey AS first_key FROM orders WHERE o_orderstatus = 'F'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) = 1""",
    "top_entity": """SELECT p_size, p_brand AS top_brand, count(*) AS uses FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_size, p_brand
  QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY count(*) DESC, p_brand) = 1""",
    "frame_stamps": "SELECT o_orderkey, CASE WHEN length(w) >= 6 THEN w ELSE lpad(w, 6, '0') END AS stamp FROM (SELECT o_orderkey, CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) AS w FROM orders)",
    "label_keys": "SELECT l_orderkey, l_linenumber, concat_ws('/', l_orderkey, l_linenumber % 2, l_partkey) AS label_key, CAST(l_orderkey AS BIGINT) AS record, CAST(l_linenumber % 2 AS INT) AS side, CAST(l_partkey AS BIGINT) AS second FROM lineitem",
    "settled_shares": """SELECT c_mktsegment, CAST(t // 10 AS VARCHAR) || '.' || CAST(t % 10 AS VARCHAR) || '%' AS share FROM (SELECT c_mktsegment,
  (2000 * count(*) FILTER (o_orderstatus = 'F') + count(*)) // (2 * count(*)) AS t FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)""",
    "empty_sides": """SELECT o_orderkey, CAST(side AS INT) AS side FROM orders, (VALUES (0), (1)) AS v(side)
  WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber % 2 = side)""",
    "profile_distance": """WITH p AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
  m AS (SELECT label, i, avg(x) AS y FROM p GROUP BY ALL)
  SELECT vec_id, round(sum(x * y) / sqrt(sum(x * x) * sum(y * y)), 5) AS cosine, round(sum(abs(x - y)), 4) AS l1 FROM p JOIN m USING (label, i) GROUP BY vec_id""",
    "accent_contrast": f"""SELECT p_partkey, lpad(to_hex(x), 6, '0') AS colour, round(light, 6) AS luminance, round((greatest(light, ground) + 0.05) / (least(light, ground) + 0.05), 4) AS contrast
  FROM (SELECT p_partkey, x, {_light('x')} AS light, {_GROUND} AS ground FROM (SELECT p_partkey, CAST(p_partkey AS BIGINT) * 2654435 % 16777216 AS x FROM part))""",
}
