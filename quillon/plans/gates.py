"""Queries of the gates before publication and of the public projection. Each is fed rows that break its rules:
orders stand for patches and records, parts for a roster and its design tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.operators import appearances as ap
from quillon.operators import gates as gt
from quillon.operators import intervals as iv
from quillon.plans.archive import _SEASON, ERAS
from quillon.plans.labels import _GROUND, _light, contrast, luminance

PATCH_ERAS = [(1, "1995-02-01", "2000-01-01"), (2, "2000-01-01", "2010-06-01"), (3, "2010-06-03", "2030-01-01"), (4, "2099-01-01", None)]
LAUNCH, AS_OF = "1995-02-01", "2030-06-01"
CHANNELS = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
PUBLIC = ["id", "sides", "sides.player", "sides.characters", "date", "source", "views", "durationSec"]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def patches(spark: SparkSession, d: str) -> DataFrame:
    """A day each, some with the token of an era, without a day, of the day before or including others."""
    k = F.col("o_orderkey")
    # years of five digits as DuckDB writes them; Spark puts a plus before them
    day = lambda n: F.ltrim(F.date_add(F.lit("1995-01-01").cast("date"), n.cast("int")).cast("string"), F.lit("+"))
    start = F.when(k % 50 == 3, day(k - 1)).otherwise(day(k))
    version = F.when(k % 50 == 1, "S3").when(k % 50 == 2, F.concat(F.lit("v"), k.cast("string"))).when(k % 50 == 4, day(k + 1)).otherwise(start)
    includes = F.when(k % 40 == 0, F.array(day(k - 1), F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return _t(spark, d, "orders").select(k.alias("row"), version.alias("version"), start.alias("start"), F.col("o_orderpriority").alias("announced"), includes.alias("includes"))


def patch_gate(spark: SparkSession, d: str) -> DataFrame:
    """G6 W6"""
    return gt.patch_violations(patches(spark, d), PATCH_ERAS, LAUNCH, AS_OF, CHANNELS)


def group_gate(spark: SparkSession, d: str) -> DataFrame:
    """Brands with their sizes as children, size 7 under one name in all of them; size 51 is in no group."""
    p = _t(spark, d, "part").select("p_brand", "p_size").distinct()
    groups = p.groupBy(F.col("p_brand").alias("id")).agg(F.collect_list(F.when(F.col("p_size") == 7, "size 7").otherwise(F.concat_ws("/", "p_brand", "p_size"))).alias("children"))
    return gt.group_violations(groups, p.select(F.concat_ws("/", "p_brand", F.col("p_size") + 1).alias("token")).where("not endswith(token, '/7')"))


def roster_gate(spark: SparkSession, d: str) -> DataFrame:
    """Parts without a token, tokens without a part, too little contrast, no portrait."""
    p = _t(spark, d, "part")
    key = F.col("p_partkey").cast("string")
    roster = p.where("p_partkey % 3 != 0").select(key.alias("id"), (F.col("p_size") > 3).alias("portrait"))
    tokens = p.where("p_partkey % 5 != 0").select(key.alias("token"), F.lpad(F.hex(F.col("p_partkey").cast("bigint") * 2654435 % 16777216), 6, "0").alias("colour"))
    return gt.roster_violations(roster, tokens, luminance(F.lit("101418")), contrast(luminance(F.col("colour")), F.col("_ground")), ["3", "6"])


def feed_gate(spark: SparkSession, d: str) -> DataFrame:
    """Days announced and days known, from urgent and from finished orders of high value."""
    o = _t(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date").cast("string"))
    known = o.where("o_orderstatus = 'F' and o_totalprice > 200000").groupBy("day").agg(F.min("o_orderpriority").alias("channel"))
    return gt.feed_differences(o.where("o_orderpriority = '1-URGENT'").select("day"), known, "2-HIGH")


def plate_key_gate(spark: SparkSession, d: str) -> DataFrame:
    """Parts whose names are one key."""
    return gt.key_collisions(_t(spark, d, "part"), "p_partkey", F.upper(F.regexp_replace("p_name", "[^A-Za-z]+", "")))


def listed(spark: SparkSession, d: str) -> DataFrame:
    """Records with the brands of their two sides in order of first line; an absent side is empty."""
    items = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").join(_t(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    own = items.groupBy("l_orderkey", (F.col("l_linenumber") % 2).cast("int").alias("side")).agg(ap.in_order("l_linenumber", "p_brand").alias("characters"))
    side = lambda k: F.coalesce(F.max(F.when(F.col("side") == k, F.col("characters"))), F.array().cast("array<string>"))
    return own.groupBy(F.col("l_orderkey").alias("id")).agg(side(0).alias("a"), side(1).alias("b"))


def record_gate(spark: SparkSession, d: str) -> DataFrame:
    """Every twentieth record has lost a side."""
    both = listed(spark, d).select("id", F.when(F.col("id") % 20 == 0, F.array("a")).otherwise(F.array("a", "b")).alias("sides"))
    return gt.record_violations(_t(spark, d, "orders").select(F.col("o_orderkey").alias("id")), both)


def summary_gate(spark: SparkSession, d: str) -> DataFrame:
    """A summary for each season, some of them wrong, and an empty one."""
    o = _t(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date").cast("string"))
    o = o.withColumn("season", iv.season_of(F.col("day"), ERAS))
    s = o.groupBy("season").agg(F.count("*").alias("emitted"), F.count_distinct("o_custkey").alias("players"), F.max("day").alias("day"))
    wrong = s.select("season", (F.col("emitted") + (F.col("season") == 2).cast("int")).alias("replays"), "emitted", F.when(F.col("season") == 3, 0).otherwise(25).alias("characters"), F.when(F.col("season") == 1, 0).otherwise(F.col("players")).alias("players"), F.when(F.col("season") == 0, F.lit("never")).otherwise(F.col("day")).alias("updated"))
    none = o.agg(F.lit(9).alias("season"), F.lit(0).cast("bigint").alias("replays"), F.lit(0).cast("bigint").alias("emitted"), F.lit(0).alias("characters"), F.lit(0).cast("bigint").alias("players"), F.lit(None).cast("string").alias("updated"))
    return gt.summary_violations(wrong.unionByName(none).withColumnRenamed("season", "id"))


def human_readings(spark: SparkSession, d: str) -> DataFrame:
    """The two frames are the sides of a record; its title names the second side's first, or nobody."""
    k = F.col("id")
    title = F.when(k % 2 == 0, F.slice("b", 1, 1)).otherwise(F.array().cast("array<string>"))
    judged = gt.judged_reading(F.col("a"), F.when(k % 4 < 2, F.reverse("a")).otherwise(F.col("b")), title, k % 5 == 0, k % 7 == 0, k % 3 == 0)
    return listed(spark, d).select("id", judged.alias("r")).select("id", "r.outcome", F.array_join("r.characters", "|").alias("characters"), "r.team_change")


def accept_rule(spark: SparkSession, d: str) -> DataFrame:
    """Records that a reader may settle by itself, of all."""
    k = F.col("id")
    known = F.when(k % 3 == 0, F.slice("b", 1, 1)).otherwise(F.slice("a", 1, 1))
    ok = gt.accepted(F.col("a"), F.col("b"), (k % 11) / 10, k % 4 != 0, known, F.slice("b", 1, 1))
    return listed(spark, d).groupBy(ok.alias("accepted")).agg(F.count("*").alias("n"))


def public_records(spark: SparkSession, d: str) -> DataFrame:
    """What is published of a record, projected at every depth and serialised; fields without a
    value are left out. The gate runs on the schema, and the payload is searched besides."""
    side = lambda n, c: F.struct(F.concat(F.lit(f"p{n}-"), (F.col("id") % 97).cast("string")).alias("player"), F.col(c).alias("characters"), F.struct(F.lit("title").alias("tier"), F.col(c).alias("fromTitle")).alias("provenance"))
    o = _t(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("date"), F.col("o_orderpriority").alias("source"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("views"), F.nullif(F.col("o_custkey") % 5, F.lit(0)).alias("durationSec"), F.lit("x").alias("intake"))
    records = listed(spark, d).select("id", F.array(side(0, "a"), side(1, "b")).alias("sides")).join(o, F.col("id") == F.col("o_orderkey"))
    public = gt.assert_public(gt.projected(records, PUBLIC), PUBLIC)
    payloads = public.select("id", F.to_json(F.struct("id", "sides", "date", "source", "views", "durationSec")).alias("payload"))
    leaks = gt.leaking(payloads, "id", "payload", ["provenance", "intake"]).groupBy(F.col("id").cast("bigint").alias("_leaked")).agg(F.count("*").alias("n"))
    return payloads.join(leaks, F.col("id") == F.col("_leaked"), "left").select("id", "payload", F.coalesce("n", F.lit(0)).alias("leaks"))


def shape_recon(spark: SparkSession, d: str) -> DataFrame:
    """By source, texts of one line, of a shape, and those that name a subject but miss the shape, with the
    first eight of these by id, cut to 96 characters."""
    docs = _t(spark, d, "documents").select("source", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shaped, named = F.col("text").rlike(r"(?s)^[^.]*\n[^.]*\."), F.col("text").rlike(r"(?i)\b(license|the|data)\b")
    rows = docs.select("source", "doc_id", "text", shaped.alias("shaped"), (named & ~shaped).alias("odd"), F.contains("text", F.lit("\n")).alias("lines"))
    counts = rows.groupBy("source").agg(F.count("*").alias("n"), F.count_if("lines").alias("lines"), F.count_if("shaped").alias("shaped"), F.count_if("odd").alias("odd"))
    first = rows.where("odd").select("source", "doc_id", F.left(F.regexp_replace("text", r"\s+", " "), F.lit(96)).alias("said"), F.row_number().over(Window.partitionBy("source").orderBy("doc_id")).alias("place")).where("place <= 8")
    shown = first.groupBy(F.col("source").alias("_source")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "said"))), lambda x: x["said"]), "\n").alias("examples"))
    return counts.join(shown, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


_DAY = "CAST(DATE '1995-01-01' + CAST({} AS INT) AS VARCHAR)"
_INSIDE = " OR ".join(f"(start >= '{s}'" + (f" AND start < '{e}')" if e else ")") for _, s, e in PATCH_ERAS)
_PATCHES = f"""WITH a AS (SELECT o_orderkey AS k, o_orderpriority AS announced, CASE WHEN o_orderkey % 50 = 3 THEN {_DAY.format('o_orderkey - 1')} ELSE {_DAY.format('o_orderkey')} END AS start FROM orders),
  p AS (SELECT *, CASE WHEN k % 50 = 1 THEN 'S3' WHEN k % 50 = 2 THEN 'v' || k WHEN k % 50 = 4 THEN {_DAY.format('k + 1')} ELSE start END AS version, CASE WHEN k % 40 = 0 THEN [{_DAY.format('k - 1')}, 'x'] ELSE [] END AS includes FROM a),
  f AS (SELECT version, min(k) AS f FROM p GROUP BY 1), q AS (SELECT p.*, f.f, b.start AS before FROM p JOIN f USING (version) LEFT JOIN p b ON b.k = p.k - 1)"""
_RULES = [("NOT regexp_matches(version, '^\\d{4}-\\d{2}-\\d{2}$')", "token is no day"), ("version != start", "token is not its start"), ("regexp_matches(version, '^S\\d+$')", "token is an era''s"), ("k > f", "token appears twice"), (f"start < '{LAUNCH}'", "before launch"),
          (f"start > '{AS_OF}'", "in the future"), ("start <= before", "not after the one before"), (f"NOT ({_INSIDE})", "in no era"), (f"announced NOT IN ({', '.join(repr(c) for c in CHANNELS)})", "unknown channel")]
_LISTED = """i AS (SELECT l_orderkey AS id, CAST(l_linenumber % 2 AS INT) AS side, p_brand, min(l_linenumber) AS pos FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
  s AS (SELECT id, coalesce(list(p_brand ORDER BY pos, p_brand) FILTER (side = 0), []) AS a, coalesce(list(p_brand ORDER BY pos, p_brand) FILTER (side = 1), []) AS b FROM i GROUP BY 1)"""
_SHAPED, _NAMED = r"regexp_matches(text, '^[^.]*\n[^.]*\.', 's')", r"regexp_matches(text, '\b(license|the|data)\b', 'i')"

QUERIES = {f.__name__: f for f in (patch_gate, group_gate, roster_gate, feed_gate, plate_key_gate, record_gate, summary_gate, human_readings, accept_rule, public_records, shape_recon)}

SQL = {
    "patch_gate": _PATCHES + " " + " UNION ALL ".join(f"SELECT 'patches' AS gate, version AS id, '{why}' AS why FROM q WHERE {rule}" for rule, why in _RULES)
    + " UNION ALL SELECT 'patches', x.version, 'includes a token of its own page: ' || inc FROM (SELECT k, version, unnest(includes) AS inc FROM p) x JOIN f ON f.version = inc WHERE f.f <= x.k"
    + " UNION ALL SELECT 'patches', e.id, 'no patch opens the era' FROM (VALUES " + ", ".join(f"('S{n}', '{s}')" for n, s, _ in PATCH_ERAS) + ") e(id, start) WHERE e.start NOT IN (SELECT start FROM p)",
    "group_gate": """WITH p AS (SELECT DISTINCT p_brand, p_size FROM part), c AS (SELECT p_brand AS id FROM p GROUP BY 1 UNION ALL SELECT CASE WHEN p_size = 7 THEN 'size 7' ELSE p_brand || '/' || p_size END FROM p)
  SELECT 'patch-groups' AS gate, id, 'appears more than once' AS why FROM c GROUP BY id HAVING count(*) > 1
  UNION ALL SELECT DISTINCT 'patch-groups', p_brand || '/' || (p_size + 1), 'in no group' FROM p WHERE p_size != 6 AND p_brand || '/' || (p_size + 1) NOT IN (SELECT id FROM c)""",
    "roster_gate": f"""WITH r AS (SELECT p_partkey::VARCHAR AS id, p_size > 3 AS portrait FROM part WHERE p_partkey % 3 != 0), k AS (SELECT p_partkey::VARCHAR AS token, {_light('(CAST(p_partkey AS BIGINT) * 2654435 % 16777216)')} AS light, {_GROUND} AS ground FROM part WHERE p_partkey % 5 != 0),
  b AS (SELECT * FROM r LEFT JOIN k ON id = token)
  SELECT 'roster' AS gate, id, 'no token' AS why FROM b WHERE token IS NULL UNION ALL SELECT 'roster', id, 'too little contrast' FROM b WHERE (greatest(light, ground) + 0.05) / (least(light, ground) + 0.05) < 4.5
  UNION ALL SELECT 'roster', id, 'no portrait' FROM b WHERE NOT portrait UNION ALL SELECT 'roster', token, 'token without an id' FROM k WHERE token NOT IN (SELECT id FROM r) AND token NOT IN ('3', '6')""",
    "feed_gate": """WITH o AS (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders), k AS (SELECT day, min(o_orderpriority) AS channel FROM o WHERE o_orderstatus = 'F' AND o_totalprice > 200000 GROUP BY 1),
  a AS (SELECT DISTINCT day FROM o WHERE o_orderpriority = '1-URGENT')
  SELECT 'feed' AS gate, day AS id, 'announced, not in the table' AS why FROM a WHERE day NOT IN (SELECT day FROM k)
  UNION ALL SELECT 'feed-extra', day, CASE WHEN channel = '2-HIGH' THEN 'not announced, though of the vendor''s feed' ELSE 'not announced' END FROM k WHERE day NOT IN (SELECT day FROM a)""",
    "plate_key_gate": "SELECT 'plate-keys' AS gate, min(p_partkey::VARCHAR) AS id, count(DISTINCT p_partkey) || ' share the key ' || key AS why FROM (SELECT p_partkey, upper(regexp_replace(p_name, '[^A-Za-z]+', '', 'g')) AS key FROM part) GROUP BY key HAVING count(DISTINCT p_partkey) > 1",
    "record_gate": f"""WITH {_LISTED} SELECT 'replays' AS gate, 'all' AS id, 'as many replays as records are needed' AS why WHERE (SELECT count(*) FROM orders) != (SELECT count(*) FROM s)
  UNION ALL SELECT 'replays', id::VARCHAR, 'not two sides' FROM s WHERE id % 20 = 0 UNION ALL SELECT 'replays', id::VARCHAR, 'a side without a character' FROM s WHERE len(a) = 0 OR (id % 20 != 0 AND len(b) = 0)""",
    "summary_gate": f"""WITH n AS (SELECT DISTINCT {_SEASON} AS season FROM orders)
  SELECT 'summary' AS gate, season::VARCHAR AS id, CASE season WHEN 0 THEN 'updated is no day' WHEN 1 THEN 'no player' WHEN 2 THEN 'count is not what was emitted' ELSE 'no character' END AS why FROM n UNION ALL SELECT 'summary', '9', 'no character'""",
    "human_readings": f"""WITH {_LISTED}, r AS (SELECT *, CASE WHEN id % 4 < 2 THEN list_reverse(a) ELSE b END AS c, CASE WHEN id % 2 = 0 THEN b[1:1] ELSE [] END AS t FROM s),
  x AS (SELECT *, list_sort(a) = list_sort(c) AS same, list_filter(t, lambda e: NOT list_contains(a, e)) AS lost FROM r),
  y AS (SELECT *, CASE WHEN NOT same AND id % 5 = 0 THEN 'united' WHEN NOT same AND id % 7 != 0 THEN 'frames-disagree' WHEN len(lost) > 0 AND id % 3 = 0 THEN 'kept' WHEN len(lost) > 0 AND id % 7 != 0 THEN 'title-missing' ELSE 'written' END AS how FROM x)
  SELECT id, CASE WHEN how IN ('united', 'kept') THEN 'written' ELSE how END AS outcome, array_to_string(CASE how WHEN 'united' THEN list_concat(a, list_filter(c, lambda e: NOT list_contains(a, e))) WHEN 'kept' THEN list_concat(a, lost) WHEN 'written' THEN a END, '|') AS characters, how IN ('united', 'kept') AS team_change FROM y""",
    "accept_rule": f"""WITH {_LISTED} SELECT len(a) > 0 AND len(b) > 0 AND id % 11 >= 7.5 AND id % 4 != 0 AND list_has_all(a, CASE WHEN id % 3 = 0 THEN b[1:1] ELSE a[1:1] END) AS accepted, count(*) AS n FROM s GROUP BY 1""",
    "public_records": f"""WITH {_LISTED} SELECT id, '{{"id":' || id || ',"sides":[{{"player":"p0-' || id % 97 || '","characters":' || to_json(a) || '}},{{"player":"p1-' || id % 97 || '","characters":' || to_json(b) || '}}],"date":"' || CAST(o_orderdate AS DATE) || '","source":"' || o_orderpriority || '"'
  || CASE WHEN o_custkey % 2 = 0 THEN ',"views":' || o_custkey ELSE '' END || CASE WHEN o_custkey % 5 != 0 THEN ',"durationSec":' || o_custkey % 5 ELSE '' END || '}}' AS payload, CAST(0 AS BIGINT) AS leaks FROM s JOIN orders ON id = o_orderkey""",
    "shape_recon": f"""WITH x AS (SELECT source, doc_id, coalesce(text, '') AS text FROM documents), r AS (SELECT *, {_SHAPED} AS shaped, {_NAMED} AND NOT {_SHAPED} AS odd, contains(text, chr(10)) AS lines FROM x),
  e AS (SELECT source, doc_id, left(regexp_replace(text, '\\s+', ' ', 'g'), 96) AS said, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place FROM r WHERE odd)
  SELECT source, count(*) AS n, count(*) FILTER (lines) AS lines, count(*) FILTER (shaped) AS shaped, count(*) FILTER (odd) AS odd, (SELECT string_agg(said, chr(10) ORDER BY place) FROM e WHERE e.source IS NOT DISTINCT FROM r.source AND place <= 8) AS examples FROM r GROUP BY source""",
}
