"""Queries on appearances, intervals, gates, spans, alignment, overrides and audits.

The test tables hold no matches, so orders stand for records, the two parities of line
numbers for their sides, part brands for entities and customers for players."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.functions.vectorized import nfkd
from quillon.operators import appearances as ap
from quillon.operators import intervals as iv
from quillon.operators import text as tx
from quillon.sources.shared import DEALT, dealt

ERAS = [iv.Era(1, "1996-01-01", "1998-01-01"), iv.Era(2, "1998-01-01", "2000-01-01"), iv.Era(3, "2000-01-01", None)]
PATCHES = ["1996-01-01", "1996-07-01", "1998-01-01", "1998-09-15", "2000-03-01", "2001-01-01"]
ALIASES = {"ring": "r", "small ring": "sr", "bolt": "b", "red": "red", "widget": "w"}


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def sides(spark: SparkSession, d: str) -> DataFrame:
    """order, side, characters in order of first line."""
    items = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").join(t(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return items.groupBy("l_orderkey", (F.col("l_linenumber") % 2).cast("long").alias("side")).agg(ap.in_order("l_linenumber", "p_brand").alias("characters"))


def appearances(spark: SparkSession, d: str) -> DataFrame:
    """order, side and entity, each once. Lines are dealt by order, which is all that what follows by order needs."""
    lines = t(spark, d, "lineitem")
    return dealt(with_parts(spark, d, lines.select("l_orderkey", "l_partkey", (F.col("l_linenumber") % 2).cast("long").alias("side")), F.col("p_brand").alias("entity")), "l_orderkey", lines.count()).distinct()


def with_parts(spark: SparkSession, d: str, lines: DataFrame, of_part: Column) -> DataFrame:
    """lines with a column of their part in place of its key. Many lines are dealt by part in tasks of a bounded size before they meet."""
    n = lines.count()
    if n > DEALT * int(spark.conf.get("spark.sql.shuffle.partitions")):
        lines = dealt(lines, "l_partkey", n)
    return lines.join(t(spark, d, "part").select("p_partkey", of_part), F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")


_ITEMS = "items AS (SELECT l_orderkey, CAST(l_linenumber % 2 AS BIGINT) AS side, p_brand, min(l_linenumber) AS pos FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
_SEASON = f"CASE WHEN {_DAY} >= '1996-01-01' AND {_DAY} < '1998-01-01' THEN 1 WHEN {_DAY} >= '1998-01-01' AND {_DAY} < '2000-01-01' THEN 2 WHEN {_DAY} >= '2000-01-01' THEN 3 ELSE 0 END"
_SIDES = f"{_ITEMS}, sides AS (SELECT l_orderkey, side, list(p_brand ORDER BY pos, p_brand) AS characters FROM items GROUP BY ALL)"


def side_appearance_usage(spark, d):
    """A1 A6"""
    return appearances(spark, d).groupBy("entity").agg(F.count("*").alias("n"))


def usage_identity(spark, d):
    """A6 G12"""
    return ap.usage_gap(sides(spark, d))


def orders(spark, d):
    o = t(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date").cast("string"))
    return o.withColumn("season", iv.season_of(F.col("day"), ERAS))


def usage_by_era(spark, d):
    """A2 J5"""
    dated = appearances(spark, d).join(orders(spark, d).select("o_orderkey", "season"), F.col("l_orderkey") == F.col("o_orderkey"))
    return dated.groupBy("season", "entity").agg(F.count("*").alias("n"))


def era_totals(spark, d):
    """A4 F13"""
    return orders(spark, d).groupBy(F.concat(F.lit("S"), F.col("season").cast("string")).alias("era")).agg(F.count("*").alias("n"))


def patch_token_for_date(spark, d):
    """J6 W5 A46"""
    windows = iv.patch_windows(spark.createDataFrame([(p,) for p in PATCHES], "version string"), ERAS)
    return iv.patch_token(orders(spark, d).select("day", "season"), "day", "season", windows).groupBy("token").agg(F.count("*").alias("n"))


def player_entity_matrix(spark, d):
    """A3"""
    owned = appearances(spark, d).join(t(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    used = dealt(owned.select("o_custkey", "entity"), "o_custkey", t(spark, d, "lineitem").count()).groupBy("o_custkey", "entity").agg(F.count("*").alias("n"))
    return t(spark, d, "customer").select("c_custkey").join(used, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "entity", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def oversize_sides(spark, d):
    """A5"""
    return sides(spark, d).agg(ap.oversize(4).alias("oversize"), F.count("*").alias("sides"))


def gate(spark, d):
    docs = t(spark, d, "documents")
    rules = [
        ("other-language", ~F.col("lang").isin("en", "fr")),
        ("licensed", F.col("text").rlike("(?i)license")),
        ("no-the", (F.col("lang") == "en") & ~F.col("text").rlike(" the ")),
        ("short", (F.col("n_chars") > 0) & (F.col("n_chars") < 300)),
    ]
    return docs.withColumn("reason", tx.first_reason(rules))


def gate_reason_tally(spark, d):
    """P1-P8 A8"""
    return gate(spark, d).groupBy(F.coalesce("reason", F.lit("passed")).alias("reason")).agg(F.count("*").alias("n"))


_GATE = "CASE WHEN lang NOT IN ('en', 'fr') THEN 'other-language' WHEN regexp_matches(text, '(?i)license') THEN 'licensed' WHEN lang = 'en' AND NOT contains(text, ' the ') THEN 'no-the' WHEN n_chars > 0 AND n_chars < 300 THEN 'short' END"


def coverage_by_source(spark, d):
    """A10"""
    g = gate(spark, d).groupBy("source").agg(F.count("*").alias("uploads"), F.count_if(F.col("reason").isNull()).alias("parsed"))
    all_sources = g.select("source").unionByName(spark.createDataFrame([("never-seen",)], "source string")).distinct()
    out = all_sources.join(g.withColumnRenamed("source", "s"), F.col("source") == F.col("s"), "left")
    u, p = F.coalesce("uploads", F.lit(0)).cast("long"), F.coalesce("parsed", F.lit(0)).cast("long")
    return out.select("source", u.alias("uploads"), p.alias("parsed"), F.round(F.coalesce(p / F.nullif(u, F.lit(0)), F.lit(0.0)), 6).alias("share"))


def alias_span_ids(spark, d):
    """T7 T8 T9"""
    ids = t(spark, d, "part").select(tx.span_ids(F.col("p_name"), ALIASES).alias("ids"))
    return ids.groupBy(F.array_join("ids", ",").alias("ids"), F.when(F.size("ids") == 1, F.get("ids", F.lit(0))).alias("one")).agg(F.count("*").alias("n"))


def residue_top(spark, d):
    """T10 A11 A12 O4"""
    rest = t(spark, d, "part").select("p_partkey", tx.residue(F.col("p_name"), ALIASES).alias("residue")).where("residue != ''")
    w = Window.partitionBy("residue").orderBy("p_partkey")
    firsts = rest.withColumn("rn", F.row_number().over(w)).groupBy("residue").agg(F.count("*").alias("n"), F.min("p_partkey").alias("example"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("rn") <= 5, F.col("p_partkey")))).cast("array<string>"), ",").alias("ids"))
    return firsts.where("n >= 3").orderBy(F.desc("n"), "residue").limit(25)


def iso_duration_seconds(spark, d):
    """F3"""
    q = F.col("l_quantity").cast("long")
    iso = F.when(q % 7 == 0, F.lit("bad")).when(q % 3 == 0, F.concat(F.lit("PT"), q.cast("string"), F.lit("M5S"))).when(q % 2 == 0, F.concat(F.lit("PT1H"), q.cast("string"), F.lit("S"))).otherwise(F.concat(F.lit("PT"), q.cast("string"), F.lit("S")))
    return t(spark, d, "lineitem").select(tx.duration_seconds(iso).alias("seconds")).groupBy("seconds").agg(F.count("*").alias("n"))


def slug_keys(spark, d):
    """T12 T14"""
    return t(spark, d, "customer").select("c_custkey", tx.slug(nfkd("c_name")).alias("slug"), F.regexp_replace(F.lower("c_name"), "[^a-z0-9]", "").alias("key"))


def pairs(spark, d):
    """The two sides of an order in order of first line, absent ones empty: two lists of one grouping."""
    items = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").join(t(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    side = lambda k: F.collect_list(F.when(F.col("l_linenumber") % 2 == k, F.struct("l_linenumber", "p_brand")))
    named = lambda c: F.array_distinct(F.transform(F.array_sort(c), lambda x: x["p_brand"])).alias(c)
    return items.groupBy("l_orderkey").agg(side(0).alias("a"), side(1).alias("b")).select("l_orderkey", named("a"), named("b"))


_PAIRS = f"{_SIDES}, pairs AS (SELECT l_orderkey, coalesce(any_value(characters) FILTER (side = 0), []) AS a, coalesce(any_value(characters) FILTER (side = 1), []) AS b FROM sides GROUP BY 1)"


def bench_alignment(spark, d):
    """Titles name the first of either side; every third record's bench has its sides crosswise, and every
    fifth is known by its handles."""
    sub = lambda x, y: (F.size(x) > 0) & (F.size(F.array_except(x, y)) == 0)
    title_a, title_b, cross = F.slice("a", 1, 1), F.slice("b", 1, 1), F.col("l_orderkey") % 3 == 1
    bench_a, bench_b = F.when(cross, F.col("b")).otherwise(F.col("a")), F.when(cross, F.col("a")).otherwise(F.col("b"))
    straight, swapped = sub(title_a, bench_a) & sub(title_b, bench_b), sub(title_a, bench_b) & sub(title_b, bench_a)
    how = F.when(F.col("l_orderkey") % 5 == 0, "handle").when(straight & ~swapped, "straight").when(swapped & ~straight, "swapped").otherwise("ambiguous")
    return pairs(spark, d).groupBy(how.alias("how")).agg(F.count("*").alias("n"))


def union_first_appearance(spark, d):
    """U2 T16"""
    return pairs(spark, d).select("l_orderkey", F.array_join(F.array_union("a", "b"), "|").alias("merged"), (F.size(F.array_except("a", "b")) > 0).alias("conflict"))


def cross_tier_disagreement(spark, d):
    """J21 U3"""
    p = pairs(spark, d).withColumn("extra", F.array_sort(F.array_except("a", "b")))
    return p.where(F.size("extra") > 0).select("l_orderkey", F.array_join("extra", "|").alias("extra"))


def share_exactly_one(spark, d):
    """U4: sides of one order that share exactly one entity."""
    shared = F.array_intersect("a", "b")
    return pairs(spark, d).where(F.size(shared) == 1).select(F.get(shared, F.lit(0)).alias("entity")).groupBy("entity").agg(F.count("*").alias("n"))


def override_apply(spark, d):
    """Every 7th record is overridden, of which every 3rd is excluded."""
    o = orders(spark, d).select("o_orderkey", "season", "o_orderpriority")
    ov = o.where("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 4).alias("ov_season"), (F.col("o_orderkey") % 3 == 0).alias("exclude"))
    out = o.join(ov.where("exclude"), F.col("o_orderkey") == F.col("k"), "left_anti").join(ov.where("not exclude"), F.col("o_orderkey") == F.col("k"), "left")
    return out.groupBy(F.coalesce(F.nullif("ov_season", F.lit(0)), "season").alias("season"), F.col("k").isNotNull().alias("overridden")).agg(F.count("*").alias("n"))


def freeze_carry_union(spark, d):
    """Finished orders are carried, the others parsed anew."""
    o = t(spark, d, "orders")
    carried, parsed = o.where("o_orderstatus = 'F'").withColumn("tier", F.lit("carried")), o.where("o_orderstatus != 'F'").withColumn("tier", F.lit("parsed"))
    return parsed.unionByName(carried).groupBy("tier").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def player_registry(spark, d):
    """The first variant of a user stays unless a later one with a lower-case e follows; the last such wins."""
    e = t(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("handle"))
    first = F.min_by("handle", "event_id")
    return e.groupBy("user_id").agg(first.alias("first"), F.max_by("handle", "event_id").alias("latest"), F.max_by("handle", F.when(F.contains("handle", F.lit("e")), F.col("event_id"))).alias("mixed")).select("user_id", F.coalesce("mixed", "first").alias("handle"), "latest")


def collapse_guard(spark, d):
    """A14 G4"""
    e = t(spark, d, "events").withColumn("late", F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    c = e.groupBy("event_type").agg(F.count_if(~F.col("late")).alias("before"), F.count_if(F.col("late") & (F.col("event_id") % 5 != 0)).alias("after"))
    lost = F.col("before") - F.col("after")
    return c.withColumn("trips", (F.col("before") > 0) & (lost > 20) & (lost / F.col("before") > 0.1))


def fk_violations(spark, d):
    """J7 J8 J9 G9"""
    o, c, l, p, s = (t(spark, d, x) for x in ("orders", "customer", "lineitem", "part", "supplier"))
    lost = lambda left, right, a, b, name: left.join(right, F.col(a) == F.col(b), "left_anti").agg(F.count("*").alias("n")).select(F.lit(name).alias("gate"), "n")
    out = lost(o, c, "o_custkey", "c_custkey", "order-customer")
    for x in (lost(c, o, "c_custkey", "o_custkey", "customer-order"), lost(l, p, "l_partkey", "p_partkey", "line-part"), lost(l, s, "l_suppkey", "s_suppkey", "line-supplier"), lost(l, o, "l_orderkey", "o_orderkey", "line-order")):
        out = out.unionByName(x)
    return out


def dupe_signature_pairs(spark, d):
    """Documents of one first line and about one length from other sources; the kept
    source is the first by name. dupe_token_set_pairs looks at whole texts."""
    docs = t(spark, d, "documents").select("doc_id", "source", "n_chars", F.substring_index("text", "\n", 1).alias("sig"))
    w = Window.partitionBy("sig").orderBy("n_chars", "doc_id")
    near = docs.withColumn("prev_id", F.lag("doc_id").over(w)).withColumn("delta", F.col("n_chars") - F.lag("n_chars").over(w)).withColumn("prev_source", F.lag("source").over(w))
    return near.where("delta <= 1 and source != prev_source").select("doc_id", "prev_id", "delta", F.least("source", "prev_source").alias("kept_source"))


def dupe_token_set_pairs(spark, d, precedence=("src2", "src0", "src1"), least=2):
    """Neighbours in length among documents of one set of words, from other
    sources. Documents without length or with fewer than least words are not keyable. Sources
    in precedence go before the others (place 99); of two alike the shorter one is kept."""
    words = F.array_sort(F.array_distinct(F.filter(F.split("text", "[ \\t-\\r]+"), lambda x: x != "")))
    docs = t(spark, d, "documents").select("doc_id", "source", "n_chars", words.alias("words")).where((F.col("n_chars") > 0) & (F.size("words") >= least))
    places = spark.createDataFrame([(s, k) for k, s in enumerate(precedence)], "source string, place int")
    docs = docs.select("doc_id", "source", "n_chars", F.sha2(F.array_join("words", " "), 256).alias("sig")).join(F.broadcast(places), "source", "left").withColumn("place", F.coalesce("place", F.lit(99)))
    w = Window.partitionBy("sig").orderBy("n_chars", "doc_id")
    near = docs.select("*", F.lag(F.struct("doc_id", "source", "n_chars", "place")).over(w).alias("prev")).where((F.col("n_chars") - F.col("prev.n_chars") <= 1) & ~F.col("source").eqNullSafe(F.col("prev.source")))
    first = F.col("prev.place") <= F.col("place")
    return near.select("doc_id", F.col("prev.doc_id").alias("prev_id"), (F.col("n_chars") - F.col("prev.n_chars")).alias("delta"), F.when(first, F.col("prev.doc_id")).otherwise(F.col("doc_id")).alias("kept_id"), F.when(first, F.col("prev.source")).otherwise(F.col("source")).alias("kept_source"))


def expiry_due(spark, d, as_of="2001-07-01"):
    """W20 W21 G15"""
    o = orders(spark, d).where("o_orderstatus = 'O'")
    stale = o.groupBy("o_orderpriority").agg(F.max("day").alias("newest")).where(F.datediff(F.lit(as_of).cast("date"), F.col("newest").cast("date")) > 21).select(F.lit("cadence").alias("kind"), F.col("o_orderpriority").alias("id"), F.col("newest").alias("date"))
    due = o.where((F.col("o_totalprice") > 400000) & (F.col("day") <= as_of)).select(F.lit("order").alias("kind"), F.col("o_orderkey").cast("string").alias("id"), F.col("day").alias("date"))
    return stale.unionByName(due)


def content_digest(spark, d):
    """One digest for each season, from bounded lines (one for each customer)."""
    o = orders(spark, d).groupBy("season", "o_custkey").agg(F.count("*").alias("n"))
    part = o.groupBy("season", (F.col("o_custkey") % 64).alias("shard")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_custkey", "n"))), lambda s: F.concat_ws(":", s["o_custkey"].cast("string"), s["n"].cast("string"))), "\n"), 256).alias("h"))
    return part.groupBy("season").agg(F.left(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("shard", "h"))), lambda s: s["h"]), ""), 256), F.lit(12)).alias("digest"), F.count("*").alias("shards"))


def json_sorted_map(spark, d):
    """O3 F18 K3"""
    c = t(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return c.groupBy("o_orderstatus").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderpriority", "n"))), lambda s: F.concat_ws("=", s["o_orderpriority"], s["n"].cast("string"))), ",").alias("counts"))


def worklist_rarity(spark, d):
    """template_worklist has the order."""
    one = F.collect_list(F.when(F.col("side") == 0, F.col("entity")))
    p = appearances(spark, d).groupBy("l_orderkey").agg(one.alias("a"), F.count_if(F.col("side") == 1).alias("n")).where((F.size("a") >= 2) & (F.col("n") >= 2)).select("l_orderkey", F.explode("a").alias("entity"))
    freq = p.groupBy(F.col("entity").alias("of")).agg(F.count("*").alias("f"))
    return p.join(freq, F.col("entity") == F.col("of")).groupBy("l_orderkey").agg(F.min("f").alias("rarity"), F.count("*").alias("candidates"))


def settled_worklist(spark, d):
    """WL3 U8: bench_worklist has the whole list."""
    p = pairs(spark, d)
    full, control = F.size("a") >= 4, F.size(F.array_except(F.slice("b", 1, 1), F.col("a"))) == 0
    return p.groupBy((full & control).alias("settled"), (full & ~control).alias("recheck")).agg(F.count("*").alias("n"))


def season_summary(spark, d):
    """A7 A48"""
    o = orders(spark, d)
    return o.groupBy("season").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("players"), F.max("day").alias("updated"))


def entity_filter(spark, d):
    """V1 V2: orders that field an entity of the group, by season."""
    hits = sides(spark, d).where(F.exists("characters", lambda c: c.isin("Brand#1", "Brand#12"))).select("l_orderkey").distinct()
    return orders(spark, d).join(hits, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").groupBy("season").agg(F.count("*").alias("n"))


_WINDOWS = "w(version, s, e, season) AS (VALUES ('1996-01-01', '1996-01-01', '1996-07-01', 1), ('1996-07-01', '1996-07-01', '1998-01-01', 1), ('1998-01-01', '1998-01-01', '1998-09-15', 2), ('1998-09-15', '1998-09-15', '2000-01-01', 2), ('2000-03-01', '2000-03-01', '2001-01-01', 3), ('2001-01-01', '2001-01-01', NULL, 3))"

SQL = {
    "side_appearance_usage": f"WITH {_ITEMS} SELECT p_brand AS entity, count(*) AS n FROM items GROUP BY 1",
    "usage_identity": f"WITH {_SIDES}, u AS (SELECT entity, count(*) AS n FROM (SELECT unnest(characters) AS entity FROM sides) GROUP BY 1) SELECT CAST((SELECT sum(n) FROM u) - (SELECT sum(len(characters)) FROM sides) AS BIGINT) AS gap",
    "usage_by_era": f"WITH {_ITEMS} SELECT CAST({_SEASON} AS BIGINT) AS season, p_brand AS entity, count(*) AS n FROM items JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL",
    "era_totals": f"SELECT concat('S', {_SEASON}) AS era, count(*) AS n FROM orders GROUP BY 1",
    "patch_token_for_date": f"WITH {_WINDOWS}, o AS (SELECT {_DAY} AS day, {_SEASON} AS season FROM orders) SELECT CASE WHEN w.season = o.season THEN version ELSE concat('S', o.season) END AS token, count(*) AS n FROM o LEFT JOIN w ON day >= s AND (e IS NULL OR day < e) GROUP BY 1",
    "player_entity_matrix": f"WITH {_ITEMS}, u AS (SELECT o_custkey, p_brand, count(*) AS n FROM items JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) SELECT c_custkey, p_brand AS entity, CAST(coalesce(n, 0) AS BIGINT) AS n FROM customer LEFT JOIN u ON c_custkey = o_custkey",
    "oversize_sides": f"WITH {_SIDES} SELECT count(*) FILTER (len(characters) > 4) AS oversize, count(*) AS sides FROM sides",
    "gate_reason_tally": f"SELECT coalesce({_GATE}, 'passed') AS reason, count(*) AS n FROM documents GROUP BY 1",
    "coverage_by_source": f"WITH g AS (SELECT source, count(*) AS uploads, count(*) FILTER (({_GATE}) IS NULL) AS parsed FROM documents GROUP BY 1) SELECT source, uploads, parsed, round(parsed / uploads, 6) AS share FROM g UNION ALL SELECT 'never-seen', 0, 0, 0.0",
    "alias_span_ids": "WITH x AS (SELECT regexp_extract_all(lower(p_name), '(small ring|widget|bolt|ring|red)') AS m FROM part), y AS (SELECT list_transform(m, lambda a: CASE a WHEN 'small ring' THEN 'sr' WHEN 'widget' THEN 'w' WHEN 'bolt' THEN 'b' WHEN 'ring' THEN 'r' ELSE 'red' END) AS ids FROM x) SELECT array_to_string(ids, ',') AS ids, CASE WHEN len(ids) = 1 THEN ids[1] END AS one, count(*) AS n FROM y GROUP BY ALL",
    "residue_top": "WITH x AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(p_name, '(small ring|widget|bolt|ring|red)', ' ', 'g'), '\\s+', ' ', 'g')) AS residue FROM part), y AS (SELECT *, row_number() OVER (PARTITION BY residue ORDER BY p_partkey) AS rn FROM x WHERE residue != '') SELECT residue, count(*) AS n, min(p_partkey) AS example, string_agg(p_partkey, ',' ORDER BY p_partkey) FILTER (rn <= 5) AS ids FROM y GROUP BY 1 HAVING count(*) >= 3 ORDER BY n DESC, residue LIMIT 25",
    "iso_duration_seconds": "WITH q AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS q FROM lineitem) SELECT CASE WHEN q % 7 = 0 THEN 0 WHEN q % 3 = 0 THEN q * 60 + 5 WHEN q % 2 = 0 THEN 3600 + q ELSE q END AS seconds, count(*) AS n FROM q GROUP BY 1",
    "slug_keys": "SELECT c_custkey, regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS key FROM customer",
    "bench_alignment": f"WITH {_PAIRS}, x AS (SELECT l_orderkey AS k, a[1] AS ta, b[1] AS tb, CASE WHEN l_orderkey % 3 = 1 THEN b ELSE a END AS ba, CASE WHEN l_orderkey % 3 = 1 THEN a ELSE b END AS bb FROM pairs), f AS (SELECT k, coalesce(list_contains(ba, ta) AND list_contains(bb, tb), false) AS straight, coalesce(list_contains(bb, ta) AND list_contains(ba, tb), false) AS swapped FROM x) SELECT CASE WHEN k % 5 = 0 THEN 'handle' WHEN straight AND NOT swapped THEN 'straight' WHEN swapped AND NOT straight THEN 'swapped' ELSE 'ambiguous' END AS how, count(*) AS n FROM f GROUP BY 1",
    "union_first_appearance": f"WITH {_PAIRS} SELECT l_orderkey, array_to_string(list_concat(a, list_filter(b, lambda x: NOT list_contains(a, x))), '|') AS merged, len(list_filter(a, lambda x: NOT list_contains(b, x))) > 0 AS conflict FROM pairs",
    "cross_tier_disagreement": f"WITH {_PAIRS}, e AS (SELECT l_orderkey, list_sort(list_filter(a, lambda x: NOT list_contains(b, x))) AS extra FROM pairs) SELECT l_orderkey, array_to_string(extra, '|') AS extra FROM e WHERE len(extra) > 0",
    "share_exactly_one": f"WITH {_PAIRS}, s AS (SELECT list_filter(a, lambda x: list_contains(b, x)) AS i FROM pairs) SELECT i[1] AS entity, count(*) AS n FROM s WHERE len(i) = 1 GROUP BY 1",
    "override_apply": f"WITH o AS (SELECT o_orderkey, {_SEASON} AS season FROM orders) SELECT CAST(CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 4 != 0 THEN o_orderkey % 4 ELSE season END AS BIGINT) AS season, o_orderkey % 7 = 0 AS overridden, count(*) AS n FROM o WHERE NOT (o_orderkey % 7 = 0 AND o_orderkey % 3 = 0) GROUP BY ALL",
    "freeze_carry_union": "SELECT CASE WHEN o_orderstatus = 'F' THEN 'carried' ELSE 'parsed' END AS tier, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
    "player_registry": "WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN upper(event_type) ELSE event_type END AS handle FROM events) SELECT user_id, coalesce(arg_max(handle, event_id) FILTER (contains(handle, 'e')), arg_min(handle, event_id)) AS handle, arg_max(handle, event_id) AS latest FROM e GROUP BY 1",
    "collapse_guard": "WITH c AS (SELECT event_type, count(*) FILTER (ts < '2024-01-16') AS before, count(*) FILTER (ts >= '2024-01-16' AND event_id % 5 != 0) AS after FROM events GROUP BY 1) SELECT *, before > 0 AND before - after > 20 AND (before - after) / before > 0.1 AS trips FROM c",
    "fk_violations": " UNION ALL ".join(f"SELECT '{n}' AS gate, count(*) AS n FROM {a} WHERE NOT EXISTS (SELECT 1 FROM {b} WHERE {x} = {y})" for n, a, b, x, y in [("order-customer", "orders", "customer", "o_custkey", "c_custkey"), ("customer-order", "customer", "orders", "c_custkey", "o_custkey"), ("line-part", "lineitem", "part", "l_partkey", "p_partkey"), ("line-supplier", "lineitem", "supplier", "l_suppkey", "s_suppkey"), ("line-order", "lineitem", "orders", "l_orderkey", "o_orderkey")]),
    "dupe_signature_pairs": "WITH x AS (SELECT doc_id, source, n_chars, split_part(text, chr(10), 1) AS sig FROM documents), y AS (SELECT *, lag(doc_id) OVER w AS prev_id, n_chars - lag(n_chars) OVER w AS delta, lag(source) OVER w AS prev_source FROM x WINDOW w AS (PARTITION BY sig ORDER BY n_chars, doc_id)) SELECT doc_id, prev_id, delta, least(source, prev_source) AS kept_source FROM y WHERE delta <= 1 AND source != prev_source",
    "dupe_token_set_pairs": r"""WITH w AS (SELECT doc_id, source, n_chars, list_sort(list_distinct(list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x != ''))) AS words FROM documents WHERE n_chars > 0),
  x AS (SELECT doc_id, source, n_chars, array_to_string(words, ' ') AS sig, CASE source WHEN 'src2' THEN 0 WHEN 'src0' THEN 1 WHEN 'src1' THEN 2 ELSE 99 END AS place FROM w WHERE len(words) >= 2),
  y AS (SELECT *, lag(doc_id) OVER v AS prev_id, n_chars - lag(n_chars) OVER v AS delta, lag(source) OVER v AS prev_source, lag(place) OVER v AS prev_place FROM x WINDOW v AS (PARTITION BY sig ORDER BY n_chars, doc_id))
  SELECT doc_id, prev_id, delta, CASE WHEN prev_place <= place THEN prev_id ELSE doc_id END AS kept_id, CASE WHEN prev_place <= place THEN prev_source ELSE source END AS kept_source FROM y WHERE delta <= 1 AND source IS DISTINCT FROM prev_source""",
    "expiry_due": f"WITH o AS (SELECT *, {_DAY} AS day FROM orders WHERE o_orderstatus = 'O') SELECT 'cadence' AS kind, o_orderpriority AS id, max(day) AS date FROM o GROUP BY 2 HAVING date_diff('day', CAST(max(day) AS DATE), DATE '2001-07-01') > 21 UNION ALL SELECT 'order', CAST(o_orderkey AS VARCHAR), day FROM o WHERE o_totalprice > 400000 AND day <= '2001-07-01'",
    "content_digest": f"WITH o AS (SELECT {_SEASON} AS season, o_custkey, count(*) AS n FROM orders GROUP BY ALL), p AS (SELECT season, o_custkey % 64 AS shard, sha256(string_agg(o_custkey || ':' || n, chr(10) ORDER BY o_custkey)) AS h FROM o GROUP BY ALL) SELECT CAST(season AS BIGINT) AS season, left(sha256(string_agg(h, '' ORDER BY shard)), 12) AS digest, count(*) AS shards FROM p GROUP BY 1",
    "json_sorted_map": "WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) SELECT o_orderstatus, string_agg(o_orderpriority || '=' || n, ',' ORDER BY o_orderpriority) AS counts FROM c GROUP BY 1",
    "worklist_rarity": f"WITH {_PAIRS}, p AS (SELECT * FROM pairs WHERE len(a) >= 2 AND len(b) >= 2), x AS (SELECT l_orderkey, unnest(a) AS entity FROM p), f AS (SELECT entity, count(*) AS f FROM x GROUP BY 1) SELECT l_orderkey, min(f) AS rarity, count(*) AS candidates FROM x JOIN f USING (entity) GROUP BY 1",
    "settled_worklist": f"WITH {_PAIRS}, x AS (SELECT len(a) >= 4 AS f, len(b) = 0 OR list_contains(a, b[1]) AS c FROM pairs) SELECT f AND c AS settled, f AND NOT c AS recheck, count(*) AS n FROM x GROUP BY ALL",
    "season_summary": f"SELECT CAST({_SEASON} AS BIGINT) AS season, count(*) AS n, count(DISTINCT o_custkey) AS players, max({_DAY}) AS updated FROM orders GROUP BY 1",
    "entity_filter": f"SELECT CAST({_SEASON} AS BIGINT) AS season, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand IN ('Brand#1', 'Brand#12')) GROUP BY 1",
}

QUERIES = {name: globals()[name] for name in SQL}
