"""Queries on landed files, merges, stores and streams; customers stand for uploads, their
nations for channels, orders for videos, events for timed reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.sources import landed, sinks
from quillon.sources.shared import shared_path
from quillon.streaming import reads as st


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def hour(c: str):
    return F.date_format(c, "yyyy-MM-dd HH").alias("hour")


def upload_playlists(spark, d):
    """S18"""
    return t(spark, d, "customer").select("c_custkey", landed.uploads_playlist(F.col("c_name")).alias("playlist"))


def hydrate_requests(spark, d):
    """S2"""
    found = landed.requests(t(spark, d, "customer"), "c_nationkey", "c_custkey")
    return found.select("c_nationkey", "request", F.size("ids").cast("long").alias("n"), F.element_at("ids", 1).alias("first"), F.element_at("ids", -1).alias("last"))


def sampling_plans(spark, d):
    """S11"""
    day = t(spark, d, "orders").select("o_orderkey", F.floor("o_totalprice").alias("s"))
    recon = F.transform(landed.recon_plan(F.col("s")), lambda w: w["start"])
    plans = {"single": landed.single_plan(F.col("s")), "burst": landed.burst_plan(F.col("s")), "recon": recon}
    plans = F.array(*(F.struct(F.lit(k).alias("plan"), at.alias("at")) for k, at in plans.items()))
    rows = day.select("o_orderkey", F.inline(plans))
    return rows.select("o_orderkey", "plan", F.array_join(F.transform("at", lambda x: x.cast("string")), ",").alias("at"))


def raw_dump_scan(spark, d):
    """Uploads written as JSON by source and scanned again, fields that are null left out."""
    path = shared_path(spark, "raw")
    docs = t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "source", F.col("text").alias("title"), F.nullif("lang", F.lit("de")).alias("description"))
    docs.withColumnRenamed("source", "channel").write.option("ignoreNullFields", True).json(path)
    raw = landed.scan_if_there(spark, path)
    return raw.groupBy("channel").agg(F.count("*").alias("n"), F.sum(F.char_length("title")).alias("chars"), F.count("description").alias("described"))


def override_upsert(spark, d):
    """K6 K8: every third order gets another status, every fifth another priority, every eleventh goes."""
    old = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = old.where("o_orderkey % 3 = 0 or o_orderkey % 5 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "X").alias("o_orderstatus"), F.when(F.col("o_orderkey") % 5 == 0, "0").alias("o_orderpriority"))
    gone = old.where("o_orderkey % 11 = 0")
    return sinks.delete(sinks.upsert(old, new, "o_orderkey"), gone, "o_orderkey").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


def side_writes(spark, d):
    """One side replaced, a member appended to the other."""
    status = F.array(F.array("o_orderstatus"), F.array(F.lit("a"), F.lit("b")))
    done = sinks.append_member(sinks.replace_side(status, F.lit(0), F.array(F.lit("h"))), (F.col("o_orderkey") % 2).cast("int"), F.col("o_orderpriority"))
    text = F.array_join(F.transform(done, lambda s: F.array_join(s, "+")), "~")
    return t(spark, d, "orders").select(text.alias("sides")).groupBy("sides").agg(F.count("*").alias("n"))


def label_merge(spark, d):
    """K10"""
    labels = t(spark, d, "labels").select("doc_id", "quality", "toxic")
    live = labels.where("doc_id % 3 != 0")
    snapshot = labels.where("doc_id % 2 = 0").withColumn("quality", 1 - F.col("quality"))
    named = sinks.identity({"toxic": F.col("toxic"), "quality": F.col("quality")})
    return sinks.merge_labels(live, snapshot, "doc_id").groupBy(named.alias("label")).agg(F.count("*").alias("n"))


def incremental_store(spark, d):
    """K9: one partition written anew, the others as they were."""
    path = shared_path(spark, "store")
    reads = t(spark, d, "events").select("event_id", "event_type", F.lit("old").alias("state"))
    sinks.write_partitions(reads, path, "event_type")
    sinks.write_partitions(reads.where("event_type = 'click'").withColumn("state", F.lit("new")), path, "event_type")
    return spark.read.schema("event_id bigint, state string, event_type string").parquet(path).groupBy("event_type", "state").agg(F.count("*").alias("n"))


def _stream(spark, d, files=None):
    rows = st.stream(spark, f"{d}/events.parquet*", t(spark, d, "events").schema, files)
    return rows.withColumn("at", F.col("ts").cast("timestamp"))


def stream_hourly_reads(spark, d):
    """W1 as a stream: closed hours only, the watermark frees the rest's state."""
    return st.drain(spark, st.windowed(_stream(spark, d), "at", "1 hour", "event_type"), "hours").select(hour("start"), "event_type", "n")


def stream_bursts(spark, d):
    """W1 as a stream: bursts that are over."""
    return st.drain(spark, st.bursts(_stream(spark, d), "at", "30 minutes", "user_id"), "bursts").select("user_id", hour("start"), "n")


def stream_first_seen(spark, d):
    """U8 as a stream: a read that repeats an id goes."""
    both = _stream(spark, d)
    twice = both.select("event_id", "at", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    return st.drain(spark, st.first_seen(twice, "at", "event_id"), "seen").select("event_id")


def stream_store(spark, d):
    """K9 as a stream."""
    path = shared_path(spark, "stream")
    st.into_store(_stream(spark, d, 64).select("event_id", "event_type"), path, "event_type", f"{path}-log")
    return spark.read.schema("event_id bigint, event_type string").parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


def _spaced(low: float, high: float) -> str:
    return f"list_transform(range(12), lambda i: CAST(floor(s * ({low}::DOUBLE + ({high}::DOUBLE - {low}::DOUBLE) * i / 11) + 0.5) AS BIGINT))"


SQL = {
    "upload_playlists": "SELECT c_custkey, 'UU' || substr(c_name, 3) AS playlist FROM customer",
    "hydrate_requests": "WITH x AS (SELECT c_nationkey, c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 50 AS request FROM customer) SELECT c_nationkey, request, count(*) AS n, min(c_custkey) AS first, max(c_custkey) AS last FROM x GROUP BY ALL",
    "sampling_plans": f"WITH x AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS s FROM orders), p AS (SELECT o_orderkey, s, {_spaced(0.08, 0.94)} AS single, {_spaced(0.06, 0.90)} AS burst FROM x) SELECT o_orderkey, 'single' AS plan, array_to_string(single, ',') AS at FROM p UNION ALL SELECT o_orderkey, 'burst', array_to_string(burst, ',') FROM p UNION ALL SELECT o_orderkey, 'recon', array_to_string(list_concat([0, CAST(floor(s * 0.45::DOUBLE) AS BIGINT)], single), ',') FROM p",
    "raw_dump_scan": "SELECT source AS channel, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, count(nullif(lang, 'de')) AS described FROM documents GROUP BY 1",
    "override_upsert": "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE o_orderpriority END AS o_orderpriority, count(*) AS n FROM orders WHERE o_orderkey % 11 != 0 GROUP BY ALL",
    "side_writes": "SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'h+' || o_orderpriority || '~a+b' ELSE 'h~a+b+' || o_orderpriority END AS sides, count(*) AS n FROM orders GROUP BY 1",
    "label_merge": "WITH m AS (SELECT CASE WHEN doc_id % 3 != 0 THEN quality ELSE 1 - quality END AS q, toxic FROM labels WHERE doc_id % 3 != 0 OR doc_id % 2 = 0) SELECT '{\"quality\":' || q || ',\"toxic\":' || toxic || '}' AS label, count(*) AS n FROM m GROUP BY 1",
    "incremental_store": "SELECT event_type, CASE WHEN event_type = 'click' THEN 'new' ELSE 'old' END AS state, count(*) AS n FROM events GROUP BY ALL",
    "stream_hourly_reads": "WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events) SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events, m WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY ALL",
    "stream_bursts": "WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events), f AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER w > INTERVAL 30 MINUTE, true) AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts) AS burst FROM f), b AS (SELECT user_id, min(ts) AS s, max(ts) AS e, count(*) AS n FROM g GROUP BY user_id, burst) SELECT user_id, strftime(date_trunc('hour', s), '%Y-%m-%d %H') AS hour, n FROM b, m WHERE e + INTERVAL 30 MINUTE <= mark",
    "stream_first_seen": "SELECT event_id FROM events",
    "stream_store": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
}

QUERIES = {name: globals()[name] for name in SQL}
