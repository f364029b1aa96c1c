"""Queries on titles and descriptions of uploads. The test tables hold none, so every order is
one upload whose key picks the shape of its text; the SQL says what each shape must give."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions.vectorized import nfc, nfkd
from quillon.operators import text as tx
from quillon.operators import titles as ti

NAMES = {"Iron Bolt": "iron-bolt", "Ring-Man": "ring-man", "Small Ring": "small-ring", "Ring": "ring", "Nut": "nut"}
GATE = ti.Gate(tx.whole_words(["GAME", "GĀME"]), tx.whole_words(["OTHER"]), tx.whole_words(["TRAILER", "TIER LIST"]), "2026-08-06")
_IDS = "['iron-bolt', 'ring-man', 'small-ring', 'ring', 'nut']"


def _orders(spark, d):
    """k, two handles and two different fighters by display name and by id."""
    k = F.col("o_orderkey")
    i, j = k % 5, (k % 5 + 1 + F.expr("o_orderkey div 5") % 4) % 5
    pick = lambda values, at: F.element_at(F.array(*(F.lit(v) for v in values)), (at + 1).cast("int"))
    return spark.read.parquet(f"{d}/orders.parquet").select(
        k.alias("k"), F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("h1"), F.concat(F.lit("Q"), k.cast("string")).alias("h2"),
        pick(NAMES, i).alias("a"), pick(NAMES, j).alias("b"), pick(NAMES.values(), i).alias("ia"), pick(NAMES.values(), j).alias("ib"),
    )


_ORDERS = f"""o AS (SELECT o_orderkey AS k, 'P' || o_custkey AS h1, 'Q' || o_orderkey AS h2,
  {_IDS}[CAST(o_orderkey % 5 + 1 AS INT)] AS a, {_IDS}[CAST((o_orderkey % 5 + 1 + (o_orderkey // 5) % 4) % 5 + 1 AS INT)] AS b FROM orders)"""

#: Titles by k % 23: {1} and {2} are handles, a and b fighters.
SHAPES = [
    "GAME ▰ {1} (a) vs {2} (b) ▰ high level", "GAME ▰ {1} (a) vs (b) {2} 👊【Game】", "{1} (a) vs {2} (b) ▰ GAME", "{1} (#2 Ranked a/b) versus {2} (b, and a) ▰ GAME",
    "a vs b ▰ GAME replays ▰ {1} vs {2} ▰ x", "GAME ▰ {1} (a)(b) vs {2} (b)", "GAME ▰ {1} vs {2} ▰", "GAME ▰ {1} (a) ▰ Rank 1 ▰ vs {2} (b)", "GAME ▰ {1} (a) vs {2} (b) vs {1} (a)",
    "GAME ▰ " + "x" * 41 + " (a) vs {2} (b)", "GAME ▰ {1} (Bolded) vs {2} (b)", "OTHER ▰ {1} (a) vs {2} (b)", "{1} (a) vs {2} (b)", "GAME OTHER ▰ {1} (a) vs {2} (b)",
    "GAME ▰ {1} (a) vs {2} (b)", "GAME ▰ {1} (a) vs {2} (b)", "GAME trailer ▰ {1} (a) vs {2} (b)", "GAME ▰ {1} (a) vs {2} (b)", "GAME ▰ {1} (a) vs. {2} (b)", "{1} (a) vs {2} (b)",
    "GĀME ▰ {1} (a) vs {2} (b)", "GAME ▰ {1} (a) vs {2}", "  GAME  ▰ 🔥 {1} - (a)   vs 　{2} (b) — 🎮",
]


def uploads(spark, d):
    """An upload for every order; its shape decides on title, day, flag and length."""
    o = _orders(spark, d)
    shape, odd = F.col("k") % len(SHAPES), F.col("k") % 2 == 1
    text = F.element_at(F.array(*(F.lit(s) for s in SHAPES)), (shape + 1).cast("int"))
    for mark, field in ((r"\{1\}", "h1"), (r"\{2\}", "h2")):
        text = F.regexp_replace(text, F.lit(mark), F.col(field))
    # Fighters stand for single letters between signs that are neither letters nor digits.
    for mark, field in ((r"(?<![A-Za-z0-9])a(?![A-Za-z0-9])", "a"), (r"(?<![A-Za-z0-9])b(?![A-Za-z0-9])", "b")):
        text = F.regexp_replace(text, F.lit(mark), F.col(field))
    return o.select(
        "k", text.alias("raw"), F.when(shape == 19, "a GAME match").alias("description"), (odd & (shape == 19)).alias("widened"),
        F.when(shape == 14, "2026-08-05T23:59:59Z").otherwise("2026-08-06T00:00:00Z").alias("published"),
        F.when(shape == 15, "live").when(odd, "none").alias("live"),
        F.when(shape == 17, F.when(odd, 1).otherwise(59)).when(shape == 18, F.when(odd, 0).otherwise(60)).otherwise(300).alias("seconds"),
    ).withColumn("title", nfc("raw"))


def _parsed(spark, d):
    return ti.parsed(uploads(spark, d), GATE, {n.lower(): i for n, i in NAMES.items()})


_EXPECTED = f"""WITH {_ORDERS}, e AS (SELECT *, k % 23 AS shape, CASE
  WHEN k % 23 = 5 THEN 'slot-ambiguous' WHEN k % 23 IN (6, 10) THEN 'char-unresolved' WHEN k % 23 IN (7, 8, 21) THEN 'no-vs-title'
  WHEN k % 23 = 9 THEN 'bad-handle' WHEN k % 23 IN (11, 13) THEN 'other-game' WHEN k % 23 = 12 OR (k % 23 = 19 AND k % 2 = 0) THEN 'not-this-game'
  WHEN k % 23 = 14 THEN 'pre-launch' WHEN k % 23 = 15 THEN 'live-or-upcoming' WHEN k % 23 = 16 THEN 'not-a-match' WHEN k % 23 = 17 THEN 'short-duration' END AS reason FROM o)"""

#: A fighter as titles say it.
_SAID = "['Iron Bolt', 'Ring-Man', 'Small Ring', 'Ring', 'Nut'][list_position(" + _IDS + ", b)]"


def title_parses(spark, d):
    """What every title gives."""
    p = F.col("parse")
    sides = F.array_join(F.transform(p["characters"], lambda c: F.array_join(c, "+")), "|")
    return _parsed(spark, d).select("k", p["reason"].alias("reason"), p["detail"].alias("detail"), F.array_join(p["orders"], "|").alias("orders"), F.array_join(p["handles"], "|").alias("handles"), sides.alias("characters"), (F.col("raw") != F.col("title")).alias("decomposed"))


def slot_order_tally(spark, d):
    """Sides by the order of their slot."""
    return _parsed(spark, d).select(F.explode("parse.orders").alias("slot_order")).groupBy("slot_order").agg(F.count("*").alias("n"))


def review_rows(spark, d):
    """Misses that go to review, with the handles that are known."""
    p = _parsed(spark, d).where("parse.queue is not null")
    return p.select("k", F.col("parse.queue").alias("queue"), F.get("parse.handles", F.lit(0)).alias("left_handle"), F.get("parse.handles", F.lit(1)).alias("right_handle"))


def miss_reasons(spark, d):
    """Misses by reason."""
    return _parsed(spark, d).where("parse.reason is not null").groupBy(F.col("parse.reason").alias("reason")).agg(F.count("*").alias("n"), F.min("k").alias("example"))


def description_benches(spark, d):
    """Sides named in descriptions, by k % 7: lines, a line said twice, one line only, a
    sentence, a sentence too far down, nothing, an unknown name."""
    o = _orders(spark, d)
    fmt = lambda pattern, *c: F.format_string(pattern, *(F.col(x) for x in c))
    shape = F.col("k") % 7
    text = (
        F.when(shape == 0, fmt("intro\nPlayer 1: %s (%s)\nplayer2 : %s (%s)", "h1", "a", "h2", "b"))
        .when(shape == 1, fmt("Player 1: Zed (%s)\nPlayer 2: %s (%s)\nPLAYER 1: %s (%s, %s)", "b", "h2", "b", "h1", "a", "b"))
        .when(shape == 2, fmt("Player 1: %s (%s)", "h1", "a"))
        .when(shape == 3, fmt("Watch this!\n%s (%s, %s) vs. %s (%s)\nPlayer 1: x (y)", "h1", "a", "b", "h2", "b"))
        .when(shape == 4, F.concat(F.repeat(F.lit("."), 900), fmt("\n%s (%s) vs %s (%s)", "h1", "a", "h2", "b")))
        .when(shape == 6, fmt("%s (%s and Cog) versus %s (Cog)", "h1", "a", "h2"))
    )
    sides = ti.bench(text, shape < 3, {n.lower(): i for n, i in NAMES.items()})
    out = o.select("k", sides.alias("sides"))
    field = lambda i, f: F.get("sides", F.lit(i))[f]
    return out.select("k", field(0, "handle").alias("handle_1"), F.array_join(field(0, "characters"), "+").alias("characters_1"), field(0, "residue").alias("residue_1"), field(1, "handle").alias("handle_2"), F.array_join(field(1, "characters"), "+").alias("characters_2"), field(1, "residue").alias("residue_2"))


def description_alignment(spark, d):
    """T14 T15 and the characters of T16: benches against titles by k % 8: handles in order, crosswise, characters in
    order, crosswise, both ways, neither, an empty side, handles in other letters."""
    o, shape = _orders(spark, d).withColumn("none", F.array().cast("array<string>")), F.col("k") % 8
    a, b, both = F.array("ia"), F.array("ib"), F.array("ia", "ib")
    by = lambda *cases: F.coalesce(*(F.when(shape.isin(s) if isinstance(s, int) else shape.isin(*s), v) for s, v in cases))
    o = o.select(
        "k", "h1", "h2", by(((0, 1, 2, 3, 4, 5, 7), a), (6, F.col("none"))).alias("ta"), b.alias("tb"),
        by(((0, 2, 6, 7), a), ((1, 3), b), (4, both), (5, F.col("none"))).alias("ba"), by(((0, 2, 6, 7), b), ((1, 3), a), (4, both), (5, F.col("none"))).alias("bb"),
        by((0, F.col("h1")), (1, F.col("h2")), (7, F.concat(F.lower("h1"), F.lit("́ !"))), ((2, 3, 4, 5, 6), F.lit("someone"))).alias("d1"),
        by((0, F.col("h2")), (1, F.col("h1")), (7, F.concat(F.lit("ｑ"), F.substring("h2", 2, 40))), ((2, 3, 4, 5), F.lit("else")), (6, F.lit("!"))).alias("d2"),
    )
    for c in ("h1", "h2", "d1", "d2"):
        o = o.withColumn(c, ti.handle_key(nfkd(c)))
    o = o.withColumn("found", ti.alignment([F.col("h1"), F.col("h2")], [F.col("d1"), F.col("d2")], [F.col("ta"), F.col("tb")], [F.col("ba"), F.col("bb")]))
    mine = F.when(~F.col("found.swapped"), F.col("ba")).when(F.col("found.swapped"), F.col("bb"))
    side = ti.side_characters(F.col("ta"), mine)
    return o.select("k", "found.how", "found.swapped", F.array_join(side["characters"], "+").alias("characters"), side["tier"].alias("tier"), side["conflict"].alias("conflict"))


def patch_title_dates(spark, d):
    """Days of patch titles, none for every third."""
    day = F.col("o_orderdate").cast("date")
    title = F.when(F.col("o_orderkey") % 3 == 0, F.lit("Patch notes")).otherwise(F.format_string("The PATCH update %d/%d/%d is here", F.month(day), F.dayofmonth(day), F.year(day)))
    return spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"), ti.patch_date(title).alias("day"))


QUERIES = {f.__name__: f for f in (title_parses, slot_order_tally, review_rows, miss_reasons, description_benches, description_alignment, patch_title_dates)}

SQL = {
    "title_parses": f"""{_EXPECTED} SELECT k, reason, CASE WHEN shape = 13 THEN 'both markers' WHEN shape IN (6, 21) THEN 'no (chars) slot' WHEN shape = 9 THEN repeat('x', 41) || ' | ' || h2 WHEN shape = 10 THEN 'Bolded | ' || {_SAID} END AS detail,
      CASE WHEN reason IS NULL THEN CASE shape WHEN 4 THEN 'parallel-lists|parallel-lists' WHEN 1 THEN 'handle-first|chars-first' ELSE 'handle-first|handle-first' END END AS orders,
      CASE WHEN reason IS NULL OR reason = 'char-unresolved' THEN h1 || '|' || h2 END AS handles,
      CASE WHEN reason IS NULL THEN CASE shape WHEN 3 THEN a || '+' || b || '|' || b || '+' || a ELSE a || '|' || b END END AS characters, shape = 20 AS decomposed FROM e""",
    "slot_order_tally": f"""{_EXPECTED} SELECT slot_order, count(*) AS n FROM (SELECT unnest(CASE shape WHEN 4 THEN ['parallel-lists', 'parallel-lists'] WHEN 1 THEN ['handle-first', 'chars-first']
      ELSE ['handle-first', 'handle-first'] END) AS slot_order FROM e WHERE reason IS NULL) GROUP BY 1""",
    "review_rows": f"""{_EXPECTED} SELECT k, CASE shape WHEN 5 THEN 'slot-ambiguous' ELSE 'character-completion' END AS queue, CASE WHEN shape <> 5 THEN h1 END AS left_handle,
      CASE WHEN shape <> 5 THEN h2 END AS right_handle FROM e WHERE shape IN (5, 6, 10)""",
    "miss_reasons": f"{_EXPECTED} SELECT reason, count(*) AS n, min(k) AS example FROM e WHERE reason IS NOT NULL GROUP BY 1",
    "description_benches": f"""WITH {_ORDERS}, s AS (SELECT *, k % 7 AS shape, k % 7 IN (0, 1, 3, 6) AS there FROM o) SELECT k, CASE WHEN there THEN h1 END AS handle_1,
      CASE WHEN shape IN (1, 3) THEN a || '+' || b WHEN there THEN a END AS characters_1, CASE WHEN shape = 6 THEN 'Cog' WHEN there THEN '' END AS residue_1, CASE WHEN there THEN h2 END AS handle_2,
      CASE WHEN shape = 6 THEN '' WHEN there THEN b END AS characters_2, CASE WHEN shape = 6 THEN 'Cog' WHEN there THEN '' END AS residue_2 FROM s""",
    "description_alignment": f"""WITH {_ORDERS}, s AS (SELECT *, k % 8 AS shape FROM o) SELECT k, CASE WHEN shape IN (0, 1, 7) THEN 'handle' WHEN shape IN (2, 3) THEN 'character-subset' ELSE 'ambiguous' END AS how,
      CASE WHEN shape IN (0, 2, 7) THEN false WHEN shape IN (1, 3) THEN true END AS swapped, CASE shape WHEN 6 THEN '' ELSE a END AS characters,
      CASE WHEN shape IN (4, 5, 6) THEN 'title' ELSE 'description' END AS tier, false AS conflict FROM s""",
    "patch_title_dates": "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders",
}
