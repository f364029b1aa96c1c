"""Titles and descriptions beyond the shapes that the queries build."""

from __future__ import annotations

import regex
from pyspark.sql import functions as F

from conftest import SF
from quillon.operators import text as tx
from quillon.operators import titles as ti

ALIASES = {"nut": "nut", "iron bolt": "iron-bolt", "ring": "ring"}
GATE = ti.Gate(tx.whole_words(["GAME"]), tx.whole_words(["OTHER"]), tx.whole_words(["TRAILER"]), "2026-08-06")


def test_titles_one_by_one(spark):
    cases = {
        "GAME ▰ A (Nut) vs B (Ring)": (None, "A|B", "nut|ring"),
        "A (Nut) vs B (Ring) ▰ GAME ▰ c (d)": ("no-vs-title", None, None),  # the bar is before the last parenthesis
        "GAME ▰ (Nut) A vs. (Ring) B": (None, "A|B", "nut|ring"),
        "GAME A (Nut) VERSUS (Iron Bolt / Ring) “B” 🔥": (None, "GAME A|“B”", "nut|iron-bolt+ring"),
        "GAME ▰ A (Nutty) vs B (Ring)": ("char-unresolved", "A|B", None),
        "GAME ▰ 🔥 (Nut) vs B (Ring)": ("bad-handle", None, None),
        "GAME ▰ Nut vs Ring ▰ A vs B": (None, "A|B", "nut|ring"),
        "Nut vs Ring ▰ A vs B GAME": ("char-unresolved", "Nut|Ring", None),  # two segments are no parallel lists
        "GAME ▰ Nut vs Ring ▰ A vs B ▰ C vs D": ("char-unresolved", "Nut|Ring", None),  # nor are two of handles; the first pair is left bare
        "GAME vs": ("no-vs-title", None, None), "GAME": ("no-vs-title", None, None), "": ("not-this-game", None, None), None: ("not-this-game", None, None),
        "GAMES ▰ A (Nut) vs B (Ring)": ("not-this-game", None, None),
        "GAME ▰ " + "x" * 40 + " (Nut) vs B (Ring)": (None, "x" * 40 + "|B", "nut|ring"),
        "GAME ▰ " + "𝔸" * 21 + " (Nut) vs B (Ring)": ("bad-handle", None, None),  # 42 units
    }
    rows = [(t, None, None, None, None, None) for t in cases]
    df = spark.createDataFrame(rows, "title string, description string, widened boolean, published string, live string, seconds int")
    p = F.col("parse")
    sides = F.array_join(F.transform(p["characters"], lambda c: F.array_join(c, "+")), "|")
    got = {r[0]: (r[1], r[2], r[3]) for r in ti.parsed(df, GATE, ALIASES).select("title", p["reason"], F.array_join(p["handles"], "|"), sides).collect()}
    assert got == cases


def test_side_characters(spark):
    rows = [(["a"], ["b", "a"]), (["a", "b"], ["c", "b"]), (["a"], None), ([], ["c"])]
    df = spark.createDataFrame(rows, "t array<string>, b array<string>")
    got = [tuple(r[0]) for r in df.select(ti.side_characters(F.col("t"), F.col("b"))).collect()]
    assert got == [(["b", "a"], "description", False), (["a", "b", "c"], "description", True), (["a"], "title", False), (["c"], "description", False)]


def test_days_and_benches(spark):
    df = spark.createDataFrame([("Patch Update 7/5/2026",), ("Patch update 12/31/2026 x",), ("patch 1/1/2026",), (None,)], "t string")
    assert [r[0] for r in df.select(ti.patch_date(F.col("t"))).collect()] == ["2026-07-05", "2026-12-31", None, None]
    texts = [(None, True), ("", False), ("Player 1: A (Nut)\nPlayer 1: B (Ring)", True), ("A (Nut) vs B (x" + "y" * 160 + ")", False)]
    df = spark.createDataFrame(texts, "d string, lines boolean")
    assert [r[0] for r in df.select(ti.bench(F.col("d"), F.col("lines"), ALIASES)).collect()] == [None] * 4


def test_patch_days_in_any_spacing(spark):
    cases = {"Patch Update 7-5-2026": "2026-07-05", "PatchUpdate 7/5/2026": "2026-07-05", "patch  update\u00a010/1/2026": "2026-10-01", "Patch Update 7.5.2026": None, "Patch Notes 7/5/2026": None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", ti.patch_date(F.col("t"))).collect()} == cases


def test_handles_lose_pictographs_alone(spark):
    cases = {"➤A☆": "➤A☆", "B✓": "B✓", "A▶": "A", "BⓂ": "B", "🔥 A 👨\u200d👩 -": "A", "—'A B'—": "A B", "©": "", "A\u3000 \u00a0B": "A B"}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", ti.clean_handle(F.col("t"))).collect()} == cases


def test_every_pictograph_and_its_neighbours(spark):
    """Against the property as the regex library has it."""
    held = regex.compile(r"[\p{Extended_Pictographic}\uFE0F\u200D]")
    near = {c + k for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and held.match(chr(c)) for k in (-1, 0, 1)}
    near = sorted(c for c in near if not 0xD7FF <= c <= 0xE000)
    df = spark.createDataFrame([(c, f"a{chr(c)}b") for c in near], "c int, t string")
    found = df.select("c", F.regexp_replace("t", ti.PICTOGRAPHS, "").alias("t")).collect()
    assert [r["c"] for r in found if (r["t"] == "ab") != bool(held.match(chr(r["c"])))] == []


def test_why_a_title_was_missed(spark):
    rows = [
        ("OTHER thing", "a GAME", True, "both markers"), ("OTHER thing", "a GAME", False, None), ("GAME OTHER", None, False, "both markers"),
        ("GAME ▰ 🔥 (Nut) vs B (Ring)", None, False, " | B"), ("GAME ▰ A (#2 Ranked Nutty) vs B (Ring)", None, False, "#2 Ranked Nutty | Ring"), ("GAME ▰ A vs B", None, False, "no (chars) slot"),
    ]
    df = spark.createDataFrame([(t, d, w, None, None, None) for t, d, w, _ in rows], "title string, description string, widened boolean, published string, live string, seconds int")
    found = {(r["title"], r["widened"]): r["detail"] for r in ti.parsed(df, GATE, ALIASES).select("title", "widened", "parse.detail").collect()}
    assert found == {(t, w): detail for t, _, w, detail in rows}


def test_descriptions_are_cut_in_units(spark):
    said = "\nA  b (Nut) vs C (Ring)"
    rows = [("." * (900 - len(said)) + said, True), ("." * (901 - len(said)) + said, False), ("𝔸" * 430 + said, True), ("𝔸" * 450 + said, False), ("." + "𝔸" * 450, False)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "d string")
    found = [r[0] for r in df.select(ti.bench(F.col("d"), F.lit(False), ALIASES)).collect()]
    assert [f is not None for f in found] == [there for _, there in rows]
    assert found[0][0]["handle"] == "A  b"  # white space inside a handle stays


def test_sides_are_built_with_their_provenance(spark):
    rows = [(["a"], ["b", "a"], False, "handle", "T", "D"), (["a"], ["b"], False, "handle", "T", "d" * 41), (["a"], ["b"], True, "handle", "T", "D"), (["a"], None, None, None, "T", None), (["a"], [], False, "ambiguous", "T", "")]
    df = spark.createDataFrame(rows, "t array<string>, b array<string>, lines boolean, how string, th string, bh string")
    side = ti.side_built(*(F.col(c) for c in ("t", "b", "lines", "how")), F.lit("handle-first"), F.col("th"), F.col("bh"), full=2)
    got = [r[0] for r in df.select(side).collect()]
    assert [(r["handle"], r["characters"]) for r in got] == [("D", ["b", "a"]), ("T", ["a", "b"]), ("D", ["a"]), ("T", ["a"]), ("T", ["a"])]
    p = [r["provenance"] for r in got]
    assert [(x["tier"], x["tiers"][-1], x["from_description"], x["alignment"], x["conflict"], x["complete"]) for x in p] == [
        ("description", "description", ["b", "a"], "handle", False, True), ("description", "description", ["b"], "handle", True, True), ("title", "title", None, "handle", False, False),
        ("title", "title", None, None, False, False), ("title", "title", None, "ambiguous", False, False),
    ]


def test_a_filter_on_parses_repeats_no_grammar(spark):
    """What is filtered is planned once: the grammar stood in the filter again, a copy for each use of each column."""
    from quillon.plans import titles as plans

    def size(name):
        return len(plans.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString())

    whole = size("title_parses")
    for name in ("miss_reasons", "review_rows", "slot_order_tally"):
        assert size(name) < 1.5 * whole


def test_a_long_description_is_searched_once_for_a_sentence(spark):
    """900 signs that begin no sentence, and sentences behind others that break off."""
    texts = ["." * 899 + ")", "x (a) vs y\n" * 40 + "p (ring) vs. q (nut, ring)", "p (ring) VERSUS q (nut)"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", ti.bench(F.col("t"), F.lit(False), {"ring": "r", "nut": "n"}).alias("b")).orderBy("i").collect()
    said = [r["b"] and [(s["handle"], s["characters"]) for s in r["b"]] for r in rows]
    assert said == [None, [("p", ["r"]), ("q", ["n", "r"])], [("p", ["r"]), ("q", ["n"])]]
