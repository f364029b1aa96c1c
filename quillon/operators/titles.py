"""Titles and descriptions of uploads: the gate, the two grammars of titles, the slots of a
side, benches named in descriptions and which side of a title they belong to.

Every function takes and returns columns of built-in functions. Texts are NFC unless said
otherwise; a null title is no match-shaped title and never fails."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators import text as tx

# Signs, separators and shapes that uploaders use, and the lengths that count.
BAR = "▰"
VERSUS = r"(?i)\s+(?:vs\.?|versus)\s+"
# Code points of the Unicode property Extended_Pictographic, which Java has no class for, as its data files list them.
PICTOGRAPHIC = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0
25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642
2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB
26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705
2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797
27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F02C-1F02F 1F094-1F09F
1F0AF-1F0B0 1F0C0 1F0CF-1F0D0 1F0F6-1F0FF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F1AF-1F1E5 1F201-1F20F
1F21A 1F22F 1F232-1F23A 1F23C-1F23F 1F249-1F25F 1F266-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0
1F3F3-1F3F5 1F3F7-1F3FA 1F400-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587
1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1
1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6E5 1F6E9 1F6EB-1F6F0 1F6F3-1F6FF
1F7DC-1F7F0 1F80C-1F80F 1F848-1F84F 1F85A-1F85F 1F888-1F88F 1F8AE-1F8AF 1F8BC-1F8BF 1F8C2-1F8CF 1F8D9-1F8FF
1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA58-1FA5F 1FA6E-1FAFF 1FC00-1FFFD
"""
#: Signs that joined pictographs carry beside, and those that no handle begins or ends with.
JOINERS = r"\x{FE0F}\x{200D}"
ENDS = r"\s\p{Z}\x{FEFF}|·—–\-:,.\"'"
SPACE = r"[\s\p{Z}\x{FEFF}]"
BRACKET_TAIL = r"\s*【[^】]*】\s*$"
SLOT = r"\(([^()]*)\)"
POSITION = r"(?i)#\s*\d+\s*(?:ranked|rank)\s*"
PLAYER_LINE = r"(?iU)player\s*([12])\s*:\s*([^\n(]{1,50}?)\s*\(([^()\n]{1,80})\)"
PROSE = r"(?iU)([^():\n!]{1,50}?)\s*\(([^()\n]{1,160})\)\s*(?:versus|vs\.?)\s*([^():\n!]{1,50}?)\s*\(([^()\n]{1,160})\)"
#: What every such sentence holds.
AGAINST = r"(?iU)\)\s*v(?:ersu)?s"
PATCH_TITLE = r"(?i)patch[\s\p{Z}\x{FEFF}]*update[\s\p{Z}\x{FEFF}]*(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
MAX_HANDLE = 40
DESCRIPTION_READ = 900
SHORTEST = 60

# the larger range first, so that ASCII is ruled out by one comparison
PICTOGRAPHS = r"[\x{80}-\x{10FFFF}&&[" + "".join("-".join(rf"\x{{{x}}}" for x in part.split("-")) for part in PICTOGRAPHIC.split()) + JOINERS + "]]"


@dataclass(frozen=True)
class Gate:
    """Patterns of the game, of other games and of content that is no match; the first day."""

    game: str
    other: str
    no_match: str
    launch: str


def spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def stripped(text: Column) -> Column:
    """Without white space at either end; inside it stays as it is."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def gate_reason(gate: Gate, title: Column, description: Column, widened: Column, published: Column, live: Column, seconds: Column) -> Column:
    """Why an upload is none of the game's matches, the first reason that holds; else null.
    Descriptions are searched for the game alone, and only where widened. No live flag and
    0 or unknown seconds pass; an unknown day is no day before the launch."""
    title = F.coalesce(title, F.lit(""))
    game, other = _searched(title, description, widened).rlike(gate.game), title.rlike(gate.other)
    return tx.first_reason(
        [
            ("other-game", other),
            ("not-this-game", ~game),
            ("pre-launch", F.substring(published, 1, 10) < gate.launch),
            ("live-or-upcoming", ~F.coalesce(live, F.lit("")).isin("", "none")),
            ("not-a-match", title.rlike(gate.no_match)),
            ("short-duration", (seconds > 0) & (seconds < SHORTEST)),
        ]
    )


def _searched(title: Column, description: Column, widened: Column) -> Column:
    """Where the game is looked for: descriptions too, where widened."""
    return F.when(F.coalesce(widened, F.lit(False)), F.concat_ws("\n", title, description)).otherwise(title)


def both_games(gate: Gate, title: Column, description: Column, widened: Column) -> Column:
    return F.coalesce(_searched(title, description, widened).rlike(gate.game) & title.rlike(gate.other), F.lit(False))


def clean_handle(text: Column) -> Column:
    return spaced(F.regexp_replace(F.regexp_replace(text, PICTOGRAPHS, ""), f"^[{ENDS}]+|[{ENDS}]+$", ""))


def fits(handle: Column) -> Column:
    """Neither empty nor over MAX_HANDLE UTF-16 units."""
    return (handle != "") & (F.octet_length(F.encode(handle, "UTF-16BE")) <= 2 * MAX_HANDLE)


def core(title: Column) -> Column:
    """The text of both sides without what bars set apart before and after; null where
    nothing is against anything or a bar is left between. A lead ends at the last bar before
    the first parenthesis or the versus; a trail begins at the first bar behind the last
    parenthesis."""
    tail = rf"[{PICTOGRAPHS}\s|·—–-]+$"
    trimmed = F.trim(F.regexp_replace(F.regexp_replace(spaced(title), BRACKET_TAIL, ""), tail, ""))

    def joined(halves: Column) -> Column:
        left = F.regexp_replace(F.get(halves, F.lit(0)), rf"(?s)^[^(]*{BAR}", "")
        right = F.regexp_replace(F.get(halves, F.lit(1)), rf"(?s)^((?:.*\))?[^{BAR})]*){BAR}[^)]*$", "$1")
        return F.trim(F.regexp_replace(F.concat(left, F.lit(" vs "), right), tail, ""))

    sides = tx.once(F.split(trimmed, VERSUS, 2), joined)
    return tx.once(sides, lambda s: F.when(~s.contains(BAR), s))


def slots(title: Column) -> Column:
    """[n, handle, said, whole, order] of the two sides, n parentheses in each, said being what the first
    one says without a place in a ranking and whole all of it; null for no two sides."""

    def slot(side: Column) -> Column:
        return tx.once(F.regexp_extract_all(side, F.lit(SLOT), F.lit(1)), lambda said: read(side, said))

    def read(side: Column, said: Column) -> Column:
        return F.struct(
            F.size(said).alias("n"),
            clean_handle(F.regexp_replace(side, SLOT, "")).alias("handle"),
            spaced(F.regexp_replace(F.coalesce(F.get(said, F.lit(0)), F.lit("")), POSITION, " ")).alias("said"),
            F.coalesce(F.get(said, F.lit(0)), F.lit("")).alias("whole"),
            F.when(side.rlike("^" + SLOT), "chars-first").otherwise("handle-first").alias("order"),
        )

    return tx.once(F.split(core(title), VERSUS), lambda sides: F.when(F.size(sides) == 2, F.transform(sides, slot)))


def parallel_lists(title: Column, aliases: dict[str, str]) -> Column:
    """(handles, characters) of titles that name both in segments of their own: of three and
    more segments, one is of characters on both sides and one of handles; else null."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(title, BRACKET_TAIL, ""), BAR), spaced), lambda s: s != "")

    def read(parts: Column) -> Column:
        pairs = F.filter(F.transform(parts, lambda s: F.split(s, VERSUS)), lambda p: F.size(p) == 2)
        return F.transform(pairs, lambda p: F.struct(F.transform(p, clean_handle).alias("handles"), F.transform(p, lambda s: tx.span_ids(s, aliases)).alias("characters")))

    def both(read: Column) -> Column:
        named = F.filter(read, lambda r: F.forall(r["characters"], lambda c: F.size(c) > 0))
        bare = F.filter(read, lambda r: F.forall(r["characters"], lambda c: F.size(c) == 0) & F.forall(r["handles"], fits))
        return F.struct(named.alias("named"), bare.alias("bare"))

    def chosen(found: Column) -> Column:
        one = (F.size(found["named"]) == 1) & (F.size(found["bare"]) == 1)
        return F.when(one, F.struct(F.get(found["bare"], F.lit(0))["handles"].alias("handles"), F.get(found["named"], F.lit(0))["characters"].alias("characters")))

    # what two segments and fewer say is not read
    return tx.once(parts, lambda p: F.when(F.size(p) >= 3, tx.once(read(p), lambda r: tx.once(both(r), chosen))))


def parsed(uploads: DataFrame, gate: Gate, aliases: dict[str, str]) -> DataFrame:
    """uploads (title, description, widened, published, live, seconds) with parse: reason
    (null: parsed), detail (why, or what could not be read), queue (the review that a miss goes to), orders, handles and
    characters of the sides. Parallel lists come first, since such titles look like sides
    that state no characters."""
    if tx.overlapping_aliases(aliases):
        raise ValueError("an alias ends as a longer one begins")
    title = F.col("title")
    gated = gate_reason(gate, title, *(F.col(c) for c in ("description", "widened", "published", "live", "seconds")))
    found, past = uploads.withColumn("_gated", gated), F.col("_gated").isNull()
    found = found.withColumn("_lists", F.when(past, parallel_lists(title, aliases))).withColumn("_slots", F.when(past & F.col("_lists").isNull(), slots(title)))
    sides, lists = F.col("_slots"), F.col("_lists")
    found = found.withColumn("_handles", F.coalesce(lists["handles"], F.transform(sides, lambda s: s["handle"])))
    found = found.withColumn("_characters", F.coalesce(lists["characters"], F.transform(sides, lambda s: tx.span_ids(s["said"], aliases))))
    handles, characters = F.col("_handles"), F.col("_characters")
    unsaid = F.exists(sides, lambda s: s["n"] == 0)
    bare = F.forall(sides, lambda s: (s["n"] == 0) & fits(s["handle"]))
    structure = tx.first_reason(
        [
            ("no-vs-title", handles.isNull()),
            ("slot-ambiguous", F.exists(sides, lambda s: s["n"] > 1)),
            ("char-unresolved", unsaid & bare),
            ("no-vs-title", unsaid),
            ("bad-handle", ~F.forall(handles, fits)),
            ("char-unresolved", F.exists(characters, lambda c: F.size(c) == 0)),
        ]
    )
    found = found.withColumn("_reason", F.coalesce("_gated", structure))
    reason = F.col("_reason")
    completion = reason == "char-unresolved"
    both = both_games(gate, title, F.col("description"), F.col("widened"))
    joined = lambda c: F.array_join(c, " | ")
    detail = (
        F.when(both, "both markers")
        .when(past & reason.isin("no-vs-title", "char-unresolved") & unsaid, "no (chars) slot")
        .when(past & (reason == "bad-handle"), joined(handles))
        .when(past & completion, joined(F.transform(sides, lambda s: s["whole"])))
    )
    orders = F.when(lists.isNotNull(), F.array_repeat(F.lit("parallel-lists"), 2)).otherwise(F.transform(sides, lambda s: s["order"]))
    parse = F.struct(
        reason.alias("reason"),
        detail.alias("detail"),
        F.when(completion, "character-completion").when(reason == "slot-ambiguous", "slot-ambiguous").alias("queue"),
        F.when(reason.isNull(), orders).alias("orders"),
        F.when(reason.isNull() | completion, handles).alias("handles"),
        F.when(reason.isNull(), characters).alias("characters"),
    )
    # a generator of one row: a filter on what was parsed stays above it, below it would repeat the grammar for each of its columns
    return found.withColumn("parse", F.explode(F.array(parse))).drop("_lists", "_slots", "_handles", "_characters", "_gated", "_reason")


def begun(text: Column, units: int) -> Column:
    """The first UTF-16 units of text; a character that would be cut in two is left out."""
    held = F.substring(F.encode(text, "UTF-16BE"), 1, 2 * units)
    last = F.hex(F.substring(held, 2 * units - 1, 1))
    whole = F.when(last.between("D8", "DB"), F.substring(held, 1, 2 * units - 2)).otherwise(held)
    return F.when(F.octet_length(text) <= units, text).otherwise(F.decode(whole, "UTF-16BE"))


def bench(description: Column, lines: Column, aliases: dict[str, str]) -> Column:
    """[handle, characters, residue] of both sides that the first DESCRIPTION_READ UTF-16 units of an
    NFC text name: a line for each player where lines holds, the last of each, else one
    sentence. Null where the shape is not there."""

    def side(handle: Column, said: Column) -> Column:
        return F.struct(stripped(handle).alias("handle"), tx.span_ids(said, aliases).alias("characters"), tx.residue(said, aliases).alias("residue"))

    def last_of(every: Column, who: str) -> Column:
        return F.try_element_at(F.filter(every, lambda m: F.regexp_extract(m, PLAYER_LINE, 1) == who), F.lit(-1))

    def by_line(last: Column) -> Column:
        both = F.forall(last, lambda m: m.isNotNull())
        return F.when(both, F.transform(last, lambda m: side(F.regexp_extract(m, PLAYER_LINE, 2), F.regexp_extract(m, PLAYER_LINE, 3))))

    # the groups of a match are those of its own text, so that the whole one is searched once
    def by_sentence(match: Column) -> Column:
        group = lambda g: F.regexp_extract(match, PROSE, g)
        return F.when(match != "", F.array(side(group(1), group(2)), side(group(3), group(4))))

    def sides(read: Column) -> Column:
        last = tx.once(F.regexp_extract_all(read, F.lit(PLAYER_LINE), F.lit(0)), lambda every: F.array(last_of(every, "1"), last_of(every, "2")))
        prose = F.when(read.rlike(AGAINST), F.regexp_extract(read, PROSE, 0))
        return F.when(lines, tx.once(last, by_line)).otherwise(tx.once(prose, by_sentence))

    return tx.once(begun(description, DESCRIPTION_READ), sides)


def handle_key(nfkd: Column) -> Column:
    return F.regexp_replace(F.lower(nfkd), "[^a-z0-9]+", "")


def alignment(title_keys: list[Column], bench_keys: list[Column], title_ids: list[Column], bench_ids: list[Column]) -> Column:
    """(how, swapped): whether the bench's sides are the title's in order or crosswise, by
    their handles' keys, else by characters where only one way holds every character of the
    title; else ambiguous, with swapped null. Never by position alone."""
    known = (bench_keys[0] != "") & (bench_keys[1] != "")
    within = lambda x, y: (F.size(x) > 0) & (F.size(F.array_except(x, y)) == 0)
    straight = within(title_ids[0], bench_ids[0]) & within(title_ids[1], bench_ids[1])
    crossed = within(title_ids[0], bench_ids[1]) & within(title_ids[1], bench_ids[0])
    verdict = lambda how, swapped: F.struct(F.lit(how).alias("how"), F.lit(swapped).cast("boolean").alias("swapped"))
    return (
        F.when(known & (bench_keys[0] == title_keys[0]) & (bench_keys[1] == title_keys[1]), verdict("handle", False))
        .when(known & (bench_keys[0] == title_keys[1]) & (bench_keys[1] == title_keys[0]), verdict("handle", True))
        .when(straight & ~crossed, verdict("character-subset", False))
        .when(crossed & ~straight, verdict("character-subset", True))
        .otherwise(verdict("ambiguous", None))
    )


def side_characters(title_ids: Column, bench_ids: Column) -> Column:
    """(characters, tier, conflict) of a side: the bench if it holds all that the title says,
    else both, the title's first, as a conflict; the title's alone without a bench."""
    told = F.size(F.array_except(title_ids, bench_ids)) == 0
    return F.struct(
        F.when(bench_ids.isNull(), title_ids).when(told, bench_ids).otherwise(F.array_union(title_ids, bench_ids)).alias("characters"),
        F.when(bench_ids.isNull(), "title").otherwise("description").alias("tier"),
        F.coalesce(~told, F.lit(False)).alias("conflict"),
    )


def side_built(title_ids: Column, bench_ids: Column, lines: Column, how: Column, order: Column, title_handle: Column, bench_handle: Column, full: int = 4) -> Column:
    """(handle, characters, provenance) of a side. A bench of one line a player (lines) is no bench, only a handle's source. The handle of the description is
    shown if it fits. provenance says what either source said, how they met and whether they disagree;
    how is null where no bench was read at all."""
    held = F.when(~F.coalesce(lines, F.lit(False)) & (F.size(bench_ids) > 0), bench_ids)
    built = side_characters(title_ids, held)
    shown = F.when(bench_handle.isNotNull() & fits(bench_handle), bench_handle).otherwise(title_handle)
    tiers = F.when(held.isNull(), F.array(F.lit("title"))).otherwise(F.array(F.lit("title"), F.lit("description")))
    provenance = F.struct(
        built["tier"].alias("tier"), tiers.alias("tiers"), title_ids.alias("from_title"), held.alias("from_description"), how.alias("alignment"),
        order.alias("slot_order"), built["conflict"].alias("conflict"), (F.size(built["characters"]) == full).alias("complete"),
    )
    return F.struct(shown.alias("handle"), built["characters"].alias("characters"), provenance.alias("provenance"))


def patch_date(title: Column) -> Column:
    """The day of a patch's title as text; null for another title."""
    part = lambda g: F.regexp_extract(title, PATCH_TITLE, g)
    return F.when(title.rlike(PATCH_TITLE), F.concat_ws("-", part(3), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0")))
