"""Gate, spans, residue, keys and durations: row-local text work."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once for a row, however often use names it."""
    return F.transform(F.array(value), use)[0]


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds; null if none does. One CASE, so that the order
    decides and not the optimizer."""
    out = F
    for name, holds in rules:
        out = out.when(holds, F.lit(name))
    return out


def whole_words(words: list[str]) -> str:
    """Pattern for any of the words between ASCII non-word characters."""
    return "(?i)(?<![A-Za-z0-9_])(?:" + "|".join(re.escape(w) for w in words) + ")(?![A-Za-z0-9_])"


def alias_pattern(aliases: dict[str, str]) -> str:
    """Longest alias first, between characters that are neither ASCII letters nor digits."""
    return "(?i)(?<![a-z0-9])(" + "|".join(re.escape(a) for a in sorted(aliases, key=lambda a: (-len(a), a))) + ")(?![a-z0-9])"


def overlapping_aliases(aliases: dict[str, str]) -> list[tuple[str, str]]:
    """Pairs for which leftmost-first matching differs from longest-first: a shorter alias
    whose end is a longer one's beginning. Must be empty for alias_pattern to be exact."""
    return [(a, b) for a in aliases for b in aliases if len(a) < len(b) and any(b.startswith(a[k:]) for k in range(1, len(a)))]


def span_ids(text: Column, aliases: dict[str, str]) -> Column:
    """Distinct ids of the aliases in text, in order."""
    ids = F.create_map(*(F.lit(x) for a, i in sorted(aliases.items()) for x in (a.lower(), i)))
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(alias_pattern(aliases)), F.lit(1)), lambda m: F.element_at(ids, F.lower(m))))


def residue(text: Column, aliases: dict[str, str]) -> Column:
    """What is left of text without aliases, separators and joining words."""
    rest = F.regexp_replace(text, alias_pattern(aliases), " ")
    rest = F.regexp_replace(rest, "(?i)(?<![a-z0-9])(?:and|vs)(?![a-z0-9])", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(rest, r"[/,&+\-|]+", " "), r"[\s\p{Z}]+", " "))


def duration_seconds(iso: Column) -> Column:
    """Seconds of PTnHnMnS; 0 where it is none."""
    part = lambda unit: F.coalesce(F.nullif(F.regexp_extract(iso, rf"^PT(?:\d+[A-Z])*?(\d+){unit}", 1), F.lit("")).cast("long"), F.lit(0))
    return part("H") * 3600 + part("M") * 60 + part("S")


def slug(folded: Column) -> Column:
    """Lower case, runs of other characters as one hyphen; takes NFKD text."""
    return F.regexp_replace(F.regexp_replace(F.lower(folded), "[^a-z0-9]+", "-"), "^-|-$", "")


def plate(text: Column) -> Column:
    """An on-screen name: upper case, no digits or other signs, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(text), "[^A-Z .\\-]", ""), " +", " "))
