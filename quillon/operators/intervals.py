"""Points in half-open intervals of small, ordered tables (eras, patch windows)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Interval tables are parameters that are written by hand; more rows than this are refused.
MAX_ROWS = 1_000


@dataclass(frozen=True)
class Era:
    season: int
    start: str
    end: str | None


def check_eras(eras: list[Era]) -> None:
    """Starts ascend, each era begins where the last one ends, and only the last is open."""
    if len(eras) > MAX_ROWS:
        raise ValueError("too many eras")
    for before, after in zip(eras, eras[1:], strict=False):
        if not before.start < after.start or before.end != after.start:
            raise ValueError(f"era {after.season} does not follow on era {before.season}")
    if eras and eras[-1].end is not None:
        raise ValueError("the last era is not open")


def validate_eras(eras: list[Era], launch: str) -> None:
    """check_eras, and that there are eras, their starts are days and none is before the launch."""
    if not eras:
        raise ValueError("no era")
    for era in eras:
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", era.start):
            raise ValueError(f"era {era.season} starts on {era.start}, which is no day")
        if era.start < launch:
            raise ValueError(f"era {era.season} starts before the launch")
    check_eras(eras)


def season_of(date: Column, eras: list[Era]) -> Column:
    """The era's number for a date as text; 0 before all eras and for null."""
    check_eras(eras)
    out = F.lit(0)
    for era in reversed(eras):
        inside = date >= F.lit(era.start)
        out = F.when(inside if era.end is None else inside & (date < F.lit(era.end)), F.lit(era.season)).otherwise(out)
    return out.cast("long")


def patch_windows(patches: DataFrame, eras: list[Era]) -> DataFrame:
    """patches (version) with start, season and end: the next start of the same era, else the
    era's end; null is open. One row for each patch, so one group is right."""
    starts = patches.select("version", F.col("version").alias("start")).withColumn("season", season_of(F.col("start"), eras))
    ends = F.lit(None).cast("string")
    for era in eras:
        ends = F.when(F.col("season") == era.season, F.lit(era.end)).otherwise(ends)
    following = F.lead("start").over(Window.partitionBy("season").orderBy("start"))
    return starts.withColumn("end", F.coalesce(following, ends))


def patch_token(records: DataFrame, date: str, season: str, windows: DataFrame) -> DataFrame:
    """records with token: the patch window that holds the date, if of the record's season;
    else the era's token. The windows are a table of parameters; more than MAX_ROWS are refused."""
    w = windows.select(F.col("version"), F.col("start").alias("w_start"), F.col("end").alias("w_end"), F.col("season").alias("w_season")).limit(MAX_ROWS + 1)
    if w.count() > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} patch windows")
    inside = (F.col(date) >= F.col("w_start")) & (F.col("w_end").isNull() | (F.col(date) < F.col("w_end")))
    joined = records.join(F.broadcast(w), inside, "left")
    return joined.withColumn("token", F.when(F.col("w_season") == F.col(season), F.col("version")).otherwise(F.concat(F.lit("S"), F.col(season).cast("string")))).drop("version", "w_start", "w_end", "w_season")
