"""Gates before publication: each returns the rows that break its rule, and enforce() refuses them.

A violation is (gate, id, why). Gates are joins, groupings and predicates over whole tables; what reaches the
driver is a bounded number of examples for the message. Rules on nested schemas are checked on the schema, when
the plan is made, before any row is read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HARD, SOFT, NOTE = "hard", "soft", "note"
#: Shapes of days and of era tokens, the least contrast of a colour on its ground.
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
ERA_TOKEN = r"^S\d+$"
LEAST_CONTRAST = 4.5


class GateError(ValueError):
    """A hard gate found rows."""


def violation(gate: str, id_: Column, why: Column | str) -> list[Column]:
    return [F.lit(gate).alias("gate"), id_.cast("string").alias("id"), (F.lit(why) if isinstance(why, str) else why).alias("why")]


def broken(df: DataFrame, gate: str, id_: Column, rules: Iterable[tuple[Column, str]]) -> DataFrame:
    """A violation for each rule that holds for a row; a rule that is null does not hold."""
    listed = F.filter(F.array(*(F.when(rule, F.lit(why)) for rule, why in rules)), lambda x: x.isNotNull())
    return df.select(id_.cast("string").alias("_id"), F.explode(listed).alias("_why")).select(*violation(gate, F.col("_id"), F.col("_why")))


def enforce(violations: DataFrame, severities: dict[str, str], examples: int = 5) -> DataFrame:
    """Counts of the violations by gate, with their severity (hard where it is not named). Raises
    for the hard ones with a few of them; the soft ones and the notes are for the caller to report."""
    counts = violations.groupBy("gate").agg(F.count("*").alias("n"))
    named = F.create_map(*(F.lit(x) for pair in severities.items() for x in pair)) if severities else F.create_map().cast("map<string,string>")
    out = counts.select("gate", "n", F.coalesce(F.element_at(named, F.col("gate")), F.lit(HARD)).alias("severity"))
    hard = out.where(F.col("severity") == HARD)
    some = violations.join(hard.select("gate"), "gate", "left_semi").orderBy("gate", "id", "why").limit(examples).collect()
    if some:
        raise GateError("; ".join(f"{r['gate']}: {r['id']}: {r['why']}" for r in some))
    return out


def patch_violations(patches: DataFrame, eras: list[tuple[int, str, str | None]], launch: str, as_of: str, channels: list[str]) -> DataFrame:
    """patches (row, version, start, announced, includes), row being the place in the table. A token
    is its start's day, no era's token and unique; starts follow each other, none is before launch, after as_of or
    in no era; the channel is known; nothing included has been a patch so far; each era opens on a patch."""
    earlier = patches.select((F.col("row") + 1).alias("_row"), F.col("start").alias("_before"))
    first = patches.groupBy(F.col("version").alias("_version")).agg(F.min("row").alias("_first"))
    rows = patches.join(earlier, F.col("row") == F.col("_row"), "left").join(first, F.col("version") == F.col("_version"), "left")
    inside = F.lit(False)
    for _, start, end in eras:
        inside = inside | ((F.col("start") >= start) & (F.lit(True) if end is None else F.col("start") < end))
    own = broken(rows, "patches", F.col("version"), [
        (~F.col("version").rlike(ISO_DAY), "token is no day"), (F.col("version") != F.col("start"), "token is not its start"), (F.col("version").rlike(ERA_TOKEN), "token is an era's"),
        (F.col("row") > F.col("_first"), "token appears twice"), (F.col("start") < launch, "before launch"), (F.col("start") > as_of, "in the future"),
        (F.col("start") <= F.col("_before"), "not after the one before"), (~inside, "in no era"), (~F.col("announced").isin(channels), "unknown channel"),
    ])
    told = patches.select("row", "version", F.explode("includes").alias("_inc"))
    paged = told.join(first, F.col("_inc") == F.col("_version")).where(F.col("_first") <= F.col("row")).select(*violation("patches", F.col("version"), F.concat(F.lit("includes a token of its own page: "), F.col("_inc"))))
    starts = patches.sparkSession.createDataFrame([(f"S{n}", start) for n, start, _ in eras], "id string, start string")
    unopened = starts.join(patches.select("start"), "start", "left_anti").select(*violation("patches", F.col("id"), "no patch opens the era"))
    return own.unionByName(paged).unionByName(unopened)


def group_violations(groups: DataFrame, tokens: DataFrame) -> DataFrame:
    """groups (id, children: ids) and tokens (token) in use: ids are unique over parents and children, and
    every token in use is one of them."""
    ids = groups.select(F.col("id").alias("_id")).unionByName(groups.select(F.explode("children").alias("_id")))
    counts = ids.groupBy("_id").agg(F.count("*").alias("n"))
    twice = counts.where("n > 1").select(*violation("patch-groups", F.col("_id"), "appears more than once"))
    lost = tokens.select(F.col("token").alias("_id")).distinct().join(counts, "_id", "left_anti")
    return twice.unionByName(lost.select(*violation("patch-groups", F.col("_id"), "in no group")))


def roster_violations(roster: DataFrame, tokens: DataFrame, ground: Column, contrast: Column, allowed: list[str]) -> DataFrame:
    """roster (id, portrait) against tokens (token, colour): every id has a token, every token that is not
    allowed to stand alone an id; colours keep their contrast (a column of ground, a luminance, and of
    colour) and portraits are there."""
    both = roster.join(tokens, F.col("id") == F.col("token"), "left")
    own = broken(both.withColumn("_ground", ground), "roster", F.col("id"), [(F.col("token").isNull(), "no token"), (F.col("token").isNotNull() & (contrast < LEAST_CONTRAST), "too little contrast"), (~F.coalesce(F.col("portrait"), F.lit(False)), "no portrait")])
    lone = tokens.join(roster.select("id"), F.col("id") == F.col("token"), "left_anti").where(~F.col("token").isin(allowed) if allowed else F.lit(True))
    return own.unionByName(lone.select(*violation("roster", F.col("token"), "token without an id")))


def feed_differences(announced: DataFrame, known: DataFrame, vendor: str) -> DataFrame:
    """Days of announced (day) that are not in known (day, channel), which a run must refuse, and days of known
    that nothing announced, which are suspicious where the vendor's own feed should have had them."""
    missing = announced.select("day").distinct().join(known, "day", "left_anti").select(*violation("feed", F.col("day"), "announced, not in the table"))
    why = F.when(F.col("channel") == vendor, "not announced, though of the vendor's feed").otherwise("not announced")
    return missing.unionByName(known.join(announced.select("day"), "day", "left_anti").select(*violation("feed-extra", F.col("day"), why)))


def key_collisions(rows: DataFrame, id_: str, key: Column) -> DataFrame:
    """Ids of which another one has the same key. The pairs are not made: a key has its number and first id."""
    keyed = rows.select(F.col(id_).cast("string").alias("_id"), key.alias("_key"))
    shared = keyed.groupBy("_key").agg(F.count_distinct("_id").alias("n"), F.min("_id").alias("_first")).where("n > 1")
    return shared.select(*violation("plate-keys", F.col("_first"), F.concat(F.col("n").cast("string"), F.lit(" share the key "), F.col("_key"))))


def record_violations(records: DataFrame, replays: DataFrame) -> DataFrame:
    """records (id) and replays (id, sides: arrays of characters): as many of either, two sides each, none
    without a character. Sides of more or of fewer than a full bench are fine."""
    n = records.agg(F.count("*").alias("a")).crossJoin(replays.agg(F.count("*").alias("b")))
    counts = broken(n, "replays", F.lit("all"), [(F.col("a") != F.col("b"), "as many replays as records are needed")])
    return counts.unionByName(broken(replays, "replays", F.col("id"), [(F.size("sides") != 2, "not two sides"), (F.exists("sides", lambda s: F.size(s) == 0), "a side without a character")]))


def summary_violations(summary: DataFrame) -> DataFrame:
    """summary (id, replays, emitted, characters, players, updated). The registry of characters is never empty;
    players and the day are asked for only where there are replays."""
    some = F.col("emitted") > 0
    return broken(summary, "summary", F.col("id"), [
        (F.col("replays") != F.col("emitted"), "count is not what was emitted"), (F.col("characters") < 1, "no character"), (some & (F.col("players") < 1), "no player"),
        (some & ~F.coalesce(F.col("updated").rlike(ISO_DAY), F.lit(False)), "updated is no day"),
    ])


def stale_sources(spark: SparkSession, raw: list[str], substrate: str, slack_hours: int = 24) -> DataFrame:
    """Raw files over slack_hours older than the newest of the substrate's files: what a reader of any file system
    knows of them. Without a substrate nothing is stale."""
    def files(paths: list[str]) -> DataFrame:
        read = spark.read.format("binaryFile").load(paths)
        return read.select("path", "modificationTime")

    newest = files([substrate]).agg(F.max("modificationTime").alias("_newest"))
    old = files(raw).crossJoin(F.broadcast(newest)).where(F.col("modificationTime") < F.col("_newest") - F.make_dt_interval(hours=F.lit(slack_hours)))
    return old.select(*violation("stale-raw", F.col("path"), "older than what was made from it"))


def private_paths(schema: T.DataType, allowed: Iterable[str], path: str = "") -> list[str]:
    """Dotted paths of a schema, through structs, arrays and maps, that are not allowed. A path is allowed
    if it is listed itself; what holds it must be listed too."""
    if isinstance(schema, T.StructType):
        out = []
        for field in schema.fields:
            own = f"{path}.{field.name}" if path else field.name
            out += [own] if own not in set(allowed) else private_paths(field.dataType, allowed, own)
        return out
    if isinstance(schema, T.ArrayType):
        return private_paths(schema.elementType, allowed, path)
    if isinstance(schema, T.MapType):
        return private_paths(schema.keyType, allowed, path) + private_paths(schema.valueType, allowed, path)
    return []


def assert_public(df: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """df, if all of its schema is allowed; else a GateError, before a row is read."""
    found = private_paths(df.schema, allowed)
    if found:
        raise GateError(f"not public: {', '.join(found)}")
    return df


def projected(df: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """df with the allowed paths only, at every depth. Other paths are cut out of structs, be they in
    arrays, in order of df's own schema; a map with a path of its own is refused."""
    wanted = set(allowed)

    def kept(value: Column, kind: T.DataType, path: str) -> Column:
        if isinstance(kind, T.StructType):
            fields = [f for f in kind.fields if f"{path}.{f.name}" in wanted]
            return F.when(value.isNotNull(), F.struct(*(kept(value[f.name], f.dataType, f"{path}.{f.name}").alias(f.name) for f in fields)))
        if isinstance(kind, T.ArrayType) and private_paths(kind, wanted, path):
            return F.transform(value, lambda x: kept(x, kind.elementType, path))
        if isinstance(kind, T.MapType) and private_paths(kind, wanted, path):
            raise GateError(f"not public: {path}")
        return value

    return df.select(*(kept(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name) for f in df.schema.fields if f.name in wanted))


def leaking(payloads: DataFrame, id_: str, payload: str, names: list[str]) -> DataFrame:
    """Serialised payloads that hold a private name as a key."""
    return broken(payloads, "leak", F.col(id_), [(F.col(payload).contains(f'"{n}"'), f"{n} is in the payload") for n in names])


def judged_reading(first: Column, second: Column, title: Column, unite: Column, force: Column, keep: Column) -> Column:
    """(outcome, characters, team_change) of a person's reading of two frames (arrays of members, the point
    first). Frames that agree as sets are written. Where they do not, the reader may unite them (a change of
    team) or force the first; else it is refused. A reading without what the title names is refused, unless the
    reader keeps both (again a change of team) or forces it."""
    a, b = F.array_distinct(first), F.array_distinct(second)
    agree = (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
    left_out = F.array_except(title, a)
    result = lambda how, who, change: F.struct(F.lit(how).alias("outcome"), who.alias("characters"), F.lit(change).alias("team_change"))
    none = F.lit(None).cast("array<string>")
    return (
        F.when(~agree & unite, result("written", F.array_union(a, b), True))
        .when(~agree & ~force, result("frames-disagree", none, False))
        .when((F.size(left_out) > 0) & keep, result("written", F.array_union(a, left_out), True))
        .when((F.size(left_out) > 0) & ~force, result("title-missing", none, False))
        .otherwise(result("written", a, False))
    )


def accepted(left: Column, right: Column, confidence: Column, decided: Column, left_known: Column, right_known: Column, least: float = 0.75) -> Column:
    """Both sides have members, confidence and attribution hold, and each side has all that is known of it."""
    control = (F.size(F.array_except(left_known, left)) == 0) & (F.size(F.array_except(right_known, right)) == 0)
    return F.coalesce((F.size(left) > 0) & (F.size(right) > 0) & (confidence >= least) & decided & control, F.lit(False))
