"""Every gate is fed the failure that it must catch, and what it must let pass."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from compare import duck_bag, spark_bag
from quillon.operators import gates, intervals
from quillon.operators import text as tx
from quillon.plans import gates as plans

ERAS = [(1, "2026-08-01", "2026-09-01"), (2, "2026-09-01", None)]


def why(df) -> set[tuple]:
    return {(r["id"], r["why"]) for r in df.collect()}


def test_patches(spark):
    good = [(0, "2026-08-01", "2026-08-01", "launch", ["a"]), (1, "2026-09-01", "2026-09-01", "x", [])]

    def found(rows, eras=ERAS):
        df = spark.createDataFrame(rows, "row int, version string, start string, announced string, includes array<string>")
        return why(gates.patch_violations(df, eras, "2026-08-01", "2026-12-31", ["launch", "x"]))

    assert found(good) == set()
    broken = {
        ("S2", "2026-09-02", "x"): {"token is no day", "token is not its start", "token is an era's"}, ("2026-09-03", "2026-09-02", "x"): {"token is not its start"},
        ("2026-08-01", "2026-08-01", "x"): {"token appears twice", "not after the one before"}, ("2027-01-01", "2027-01-01", "x"): {"in the future"}, ("2026-09-02", "2026-09-02", "tv"): {"unknown channel"},
        ("2026-07-31", "2026-07-31", "x"): {"before launch", "not after the one before", "in no era"},
    }
    for (version, start, channel), reasons in broken.items():
        assert found([*good, (2, version, start, channel, [])]) == {(version, r) for r in reasons}
    assert found([*good, (2, "2026-09-02", "2026-09-02", "x", ["2026-08-01", "2026-09-02", "new"])]) == {("2026-09-02", f"includes a token of its own page: {t}") for t in ("2026-08-01", "2026-09-02")}
    assert found(good[:1]) == {("S2", "no patch opens the era")}
    assert found([]) == {("S1", "no patch opens the era"), ("S2", "no patch opens the era")}


def test_groups_records_and_keys(spark):
    groups = spark.createDataFrame([("S1", ["a", "b"]), ("S2", ["b", "S1"]), ("S3", None)], "id string, children array<string>")
    tokens = spark.createDataFrame([("a",), ("zz",), ("S3",)], "token string")
    assert why(gates.group_violations(groups, tokens)) == {("b", "appears more than once"), ("S1", "appears more than once"), ("zz", "in no group")}
    replays = spark.createDataFrame([("p", [["a"], ["b"]]), ("q", [["a"]]), ("r", [[], ["a", "b", "c", "d", "e"]])], "id string, sides array<array<string>>")
    assert why(gates.record_violations(replays.select("id"), replays)) == {("q", "not two sides"), ("r", "a side without a character")}
    assert ("all", "as many replays as records are needed") in why(gates.record_violations(replays.limit(2).select("id"), replays))
    names = spark.createDataFrame([(1, "Star Lord"), (2, "STAR-LORD"), (3, "Loki")], "id int, name string")
    assert why(gates.key_collisions(names, "id", F.upper(F.regexp_replace("name", "[^A-Za-z]", "")))) == {("1", "2 share the key STARLORD")}


def test_summary(spark):
    rows = [("ok", 5, 5, 2, 2, "2026-08-01"), ("empty", 0, 0, 2, 0, None), ("roster", 0, 0, 0, 0, None), ("day", 1, 1, 1, 1, "2026-8-1"), ("none", 1, 1, 1, 1, None), ("count", 1, 2, 1, 0, "2026-08-01")]
    df = spark.createDataFrame(rows, "id string, replays int, emitted int, characters int, players int, updated string")
    assert why(gates.summary_violations(df)) == {("roster", "no character"), ("day", "updated is no day"), ("none", "updated is no day"), ("count", "count is not what was emitted"), ("count", "no player")}


def test_roster_and_feed(spark):
    roster = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", True)], "id string, portrait boolean")
    tokens = spark.createDataFrame([("a", 9.0), ("c", 9.0), ("d", 4.4), ("x", 9.0), ("alt", 9.0)], "token string, ratio double")
    assert why(gates.roster_violations(roster, tokens, F.lit(0.0), F.col("ratio"), ["alt"])) == {("b", "no token"), ("c", "no portrait"), ("d", "too little contrast"), ("x", "token without an id")}
    announced = spark.createDataFrame([("2026-08-10",), ("2026-08-10",), ("2026-08-20",)], "day string")
    known = spark.createDataFrame([("2026-08-01", "launch"), ("2026-08-10", "vendor"), ("2026-08-12", "vendor")], "day string, channel string")
    found = gates.feed_differences(announced, known, "vendor")
    assert {(r["gate"], r["id"]) for r in found.collect()} == {("feed", "2026-08-20"), ("feed-extra", "2026-08-01"), ("feed-extra", "2026-08-12")}
    assert ("2026-08-12", "not announced, though of the vendor's feed") in why(found)
    with pytest.raises(gates.GateError, match="feed: 2026-08-20"):
        gates.enforce(found, {"feed-extra": gates.NOTE})
    told = gates.enforce(found, {"feed": gates.SOFT, "feed-extra": gates.NOTE}).collect()
    assert {(r["gate"], r["n"], r["severity"]) for r in told} == {("feed", 1, "soft"), ("feed-extra", 2, "note")}


def test_stale_sources(spark, tmp_path):
    for name in ("one", "two", "made"):
        (tmp_path / f"{name}.json").write_text("{}")
    now = 1_790_000_000
    os.utime(tmp_path / "made.json", (now, now))
    os.utime(tmp_path / "one.json", (now - 86_300, now - 86_300))
    os.utime(tmp_path / "two.json", (now - 86_500, now - 86_500))
    found = gates.stale_sources(spark, [f"{tmp_path}/one.json", f"{tmp_path}/two.json"], f"{tmp_path}/made.json")
    assert [r["id"].rsplit("/", 1)[1] for r in found.collect()] == ["two.json"]
    with pytest.raises(gates.GateError, match="stale-raw"):
        gates.enforce(found, {})


def test_private_fields_are_refused_at_every_depth(spark):
    df = spark.createDataFrame([(1, [("p", ["a"], ("title", 1))], {"k": (1, "secret")})], "id int, sides array<struct<player:string,characters:array<string>,provenance:struct<tier:string,n:int>>>, extra map<string,struct<n:int,note:string>>")
    allowed = ["id", "sides", "sides.player", "sides.characters"]
    assert gates.private_paths(df.schema, allowed) == ["sides.provenance", "extra"]
    assert gates.private_paths(df.schema, [*allowed, "sides.provenance", "sides.provenance.tier", "extra", "extra.n"]) == ["sides.provenance.n", "extra.note"]
    with pytest.raises(gates.GateError, match="sides.provenance, extra"):
        gates.assert_public(df, allowed)
    public = gates.assert_public(gates.projected(df, allowed), allowed)
    assert [tuple(r) for r in public.collect()] == [(1, [("p", ["a"])])]
    with pytest.raises(gates.GateError, match="extra"):
        gates.projected(df, [*allowed, "extra", "extra.n"])
    payloads = df.select("id", F.to_json(F.struct("id", "sides")).alias("payload")).unionByName(public.select("id", F.to_json(F.struct("id", "sides")).alias("payload")))
    assert gates.leaking(payloads, "id", "payload", ["provenance"]).count() == 1


def test_readings(spark):
    rows = [
        ("agree", ["p", "a"], ["a", "p"], ["p"], False, False, False, ("written", ["p", "a"], False)), ("disagree", ["p", "a"], ["p", "b"], [], False, False, False, ("frames-disagree", None, False)),
        ("unite", ["p", "a"], ["p", "b"], ["z"], True, True, False, ("written", ["p", "a", "b"], True)), ("force", ["p", "a"], ["p", "b"], ["p"], False, True, False, ("written", ["p", "a"], False)),
        ("titled", ["p", "a"], ["p", "a"], ["t"], False, False, False, ("title-missing", None, False)), ("keep", ["p", "a"], ["p", "a"], ["t", "p"], False, True, True, ("written", ["p", "a", "t"], True)),
        ("forced title", ["p", "a"], ["p", "a"], ["t"], True, True, False, ("written", ["p", "a"], False)),
    ]
    df = spark.createDataFrame([r[:-1] for r in rows], "k string, a array<string>, b array<string>, t array<string>, u boolean, f boolean, kp boolean")
    found = {r["k"]: tuple(r["r"]) for r in df.select("k", gates.judged_reading(*(F.col(c) for c in ("a", "b", "t", "u", "f", "kp"))).alias("r")).collect()}
    assert found == {r[0]: r[-1] for r in rows}


def test_eras():
    era = intervals.Era
    good = [era(1, "2026-08-01", "2026-09-01"), era(2, "2026-09-01", None)]
    intervals.validate_eras(good, "2026-08-01")
    broken = {"no era": [], "no day": [era(1, "2026-8-1", None)], "before the launch": [era(1, "2026-07-31", None)], "is not open": good[:1], "does not follow": [good[0], era(2, "2026-09-02", None)]}
    for said, eras in broken.items():
        with pytest.raises(ValueError, match=said):
            intervals.validate_eras(eras, "2026-08-01")


def test_names_are_no_patterns(spark):
    df = spark.createDataFrame([("a.b (c) axb a.b c+ A.B",)], "t string")
    found = df.select(tx.span_ids(F.col("t"), {"a.b": "dot", "c+": "plus", "(c)": "round"}).alias("ids")).first()["ids"]
    assert found == ["dot", "round", "plus"]


def test_patches_of_years_of_five_digits(spark, tmp_path):
    """Keys that reach beyond the year 9999 give the rows of the SQL."""
    keys = [1, 2, 3, 4, 40, 2_924_000, 2_924_003, 2_924_040, 8_999_999, 9_000_000]
    rows = spark.createDataFrame([(k, "1-URGENT" if k % 3 else "5-LOW") for k in keys], "o_orderkey bigint, o_orderpriority string")
    rows.toPandas().to_parquet(tmp_path / "orders.parquet")
    assert spark_bag(plans.patch_gate(spark, str(tmp_path))) == duck_bag(str(tmp_path), plans.SQL["patch_gate"])
