"""Landed files, writers and streams beyond what SQL compares."""

from __future__ import annotations

import duckdb
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from compare import bag, spark_bag
from conftest import SF

from quillon.plans import landing
from quillon.sources import landed, sinks


def test_broken_dump_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x", "channel": "c"}\n{"id": \n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        landed.scan(spark, str(tmp_path)).collect()


def test_absent_dump_has_no_rows(spark, tmp_path):
    rows = landed.scan_if_there(spark, f"file://{tmp_path}/none")
    assert rows.count() == 0 and "viewCount" in rows.columns
    channels = spark.createDataFrame([("c",)], "channel string")
    assert [r.channel for r in landed.missing(rows, channels).collect()] == ["c"]


def test_a_default_stands_in_for_absent_and_broken_files(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"a": 1}\n{"a": null}\n')
    (tmp_path / "broken.json").write_text('{"a": 1}\n{"a": \n')
    found = {name: [r.a for r in landed.scan_or(spark, f"{tmp_path}/{name}.json", [(7,)], "a int").collect()] for name in ("good", "broken", "none")}
    assert found == {"good": [1, None], "broken": [7], "none": [7]}


def test_rosters(spark, tmp_path):
    rosters = {"good": '[{"id": "a", "name": "A"}, {"id": "b", "name": "B", "aliases": ["x"]}]', "empty": "[]", "twice": '[{"id": "a", "name": "A"}, {"id": "a", "name": "B"}]', "nameless": '[{"id": "a"}]'}
    for name, text in rosters.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert sorted(r.id for r in landed.roster(spark, f"{tmp_path}/good.json").collect()) == ["a", "b"]
    for name, said in (("empty", "no one"), ("twice", "id a appears twice"), ("nameless", "name None is missing")):
        with pytest.raises(ValueError, match=said):
            landed.roster(spark, f"{tmp_path}/{name}.json")


def test_requests_keep_all_ids_once(spark):
    ids = spark.range(1234).select(F.when(F.col("id") < 1000, "hot").otherwise("cold").alias("channel"), F.col("id"))
    got = landed.requests(ids, "channel", "id").collect()
    assert sorted(x for r in got for x in r.ids) == list(range(1234))
    assert sorted((r.channel, len(r.ids)) for r in got) == [("cold", 34)] + [("cold", 50)] * 4 + [("hot", 50)] * 20


def test_frames(spark, tmp_path):
    for name in ("v1/000003.png", "v1/000010.png", "v2/000001.png", "v2/readme.txt", "v2/cover.png"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    found = landed.frames(spark, str(tmp_path))
    assert sorted((r.video, r.sec) for r in found.collect()) == [("v1", 3), ("v1", 10), ("v2", 1)]
    wanted = spark.createDataFrame([("v1", 10)], "video string, sec int")
    assert [(r.video, r.sec) for r in landed.frames_at(found, wanted).collect()] == [("v1", 10)]


def test_tokens(spark):
    sheet = spark.createDataFrame([(":root { --char-ann: #FfA000; --char-b-2:#123 ; --x: #fff }",)], "s string")
    assert [tuple(x) for x in sheet.select(landed.tokens(F.col("s")).alias("t")).first().t] == [("ann", "#ffa000"), ("b-2", "#123")]


def test_nothing_is_written_if_a_guard_trips(spark, tmp_path):
    rows = spark.range(3)
    with pytest.raises(ValueError, match="lost"):
        sinks.publish({"rows": rows}, {"fine": rows.where("id > 9"), "lost": rows}, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    paths = sinks.publish({"rows": rows}, {"fine": rows.where("id > 9")}, str(tmp_path / "out"))
    assert spark.read.parquet(paths["rows"]).count() == 3


def test_contract_file(spark, tmp_path):
    rows = spark.createDataFrame([("b", None), ("a", 1)], "id string, views int")
    sinks.write_array(rows, str(tmp_path / "c"), "id")
    assert [r.value for r in spark.read.text(str(tmp_path / "c")).collect()] == ['[{"id":"a","views":1},{"id":"b"}]']


def test_upsert_adds_and_keeps(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, p string, q string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", None)], "id int, p string, q string")
    assert sorted(map(tuple, sinks.upsert(old, new, "id").collect())) == [(1, "a", "x"), (2, "b", "z"), (3, "c", None)]


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """Events in 150 files, each of which spans all times."""
    folder = tmp_path_factory.mktemp("many")
    spark.read.parquet(f"{SF}/events.parquet").repartition(150, F.xxhash64("event_id")).write.parquet(f"{folder}/events.parquet")
    assert len(list((folder / "events.parquet").glob("part-*"))) > 128
    return str(folder)


@pytest.mark.parametrize("name", ["stream_hourly_reads", "stream_bursts", "stream_first_seen", "stream_store"])
def test_streams_of_many_files_lose_nothing(spark, many_files, name):
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{many_files}/events.parquet/*.parquet')")
        got = con.execute(landing.SQL[name])
        columns = [c[0] for c in got.description]
        want = sorted(columns), bag(got.fetchall(), columns)
    assert len(want[1]) > 0
    assert spark_bag(landing.QUERIES[name](spark, many_files)) == want
