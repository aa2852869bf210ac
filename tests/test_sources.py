"""Readers, writers and streams over small files."""

import json

import pytest
from pyspark.sql import functions as F

from loomtrace.sources import readers, writers
from loomtrace.streaming import groups


@pytest.fixture
def log(tmp_path):
    (tmp_path / "a.jsonl").write_text('{"type":"x","n":1}\n[1]\nbad\n\n{"type":"y","n":2}\n[runner-error] stopped\n')
    return str(tmp_path / "a.jsonl")


def test_jsonl(spark, log, tmp_path):
    rows, bad = readers.read_jsonl(spark, log)
    assert [r.line_no for r in rows.orderBy("line_no").collect()] == [1, 5]
    assert [(r.line_no, r.reason) for r in bad.orderBy("line_no").collect()] == [(2, "not_an_object"), (3, "invalid_json"), (6, "invalid_json")]
    with pytest.raises(Exception, match="a.jsonl"):
        readers.read_jsonl_strict(spark, log).collect()
    events, summary = readers.session_events(spark, log)
    assert events.count() == 2 and summary.first()["malformed"] == 2 and summary.first()["runner_error"]
    assert readers.read_jsonl_or_empty(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0


def test_numbers_over_splits(spark, tmp_path):
    (tmp_path / "n.txt").write_text("".join(f"{i}\n" for i in range(1, 5001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    rows = readers.numbered_lines(spark, f"{tmp_path}/n.txt")
    wrong = rows.where("line_no <> cast(value as long)").count()
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (rows.count(), wrong) == (5000, 0)


def test_table_slice(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    assert [r.id for r in readers.read_table(spark, f"{tmp_path}/t.parquet@[3:6]", order="id").collect()] == [3, 4, 5]
    assert readers.split_slice("x@[2:]") == ("x", 2, None) and readers.split_slice("x") == ("x", None, None)
    for bad in ("x.txt", "x.parquet@[-1:]"):
        with pytest.raises(ValueError):
            readers.read_table(spark, bad)


def test_layout(spark, tmp_path):
    for p in ("r1/run_config.json", "r1/row0001_idx7/meta.json", "r1/row0002_idx8/rollout3/meta.json"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("{}")
    assert [r.run_dir.rsplit("/", 1)[1] for r in readers.run_dirs(spark, str(tmp_path)).collect()] == ["r1"]
    got = {(r.row_number, r.dataset_index, r.rollout_index) for r in readers.rollout_samples(spark, f"{tmp_path}/r1").collect()}
    assert got == {(1, 7, 0), (2, 8, 3)}


def test_records(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"a":1}')
    (tmp_path / "c.jsonl").write_text('{"a":2}\n{"a":3}\n')
    assert [r.name for r in readers.records(spark, str(tmp_path)).orderBy("name").collect()] == ["b.json", "c__000001.jsonl", "c__000002.jsonl"]


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('﻿id,q1,q2\n1,,"x\ny"\n2,z,w\n', encoding="utf-8")
    rows = readers.csv_mapped(spark, str(tmp_path / "t.csv"), {"id": ["id"], "question": ["q1", "q2"], "none": ["q9"]}).orderBy("id").collect()
    assert [(r.id, r.question, r.none) for r in rows] == [("1", "x\ny", None), ("2", "z", None)]


def test_limits(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "limit int, tools array<string>")
    assert readers.inverted_limits(df, 3).count() == 3
    with pytest.raises(ValueError):
        readers.inverted_limits(df.unionByName(df))


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), (" ", 3)], "k string, n int")
    assert writers.write_jsonl(df, f"{tmp_path}/j") == 3
    for _ in range(2):
        writers.publish(df, f"{tmp_path}/p")
    assert spark.read.schema("k string, n int").json(f"{tmp_path}/p").count() == 3
    writers.write_partitioned(df, f"{tmp_path}/q", "k")
    assert spark.read.json(f"{tmp_path}/q").count() == 2
    writers.write_csv(df, f"{tmp_path}/c")
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").columns == ["k", "n"]
    with pytest.raises(ValueError):
        writers.publish_tables({"a": df, "b": df.limit(0)}, f"{tmp_path}/all")
    s = writers.summarise(df, "k", "k", "k").first()
    assert s.records == 3 and s.unique_ids == 3
    (tmp_path / "f.jsonl").write_text('{"a":1}\nbad\n')
    r = writers.file_stats(spark.read.format("binaryFile").load(f"{tmp_path}/f.jsonl")).first()
    assert r.bytes == 12 and r.events == 1 and r.valid


def test_streams(spark, tmp_path):
    rows = [("a", 1.0), ("a", 1.0), ("b", 0.0), ("a", 0.0), ("a", 1.0), ("a", 5.0)]
    for i, part in enumerate((rows[:3], rows[3:])):
        spark.createDataFrame(part, "g string, r double").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = spark.readStream.schema("g string, r double").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    q = groups.complete_groups(stream, "g", "r", 2, groups.spread).writeStream.format("memory").queryName("done").outputMode("append").option("checkpointLocation", f"{tmp_path}/s").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT g, n FROM done").count() == 2  # five of a: two pairs and one left over

    for part in ([("x", 1), ("x", 1), ("y", 2)], [("y", 3), ("z", 4)]):
        spark.createDataFrame(part, "fingerprint string, v int").write.mode("append").json(f"{tmp_path}/tasks")
        run = groups.checkpoint_tasks(spark.readStream.schema("fingerprint string, v int").json(f"{tmp_path}/tasks"), f"{tmp_path}/out", f"{tmp_path}/k")
        run.processAllAvailable()
        run.stop()
    done = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.fingerprint for r in done.collect()) == ["x", "y", "z"]
    assert groups.remaining(spark.createDataFrame([("x",), ("w",)], "fingerprint string"), done).count() == 1


def test_public_only(spark):
    from loomtrace.functions.text import public_part

    df = spark.createDataFrame([({"q": "x", " Answer ": "y"},)], "m map<string,string>")
    assert json.loads(df.select(F.to_json(public_part(F.col("m"), ("answer",)))).first()[0]) == {"q": "x"}
