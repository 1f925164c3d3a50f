import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.test_topics import records
from tidelog import storage
from tidelog.operators.offsets import offset_ranges
from tidelog.sources import generate, sinks, tables
from tidelog.sources.topics import TopicSpec, publish, read_topic_stream
from tidelog.streaming.append import append_stream
from tidelog.streaming.progress import (
    ProgressRecorder, observe_ranges, observed_ranges, progress_table, read_events,
)
from tidelog.streaming.rows import RowWriter, foreach_rows, read_rows

PEOPLE = "id int, name string, seq int"


def test_csv_bad_cells_are_null(spark, path):
    os.makedirs(path("csv"))
    with open(path("csv/id.csv"), "w") as out:
        out.write("1,2\n2,x\n3\n,4\n5,3000000000\n")
    got = tables.read_csv(spark, path("csv"), tables.PAIR_SCHEMA)
    assert rows(got) == sorted([(1, 2), (2, None), (3, None), (None, 4), (5, None)], key=str)


def test_export_writes_one_file_per_partition(spark, path):
    sinks.export_csv(spark.range(0, 100, 1, 4), path("out"))
    assert len([n for n in os.listdir(path("out")) if n.startswith("part-")]) == 4
    back = tables.read_csv(spark, path("out"), T.StructType([T.StructField("id", T.LongType())]))
    assert back.count() == 100


def test_upsert_replaces_adds_and_is_repeatable(spark, path):
    target = path("people")
    sinks.upsert(spark, target, spark.createDataFrame([(1, "a", 0), (2, "b", 0)], PEOPLE), ["id"], "seq")
    change = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1)], PEOPLE)
    assert sinks.upsert(spark, target, change, ["id"], "seq") == 2
    once = rows(sinks.read_keyed_table(spark, target))
    assert once == [(1, "a"), (2, "new"), (3, "c")]
    sinks.upsert(spark, target, change, ["id"], "seq")
    assert rows(sinks.read_keyed_table(spark, target)) == once


def test_incomplete_version_is_not_read(spark, path):
    target = path("people")
    sinks.upsert(spark, target, spark.createDataFrame([(1, "a", 0)], PEOPLE), ["id"], "seq")
    spark.range(3).write.parquet(f"{target}/version=00000002")
    os.remove(f"{target}/version=00000002/_SUCCESS")
    assert rows(sinks.read_keyed_table(spark, target)) == [(1, "a")]
    assert sinks.upsert(spark, target, spark.createDataFrame([(2, "b", 0)], PEOPLE), ["id"], "seq") == 2


def test_latest_per_key_takes_ties_by_content(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "c", 4)], PEOPLE)
    assert rows(sinks.latest_per_key(df, ["id"], "seq")) == [(1, "b", 5)]
    plan = sinks.latest_per_key(df, ["id"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_filter_is_pushed_to_the_scan(spark, path):
    tables.triple_range(spark, 1000).write.parquet(path("test.parquet"))
    tables.read_table(spark, os.path.dirname(path("x")), "test")
    result = tables.filter_view(spark, "test", "v1 > 200", columns="key, v1")
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(v1,200)" in plan and "ReadSchema: struct<key:bigint,v1:bigint>" in plan
    cached = tables.filter_view(spark, "test", "v1 > 200", cached=True)
    assert cached.count() == cached.agg(F.count("*")).first()[0] == 799
    cached.unpersist()


def test_key_range(spark):
    assert rows(tables.key_range(spark, 2)) == [(1, "d1", "bucket1"), (2, "d2", "bucket2")]


def test_payloads_are_repeatable_and_in_range(spark):
    made = generate.generate_payloads(spark.range(2000).toDF("i"), "i", seed=1)
    again = generate.generate_payloads(spark.range(2000).toDF("i").repartition(7), "i", seed=1)
    other = generate.generate_payloads(spark.range(2000).toDF("i"), "i", seed=2)
    assert rows(made) == rows(again) != rows(other)
    parsed = [json.loads(r["value"]) for r in made.collect()]
    assert all(len(p["name"]) == 10 and p["name"].isalnum() for p in parsed)
    assert {p["age"] for p in parsed} == set(range(99))


def test_transactions_commit_every_record_once(spark):
    size = 1000
    source = spark.range(size).withColumnRenamed("id", "r")
    sent = generate.generate_transactions(source, "r", size, seed=3).cache()
    committed = sent.filter(~F.col("abort"))
    assert rows(committed, "r") == sorted([(i,) for i in range(size)], key=str)
    per_txn = sent.groupBy("txn_id").agg(F.count("*").alias("n"), F.count_distinct("abort").alias("flags"))
    assert {r["n"] for r in per_txn.collect()} <= {1, 2, 3}
    assert per_txn.filter("flags > 1").count() == 0
    share = sent.filter("abort").select("txn_id").distinct().count() / per_txn.count()
    assert 0.42 < share < 0.56
    sent.unpersist()


def test_transaction_plan_in_small_blocks(spark, monkeypatch):
    whole = rows(generate.transaction_plan(spark.range(1200).toDF("txn_id"), 181, seed=3))
    calls = generate.prefix_sum
    monkeypatch.setattr(generate, "prefix_sum", lambda df, **kw: calls(df, block=16, **kw))
    assert rows(generate.transaction_plan(spark.range(1200).toDF("txn_id"), 181, seed=3)) == whole


def test_rows_written_by_a_stream(spark, path):
    spec = TopicSpec("t", root=path("topic"), max_files_per_trigger=2)
    publish(records(spark, {0: 40, 1: 20}), spec, offsets_per_slice=10)
    stream = read_topic_stream(spark, spec).select("partition", "offset")
    foreach_rows(stream, RowWriter(path("rows"))).awaitTermination()
    got = rows(read_rows(spark, path("rows"), "partition int, offset bigint"))
    assert got == sorted([(0, o) for o in range(40)] + [(1, o) for o in range(20)], key=str)


def test_row_writer_replaces_on_retry_and_leaves_nothing_on_error(path):
    from pyspark.sql import Row

    writer = RowWriter("file:" + path("rows"))
    for value in (1, 2):
        assert writer.open(0, 5)
        writer.process(Row(a=value))
        writer.close(None)
    writer.open(1, 5)
    writer.process(Row(a=9))
    writer.close(ValueError())
    assert os.listdir(path("rows")) == ["part-00000005-000000.json"]
    assert open(path("rows/part-00000005-000000.json")).read() == '{"a": 2}\n'


def test_progress_events(spark, path):
    spec = TopicSpec("t", root=path("topic"), max_files_per_trigger=1)
    publish(records(spark, {0: 30}), spec, offsets_per_slice=10)
    recorder = ProgressRecorder(spark, path("progress"))
    spark.streams.addListener(recorder)
    try:
        good = append_stream(read_topic_stream(spark, spec), path("out"), name="good")
        good.awaitTermination()

        def fail(df, batch_id):
            raise ValueError("refused")

        bad = (
            read_topic_stream(spark, spec).writeStream.queryName("bad")
            .option("checkpointLocation", path("cp")).foreachBatch(fail).trigger(availableNow=True).start()
        )
        try:
            bad.awaitTermination()
        except Exception:
            pass
        assert recorder.wait_terminated(str(good.runId)) and recorder.wait_terminated(str(bad.runId))
    finally:
        spark.streams.removeListener(recorder)
    table = {r["name"]: r for r in progress_table(spark, path("progress")).collect()}
    assert (table["good"]["batches"], table["good"]["input_rows"], table["good"]["terminated"]) == (3, 30, True)
    assert table["good"]["exception"] is None and "refused" in table["bad"]["exception"]
    assert read_events(spark, path("progress")).filter("kind = 'started'").count() == 2


def test_shared_folder_comes_from_the_session(spark, path):
    assert storage.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert storage.scratch(spark, "x") != storage.scratch(spark, "x")


def test_settings_follow_the_input():
    from tidelog.session import settings_for

    assert settings_for(10, 8)["spark.sql.shuffle.partitions"] == "8"
    assert settings_for(100 * 2**40, 4000)["spark.sql.shuffle.partitions"] == "409600"


def test_upsert_takes_maps_and_refuses_null_keys(spark, path):
    schema = "k int, items map<string,double>, tags array<string>, seq int"
    sinks.upsert(spark, path("t"), spark.createDataFrame([(1, {"a": 1.0}, ["x"], 0), (2, {}, None, 0)], schema), ["k"], "seq")
    changes = [(1, {"b": 2.0}, ["y"], 2), (1, {"c": 3.0}, ["z"], 1), (3, None, [], 1)]
    sinks.upsert(spark, path("t"), spark.createDataFrame(changes, schema), ["k"], "seq")
    got = {r["k"]: (r["items"], r["tags"]) for r in sinks.read_keyed_table(spark, path("t")).collect()}
    assert got == {1: ({"b": 2.0}, ["y"]), 2: ({}, None), 3: (None, [])}
    with pytest.raises(Exception, match="key column is null"):
        sinks.upsert(spark, path("t"), spark.createDataFrame([(None, {}, [], 3)], schema), ["k"], "seq")
    assert sinks.read_keyed_table(spark, path("t")).count() == 3


def test_csv_gives_any_text_back(spark, path):
    texts = ["a\nb", "", None, 'say "x"', "a,b", " pad ", "\n", "back\\slash", "é"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    sinks.export_csv(df, path("csv"))
    got = {r["i"]: r["t"] for r in tables.read_csv(spark, path("csv"), df.schema).collect()}
    assert got == dict(enumerate(texts))


def test_rows_of_all_types_come_back(spark, path):
    from datetime import date, datetime
    from decimal import Decimal

    schema = "b binary, d date, t timestamp_ntz, n decimal(10,2), big long, m map<string,binary>, a array<date>, s string"
    values = (bytearray(b"\x00\xff"), date(2024, 2, 29), datetime(2024, 1, 2, 3, 4, 5, 678901), Decimal("1.50"), 2**60,
              {"k": bytearray(b"v")}, [date(2024, 1, 1)], "é\n")
    df = spark.createDataFrame([values, (None,) * 8], schema)
    df.write.parquet(path("in"))
    foreach_rows(spark.readStream.schema(df.schema).parquet(path("in")), RowWriter(path("rows"))).awaitTermination()
    back = read_rows(spark, path("rows"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_rows_need_a_known_file_system(spark, path):
    stream = spark.readStream.schema("a int").parquet(path(""))
    with pytest.raises(Exception, match="nowhere|No FileSystem"):
        foreach_rows(stream, RowWriter("nowhere://x/y"))


def test_observed_ranges_equal_those_of_the_batches(spark, path):
    spec = TopicSpec("t", root=path("topic"), max_files_per_trigger=2)
    publish(records(spark, {0: 40, 1: 25}), spec, offsets_per_slice=10)
    recorder = ProgressRecorder(spark, path("progress"), file_events=4)
    spark.streams.addListener(recorder)
    seen = {}

    def batch(df, batch_id):
        seen.update({(batch_id, r["partition"]): (r["from_offset"], r["until_offset"], r["n"]) for r in offset_ranges(df, ["partition"]).collect()})
        df.write.format("noop").mode("overwrite").save()

    try:
        query = append_stream(observe_ranges(read_topic_stream(spark, spec), 2), path("out"), checkpoint=path("cp"))
        query.awaitTermination()
        assert recorder.wait_terminated(str(query.runId))
        other = read_topic_stream(spark, spec).writeStream.foreachBatch(batch).option("checkpointLocation", path("cp2")).trigger(availableNow=True).start()
        other.awaitTermination()
        assert recorder.wait_terminated(str(other.runId))
    finally:
        spark.streams.removeListener(recorder)
    events = read_events(spark, path("progress")).filter(F.col("run_id") == str(query.runId))
    told = {(r["batch_id"], r["partition"]): (r["from_offset"], r["until_offset"], r["n"]) for r in observed_ranges(events, 2).collect()}
    assert told == seen and len({b for b, _ in told}) > 2
    # Events are gathered in files.
    files = [n for n in os.listdir(path("progress")) if n.endswith(".json")]
    assert len(files) < read_events(spark, path("progress")).count()
