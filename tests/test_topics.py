import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.sources import topics
from tidelog.sources.topics import (
    EARLIEST, LATEST, DataLossError, TopicSpec, check_data_loss, format_offsets, parse_offsets, publish,
    publish_slice, read_topic, read_topic_range, read_topic_stream,
)
from tidelog.streaming.append import append_stream


def records(spark, counts, first=0):
    """``counts[p]`` records in partition ``p``, offsets from ``first``."""
    parts = [
        spark.range(first, first + n).select(F.lit(p).alias("partition"), F.col("id").alias("offset"))
        for p, n in counts.items()
    ]
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    return df.select(
        F.concat_ws("-", "partition", "offset").cast("binary").alias("key"),
        F.col("offset").cast("string").cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        "partition",
        "offset",
        F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def positions(df):
    return rows(df, "partition", "offset")


def test_spec_text():
    assert parse_offsets('{"t": {"0": 23, "1": -2}}', "t") == {0: 23, 1: -2}
    assert format_offsets("t", {1: 5, 0: 3}) == '{"t": {"0": 3, "1": 5}}'
    with pytest.raises(ValueError):
        parse_offsets('{"other": {"0": 1}}', "t")


def test_range_bounds(spark):
    df = records(spark, {0: 10, 1: 10})
    got = read_topic_range(df, {0: 3, 1: EARLIEST}, {0: LATEST, 1: 2})
    assert positions(got) == sorted([(0, o) for o in range(3, 10)] + [(1, 0), (1, 1)], key=str)
    assert read_topic_range(df, {0: 4, 1: 4}, {0: 4, 1: 4}).count() == 0


def test_range_errors(spark):
    df = records(spark, {0: 3, 1: 3})
    with pytest.raises(ValueError, match="partition 1"):
        read_topic_range(df, {0: 0}, {0: LATEST})
    with pytest.raises(ValueError):
        read_topic_range(df, {0: LATEST, 1: 0}, {0: 1, 1: 1})
    with pytest.raises(ValueError):
        read_topic_range(df, {0: 0, 1: 0}, {0: EARLIEST, 1: 1})
    with pytest.raises(ValueError):
        read_topic_range(df, {0: 0, 1: 0}, {0: 1})


def test_range_with_many_partitions_equals_predicate(spark, monkeypatch):
    df = records(spark, {p: 20 for p in range(5)})
    start = {0: 3, 1: EARLIEST, 2: 5, 3: 0, 4: 19}
    end = {0: LATEST, 1: 7, 2: 5, 3: 20, 4: LATEST}
    by_predicate = positions(read_topic_range(df, start, end))
    monkeypatch.setattr(topics, "MAX_PREDICATE_TERMS", 2)
    assert positions(read_topic_range(df, start, end)) == by_predicate
    bounded = {p: 2 for p in range(5)}
    assert read_topic_range(df, bounded, {p: 4 for p in range(5)}).count() == 10


def test_data_loss(spark):
    df = records(spark, {0: 5, 1: 5}, first=10)
    lost = check_data_loss(df, {0: 4, 1: 10, 2: 0})
    assert rows(lost) == [(0, 4, 10, 6), (2, 0, None, None)]
    with pytest.raises(DataLossError, match="partition 0"):
        check_data_loss(df, {0: 4, 1: 10}, strict=True)
    assert check_data_loss(df, {0: 10, 1: EARLIEST}, strict=True).count() == 0


def test_publish_skewed_partitions_and_read_back(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    df = records(spark, {0: 100, 1: 7, 2: 1})
    publish(df, spec, offsets_per_slice=30)
    back = read_topic(spark, spec)
    assert back.schema.fieldNames() == topics.RECORD_COLUMNS
    assert rows(back) == rows(df)
    # One file per slice and partition, and none beyond the slice size.
    files = back.groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi")
    ).collect()
    assert len(files) == 4 + 1 + 1
    assert all(f["n"] == f["hi"] - f["lo"] + 1 <= 30 for f in files)


def test_later_slices_have_later_files(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 40, 1: 13}), spec, offsets_per_slice=10)
    publish(records(spark, {0: 15}, first=40), spec, offsets_per_slice=10)
    times = (
        spark.read.parquet(spec.path)
        .select("slice", F.col("_metadata.file_modification_time").alias("at"))
        .groupBy("slice").agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .orderBy("slice").collect()
    )
    assert len(times) == 6
    assert all(a["last"] < b["first"] for a, b in zip(times, times[1:]))
    assert [n for n in os.listdir(path("topic")) if n.startswith("_")] == []


def test_publishing_again_changes_nothing(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    df = records(spark, {0: 5, 1: 5})
    publish_slice(df, spec)
    publish_slice(df, spec)
    assert read_topic(spark, spec).count() == 10


def test_appending_inside_a_slice_keeps_all_records(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 70}), spec, offsets_per_slice=50)
    publish(records(spark, {0: 50}, first=70), spec, offsets_per_slice=50)
    publish(records(spark, {0: 50, 1: 5}, first=70), spec, offsets_per_slice=50)
    assert positions(read_topic(spark, spec)) == sorted([(0, o) for o in range(120)] + [(1, o) for o in range(70, 75)], key=str)


def test_a_failed_publish_loses_nothing_and_may_be_repeated(spark, path, monkeypatch):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 15}), spec, offsets_per_slice=10)
    real, seen = topics.reveal_in_order, []

    def half(spark, staging, target, prefix):
        from tidelog.storage import child_names

        names = sorted(n for n in child_names(spark, staging) if n.startswith(prefix))
        os.rename(f"{staging}/{names[0]}", f"{target}/{names[0]}")
        seen.append(names)
        raise OSError("lost")

    monkeypatch.setattr(topics, "reveal_in_order", half)
    with pytest.raises(OSError, match="lost"):
        publish(records(spark, {0: 30}, first=15), spec, offsets_per_slice=10)
    assert len(seen[0]) > 1 and read_topic(spark, spec).count() == 20
    monkeypatch.setattr(topics, "reveal_in_order", real)
    publish(records(spark, {0: 30}, first=15), spec, offsets_per_slice=10)
    assert positions(read_topic(spark, spec)) == sorted([(0, o) for o in range(45)], key=str)


@pytest.mark.parametrize("terms", [2, 64])
def test_positions_prune_and_new_partitions_are_taken(spark, path, monkeypatch, terms):
    monkeypatch.setattr(topics, "MAX_PREDICATE_TERMS", terms)
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {p: 20 for p in range(6)}), spec, offsets_per_slice=10)
    at = {0: 3, 1: 20, 2: 15, 3: 0, 4: 19}
    later = read_topic(spark, spec).filter(topics.not_before(at))
    assert positions(later) == sorted([(p, o) for p in range(6) for o in range(at.get(p, 0), 20)], key=str)
    assert topics.first_open_slice(spark, spec, at) == 0
    assert topics.first_open_slice(spark, spec, {p: 12 for p in range(6)}) == 1
    assert topics.first_open_slice(spark, spec, {p: 20 for p in range(6)}) == 2


def test_unnamed_partitions_are_found_without_reading(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 5, 1: 5}), spec, offsets_per_slice=10)
    with pytest.raises(ValueError, match="partition 1"):
        topics.read_range(spark, spec, {0: 0}, {0: LATEST}, require_all=True)
    assert topics.read_range(spark, spec, {0: 2, 1: 5}, {0: 4, 1: LATEST}, require_all=True).count() == 2


@pytest.mark.parametrize("files_per_batch", [1, 2, 5, None])
def test_stream_equals_batch(spark, path, files_per_batch):
    spec = TopicSpec("t", root=path("topic"), max_files_per_trigger=files_per_batch)
    publish(records(spark, {0: 40, 1: 13}), spec, offsets_per_slice=10)
    append_stream(read_topic_stream(spark, spec), path("out"), checkpoint=path("cp")).awaitTermination()
    assert rows(spark.read.parquet(path("out"))) == rows(read_topic(spark, spec))


def test_stream_takes_only_new_slices(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish_slice(records(spark, {0: 5}), spec)
    append_stream(read_topic_stream(spark, spec), path("out"), checkpoint=path("cp")).awaitTermination()
    publish_slice(records(spark, {0: 5}, first=5), spec)
    append_stream(read_topic_stream(spark, spec), path("out"), checkpoint=path("cp")).awaitTermination()
    assert positions(spark.read.parquet(path("out"))) == [(0, o) for o in range(10)]


def test_range_replay_is_pruned(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 20, 1: 20, 2: 20}), spec, offsets_per_slice=10)
    ranged = read_topic_range(read_topic(spark, spec), {1: 3}, {1: 8}, require_all=False).select("offset")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan
    assert "GreaterThanOrEqual(offset,3)" in plan and "LessThan(offset,8)" in plan
    assert "ReadSchema: struct<offset:bigint>" in plan
    assert "Exchange" not in plan


def test_kafka_options():
    spec = TopicSpec(
        "t", kind="kafka", max_offsets_per_trigger=100, starting_offsets='{"t":{"0":5}}',
        options={"kafka.bootstrap.servers": "host:9092"},
    )
    assert topics._kafka_options(spec) == {
        "subscribe": "t",
        "startingOffsets": '{"t":{"0":5}}',
        "failOnDataLoss": "true",
        "kafka.isolation.level": "read_committed",
        "maxOffsetsPerTrigger": "100",
        "kafka.bootstrap.servers": "host:9092",
    }
    ranged = topics._kafka_range_options(spec, {1: 5, 0: EARLIEST}, {1: 9, 0: LATEST})
    assert ranged["assign"] == '{"t": [0, 1]}' and "subscribe" not in ranged
    assert ranged["startingOffsets"] == '{"t": {"0": -2, "1": 5}}'
    assert ranged["endingOffsets"] == '{"t": {"0": -1, "1": 9}}'


def test_framed_stream_with_reader_schema(spark, path):
    from tidelog.functions import frames

    users = spark.range(20).select(
        F.col("id"), F.concat(F.lit("first"), "id").alias("a"), F.concat(F.lit("last"), "id").alias("b")
    )
    framed = topics.as_records(
        users.withColumn("value", frames.encode_frame(7, "a", "b")).withColumn(
            "at", F.lit("2024-01-01").cast("timestamp_ntz")
        ),
        key=F.col("id"), value=F.col("value"), topic="user", partition=F.lit(0), offset=F.col("id"),
        timestamp=F.col("at"),
    )
    spec = TopicSpec("user", root=path("topic"), max_files_per_trigger=1)
    publish(framed, spec, offsets_per_slice=10)
    registry = spark.createDataFrame(
        [("user-value", 1, 6), ("user-value", 2, 7)], "subject string, version int, schema_id int"
    )
    stream = frames.decode_frames(read_topic_stream(spark, spec), "value")
    joined = frames.with_reader_schema(stream, registry)
    append_stream(joined.select("offset", "firstname", "lastname", "schema_id", "reader_schema_id"), path("out")).awaitTermination()
    assert rows(spark.read.parquet(path("out"))) == sorted(
        [(i, f"first{i}", f"last{i}", 7, 7) for i in range(20)], key=str
    )


def test_late_records_are_added_and_repeated_ones_are_not(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 50}, first=100), spec, offsets_per_slice=30)
    publish(records(spark, {0: 100, 1: 3}), spec, offsets_per_slice=30)
    publish(records(spark, {0: 160}, first=40), spec, offsets_per_slice=30)
    publish(records(spark, {0: 20, 1: 5}), spec, offsets_per_slice=30)
    assert positions(read_topic(spark, spec)) == sorted([(0, o) for o in range(200)] + [(1, o) for o in range(5)], key=str)
    assert topics.next_offsets(spark, spec) == {0: 200, 1: 5}


def test_a_hole_inside_a_slice_is_filled(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    df = records(spark, {0: 60})
    publish(df.filter("offset % 3 <> 0"), spec, offsets_per_slice=20)
    publish(df, spec, offsets_per_slice=20)
    assert positions(read_topic(spark, spec)) == sorted([(0, o) for o in range(60)], key=str)


def test_index_has_every_slice_and_partition(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 40, 1: 13}), spec, offsets_per_slice=10)
    publish(records(spark, {0: 5}, first=40), spec, offsets_per_slice=10)
    stored = spark.read.parquet(spec.path).groupBy("slice", "partition").agg(F.min("offset"), F.max("offset"), F.count("*"))
    assert rows(topics.slice_index(spark, spec)) == rows(stored)
    assert topics.slice_index(spark, TopicSpec("none", root=path("topic"))).count() == 0


def _spoil(folder):
    """Make the record files below a folder unreadable."""
    for top, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(top, name), "wb") as file:
                    file.write(b"spoiled")
            elif name.endswith(".crc"):
                os.remove(os.path.join(top, name))


def test_append_and_restart_read_no_finished_file(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 40, 1: 13}), spec, offsets_per_slice=10)
    _spoil(spec.path)
    with pytest.raises(Exception):
        read_topic(spark, spec).count()
    publish(records(spark, {0: 5, 1: 4}, first=40), spec, offsets_per_slice=10)
    assert topics.next_offsets(spark, spec) == {0: 45, 1: 44}
    assert topics.first_open_slice(spark, spec, {0: 40, 1: 13}) == 8
    assert topics.first_open_slice(spark, spec, {0: 25, 1: 13}) == 2
    assert topics.first_open_slice(spark, spec, {0: 45, 1: 44}) == 9
    assert spark.read.parquet(f"{spec.path}/slice=8").count() == 9


def test_slices_without_an_index_row_are_indexed_again(spark, path):
    import shutil

    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 30}), spec, offsets_per_slice=10)
    shutil.rmtree(f"{path("topic")}/slice-index")
    assert topics.next_offsets(spark, spec) == {0: 30}
    assert topics.slice_index(spark, spec).count() == 3
