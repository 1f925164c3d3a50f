import datetime
import struct
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.functions import frames, maps
from tidelog.functions.clock import epoch_micros, epoch_minute, from_epoch_micros, minute_start
from tidelog.functions.payloads import PERSON_SCHEMA, decode_json, encode_json, read_json_text
from tidelog.functions.timeuuid import timeuuid, timeuuid_time


def varint(number: int) -> bytes:
    out = bytearray()
    while True:
        low, number = number & 0x7F, number >> 7
        if not number:
            return bytes([*out, low])
        out.append(low | 0x80)


def frame(schema_id: int, *texts: str) -> bytes:
    body = b"".join(varint(2 * len(t.encode())) + t.encode() for t in texts)
    return b"\0" + struct.pack(">I", schema_id) + body


TEXTS = ["", "a", "é", "x" * 63, "x" * 64, "ü" * 40, "x" * 8191, "x" * 8192, "日本" * 5000, "z" * 1_100_000]


def test_frames_equal_hand_made_bytes(spark):
    df = spark.createDataFrame([(i, t, "last") for i, t in enumerate(TEXTS)], "i int, a string, b string")
    encoded = df.withColumn("frame", frames.encode_frame(70_000, "a", "b"))
    for row in encoded.collect():
        assert bytes(row["frame"]) == frame(70_000, TEXTS[row["i"]], "last")


def test_frames_round_trip(spark):
    df = spark.createDataFrame(
        [(i, bytearray(frame(9, t, "b" * i))) for i, t in enumerate(TEXTS)], "i int, value binary"
    )
    decoded = frames.decode_frames(df, "value").collect()
    for row in decoded:
        assert (row["schema_id"], row["firstname"], row["lastname"], row["error"]) == (
            9, TEXTS[row["i"]], "b" * row["i"], None,
        )


BAD = [
    (None, frames.TRUNCATED),
    (b"", frames.TRUNCATED),
    (b"\0\0\0\0", frames.TRUNCATED),
    (b"\0\0\0\0\x09", frames.TRUNCATED),
    (b"\x01" + frame(9, "a", "b")[1:], frames.BAD_MAGIC),
    (frame(8, "a", "b"), frames.UNKNOWN_SCHEMA),
    (frame(9, "a", "bc")[:-1], frames.TRUNCATED),
    (frame(9, "a"), frames.TRUNCATED),
    (b"\0\0\0\0\x09\x03ab", frames.BAD_LENGTH),
    (b"\0\0\0\0\x09\xff\xff\xff\xff\xff\x01", frames.BAD_LENGTH),
    (b"\0\0\0\0\x09\x80", frames.TRUNCATED),
    (b"\0\0\0\0\x09\xfe\xff\xff\xff\x0fabc", frames.TRUNCATED),
    (b"\0\0\0\0\x09\x02\xff\x02a", frames.BAD_TEXT),
    (frame(9, "a", "b") + b"rest", None),
]


def test_bad_frames_give_a_reason(spark):
    df = spark.createDataFrame(
        [(i, bytearray(b) if b is not None else None) for i, (b, _) in enumerate(BAD)], "i int, value binary"
    )
    decoded = frames.decode_frames(df, "value", known_ids=(9,))
    got = {row["i"]: row for row in decoded.collect()}
    for i, (_, reason) in enumerate(BAD):
        assert got[i]["error"] == reason, (i, got[i])
        if reason is not None:
            assert got[i]["firstname"] is None and got[i]["schema_id"] is None
    assert frames.dead_letters(decoded).count() == len(BAD) - 1


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(max_size=200), st.text(max_size=200)), min_size=1, max_size=30))
def test_frames_any_text(spark, pairs):
    pairs = [tuple(t.encode("utf-8", "ignore").decode() for t in p) for p in pairs]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    framed = df.select("i", frames.encode_frame(1, "a", "b").alias("f"))
    got = {r["i"]: (r["firstname"], r["lastname"]) for r in frames.decode_frames(framed, "f").collect()}
    assert got == dict(enumerate(pairs))


def test_latest_schema_and_missing_subject(spark):
    registry = spark.createDataFrame(
        [("user-value", 1, 10), ("user-value", 3, 12), ("user-value", 2, 11)],
        "subject string, version int, schema_id int",
    )
    records = spark.createDataFrame([("user",), ("other",)], "topic string")
    got = rows(frames.with_reader_schema(records, registry), "topic", "version", "reader_schema_id")
    assert got == [("other", None, None), ("user", 3, 12)]


def test_map_put_replaces_and_adds(spark):
    df = spark.createDataFrame([({"a": "1"},), ({"a": "1", "k": "old"},), ({},)], "m map<string,string>")
    got = [r[0] for r in df.select(maps.map_put(F.col("m"), "k", "v")).collect()]
    assert got == [{"a": "1", "k": "v"}, {"a": "1", "k": "v"}, {"k": "v"}]


def test_map_get_and_set_and_total(spark):
    df = spark.createDataFrame(
        [({"test": 1.5, "x": 2.0}, ["b", "a", "b"]), ({"x": 1.0}, [])], "m map<string,double>, t array<string>"
    )
    got = df.select(maps.map_get(F.col("m"), "test"), maps.map_total(F.col("m")), maps.as_set(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(1.5, 3.5, ["a", "b"]), (None, 1.0, [])]


def test_json_bad_cells(spark):
    df = spark.createDataFrame(
        [(1, '{"name": "Ann", "age": 3}'), (2, "{broken"), (3, '{"name": "Bob"}'), (4, '{"age": "x"}'), (5, None)],
        "id int, value string",
    )
    assert rows(decode_json(df, "value", PERSON_SCHEMA, ["id"])) == [
        (1, "Ann", 3), (2, None, None), (3, "Bob", None), (4, None, None), (5, None, None),
    ]
    corrupt = {r["id"]: r["_corrupt_record"] for r in read_json_text(df, "value", PERSON_SCHEMA, ["id"]).collect()}
    assert corrupt == {1: None, 2: "{broken", 3: None, 4: '{"age": "x"}', 5: None}


def test_json_schema_as_text_and_binary_value(spark):
    df = spark.createDataFrame([("Ann", 3)], "name string, age int").select(
        encode_json("name", "age").cast("binary").alias("value")
    )
    assert rows(decode_json(df, "value", "age int, name string", [])) == [(3, "Ann")]


TIMES = [
    datetime.datetime(1969, 12, 31, 23, 59, 59, 999_999),
    datetime.datetime(1970, 1, 1),
    datetime.datetime(2024, 2, 29, 12, 34, 56, 789_012),
    datetime.datetime(2024, 3, 31, 2, 30),
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_clock_and_uuid_do_not_depend_on_the_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, t) for i, t in enumerate(TIMES)], "i int, ts timestamp_ntz")
        got = df.select(
            "ts",
            epoch_micros(F.col("ts")).alias("us"),
            from_epoch_micros(epoch_micros(F.col("ts"))).alias("back"),
            minute_start(epoch_minute(F.col("ts"))).alias("minute"),
            timeuuid(F.col("ts"), F.col("i")).alias("uuid"),
            timeuuid_time(timeuuid(F.col("ts"), F.col("i"))).alias("from_uuid"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = datetime.datetime(1970, 1, 1)
    for row in got:
        assert row["us"] == (row["ts"] - epoch) // datetime.timedelta(microseconds=1)
        assert row["back"] == row["ts"] == row["from_uuid"]
        assert row["minute"] == row["ts"].replace(second=0, microsecond=0)
        parsed = uuid.UUID(row["uuid"])
        assert parsed.version == 1 and parsed.variant == uuid.RFC_4122
        assert parsed.time == row["us"] * 10 + 122_192_928_000_000_000
        assert parsed.node >> 40 & 1


def test_uuid_differs_for_rows_of_one_time(spark):
    df = spark.range(1000).select(timeuuid(F.lit(TIMES[1]).cast("timestamp_ntz"), F.col("id")).alias("u"))
    assert df.distinct().count() == 1000
