import json
import math
import struct

import pytest
from pyspark.sql import functions as F

from tidelog.functions import avro
from tidelog.functions.avro import SchemaError, decode_versions, encode_record, parse_schema, registered_schemas


def zigzag(n):
    n = (n << 1) ^ (n >> 63)
    n &= (1 << 64) - 1
    out = bytearray()
    while True:
        out.append((n & 127) | (128 if n > 127 else 0))
        n >>= 7
        if not n:
            return bytes(out)


def write(schema, value):
    """Plain Avro writer."""
    if isinstance(schema, list):
        branch = schema.index("null") if value is None else next(i for i, s in enumerate(schema) if s != "null")
        return zigzag(branch) + write(schema[branch], value)
    schema = INNER if schema == "In" else schema
    kind = schema["type"] if isinstance(schema, dict) else schema
    if kind == "record":
        return b"".join(write(f["type"], value[f["name"]]) for f in schema["fields"])
    if kind == "array":
        out = b""
        for k in range(0, len(value), 2):
            part = b"".join(write(schema["items"], v) for v in value[k:k + 2])
            # Blocks of two items; every other one tells its size.
            n = len(value[k:k + 2])
            out += (zigzag(-n) + zigzag(len(part)) if k % 4 else zigzag(n)) + part
        return out + b"\0"
    if kind == "enum":
        return zigzag(schema["symbols"].index(value))
    return {
        "null": lambda: b"", "boolean": lambda: bytes([value]), "int": lambda: zigzag(value), "long": lambda: zigzag(value),
        "float": lambda: struct.pack("<f", value), "double": lambda: struct.pack("<d", value),
        "string": lambda: zigzag(len(value.encode())) + value.encode(), "bytes": lambda: zigzag(len(value)) + value, "fixed": lambda: value,
    }[kind]()


def frame(schema_id, schema, value):
    return b"\0" + struct.pack(">I", schema_id) + write(schema, value)


def record(name, **fields):
    return {"type": "record", "name": name, "fields": [{"name": k, "type": v} for k, v in fields.items()]}


INNER = record("In", a="int", b=["null", "string"])
ALL = record(
    "All", i="int", l="long", d="double", f="float", t="boolean", s="string", y="bytes", e={"type": "enum", "name": "E", "symbols": ["A", "B"]},
    x={"type": "fixed", "name": "X", "size": 3}, u=["null", "double"], w=["string", "null"], r=INNER,
    n={"type": "array", "items": "long"}, m={"type": "array", "items": {"type": "array", "items": "string"}},
    q={"type": "array", "items": "In"},
)
VALUES = [
    dict(i=0, l=0, d=0.0, f=0.0, t=False, s="", y=b"", e="A", x=b"abc", u=None, w="w", r=dict(a=1, b=None), n=[], m=[], q=[]),
    dict(i=-2**31, l=2**63 - 1, d=-1.5e300, f=-3.25, t=True, s="é漢😀" * 50, y=bytes(range(256)), e="B", x=b"\0\xff\0", u=math.pi, w=None,
         r=dict(a=-7, b="x'y\\z"), n=[1, -1, 2**40, 5, 6], m=[["a"], [], ["b", "c", "d"]], q=[dict(a=2, b="t"), dict(a=3, b=None)] * 3),
    dict(i=2**31 - 1, l=-2**63, d=5e-324, f=1.17e-42, t=True, s="s", y=b"\0", e="A", x=b"xyz", u=math.inf, w="", r=dict(a=0, b=""), n=list(range(-40, 40)),
         m=[[]], q=[]),
    dict(i=1, l=1, d=float("nan"), f=float("-inf"), t=True, s="s", y=b"\0", e="A", x=b"xyz", u=-0.0, w="", r=dict(a=0, b=""), n=[0], m=[[]], q=[]),
]


def plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, list):
        return [plain(v) for v in value]
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, float):
        return repr(value)
    return value


def decoded(spark, frames, schemas, reader):
    df = spark.createDataFrame([(k, bytearray(f) if f is not None else None) for k, f in enumerate(frames)], "k int, body binary")
    rows = decode_versions(df, "body", {i: json.dumps(s) for i, s in schemas.items()}, json.dumps(reader)).orderBy("k").collect()
    return [r.asDict() for r in rows]


def test_all_types_round_trip(spark):
    got = decoded(spark, [frame(7, ALL, v) for v in VALUES], {7: ALL}, ALL)
    for row, value in zip(got, VALUES):
        assert row["error"] is None and row["schema_id"] == 7
        value = {**value, "f": struct.unpack("<f", struct.pack("<f", value["f"]))[0]}
        assert plain({k: row[k] for k in value}) == plain(value)


V1 = record("User", firstname="string", lastname="string")
V2 = record("User", firstname="string", old="long", lastname="string", age="int", score="float")
V3 = {"type": "record", "name": "User", "fields": [
    {"name": "given", "type": "string", "aliases": ["firstname"]}, {"name": "lastname", "type": ["null", "string"]},
    {"name": "age", "type": "long", "default": -1}, {"name": "score", "type": "double", "default": 0.5},
    {"name": "tags", "type": {"type": "array", "items": "string"}, "default": ["none"]},
    {"name": "home", "type": record("Home", city="string"), "default": {"city": "it's"}}, {"name": "note", "type": ["null", "string"], "default": None},
]}


def test_versions_are_read_as_the_newest(spark):
    frames = [
        frame(1, V1, dict(firstname="a", lastname="b")), frame(2, V2, dict(firstname="c", old=5, lastname="d", age=40, score=1.5)),
        frame(3, V3, dict(given="e", lastname=None, age=2**40, score=2.5, tags=["x", "y"], home=dict(city="z"), note="n")),
    ]
    got = decoded(spark, frames, {1: V1, 2: V2, 3: V3}, V3)
    assert [plain({k: v for k, v in r.items() if k not in ("k", "body")}) for r in got] == [
        dict(schema_id=1, given="a", lastname="b", age=-1, score="0.5", tags=["none"], home=dict(city="it's"), note=None, error=None),
        dict(schema_id=2, given="c", lastname="d", age=40, score="1.5", tags=["none"], home=dict(city="it's"), note=None, error=None),
        dict(schema_id=3, given="e", lastname=None, age=2**40, score="2.5", tags=["x", "y"], home=dict(city="z"), note="n", error=None),
    ]


def test_frames_that_cannot_be_read_have_a_reason(spark):
    good = frame(1, V1, dict(firstname="ab", lastname="cd"))
    nullable = record("N", a=["null", "string"])
    strict = record("N", a="string")
    listed = record("L", a={"type": "array", "items": "long"}, b="boolean")
    bad = {
        "truncated": [None, b"", b"\0\0\0\0", good[:-1], good[:5], frame(4, listed, dict(a=[1, 2], b=True))[:-2], good[:5] + b"\x80"],
        "bad_magic": [b"\1" + good[1:]], "unknown_schema": [frame(99, V1, dict(firstname="a", lastname="b"))],
        "bad_length": [good[:5] + b"\x01" + good[6:], good[:5] + b"\xff" * 12], "bad_text": [good[:6] + b"\xff\xfe" + good[8:]],
        "null_value": [frame(2, nullable, dict(a=None))], "bad_branch": [b"\0\0\0\0\2" + zigzag(5)],
        "unsupported_schema": [frame(3, record("M", m="string"), dict(m="x"))], "bad_number": [frame(4, listed, dict(a=[], b=2))],
    }
    strict_reader = [(reason, f) for reason, frames in bad.items() for f in frames]
    for reason, body in strict_reader:
        reader, schemas = (V1, {1: V1})
        if body and len(body) > 4 and body[4] in (2, 3) and reason in ("null_value", "bad_branch", "unsupported_schema"):
            reader, schemas = strict, {2: nullable, 3: record("M", m={"type": "map", "values": "string"})}
        if body and len(body) > 4 and body[4] == 4:
            reader, schemas = listed, {4: listed}
        row, = decoded(spark, [body], schemas, reader)
        assert row["error"] == reason, (reason, body)
        assert all(v is None for k, v in row.items() if k not in ("k", "body", "error"))


def test_schemas_that_cannot_be_read_are_refused():
    for text in ("{", '"string"', '{"type": "record"}', json.dumps(record("R", a=["int", "string"])), json.dumps(record("R", a="R")),
                 json.dumps(record("R", a="unheard"))):
        with pytest.raises(SchemaError):
            parse_schema(text)
    with pytest.raises(SchemaError):
        avro._Compiler("b").plain(avro.Node("string"), avro.Node("int"), "6L")
    with pytest.raises(SchemaError):
        avro._Compiler("b").record(parse_schema(json.dumps(record("R"))), parse_schema(json.dumps(record("R", a="int"))), "6L")


def test_writing_equals_the_plain_writer(spark):
    schema = record("W", i="int", s="string", t="boolean", u=["null", "long"], r=INNER, a={"type": "array", "items": "string"})
    values = [dict(i=-5, s="é", t=True, u=None, r=dict(a=1, b=None), a=[]), dict(i=300, s="", t=False, u=2**32, r=dict(a=-9, b="q"), a=["x", "yz"])]
    df = spark.createDataFrame(values, "i int, s string, t boolean, u long, r struct<a: int, b: string>, a array<string>")
    got = [bytes(r["f"]) for r in df.select(encode_record(9, json.dumps(schema)).alias("f")).collect()]
    assert got == [frame(9, schema, v) for v in values]


def test_newest_schema_of_a_subject(spark):
    registry = spark.createDataFrame([("a-value", 1, 7, "{1}"), ("a-value", 2, 5, "{2}"), ("b-value", 9, 1, "{3}")], "subject string, version int, schema_id int, schema string")
    assert registered_schemas(registry, "a-value") == ({7: "{1}", 5: "{2}"}, "{2}")
    with pytest.raises(SchemaError):
        registered_schemas(registry, "c-value")


def test_a_filter_on_the_result_does_not_read_twice(spark):
    df = spark.createDataFrame([(bytearray(frame(1, V1, dict(firstname="a", lastname="b"))),)], "body binary")
    plan = decode_versions(df, "body", {1: json.dumps(V1)}, json.dumps(V1)).filter("error IS NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("is_valid_utf8") <= 4


def test_dead_letters_of_a_stream_lie_apart(spark, tmp_path):
    from tidelog.streaming.append import append_stream

    frames = [frame(1, V1, dict(firstname=f"a{k}", lastname="b")) for k in range(5)] + [b"\1bad", b""]
    source = str(tmp_path / "in")
    spark.createDataFrame([(bytearray(f),) for f in frames], "body binary").write.parquet(source)
    stream = spark.readStream.schema("body binary").parquet(source)
    out = str(tmp_path / "out")
    decoded = decode_versions(stream, "body", {1: json.dumps(V1)}, json.dumps(V1)).drop("body")
    append_stream(avro.with_dead_letters(decoded), out, checkpoint=str(tmp_path / "cp"), partition_by=("dead",)).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.filter("dead = 0").count() == 5 and {r["error"] for r in rows.filter("dead = 1").collect()} == {"bad_magic", "truncated"} - (
        set() if rows.filter("error = 'bad_magic'").count() else {"bad_magic"})
