import json
import random

import pytest
from pyspark.sql import functions as F

from tidelog.llm import tools

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>, level string"
RESULTS = "conv_id long, turn long, call_id string, content string"
TOOLS = (tools.Tool("f", (tools.Field("a", "integer"), tools.Field("b", "string", required=False))), tools.Tool("g", (tools.Field("x", "array"),)))


def link(spark, calls, results):
    found = tools.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOLS)
    return {(r["conv_id"], r["call_id"]): r for r in found.collect()}


def test_levels_links_and_errors(spark):
    calls = [
        (1, 5, "d", "f", '{"a":1}', ["b", "c"], None), (1, 1, "a", "f", '{"b":"é\\n","a":2}', None, None),
        (1, 3, "b", "f", '{"a":"x"}', ["a"], None), (1, 4, "c", "g", '{"x":[1,{"z":1,"y":2}]}', ["b", "b"], None),
        (1, 9, "e", "h", "{}", ["zz"], None), (1, 9, "p", "f", "[1]", ["q"], None), (1, 9, "q", "f", "{oops", ["p"], None),
        (1, 9, "r", "f", None, ["q"], None), (2, 1, "a", "f", '{"a":1,"k":0}', ["a"], None), (None, 1, "a", None, '{"a":1}', [None], None),
        (1, 2, "a", "g", "{}", None, None),
    ]
    results = [(1, 7, "a", "late"), (1, 2, "a", "first"), (2, 2, "zz", "orphan"), (None, 2, "a", None), (1, 3, None, "none")]
    got = link(spark, calls, results)
    assert {k: v["level"] for k, v in got.items()} == {
        (1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "d"): 3, (1, "e"): 0, (1, "p"): None, (1, "q"): None, (1, "r"): None,
        (2, "a"): None, (None, "a"): 0,
    }
    assert got[1, "a"]["message"] == '{"arguments":{"a":2,"b":"é\\n"},"id":"a","name":"f","result":"first"}'
    assert json.loads(got[1, "c"]["message"])["arguments"] == {"x": [1, {"y": 2, "z": 1}]}
    assert '{"y":2,"z":1}' in got[1, "c"]["message"]
    errors = {k: v["errors"] for k, v in got.items()}
    assert errors[1, "b"] == ["type:a"] and errors[1, "c"] == [] and errors[1, "e"] == ["unknown_tool", "missing_dependency"]
    assert errors[1, "p"] == errors[1, "q"] == errors[1, "r"] == ["not_an_object"]
    assert errors[2, "a"] == ["unexpected:k"] and errors[None, "a"] == ["unknown_tool"]
    assert [k for k, v in got.items() if v["linked"]] == [k for k in got if k in ((1, "a"), (None, "a"))]


def test_calls_without_identifier_and_empty(spark):
    got = link(spark, [(1, 1, None, "f", '{"a":1}', ["x"], None)], [(1, 2, None, "r")])
    assert got[1, None]["level"] == 0 and not got[1, None]["linked"]
    assert link(spark, [], []) == {}


def test_missing_fields(spark):
    got = link(spark, [(1, 1, "a", "g", "{}", None, None), (1, 1, "b", "g", '{"x":3}', None, None)], [])
    assert got[1, "a"]["errors"] == ["missing:x"] and got[1, "b"]["errors"] == ["type:x"]


def test_repeated_keys_and_long_integers(spark):
    bodies = ['{"a":1,"a":2}', '{"a":12345678901234567890}', '{"a":1.0}', '{"a":1e3}', '{"a":-5,"b":{"x":1,"x":2}}']
    got = link(spark, [(1, k, f"c{k}", "f", body, None, None) for k, body in enumerate(bodies)], [])
    assert [got[1, f"c{k}"]["errors"] for k in range(3)] == [["duplicate_key"], [], []]
    assert got[1, "c3"]["errors"] == ["type:a"] and got[1, "c4"]["errors"] == ["not_an_object"]
    assert json.loads(got[1, "c0"]["message"])["arguments"] is None
    assert '"a":12345678901234567890' in got[1, "c1"]["message"]


def _plain_levels(needs):
    """Longest chain below each call; none on or behind a cycle."""
    level, open_ = {}, dict(needs)
    while ready := [c for c, n in open_.items() if all(x in level for x in n)]:
        for c in ready:
            level[c] = 1 + max((level[x] for x in open_[c]), default=-1)
        for c in ready:
            del open_[c]
    return level


@pytest.mark.parametrize("shape", ["chain", "random", "dense", "cycle"])
def test_levels_of_all_shapes(spark, shape):
    pick = random.Random(3)
    n = 150
    needs = {k: [k - 1] if k else [] for k in range(n)}
    if shape == "random":
        needs = {k: sorted({pick.randrange(k) for _ in range(pick.randrange(3))}) if k else [] for k in range(n)}
    if shape == "dense":
        needs = {k: list(range(max(0, k - 6), k)) for k in range(40)}
    if shape == "cycle":
        needs[20] = [19, 25]
    calls = spark.createDataFrame([("c", str(k)) for k in needs], "conv_id string, call_id string")
    links = spark.createDataFrame([("c", str(k), str(x)) for k, xs in needs.items() for x in xs], "conv_id string, call_id string, needs string")
    expected = {str(k): v for k, v in _plain_levels(needs).items()}
    for found in (tools.levels(calls, links), tools._levels_one_by_one(calls, links) if shape in ("dense", "cycle") else None):
        if found is not None:
            assert {r["call_id"]: r["level"] for r in found.collect()} == expected


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    calls = spark.range(200).select(F.lit("c").alias("conv_id"), F.col("id").cast("string").alias("call_id"))
    links = spark.range(1, 200).select(F.lit("c").alias("conv_id"), F.col("id").cast("string").alias("call_id"), (F.col("id") - 1).cast("string").alias("needs"))
    written = []
    real = tools.materialize
    monkeypatch.setattr(tools, "materialize", lambda df, name: written.append(name) or real(df, name))
    assert tools.levels(calls, links).agg(F.max("level")).first()[0] == 199
    assert len(written) <= 2 * 8 + 2


@pytest.mark.parametrize("shape", ["wide"])
def test_hot_conversation(spark, shape):
    calls = spark.range(3000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.concat(F.lit("c"), "id").alias("call_id"),
        F.lit("f").alias("name"), F.lit('{"a":1}').alias("arguments"),
        F.when(F.col("id") % 3 != 0, F.array(F.concat(F.lit("c"), F.col("id") - 1))).alias("needs"),
    )
    results = calls.select("conv_id", "turn", "call_id", F.lit("r").alias("content"))
    found = tools.link_calls(calls, results, TOOLS).groupBy("level").count().collect()
    assert {r["level"]: r["count"] for r in found} == {0: 1000, 1: 1000, 2: 1000}


def test_repeated_calls_and_results_are_kept(spark):
    calls = [
        (1, 1, "a", "f", '{"a":1}', None, None), (1, 1, "a", "f", '{"a":1}', None, None), (1, 4, "a", "g", "{}", ["a"], None),
        (None, 1, "a", "f", '{"a":1}', None, None), (None, 1, "a", "f", '{"a":1}', None, None), (1, 6, "b", "f", '{"a":1}', ["a"], None),
    ]
    results = [
        (1, 2, "a", "one"), (1, 2, "a", "one"), (1, 5, "a", "two"), (None, 3, "a", None), (1, 9, None, "x"),
        (1, 9, None, "x"), (2, 2, "a", "orphan"), (1, 7, "b", "only"),
    ]
    calls, results = spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)
    found = [(r["conv_id"], r["turn"], r["call_id"], r["level"], r["linked"], tuple(r["errors"])) for r in tools.link_calls(calls, results, TOOLS).collect()]
    assert sorted(found, key=str) == sorted([
        (1, 1, "a", 0, True, ("multiple_results",)), (1, 1, "a", None, False, ("duplicate_id",)),
        (1, 4, "a", None, False, ("missing:x", "duplicate_id")), (None, 1, "a", 0, True, ()),
        (None, 1, "a", None, False, ("duplicate_id",)), (1, 6, "b", 1, True, ()),
    ], key=str)
    left = sorted((tuple(r) for r in tools.unlinked_results(calls, results).collect()), key=str)
    assert left == sorted([
        (1, 2, "a", "one", "later_result"), (1, 5, "a", "two", "later_result"), (1, 9, None, "x", "no_identifier"),
        (1, 9, None, "x", "no_identifier"), (2, 2, "a", "orphan", "no_call"),
    ], key=str)
