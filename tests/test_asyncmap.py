import os
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators.asyncmap import IN_FLIGHT, foreach_async, map_async

SCHEMA = "id bigint, payload string"


def echo(client, row):
    # Later rows of a window finish first.
    time.sleep(0.001 * (row["id"] % 7))
    return {"id": row["id"], "payload": row["payload"] + "!"}


def frame(spark, n, parts=1):
    return spark.range(0, n, 1, parts).withColumn("payload", F.concat(F.lit("p"), F.col("id")))


@pytest.mark.parametrize("n", [0, 1, 48, 49, 50, 500])
def test_output_order_is_input_order(spark, n):
    got = map_async(frame(spark, n), lambda: None, echo, SCHEMA).collect()
    assert [(r["id"], r["payload"]) for r in got] == [(i, f"p{i}!") for i in range(n)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 50), max_size=120), st.integers(1, 60))
def test_any_rows_and_window(spark, ids, in_flight):
    df = spark.createDataFrame([(i, "x") for i in ids], SCHEMA).coalesce(1)
    got = map_async(df, lambda: None, echo, SCHEMA, in_flight=in_flight).collect()
    assert [r["id"] for r in got] == ids


def test_calls_overlap_within_the_bound(spark, path):
    class Counter:
        def __init__(self):
            import threading

            self.lock, self.now, self.most = threading.Lock(), 0, 0

    def call(client, row):
        with client.lock:
            client.now += 1
            client.most = max(client.most, client.now)
        time.sleep(0.01)
        with client.lock:
            client.now -= 1
        return {"id": row["id"], "payload": str(client.most)}

    got = map_async(frame(spark, 200), Counter, call, SCHEMA).collect()
    most = max(int(r["payload"]) for r in got)
    assert 10 < most <= IN_FLIGHT


@pytest.mark.parametrize("kept", [60, 20, 0])
def test_close_runs_once_per_partition_even_when_empty(spark, path, kept):
    folder = path("closed")
    os.makedirs(folder)

    def close(client):
        import tempfile

        tempfile.mkstemp(dir=folder)

    df = frame(spark, 60, parts=3).filter(F.col("id") < kept)
    map_async(df, lambda: None, echo, SCHEMA, close=close).collect()
    assert len(os.listdir(folder)) == 3


def test_close_runs_after_an_error(spark, path):
    folder = path("closed")
    os.makedirs(folder)

    def close(client):
        import tempfile

        tempfile.mkstemp(dir=folder)

    def broken(client, row):
        raise ValueError("refused")

    with pytest.raises(Exception, match="refused"):
        map_async(frame(spark, 5), lambda: None, broken, SCHEMA, close=close).collect()
    assert len(os.listdir(folder)) == 1


def test_slow_call_fails_the_task(spark):
    def slow(client, row):
        time.sleep(1.5)
        return row

    with pytest.raises(Exception, match="TimeoutError"):
        map_async(frame(spark, 2), lambda: None, slow, SCHEMA, timeout=0.2).collect()


def test_foreach_awaits_every_row(spark, path):
    folder = path("calls")
    os.makedirs(folder)

    def touch(client, row):
        open(os.path.join(folder, str(row["id"])), "w").close()

    receipts = foreach_async(frame(spark, 130, parts=2), lambda: None, touch, "id").collect()
    assert sorted(r["id"] for r in receipts) == list(range(130)) and all(r["done"] for r in receipts)
    assert len(os.listdir(folder)) == 130


def test_integers_keep_their_digits_and_nulls_are_none(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, "a"), (None, None), (big + 2, "c")], "id long, t string").coalesce(1)
    seen = map_async(df, lambda: None, lambda c, row: {"id": row["id"], "seen": repr(row["id"])}, "id long, seen string")
    assert [tuple(r) for r in seen.collect()] == [(big, str(big)), (None, "None"), (big + 2, str(big + 2))]
    assert [r["id"] for r in foreach_async(df, lambda: None, lambda c, row: None, "id").collect()] == [big, None, big + 2]
