import datetime
import os
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.operators import rollups
from tidelog.operators.committed import read_committed
from tidelog.operators.offsets import (
    batch_offset_ranges, batch_running_total, offset_ranges, row_count, stream_total,
)
from tidelog.operators import percentiles
from tidelog.operators.percentiles import exact_percentiles, value_band
from tidelog.streaming.append import append_stream
from tidelog.sources.topics import TopicSpec, publish, read_topic_stream
from tests.test_topics import records

WANTED = {"median": 0.5, "p95": 0.95, "p99": 0.99, "low": 0.0, "high": 1.0}
T = datetime.datetime(2024, 1, 1, 10, 58, 30)


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_equal_numpy(spark, seed):
    random = np.random.default_rng(seed)
    groups = {
        "one": [5.0],
        "two": [1.0, 2.0],
        "same": [3.25] * 1000,
        "mixed": list(random.normal(0, 100, 700).round(2)) + [0.0] * 50,
        "wide": list(np.exp(random.normal(0, 8, 500))),
        "close": list(1000 + random.random(400)),
    }
    data = [(k, float(v)) for k, values in groups.items() for v in values] + [("two", None), (None, 1.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", WANTED).collect()}
    assert set(got) == set(groups)
    for name, values in groups.items():
        for column, p in WANTED.items():
            assert math.isclose(got[name][column], np.quantile(values, p), rel_tol=1e-9, abs_tol=1e-9)


def test_bands_follow_the_order_of_the_values(spark):
    values = [-math.inf, -1e308, -5.0, -1e-308, 0.0, 5e-324, 1e-300, 1.0, 1.0001, 7.0, 1e308, math.inf, math.nan]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    bands = [r["b"] for r in df.select("i", value_band(F.col("v")).alias("b")).orderBy("i").collect()]
    assert bands == sorted(bands) and len(set(bands)) >= len(bands) - 2


def events(spark, *data):
    return spark.createDataFrame(
        [(T + datetime.timedelta(seconds=s), t, float(v)) for s, t, v in data],
        "ts timestamp_ntz, event_type string, value double",
    )


def test_trailing_rates(spark):
    df = events(spark, (0, "a", 1), (10, "a", 2), (60, "a", 3), (0, "b", 4))
    got = {(r["event_type"], r["minute"]): r for r in rollups.metric_rollup(df).collect()}
    first = T.replace(second=0)
    at = lambda m: first + datetime.timedelta(minutes=m)
    assert {k[1] for k in got if k[0] == "a"} == {at(m) for m in range(16)}
    assert (got["a", at(0)]["n"], got["a", at(0)]["rate_15m"]) == (2, 2 / 900)
    assert (got["a", at(1)]["n"], got["a", at(1)]["rate_15m"]) == (1, 3 / 900)
    assert (got["a", at(14)]["n"], got["a", at(14)]["rate_15m"]) == (0, 3 / 900)
    assert got["a", at(15)]["rate_15m"] == 1 / 900
    assert got["a", at(1)]["rate_1m"] == 1 / 60
    # Percentiles are those of the clock hour: 10:58 and 10:59 only.
    assert got["a", at(0)]["median"] == 2.0 and got["a", at(2)]["median"] is None


def test_approximate_percentiles_agree_on_small_groups(spark):
    df = events(spark, *[(0, "a", v) for v in range(1, 102)])
    row = rollups.approximate_percentiles(df).first()
    assert (row["median"], row["p95"], row["p99"]) == (51.0, 96.0, 100.0)


def test_approval_rates(spark):
    df = events(spark, (0, "ok", 1), (1, "error", 1), (60, "ok", 1), (120, "ok", 1))
    got = rollups.approval_rate_minute(df, F.col("event_type") != "error")
    assert rows(got, "hour", "minute", "ttl_txn_min", "approved_txn_min", "ttl_txn_hr", "approved_txn_hr") == [
        (10, 58, 2, 1, 3, 2), (10, 59, 1, 1, 3, 2), (11, 0, 1, 1, 1, 1),
    ]
    assert rows(got.filter("minute = 58"), "approved_rate_min", "approved_rate_hr") == [(0.5, 2 / 3)]


def test_offset_ranges_and_totals(spark):
    df = records(spark, {0: 600, 1: 250})
    assert rows(offset_ranges(df), "partition", "from_offset", "max_offset", "until_offset", "n") == [
        (0, 0, 599, 600, 600), (1, 0, 249, 250, 250),
    ]
    assert rows(batch_offset_ranges(df), "partition", "batch_id", "from_offset", "until_offset") == [
        (0, 0, 0, 250), (0, 1, 250, 500), (0, 2, 500, 600), (1, 0, 0, 250),
    ]
    assert rows(batch_running_total(df, 599), "batch_id", "n", "total") == [(0, 500, 500), (1, 250, 750), (2, 100, 850)]
    assert row_count(df).first()[0] == 850


def test_stream_total_is_kept_as_state(spark, path):
    spec = TopicSpec("t", root=path("topic"), max_files_per_trigger=1)
    publish(records(spark, {0: 30}), spec, offsets_per_slice=10)
    seen = []
    query = (
        stream_total(read_topic_stream(spark, spec)).writeStream.outputMode("complete")
        .option("checkpointLocation", path("cp"))
        .foreachBatch(lambda df, batch_id: seen.append(df.first()[0]))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert seen == [10, 20, 30]


def transactional(spark):
    """Two partitions; transactions of three records, marker at every fourth offset."""
    return spark.range(0, 60).select(
        (F.col("id") % 2).cast("int").alias("partition"),
        F.expr("id div 6").alias("txn_id"),
        F.expr("4 * (id div 6) + (id div 2) % 3").alias("offset"),
    )


def markers(spark, states):
    data = [(p, t, s) for (p, t), s in states.items()]
    return spark.createDataFrame(data, "partition int, txn_id bigint, state string")


def test_read_committed_hides_aborted_and_what_follows_an_open_transaction(spark):
    states = {(p, t): "commit" for p in (0, 1) for t in range(10)}
    states[0, 2] = "abort"
    del states[0, 5], states[1, 0]
    got = rows(read_committed(transactional(spark), markers(spark, states)), "partition", "txn_id")
    assert got == sorted([(0, t) for t in (0, 1, 3, 4) for _ in range(3)], key=str)


def test_read_committed_only_grows_as_markers_arrive(spark):
    order = [(p, t) for t in range(10) for p in (0, 1)]
    visible = set()
    for known in (0, 5, 11, 20):
        states = {key: ("abort" if key[1] % 3 == 0 else "commit") for key in order[:known]}
        now = set(rows(read_committed(transactional(spark), markers(spark, states)), "partition", "offset"))
        assert visible <= now
        visible = now
    assert len(visible) == 2 * 6 * 3


def test_percentiles_of_infinities_and_small_rates(spark):
    df = spark.createDataFrame([("a", math.inf), ("a", math.inf), ("a", 1.0), ("b", -math.inf), ("b", -math.inf)], "k string, v double")
    got = rows(exact_percentiles(df, ["k"], "v", {"p50": 0.5, "p0": 0.0}))
    assert got == [("a", math.inf, 1.0), ("b", -math.inf, -math.inf)]
    events = spark.range(1).select(F.lit("x").alias("event_type"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.lit(1e-9).alias("value"))
    assert {r["median"] for r in rollups.metric_rollup(events).collect()} == {1e-9}


def test_crowded_bands_are_cut_until_they_are_small(spark, monkeypatch):
    # All values lie in one band, half of them within a millionth of it.
    df = spark.range(20_000).select(
        (F.col("id") % 2).cast("string").alias("k"),
        F.when(F.col("id") % 4 < 2, F.lit(1e9) + F.col("id") * 1e-6).otherwise(F.lit(1e9) + F.col("id") / 20_000).alias("v"),
    )
    assert df.select(value_band(F.col("v"))).distinct().count() <= 2
    sizes = []
    real = percentiles.materialize

    def watched(table, name):
        out = real(table, name)
        if name == "bands":
            sizes.append(out.agg(F.max("_different")).first()[0])
        return out

    monkeypatch.setattr(percentiles, "materialize", watched)
    got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", WANTED, most=50).collect()}
    assert sizes[0] > 5000 and sizes[-1] <= 50
    for k in ("0", "1"):
        values = [r["v"] for r in df.filter(F.col("k") == k).collect()]
        for name, p in WANTED.items():
            assert got[k][name] == pytest.approx(float(np.quantile(values, p)), abs=1e-6)


def test_null_types_have_percentiles(spark):
    df = events(spark, (0, None, 1), (1, None, 3), (2, "a", 5), (3, "a", 7))
    got = {(r["event_type"], r["median"]) for r in rollups.metric_rollup(df).filter("n > 0").collect()}
    assert got == {(None, 2.0), ("a", 6.0)}


def test_weighted_rates_equal_the_recursion(spark):
    random = np.random.default_rng(4)
    minutes = sorted(random.choice(np.arange(10_000, 12_500), 300, replace=False).tolist()) + [13_000, 20_000]
    data = [(t, int(m), int(n)) for t in ("a", None) for m, n in zip(minutes, random.integers(0, 50, len(minutes)))]
    df = spark.createDataFrame(data, "event_type string, minute long, n long")
    got = {(r["event_type"], r["minute"]): r for r in rollups.weighted_rates(df, {"short": 1, "long": 15}).collect()}
    assert len(got) == len(data)
    for kind in ("a", None):
        for name, w in (("short", 1), ("long", 15)):
            average, last = None, None
            for t, m, n in data:
                if t != kind:
                    continue
                keep = math.exp(-1.0 / w)
                average = n / 60 if average is None else average * keep ** (m - last) + (1 - keep) * n / 60
                last = m
                assert got[kind, m][name] == pytest.approx(average, rel=1e-9, abs=1e-9)


def test_minutes_of_a_stream_equal_the_batch_and_late_rows_are_told(spark, path):
    from tidelog.streaming.progress import ProgressRecorder, progress_table

    schema = "ts timestamp, ok boolean, beat boolean"
    base = datetime.datetime(2024, 1, 1, 10, 0, 0)
    at = lambda minutes, **s: base + datetime.timedelta(minutes=minutes, **s)
    batches = [
        [(at(0), True, False), (at(0, seconds=59), False, False), (at(3), True, False)],
        [(at(1), True, False), (at(61), False, False)],              # late by less than the delay
        [(at(62), True, False)],                                     # from here on the watermark is past 10:56
        [(at(2), True, False), (at(62), False, False)],              # the first row is late
        [(at(500), True, True)],
    ]
    for k, data in enumerate(batches):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(path(f"in/b{k}"))
        for name in os.listdir(path(f"in/b{k}")):
            os.utime(os.path.join(path(f"in/b{k}"), name), (1_700_000_000 + k, 1_700_000_000 + k))
    recorder = ProgressRecorder(spark, path("progress"))
    spark.streams.addListener(recorder)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path("in/*"))
        minutes = rollups.approval_minutes_stream(stream, F.col("ok"), "5 minutes", ~F.col("beat"))
        query = append_stream(minutes, path("out"), checkpoint=path("cp"))
        query.awaitTermination()
        assert recorder.wait_terminated(str(query.runId))
    finally:
        spark.streams.removeListener(recorder)
    kept = [r for data in batches[:4] for r in data if r[0] != at(2)]
    whole = spark.createDataFrame(kept, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    expected = rollups.approval_rate_minute(whole, F.col("ok"))
    assert rows(rollups.approval_hours(spark.read.parquet(path("out")))) == rows(expected)
    assert progress_table(spark, path("progress")).first()["late_rows"] == 1


def test_merged_sketches_are_within_the_stated_error(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 != 0, F.lit("a")).alias("event_type"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=F.col("id") % 36_000)).alias("ts"),
        F.exp(F.randn(seed=5) * 3).alias("value"),
    )
    sketches = rollups.minute_sketches(df)
    assert sketches.count() == 2 * 600
    marks = rollups.merged_quantiles(sketches, "event_type")
    found = rollups.rank_errors(df, marks, "event_type").collect()
    assert {r["event_type"] for r in found} == {None, "a"} and sum(r["n"] for r in found) == 200_000
    assert all(0 <= r[f"{name}_error"] <= rollups.RANK_ERROR for r in found for name in rollups.PERCENTILES)
    hours = rollups.merged_quantiles(sketches, "event_type", F.date_trunc("hour", "minute").alias("hour"))
    assert hours.count() == 2 * 10 and hours.agg(F.sum("n")).first()[0] == 200_000
    # A sketch does not grow with the rows.
    size = sketches.groupBy().agg(F.octet_length(F.kll_merge_agg_double("sketch", F.lit(rollups.SKETCH_SIZE))).alias("b")).first()["b"]
    assert size < 60_000
