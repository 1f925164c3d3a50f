import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.operators import ledger
from tidelog.operators.prefix import highest_before, prefix_sum
from tidelog.storage import small_table

T0 = datetime.datetime(2024, 1, 31)


def event(p, lo, hi, processed=True, days_ago=0.0, name=None, app="a", n=None):
    at = T0 - datetime.timedelta(days=days_ago)
    return (app, "t", p, lo, hi, hi - lo if n is None else n, "r", 0, name or f"{p}:{lo}-{hi}", processed, at)


@pytest.fixture
def make(spark):
    return lambda *events: small_table(spark, list(events), ledger.LEDGER_SCHEMA)


def test_current_takes_newest_finished_range(make):
    events = make(
        event(0, 0, 10, days_ago=3), event(0, 10, 20, days_ago=2), event(0, 20, 30, processed=False),
        event(1, 0, 5, days_ago=1), event(1, 5, 9, days_ago=1),
    )
    got = rows(ledger.ledger_current(events), "partition", "from_offset", "until_offset", "n")
    assert got == [(0, 10, 20, 10), (1, 5, 9, 4)]


def test_history_is_newest_first_and_of_one_key(make):
    events = make(event(0, 0, 10, days_ago=3), event(0, 10, 20, days_ago=1), event(0, 0, 10, app="b"))
    got = [r["until_offset"] for r in ledger.ledger_history(events, "a", "t").collect()]
    assert got == [20, 10]


def test_continuity_kinds_and_modes(make):
    events = make(
        event(0, 0, 10), event(0, 10, 20), event(0, 25, 30), event(0, 28, 40), event(0, 28, 40),
        event(1, 7, 9), event(1, 9, 12, processed=False), event(1, 12, 14),
    )
    strict = rows(ledger.range_continuity(events), "partition", "from_offset", "prev_until", "kind")
    assert strict == [(0, 25, 20, "gap"), (0, 28, 30, "overlap"), (1, 12, 9, "gap")]
    loose = rows(ledger.range_continuity(events, transactional=True), "partition", "from_offset", "kind")
    assert loose == [(0, 28, "overlap")]


@pytest.mark.parametrize("span", [1, 7, 64, 1 << 28])
def test_continuity_does_not_depend_on_the_span(make, span):
    starts = [o for o in range(0, 300, 5) if o % 35]
    events = make(*[event(p, o, o + 5) for p in (0, 1) for o in starts])
    got = rows(ledger.range_continuity(events, span=span), "partition", "from_offset", "prev_until")
    expected = [
        (p, b, a + 5) for p in (0, 1) for a, b in zip(starts, starts[1:]) if b != a + 5
    ]
    assert got == sorted(expected, key=str)


def test_retention_and_compaction(make):
    events = make(
        event(0, 0, 10, days_ago=30), event(0, 10, 20, days_ago=20), event(1, 0, 5, days_ago=1),
        event(2, 0, 5, processed=False, days_ago=15, name="open"),
        event(1, 5, 9, days_ago=7), event(1, 9, 11, days_ago=7.001),
    )
    kept = rows(ledger.ledger_retention(events, "2024-01-31 00:00:00"), "partition", "from_offset")
    assert kept == [(1, 0), (1, 5)]
    compacted = ledger.compact(events, "2024-01-31 00:00:00")
    assert rows(compacted, "partition", "from_offset") == [(0, 10), (1, 0), (1, 5), (2, 0)]
    assert rows(ledger.pending_ranges(compacted), "range_id") == [("open",)]


def test_resume_and_pending(make):
    events = make(
        event(0, 0, 10), event(0, 10, 20, processed=False), event(1, 0, 5, processed=False), event(1, 0, 5),
        event(0, 0, 99, app="b"),
    )
    assert rows(ledger.resume_position(events, "a", "t")) == [(0, 10), (1, 5)]
    assert rows(ledger.pending_ranges(events), "application_id", "partition", "from_offset") == [("a", 0, 10)]


def test_range_id_ignores_order_and_depends_on_bounds():
    a = ledger.range_id("app", [("t", 0, 0, 5), ("t", 1, 0, 7)])
    assert a == ledger.range_id("app", [("t", 1, 0, 7), ("t", 0, 0, 5)])
    assert a != ledger.range_id("app", [("t", 1, 0, 8), ("t", 0, 0, 5)])
    assert a != ledger.range_id("other", [("t", 1, 0, 7), ("t", 0, 0, 5)])


@pytest.mark.parametrize("block", [2, 5, 64, 1000])
def test_prefix_sum_with_any_block(spark, block):
    df = spark.range(0, 200).filter("id % 3 <> 1").withColumn("v", F.col("id") % 7)
    got = rows(prefix_sum(df, index="id", value="v", result="s", max_index=199, block=block), "id", "s")
    total, expected = 0, []
    for i in range(200):
        if i % 3 != 1:
            total += i % 7
            expected.append((i, total))
    assert got == sorted(expected, key=str)


def test_prefix_sum_has_no_single_task_window_over_the_rows(spark):
    df = spark.range(0, 1000).withColumn("v", F.col("id") % 7)
    summed = prefix_sum(df, index="id", value="v", result="s", max_index=999, block=100)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [sum(v#" in line]
    assert windows and all("windowspecdefinition(id_block" in line for line in windows)


def test_highest_before_of_a_hot_key(spark):
    values = [(i * 37) % 501 for i in range(500)]
    df = spark.createDataFrame([("hot", 3 * i, v) for i, v in enumerate(values)], "k string, o long, v long")
    got = highest_before(df, keys=["k"], order=["o"], value="v", result="before", span=50)
    assert rows(got, "o", "before") == sorted(
        [(3 * i, max(values[:i], default=None)) for i in range(500)], key=str
    )


@pytest.mark.parametrize("block", [2, 65_536])
def test_prefix_sum_treats_a_null_index_alike_at_every_size(spark, block):
    df = spark.createDataFrame([(None, 5), (0, 1), (1, 2), (7, 4), (None, 9)], "i long, v long")
    got = prefix_sum(df, index="i", value="v", result="s", max_index=7, block=block)
    assert rows(got) == sorted([(None, 5, None), (0, 1, 1), (1, 2, 3), (7, 4, 7), (None, 9, None)], key=str)


def test_ranges_are_compared_with_all_before_them(spark):
    found = []
    for lo, hi in ((0, 100), (10, 20), (20, 30), (100, 200)):
        found.append(("a", "t", 0, lo, hi, hi - lo, "r", 0, f"{lo}", True, None))
    broken = ledger.range_continuity(small_table(spark, found, ledger.LEDGER_SCHEMA))
    assert rows(broken, "from_offset", "prev_until", "kind") == [(10, 100, "overlap"), (20, 100, "overlap")]


def test_prefix_sum_reads_its_source_once(spark, path):
    spark.range(0, 3000).write.parquet(path("rows"))
    counts = spark.read.parquet(path("rows")).groupBy(F.expr("id div 10").alias("b")).agg(F.count("*").alias("n"))
    summed = prefix_sum(counts, index="b", value="n", result="total", max_index=299, block=50)
    assert summed.agg(F.max("total")).first()[0] == 3000
    summed.collect()
    plan = summed._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
