import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.operators.lookup import lookup_join
from tidelog.sources import keyed


def people(spark, n):
    return spark.range(n).select(
        (F.col("id") % 50).cast("int").alias("k"), F.concat(F.lit("d"), F.col("id") % 7).alias("day"), F.col("id").alias("v")
    )


def files_read(df):
    return {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}


def test_a_lookup_reads_only_the_buckets_of_its_keys(spark, path):
    table = keyed.create_table(people(spark, 2000), path("t"), ["k"], 16)
    keys = spark.createDataFrame([(3, "x"), (3, "x"), (4, "y"), (None, "z"), (900, "w")], "k long, tag string")
    found = keyed.keyed_lookup(keys, table, ["k"], select=["v"])
    assert rows(found) == rows(lookup_join(keys, people(spark, 2000), ["k"], select=["v"]))
    buckets = keyed.buckets_of(keys, table, ["k"])
    assert 0 < len(buckets) <= 3 < len(os.listdir(f"{path('t')}/data/version=1")) - 1
    # Scans prune directories: the filter on the bucket is a partition filter, and few files remain.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket")
    entries = keyed._read(spark, table, keyed._places(spark, table)[1], buckets)
    scan = entries._jdf.queryExecution().sparkPlan()
    read = [m for m in entries.select(F.input_file_name().alias("f")).distinct().collect()]
    assert {int(r["f"].split("bucket=")[1].split("/")[0]) for r in read} <= buckets and scan is not None


def test_lookup_of_no_key_reads_nothing(spark, path):
    table = keyed.create_table(people(spark, 100), path("t"), ["k", "day"], 4)
    keys = spark.createDataFrame([(None, "d1")], "a int, b string")
    assert keyed.keyed_lookup(keys, table, ["a", "b"], key_map={"a": "k", "b": "day"}).count() == 0
    keys = spark.createDataFrame([(1, "d1"), (1, "none")], "a int, b string")
    found = keyed.keyed_lookup(keys, table, ["a", "b"], key_map={"a": "k", "b": "day"}, value=("v", "value"))
    assert rows(found) == rows(people(spark, 100).filter("k = 1 AND day = 'd1'").select("v"))
    with pytest.raises(ValueError, match="day"):
        keyed.keyed_lookup(keys, table, ["a"], key_map={"a": "k"})


def test_a_change_rewrites_only_the_buckets_of_its_keys(spark, path):
    table = keyed.create_table(people(spark, 50), path("t"), ["k"], 16)
    before = {f for f in keyed.read_table(spark, table).inputFiles()}
    change = spark.createDataFrame([(3, "new", 1, 1), (3, "old", 0, 0), (777, "added", 5, 0)], "k int, day string, v long, seq int")
    assert keyed.change_table(table, change, "seq") == 2
    expected = [r for r in rows(people(spark, 50)) if r[0] != 3] + [(3, "new", 1), (777, "added", 5)]
    assert rows(keyed.read_table(spark, table)) == sorted(expected, key=str)
    touched = keyed.buckets_of(change, table, ["k"])
    rewritten = [n for n in os.listdir(f"{path('t')}/data/version=2") if n.startswith("bucket=")]
    assert {int(n.split("=")[1]) for n in rewritten} == touched and len(touched) <= 2
    # Old files are where they were.
    assert all(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in before)
    # The same change again changes nothing.
    keyed.change_table(table, change, "seq")
    assert rows(keyed.read_table(spark, table)) == sorted(expected, key=str)


def test_an_incomplete_change_is_not_seen(spark, path, monkeypatch):
    table = keyed.create_table(people(spark, 50), path("t"), ["k"], 4)
    once = rows(keyed.read_table(spark, table))

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(keyed, "complete_version", lost)
    change = spark.createDataFrame([(1, "x", 0, 0)], "k int, day string, v long, seq int")
    with pytest.raises(OSError):
        keyed.change_table(table, change, "seq")
    assert rows(keyed.read_table(spark, keyed.open_table(spark, path("t")))) == once
    monkeypatch.undo()
    assert keyed.change_table(table, change, "seq") == 2
    assert keyed.read_table(spark, table).filter("day = 'x'").count() == 1


def test_null_keys_and_clashing_names_are_refused(spark, path):
    with pytest.raises(Exception, match="a key column is null"):
        keyed.create_table(spark.createDataFrame([(None, 1)], "k int, v int"), path("n"), ["k"], 2)
    with pytest.raises(ValueError):
        keyed.create_table(spark.createDataFrame([(1, 1)], "k int, bucket int"), path("b"), ["k"], 2)
    keyed.create_table(people(spark, 3), path("t"), ["k"], 2)
    with pytest.raises(FileExistsError):
        keyed.create_table(people(spark, 3), path("t"), ["k"], 2)


def test_empty_table(spark, path):
    table = keyed.create_table(people(spark, 0), path("t"), ["k"], 2)
    assert keyed.read_table(spark, table).count() == 0
    keyed.change_table(table, spark.createDataFrame([(1, "x", 0, 0)], "k int, day string, v long, seq int"), "seq")
    assert keyed.read_table(spark, table).count() == 1
