import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidelog.operators.lookup import (
    copartition_join, frequent_keys, lookup_join, lookup_table_rows, write_bucketed,
)
from tidelog.sources.tables import where_join


@pytest.fixture
def entries(spark):
    return spark.createDataFrame(
        [(1, "day1", "b1", "x"), (1, "day1", "b2", "y"), (2, "day2", "b1", "z"), (None, "day1", "b1", "n")],
        "partitioner int, day string, bucket string, val string",
    )


def test_duplicates_kept_misses_and_nulls_dropped(spark, entries):
    keys = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "partitioner int")
    got = rows(lookup_join(keys, entries, ["partitioner"], select=["val"]))
    assert got == [(1, "x"), (1, "x"), (1, "y"), (1, "y"), (2, "z")]


def test_table_rows_keep_the_schema_of_the_table(spark, entries):
    keys = spark.createDataFrame([(1,), (2,)], "dummy int")
    got = lookup_table_rows(keys, entries, ["dummy"], {"dummy": "partitioner"})
    assert got.schema == entries.schema
    assert got.count() == 3


def test_mapped_composite_key_keeps_extra_left_columns(spark, entries):
    keys = spark.createDataFrame([(1, "day1", "b2"), (2, "day2", "b9")], "dummy int, day string, bucket string")
    keys = keys.withColumn("toto", F.lit("42"))
    got = lookup_join(keys, entries, ["dummy", "day", "bucket"], key_map={"dummy": "partitioner"})
    assert got.columns == ["dummy", "day", "bucket", "toto", "partitioner", "val"]
    assert rows(got) == [(1, "day1", "b2", "42", 1, "y")]


def test_value_only(spark, entries):
    keys = spark.createDataFrame([(1, "day1", "b1")], "partitioner int, day string, bucket string")
    got = lookup_join(keys, entries, keys.columns, value=("val", "value"))
    assert got.columns == ["value"] and rows(got) == [("x",)]


def test_columns_are_pruned_to_the_selected(spark, path):
    spark.range(10).selectExpr("id AS k", "id AS a", "id AS b").write.parquet(path("table"))
    joined = lookup_join(spark.range(3).toDF("k"), spark.read.parquet(path("table")), ["k"], select=["a"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint,a:bigint>" in plan


def test_where_join_is_not_a_cartesian_product(spark):
    spark.range(5).selectExpr("id", "concat('n', id) AS name").createOrReplaceTempView("ent")
    spark.range(3, 9).selectExpr("id AS ent_id", "id AS ent_other").createOrReplaceTempView("ent_id")
    joined = where_join(spark, "ent", "ent_id", "id", "ent_id")
    assert rows(joined) == [(3, "n3"), (4, "n4")]
    assert "Cartesian" not in joined._jdf.queryExecution().executedPlan().toString()


def skewed(spark, hot_left, hot_right):
    left = spark.range(300).select(
        F.when(F.col("id") < hot_left, 7).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("l")
    )
    right = spark.range(400).select(
        F.when(F.col("id") < hot_right, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("r")
    )
    return left, right


@pytest.mark.parametrize("hot", [(0, 0), (150, 0), (0, 200), (150, 200)])
def test_copartition_with_hot_keys_equals_plain_join(spark, hot):
    left, right = skewed(spark, *hot)
    got = copartition_join(left, right, ["k"], 6)
    assert rows(got, "k", "l", "r") == rows(left.join(right, "k"), "k", "l", "r")


def test_copartition_keeps_copies_and_drops_null_keys(spark):
    left = spark.createDataFrame([(1,)] * 50 + [(None,)] * 50 + [(2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    got = rows(copartition_join(left, right, ["k"], 4))
    assert got == [(1, "a")] * 50 + [(2, "b")]


def test_frequent_keys_are_fewer_than_parts(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"))
    assert frequent_keys(df, ["k"], 3).count() == 1
    assert frequent_keys(df, ["k"], 4).count() == 3


def test_copartition_without_hot_keys_has_two_exchanges_and_one_join(spark):
    left, right = skewed(spark, 0, 0)
    plan = copartition_join(left, right, ["k"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("SortMergeJoin") == 1 and "Union" not in plan


def test_bucketed_tables_join_without_an_exchange(spark):
    left, right = skewed(spark, 0, 0)
    write_bucketed(left, "bucketed_left", ["k"], 4)
    write_bucketed(right, "bucketed_right", ["k"], 4)
    joined = lookup_join(
        spark.table("bucketed_left"), spark.table("bucketed_right").hint("merge"), ["k"], select=["r"]
    )
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == left.join(right, "k").count()


def test_columns_of_the_same_name_are_both_given(spark):
    keys = spark.createDataFrame([(1, "left", 99)], "id int, name string, partitioner int")
    table = spark.createDataFrame([(1, "right", 1)], "id int, name string, partitioner int")
    got = lookup_join(keys, table, ["id"], select=["id", "name"])
    assert got.columns == ["id", "name", "partitioner", "table_name"] and rows(got) == [(1, "left", 99, "right")]
    renamed = lookup_join(keys.withColumnRenamed("id", "dummy"), table, ["dummy"], key_map={"dummy": "partitioner"})
    assert rows(renamed, "dummy", "partitioner", "table_partitioner", "table_name") == [(1, 99, 1, "right")]
    with pytest.raises(ValueError, match="table_name"):
        lookup_join(keys.withColumnRenamed("partitioner", "table_name"), table, ["id"], select=["name"])
