"""Keyed tables, CSV files and integer key ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The same on both sides. A null has a mark of its own; an empty text is a pair of quotes.
CSV_OPTIONS = {
    "header": "false", "nullValue": "\\N", "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

PAIR_SCHEMA = T.StructType(
    [T.StructField("ent_id", T.IntegerType()), T.StructField("ent_other", T.IntegerType())]
)


def read_table(spark: SparkSession, keyspace: str, table: str, view: str | None = None) -> DataFrame:
    """Load table ``table`` of the folder ``keyspace`` and register it as a view."""
    df = spark.read.parquet(f"{keyspace}/{table}.parquet")
    df.createOrReplaceTempView(view or table)
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV without header and with a given schema; a cell that does not fit is null.

    A table with text may have line breaks in it: its files are read whole, one per
    task, as they were written. Others are split.
    """
    text = any(isinstance(f.dataType, T.StringType) for f in schema.fields)
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", "PERMISSIVE")
    return reader.option("multiLine", str(text).lower()).csv(path)


def key_columns(index: Column, first: str = "k", prefix: str = "d", bucket: str = "bucket") -> list[Column]:
    """``(i, "d" + i, "bucket" + i)`` for an integer column."""
    text = index.cast("string")
    return [
        index.alias(first),
        F.concat(F.lit(prefix), text).alias("day"),
        F.concat(F.lit(bucket), text).alias("bucket"),
    ]


def key_range(spark: SparkSession, last: int, first: int = 1) -> DataFrame:
    """Key rows for the integers ``first`` to ``last``, made on the executors."""
    return spark.range(first, last + 1).select(*key_columns(F.col("id")))


def triple_columns(index: Column) -> list[Column]:
    """``(i, i, i)`` for an integer column."""
    return [index.alias("key"), index.alias("v1"), index.alias("v2")]


def triple_range(spark: SparkSession, rows: int) -> DataFrame:
    """Rows ``(i, i, i)`` for ``i`` from 0."""
    return spark.range(rows).select(*triple_columns(F.col("id")))


def filter_view(
    spark: SparkSession, view: str, condition: str, *, columns: str = "*", cached: bool = False
) -> DataFrame:
    """``SELECT columns FROM view WHERE condition``.

    ``cached`` keeps the filtered rows (not the table) when several actions
    follow; the scan below still gets the pushed filter.
    """
    result = spark.sql(f"SELECT {columns} FROM {view} WHERE {condition}")
    return result.cache() if cached else result


def where_join(spark: SparkSession, left_view: str, right_view: str, left_key: str, right_key: str) -> DataFrame:
    """All left columns of an inner join whose condition stands in WHERE."""
    return spark.sql(
        f"SELECT {left_view}.* FROM {left_view} INNER JOIN {right_view} "
        f"WHERE {left_view}.{left_key} = {right_view}.{right_key}"
    )
