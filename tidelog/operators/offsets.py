"""Offset ranges and counts of topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.numbers import int_div
from tidelog.operators.prefix import prefix_sum

# Fixed value: 50 records per second and partition in a batch of 5 seconds.
BATCH_STRIDE = 250


def offset_ranges(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """First, last and next offset and the row count per topic partition.

    Aggregates two narrow columns and combines them before the shuffle.
    """
    return records.groupBy(*(by or ["topic", "partition"])).agg(
        F.min("offset").alias("from_offset"),
        F.max("offset").alias("max_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("n"),
    )


def counted_offset_ranges(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Like :func:`offset_ranges`, with ``n_different``, the number of different offsets.

    Rows are counted per offset first, so that no task holds a whole partition.
    """
    keys = by or ["topic", "partition"]
    per_offset = records.groupBy(*keys, "offset").agg(F.count(F.lit(1)).alias("copies"))
    return per_offset.groupBy(*keys).agg(
        F.min("offset").alias("from_offset"),
        F.max("offset").alias("max_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.sum("copies").alias("n"),
        F.count(F.lit(1)).alias("n_different"),
    )


def batch_number(stride: int = BATCH_STRIDE) -> Column:
    return int_div(F.col("offset"), stride)


def batch_offset_ranges(records: DataFrame, stride: int = BATCH_STRIDE) -> DataFrame:
    """Offset range of each micro-batch of ``stride`` offsets per partition."""
    return offset_ranges(
        records.withColumn("batch_id", batch_number(stride)), ["topic", "partition", "batch_id"]
    )


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def batch_running_total(records: DataFrame, max_offset: int, stride: int = BATCH_STRIDE) -> DataFrame:
    """Rows per micro-batch and the total over this and all earlier batches.

    Records without an offset are a batch of their own, without a total.
    """
    counts = records.groupBy(batch_number(stride).alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))
    return prefix_sum(
        counts, index="batch_id", value="n", result="total", max_index=max_offset // stride
    )


def stream_total(stream: DataFrame) -> DataFrame:
    """Total of a stream, kept as state: write it in complete or update mode."""
    return stream.groupBy().agg(F.count(F.lit(1)).alias("total"))
