"""Sinks: keyed tables with versions, CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.tables import CSV_OPTIONS
from tidelog.storage import complete_version, drop, newest_version, scratch, version_path

def latest_per_key(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """The row with the highest ``order_by`` for each key.

    An aggregation, not a window: rows of a hot key are reduced before the
    shuffle. Rows that share the order value are put in order by a hash of their content
    (columns may be maps, which have no order). A null key is an error.
    """
    others = [c for c in df.columns if c not in keys and c != order_by]
    content = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    newest = F.max_by(F.struct(order_by, *others), F.struct(order_by, content)).alias("newest")
    null_key = F.raise_error(F.lit("a key column is null"))
    present = {k: F.coalesce(F.col(k), null_key.cast(df.schema[k].dataType)) for k in keys}
    return (
        df.withColumns(present).groupBy(*keys)
        .agg(newest)
        .select(*keys, *[F.col(f"newest.{c}").alias(c) for c in [order_by, *others]])
        .select(*df.columns)
    )


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Table content after writing ``new``, which has one row per key.

    Old rows move only if the new keys are too many to broadcast.
    """
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def read_keyed_table(spark: SparkSession, target: str) -> DataFrame:
    """Newest complete version of a keyed table."""
    version = newest_version(spark, target)
    if not version:
        raise ValueError(f"no complete version at {target}")
    return spark.read.parquet(version_path(target, version))


def upsert(spark: SparkSession, target: str, df: DataFrame, keys: list[str], order_by: str) -> int:
    """Write rows into a keyed table; returns the new version.

    A row replaces the row with the same key. ``order_by`` tells which of several
    new rows of one key was written last; it is not part of the table.
    The result is written beside the old version and becomes visible when its
    write is complete, so a failed write changes nothing and may be repeated.
    """
    version = newest_version(spark, target)
    rows = latest_per_key(df, keys, order_by).drop(order_by)
    if version:
        # Written first: both branches of the merge then read the same rows, and
        # their size on disk decides whether the keys are broadcast.
        staged = scratch(spark, "upsert")
        rows.write.parquet(staged)
        rows = replace_rows(read_keyed_table(spark, target), spark.read.parquet(staged), keys)
    rows.write.mode("overwrite").parquet(version_path(target, version + 1))
    complete_version(spark, target, version + 1)
    if version:
        drop(spark, staged)
    return version + 1


def export_csv(df: DataFrame, path: str) -> None:
    """Write CSV without header, one file per partition, from the executors.

    ``read_csv`` gives the same rows back, line breaks, quotes and empty texts included.
    """
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
