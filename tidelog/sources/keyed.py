"""Keyed tables in hash buckets: lookups read, and changes rewrite, only the buckets they meet.

A table is a folder of complete versions of its list of buckets. Rows lie below
``data/version=<v>/bucket=<b>``, sorted by key within a file, and version ``v`` lists for
every bucket the data version that holds it. A change writes the buckets of its keys
anew, beside the old ones, and then a list that points there; readers take the
newest complete list, so they switch at once and a change that failed is not seen.

A bucket is a hash of the key columns in the types of the table. The number of buckets
is fixed when the table is written (and bounds what comes to the driver): take the size
of the table divided by what one task may rewrite.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.lookup import lookup_join
from tidelog.sources.sinks import latest_per_key
from tidelog.storage import (
    child_names, complete_version, exists, newest_version, read_text, scratch, small_table, version_path, write_text,
)

BUCKET = "bucket"
LIST_SCHEMA = T.StructType([T.StructField(BUCKET, T.IntegerType()), T.StructField("data_version", T.IntegerType())])


@dataclass(frozen=True)
class KeyedTable:
    path: str
    keys: tuple[str, ...]
    buckets: int
    schema: T.StructType

    def bucket_of(self, columns: list[str]) -> Column:
        """Bucket of the key in ``columns``; a key that is null, or not of the table's type, has none."""
        typed = [F.col(c).try_cast(self.schema[k].dataType) for c, k in zip(columns, self.keys)]
        known = reduce(Column.__and__, [c.isNotNull() for c in typed])
        return F.when(known, F.pmod(F.xxhash64(*typed), F.lit(self.buckets)).cast("int"))


def open_table(spark: SparkSession, path: str) -> KeyedTable:
    facts = json.loads(read_text(spark, f"{path}/table.json"))
    return KeyedTable(path, tuple(facts["keys"]), facts["buckets"], T.StructType.fromJson(facts["schema"]))


def create_table(df: DataFrame, path: str, keys: list[str], buckets: int) -> KeyedTable:
    """Write a new keyed table. Rows with the same key may be several; a null key is an error."""
    spark = df.sparkSession
    if exists(spark, f"{path}/table.json"):
        raise FileExistsError(f"there is a keyed table at {path}")
    if BUCKET in df.columns:
        raise ValueError(f"a table cannot have a column named {BUCKET!r}")
    table = KeyedTable(path, tuple(keys), buckets, df.schema)
    write_text(spark, f"{path}/table.json", json.dumps({"keys": keys, "buckets": buckets, "schema": df.schema.jsonValue()}))
    _write(table, df, 1, {})
    return table


def _with_bucket(table: KeyedTable, df: DataFrame) -> DataFrame:
    null_key = F.raise_error(F.lit("a key column is null")).cast("int")
    return df.withColumn(BUCKET, F.coalesce(table.bucket_of(list(table.keys)), null_key))


def _write(table: KeyedTable, rows: DataFrame, version: int, before: dict[int, int]) -> None:
    """Write rows as data of ``version`` and list them; buckets without rows there keep the place they have."""
    spark, data = rows.sparkSession, f"{table.path}/data/version={version}"
    placed = _with_bucket(table, rows).repartition(BUCKET).sortWithinPartitions(BUCKET, *table.keys)
    placed.write.mode("overwrite").partitionBy(BUCKET).parquet(data)
    written = [int(n.removeprefix(f"{BUCKET}=")) for n in child_names(spark, data) if n.startswith(f"{BUCKET}=")]
    places = {**before, **dict.fromkeys(written, version)}
    small_table(spark, sorted(places.items()), LIST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        version_path(table.path, version)
    )
    complete_version(spark, table.path, version)


def _places(spark: SparkSession, table: KeyedTable) -> tuple[int, dict[int, int]]:
    """Newest version, and the data version of each bucket: one row a bucket."""
    version = newest_version(spark, table.path)
    if not version:
        raise ValueError(f"no complete version at {table.path}")
    rows = spark.read.schema(LIST_SCHEMA).parquet(version_path(table.path, version)).collect()
    return version, {r[BUCKET]: r["data_version"] for r in rows}


def _read(spark: SparkSession, table: KeyedTable, places: dict[int, int], buckets: set[int] | None = None) -> DataFrame:
    by_version: dict[int, list[int]] = {}
    for bucket, version in places.items():
        if buckets is None or bucket in buckets:
            by_version.setdefault(version, []).append(bucket)
    stored = T.StructType([*table.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    # A directory filter on each data version: other buckets are not listed in the scan.
    parts = [
        spark.read.schema(stored).parquet(f"{table.path}/data/version={version}").filter(F.col(BUCKET).isin(*found))
        for version, found in sorted(by_version.items())
    ]
    if not parts:
        return spark.createDataFrame([], table.schema)
    return reduce(DataFrame.unionByName, parts).select(*table.schema.fieldNames())


def read_table(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return _read(spark, table, _places(spark, table)[1])


def buckets_of(keys: DataFrame, table: KeyedTable, columns: list[str]) -> set[int]:
    """Buckets of the keys; at most as many numbers as the table has buckets."""
    found = keys.select(table.bucket_of(columns).alias(BUCKET)).filter(F.col(BUCKET).isNotNull()).distinct()
    return {r[BUCKET] for r in found.collect()}


def keyed_lookup(
    keys: DataFrame, table: KeyedTable, on: list[str], *, key_map: dict[str, str] | None = None,
    select: list[str] | None = None, value: tuple[str, str] | None = None,
) -> DataFrame:
    """:func:`lookup_join` with a keyed table; only the buckets of the keys are read.

    ``on`` names the key columns of ``keys``, and all key columns of the table must be
    among them (through ``key_map``).
    """
    mapping = {(key_map or {}).get(k, k): k for k in on}
    if missing := [k for k in table.keys if k not in mapping]:
        raise ValueError(f"the lookup does not name the key columns {missing}")
    spark = keys.sparkSession
    wanted = buckets_of(keys, table, [mapping[k] for k in table.keys])
    entries = _read(spark, table, _places(spark, table)[1], wanted)
    return lookup_join(keys, entries, on, key_map=key_map, select=select, value=value)


def change_table(table: KeyedTable, df: DataFrame, order_by: str) -> int:
    """Write rows into the table; returns the new version.

    A row replaces the rows with its key. ``order_by`` tells which of several new rows of one
    key was written last; it is not part of the table. Only the buckets of the
    changed keys are read and written.
    """
    spark = df.sparkSession
    version, places = _places(spark, table)
    staged = scratch(spark, "changes")
    latest = latest_per_key(df, list(table.keys), order_by).drop(order_by)
    latest.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]).write.parquet(staged)
    new = spark.read.parquet(staged)
    touched = buckets_of(new, table, list(table.keys))
    old = _read(spark, table, places, touched)
    kept = old.join(new.select(*table.keys), list(table.keys), "left_anti").select(*old.columns)
    _write(table, kept.unionByName(new.select(*old.columns)), version + 1, places)
    return version + 1
