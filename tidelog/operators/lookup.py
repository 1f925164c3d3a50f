"""Keyed lookup joins: a set of key rows against a keyed table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.storage import small_table


def _key_pairs(on: list[str], key_map: dict[str, str] | None) -> list[tuple[str, str]]:
    """(key column, table column) pairs; ``key_map`` is ``{key column: table column}``."""
    mapping = key_map or {}
    return [(key, mapping.get(key, key)) for key in on]


def lookup_join(
    keys: DataFrame,
    table: DataFrame,
    on: list[str],
    *,
    select: list[str] | None = None,
    key_map: dict[str, str] | None = None,
    value: tuple[str, str] | None = None,
) -> DataFrame:
    """Inner join of key rows with the table rows that have the same key.

    ``on`` names the key columns of ``keys``; ``key_map`` gives the table's name
    of a key column when it differs. Duplicate key rows are kept, keys without a
    match are dropped and null keys match nothing. The result has all columns of
    ``keys`` and the chosen table columns: ``select``, all of them by default,
    or, with ``value=(column, new_name)``, only that table column under its new
    name. A key column that both sides call the same is given once; any other table column
    whose name the key side uses too is given as ``table_<name>``. Spark's adaptive execution chooses a broadcast or a shuffle from the
    sizes, and splits skewed shuffle partitions.
    """
    pairs = _key_pairs(on, key_map)
    key_columns = [right for _, right in pairs]
    wanted = [value[0]] if value else (select if select is not None else table.columns)
    left = keys.alias("keys")
    right = table.select(*dict.fromkeys(key_columns + wanted)).alias("entries")
    condition = reduce(
        Column.__and__, [F.col(f"keys.{k}") == F.col(f"entries.{r}") for k, r in pairs]
    )
    joined = left.join(right, condition, "inner")
    if value:
        return joined.select(F.col(f"entries.{value[0]}").alias(value[1]))
    extra = [c for c in wanted if (c, c) not in pairs]
    named = {c: f"table_{c}" if c in keys.columns else c for c in extra}
    if taken := sorted({*keys.columns, *extra} & {new for old, new in named.items() if new != old}):
        raise ValueError(f"both sides have columns named {taken}")
    return joined.select(
        *[F.col(f"keys.{c}") for c in keys.columns],
        *[F.col(f"entries.{c}").alias(named[c]) for c in extra],
    )


def lookup_table_rows(keys: DataFrame, table: DataFrame, on: list[str], key_map: dict[str, str] | None = None) -> DataFrame:
    """Matching table rows with the table's own schema, one per (key row, match)."""
    pairs = _key_pairs(on, key_map)
    wanted = keys.select(*[F.col(k).alias(f"_key_{i}") for i, (k, _) in enumerate(pairs)])
    condition = reduce(
        Column.__and__, [F.col(f"_key_{i}") == table[r] for i, (_, r) in enumerate(pairs)]
    )
    return wanted.join(table, condition, "inner").select(*[table[c] for c in table.columns])


def frequent_keys(df: DataFrame, on: list[str], parts: int) -> DataFrame:
    """Keys that hold more than one in ``parts`` of the rows.

    There are fewer than ``parts`` such keys, whatever the data. Counts are
    combined before the shuffle, and the total is the sum of the same counts.
    """
    counts = df.groupBy(*on).count()
    total = counts.agg(F.sum("count")).scalar()
    return counts.filter(F.col("count") * parts > total).select(*on)


def copartition_join(
    keys: DataFrame, table: DataFrame, on: list[str], parts: int, *, select: list[str] | None = None
) -> DataFrame:
    """Lookup join with both sides placed by key in ``parts`` partitions first.

    The join itself then needs no exchange. A key with more than its share of
    rows on either side would overload its one partition, so such keys take an
    ordinary join, which adaptive execution may split. They are found first:
    fewer than ``2 * parts`` keys, small enough for the driver and a broadcast.
    When there are none, the optimizer removes that branch.
    """
    frequent = frequent_keys(keys, on, parts).unionByName(frequent_keys(table, on, parts)).distinct()
    found = [tuple(row) for row in frequent.collect()]
    hot = F.broadcast(small_table(keys.sparkSession, found, frequent.schema))
    cold = lookup_join(
        keys.join(hot, on, "left_anti").repartition(parts, *on),
        table.join(hot, on, "left_anti").repartition(parts, *on).hint("merge"),
        on,
        select=select,
    )
    spread = lookup_join(
        keys.join(hot, on, "left_semi"), table.join(hot, on, "left_semi"), on, select=select
    )
    return cold.unionByName(spread)


def write_bucketed(df: DataFrame, name: str, on: list[str], buckets: int) -> None:
    """Save a table bucketed and sorted by key, for joins without an exchange."""
    df.write.mode("overwrite").bucketBy(buckets, *on).sortBy(*on).format("parquet").saveAsTable(name)
