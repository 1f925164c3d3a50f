"""Map and set columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_put(entries: Column, key: str, value: str) -> Column:
    """Add one entry, replacing the entry that has the same key."""
    others = F.map_filter(entries, lambda k, _: k != F.lit(key))
    return F.map_concat(others, F.create_map(F.lit(key), F.lit(value)))


def map_get(entries: Column, key: str) -> Column:
    """The value stored under ``key``, null when there is none."""
    return F.try_element_at(entries, F.lit(key))


def as_set(values: Column) -> Column:
    """An array with set content: distinct and sorted."""
    return F.array_sort(F.array_distinct(values))


def map_total(entries: Column) -> Column:
    """Sum of the values of a numeric map."""
    return F.aggregate(F.map_values(entries), F.lit(0.0), lambda total, value: total + value)
