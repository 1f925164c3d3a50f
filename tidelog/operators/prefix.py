"""Running totals and running maxima without a single-task window.

Spark computes a window without a partition key in one task, and a window over
a hot key likewise. The functions here cut the order into blocks of bounded
length, work inside the blocks, and carry one row per block forward.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.numbers import int_div

BLOCK = 1 << 16


def prefix_sum(
    df: DataFrame, *, index: str, value: str, result: str, max_index: int, block: int = BLOCK
) -> DataFrame:
    """Add ``result``: the sum of ``value`` over all rows up to this ``index``.

    ``index`` is a unique integer from 0 to ``max_index`` (holes are fine). A row
    with a null index has no place in the order: it is kept, counts for no other row and has a
    null result. No task handles more than ``block`` rows of the order at any level.
    """
    placed = _blocked_sum(df.filter(F.col(index).isNotNull()), index, value, result, max_index, block)
    nowhere = F.lit(None).cast(placed.schema[result].dataType).alias(result)
    return placed.unionByName(df.filter(F.col(index).isNull()).select("*", nowhere))


def _blocked_sum(df: DataFrame, index: str, value: str, result: str, max_index: int, block: int) -> DataFrame:
    # Named after the index, because the totals of a level are the input of the next.
    number, total, carry = f"{index}_block", f"{index}_total", f"{index}_carry"
    # The join adds this filter to one branch; given here it is in both, and what
    # ``df`` shuffles is then shuffled once.
    blocked = df.withColumn(number, int_div(F.col(index), block)).filter(F.col(number).isNotNull())
    inside = (
        Window.partitionBy(number).orderBy(index).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = blocked.groupBy(number).agg(F.sum(value).alias(total))
    last = max_index // block
    if last < block:
        order = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carried = totals.withColumn(carry, F.sum(total).over(order))
    else:
        carried = _blocked_sum(totals, number, total, carry, last, block)
    carried = carried.select(number, (F.col(carry) - F.col(total)).alias(carry))
    return (
        blocked.withColumn(result, F.sum(value).over(inside))
        .join(carried, number)
        .withColumn(result, F.col(result) + F.col(carry))
        .select(*df.columns, result)
    )


def highest_before(
    df: DataFrame, *, keys: list[str], order: list[str], value: str, result: str, span: int
) -> DataFrame:
    """Add ``result``: the highest ``value`` of all rows before, in ``order``, within ``keys``.

    Keys are not null. The first ``order`` column is an integer; rows are grouped by key and by
    ``span`` values of it, so that a hot key is spread over many tasks. Only the
    highest value of each such group is compared across groups.
    """
    grouped = df.withColumn("_span", int_div(F.col(order[0]), span))
    before = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_span").orderBy(*order).rowsBetween(*before)
    across = Window.partitionBy(*keys).orderBy("_span").rowsBetween(*before)
    entering = (
        grouped.groupBy(*keys, "_span").agg(F.max(value).alias("_top"))
        .select(*keys, "_span", F.max("_top").over(across).alias("_entering"))
    )
    return (
        grouped.withColumn("_inside", F.max(value).over(inside))
        .join(entering, [*keys, "_span"])
        .withColumn(result, F.greatest("_inside", "_entering"))
        .select(*df.columns, result)
    )
