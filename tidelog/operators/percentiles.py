"""Exact percentiles of groups of any size.

The built-in exact percentile keeps every distinct value of a group in the memory
of one task. Here a group is cut into value bands first. Band counts tell in
which bands the wanted ranks lie, and only rows of those bands are put in order.
A band that still has many different values (they may lie close together) is cut
again, evenly between its smallest and largest value, as often as it takes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.storage import materialize

# Bands per doubling of the value. Neighbouring bands differ by less than 0.02
# percent, so that values that lie close together still spread over many bands.
BANDS_PER_DOUBLING = 4096
# Different values that a band may have before it is cut again, and into how many parts.
MOST_VALUES, PARTS = 1 << 16, 1 << 12
# Added so that the band of the smallest positive double is above zero.
_BAND_SHIFT = 1100 * BANDS_PER_DOUBLING


def value_band(value: Column) -> Column:
    """A whole number that never falls when the value rises."""
    step = F.floor(F.log2(F.abs(value)) * BANDS_PER_DOUBLING)
    size = F.least(step, F.lit(_BAND_SHIFT)) + _BAND_SHIFT
    return (
        F.when(F.isnan(value), F.lit(3 * _BAND_SHIFT))
        .when(value == 0, F.lit(0))
        .when(value > 0, size)
        .otherwise(-size)
        .cast("bigint")
    )


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _placed(bands: DataFrame, outer: list[str], inner: str) -> DataFrame:
    """Add ``_from`` and ``_until``, the ranks that a band covers, counted from ``_base``."""
    upward = Window.partitionBy(*outer).orderBy(inner).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return bands.withColumn("_until", F.col("_base") + F.sum("_in_band").over(upward)).withColumn(
        "_from", F.col("_until") - F.col("_in_band")
    )


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], *,
    null_keys: bool = False, most: int = MOST_VALUES,
) -> DataFrame:
    """One row per group with a column for each wanted percentile.

    Between two ranks the result is interpolated. Rows with a null value do not count, nor
    do rows with a null key, unless ``null_keys`` makes null a key like others. Equal values are counted before they are shuffled. No
    sort has more than ``most`` different values of a group.
    """
    present = [value] if null_keys else [*keys, value]
    copies = materialize(
        df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in present]))
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_copies"))
        # Numbers of parts are appended to it.
        .withColumn("_band", value_band(F.col("_value")).cast("decimal(38,0)")),
        "copies",
    )

    # Rank p * (total - 1), counted from zero, lies between two whole ranks.
    def rank(p: float) -> Column:
        return F.lit(p) * (F.col("_total") - 1)

    def holds(position: Column, low: str, high: str) -> Column:
        return (position >= F.col(low)) & (position < F.col(high))

    positions = [edge(rank(p)) for p in wanted.values() for edge in (F.floor, F.ceil)]
    needed = reduce(Column.__or__, [holds(p, "_from", "_until") for p in positions])
    facts = [F.sum("_copies").alias("_in_band"), F.count(F.lit(1)).alias("_different"), F.min("_value").alias("_least"), F.max("_value").alias("_most")]

    bands = (
        copies.groupBy(*keys, "_band").agg(*facts).withColumn("_base", F.lit(0).cast("bigint"))
        .withColumn("_total", F.sum("_in_band").over(Window.partitionBy(*keys)))
    )
    targets = materialize(_placed(bands, keys, "_band").filter(needed), "bands")
    while True:
        names = [f"_t{k}" for k in range(len(keys))]
        side = targets.select(
            *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_band").alias("_tb"), "_from", "_total", "_different", "_least", "_most",
        )
        found = copies.join(side, _same([*keys, "_band"], [*names, "_tb"])).drop(*names, "_tb")
        if not targets.filter(F.col("_different") > most).limit(1).count():
            break
        # The values of a crowded band are cut evenly; others stay as they are.
        part = F.floor((F.col("_value") - F.col("_least")) / (F.col("_most") - F.col("_least")) * PARTS)
        found = found.withColumn("_part", F.when(F.col("_different") > most, F.least(part, F.lit(PARTS - 1))).otherwise(0))
        copies = materialize(found.select(*keys, "_value", "_copies", "_band", "_part", "_from", "_total"), "copies")
        parts = copies.groupBy(*keys, "_band", "_part").agg(
            *facts, F.first("_from").alias("_base"), F.first("_total").alias("_total")
        )
        numbered = (F.col("_band") * PARTS + F.col("_part")).cast("decimal(38,0)")
        placed = _placed(parts, [*keys, "_band"], "_part").filter(needed)
        targets = materialize(placed.withColumn("_band", numbered), "bands")
        copies = copies.select(*keys, "_value", "_copies", numbered.alias("_band"))

    in_band = (
        Window.partitionBy(*keys, "_band")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = found.withColumn("_high", F.col("_from") + F.sum("_copies").over(in_band)).withColumn(
        "_low", F.col("_high") - F.col("_copies")
    )
    at_ranks = []
    for name, p in wanted.items():
        for side, edge in (("floor", F.floor), ("ceil", F.ceil)):
            at_ranks.append(
                F.max(F.when(holds(edge(rank(p)), "_low", "_high"), F.col("_value"))).alias(f"_{name}_{side}")
            )
    found = ranked.groupBy(*keys).agg(F.first("_total").alias("_total"), *at_ranks)
    results = []
    for name, p in wanted.items():
        low, high = F.col(f"_{name}_floor"), F.col(f"_{name}_ceil")
        between = low + (high - low) * (rank(p) - F.floor(rank(p)))
        # Two equal infinities have no difference.
        results.append(F.when(low == high, low).otherwise(between).alias(name))
    return found.select(*keys, *results)
