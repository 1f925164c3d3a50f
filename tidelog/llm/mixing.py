"""Mixing sources to target weights by capped water-filling.

Sources share a total by weight. A source stops at ``max_epochs`` times its own
size; what it cannot take is shared again by weight among the others until no
source is above its limit. Documents are then taken a whole number of times, and
once more for a seeded fraction of each source.

Every source may be hot: documents are only counted per source and seeded bin,
and joined with one row per source. That table (a recipe, one row per source) is
the only thing that is ordered as a whole.

Cases: a null source is one more source; a null text has size 0; a source of
size 0 has target 0 and its documents, which add no words, are taken once; a null id is sampled like the id ''; rows with the same id
share their bin, so all or none of them are repeated; an empty table gives no
rows; extra columns are kept by ``mix_documents`` and ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import free_name, materialize, small_side, words_of

# Seeded bins per source. A source misses its target by half a bin at most.
BIN_DIGITS = 3
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def bin_of(doc_id: Column, seed: str = SEED) -> Column:
    """Seeded bin of a document: the first hexadecimal digits of a hash of its id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, BIN_DIGITS), 16, 10).cast("int")


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2)) -> DataFrame:
    """Give the sources (one row each) the weights in turn, by code point, null last."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choices = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(choices, turn % len(weights)))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to ``source, source_size, weight``.

    In order of limit by weight, a source is full if an equal share (by weight) of
    what the sources before it leave is above its limit. The rest share what is left.
    """
    limit = F.col("source_size") * F.lit(float(max_epochs))
    order = Window.orderBy((limit / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    ranked = sources.select(
        "source", "source_size", "weight", limit.alias("_limit"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("_total"),
        F.sum("weight").over(everything).alias("_weights"),
        F.coalesce(F.sum(limit).over(before), F.lit(0.0)).alias("_limits_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("_weights_before"),
    )
    full = ranked.withColumn(
        "_full",
        (F.col("_total") - F.col("_limits_before")) * F.col("weight")
        >= F.col("_limit") * (F.col("_weights") - F.col("_weights_before")),
    )
    left = F.max("_total").over(everything) - F.sum(F.when(F.col("_full"), F.col("_limit")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("weight"))).over(everything)
    return full.select(
        "source", "source_size", "weight",
        F.when(F.col("_full"), F.col("_limit")).otherwise(F.col("weight") * (left / open_weight)).alias("target"),
    )


def plan_mix(
    sized: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """One row per source from ``source, size, bin``: its size, target, the whole
    repetitions of its documents, and the last bin that is taken once more."""
    bins = materialize(
        sized.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")), "mix-bins"
    )
    sources = bins.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    targets = water_fill(cycled_weights(sources, weights), share, max_epochs)
    targets = targets.withColumn(
        "whole",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"),
    )
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        bins.withColumn("_before", F.coalesce(F.sum("bin_size").over(before), F.lit(0)))
        .withColumnRenamed("source", "_source")
        .join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .groupBy("source")
        .agg(
            F.max(
                F.when(
                    # Whole repetitions alone leave nothing for documents of size 0 either.
                    ((F.col("target") > F.col("whole") * F.col("source_size")) | (F.col("source_size") == 0))
                    & (F.col("_before") + F.col("bin_size") / 2 <= F.col("target") - F.col("whole") * F.col("source_size")),
                    F.col("bin"),
                )
            ).alias("last_bin")
        )
        .withColumnRenamed("source", "_source")
    )
    return targets.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("last_bin", F.lit(-1)).alias("last_bin")
    )


def _with_plan(rows: DataFrame, source: str, plan: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Join ``rows`` with the plan, its columns under the given new names."""
    key = free_name(rows, "_plan_source")
    side = plan.select(F.col("source").alias(key), *[F.col(old).alias(new) for old, new in columns.items()])
    return rows.join(small_side(side), F.col(source).eqNullSafe(F.col(key)), "left").drop(key)


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0,
        seed: str = SEED) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, copies``."""
    sized = materialize(
        docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), bin_of(F.col("doc_id"), seed).alias("bin")),
        "mix-sizes",
    )
    plan = materialize(plan_mix(sized, weights, share, max_epochs), "mix-plan")
    joined = _with_plan(sized, "source", plan, {c: c for c in ("source_size", "target", "whole", "last_bin")})
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") + F.when(F.col("bin") <= F.col("last_bin"), 1).otherwise(0)).alias("copies"),
    )


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                  max_epochs: float = 2.0, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns kept."""
    sized = docs.select("source", size_of(F.col("text")).alias("size"), bin_of(F.col("doc_id"), seed).alias("bin"))
    plan = materialize(plan_mix(sized, weights, share, max_epochs), "mix-plan")
    whole, last, copies = (free_name(docs, c) for c in ("_whole", "_last_bin", "_copy"))
    joined = _with_plan(docs, "source", plan, {"whole": whole, "last_bin": last})
    taken = F.col(whole) + F.when(bin_of(F.col("doc_id"), seed) <= F.col(last), 1).otherwise(0)
    return joined.withColumn(copies, F.explode(F.array_repeat(F.lit(1), taken))).select(*docs.columns)
