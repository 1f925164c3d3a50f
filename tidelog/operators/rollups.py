"""Per-minute rates and value distributions of event streams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.clock import epoch_minute, minute_start
from tidelog.functions.numbers import int_div
from tidelog.operators.percentiles import exact_percentiles
from tidelog.storage import materialize

# Fixed values of the meter: trailing window lengths and percentiles.
SHORT_MINUTES = 1
LONG_MINUTES = 15
# Lengths of a window after which a weighted average has forgotten.
DECAYED = 20
PERCENTILES = {"median": 0.5, "p95": 0.95, "p99": 0.99}


def trailing_rates(events: DataFrame) -> DataFrame:
    """Events per type and minute with trailing 1- and 15-minute rates per second.

    One row for each minute whose trailing 15 minutes hold an event. Events are
    counted per minute first; only those counts are spread over the 15 windows
    they fall in, so the spread grows with minutes and not with events.
    """
    per_minute = events.groupBy("event_type", epoch_minute(F.col("ts")).alias("at")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spread = per_minute.select(
        "event_type",
        F.explode(F.sequence(F.col("at"), F.col("at") + (LONG_MINUTES - 1))).alias("minute"),
        "at",
        "n",
    )
    windowed = spread.groupBy("event_type", "minute").agg(
        F.sum(F.when(F.col("at") > F.col("minute") - SHORT_MINUTES, F.col("n")).otherwise(0)).alias("n"),
        F.sum("n").alias("n_15m"),
    )
    return windowed.select(
        "event_type",
        "minute",
        "n",
        "n_15m",
        (F.col("n") / (60 * SHORT_MINUTES)).alias("rate_1m"),
        (F.col("n_15m") / (60 * LONG_MINUTES)).alias("rate_15m"),
    )


def weighted_rates(rates: DataFrame, minutes: dict[str, int]) -> DataFrame:
    """Add exponentially weighted rates per second to rows ``event_type, minute, n``.

    The rate of a minute moves the average by ``1 - d`` of the difference, with ``d = exp(-1 / w)``
    for a window of ``w`` minutes; the first minute of a type sets it, and minutes without
    a row count as rate 0. A decayed sum is a prefix sum of terms that are scaled by their place in
    a block of minutes; blocks hand one number on. A block lasts ``DECAYED * w`` minutes, after
    which nothing is left of what came two blocks before.
    """
    def block_of(w: int) -> Column:
        return int_div(F.col("minute"), DECAYED * w)

    def place_of(w: int) -> Column:
        return (F.col("minute") - block_of(w) * (DECAYED * w)) / float(w)

    def inside(name: str, w: int) -> Column:
        rate, keep = F.col("n") / 60.0, math.exp(-1.0 / w)
        gain = F.when(F.col("minute") == F.col("_first"), rate).otherwise(rate * (1.0 - keep))
        order = Window.partitionBy("event_type", f"_block_{name}").orderBy("minute")
        return F.sum(gain * F.exp(place_of(w))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    sums = rates.withColumn("_first", F.min("minute").over(Window.partitionBy("event_type")))
    sums = sums.withColumns({f"_block_{name}": block_of(w) for name, w in minutes.items()})
    # The sums of a block are read twice, by its rows and for what it hands on.
    sums = materialize(sums.withColumns({f"_sum_{name}": inside(name, w) for name, w in minutes.items()}), "weighted")
    out = sums
    in_order = Window.partitionBy("_t").orderBy("_b")
    for name, w in minutes.items():
        # As of the last minute of a block; one row for each type and block.
        ends = sums.groupBy(F.col("event_type").alias("_t"), F.col(f"_block_{name}").alias("_b")).agg(
            (F.max(f"_sum_{name}") * math.exp(-(DECAYED * w - 1) / w)).alias("_end")
        )

        def of(k: int, distance: int) -> Column:
            return F.when(F.lag("_b", k).over(in_order) == F.col("_b") - distance, F.lag("_end", k).over(in_order))

        # The last block but one, and the one before.
        last, other = F.coalesce(of(1, 1), F.lit(0.0)), F.coalesce(of(2, 2), of(1, 2), F.lit(0.0))
        carried = ends.select("_t", "_b", (last + other * math.exp(-DECAYED)).alias("_carry"))
        value = F.col(f"_sum_{name}") * F.exp(-place_of(w)) + F.col("_carry") * F.exp(-place_of(w) - 1.0 / w)
        out = (
            out.join(carried, F.col("event_type").eqNullSafe(F.col("_t")) & (F.col(f"_block_{name}") == F.col("_b")))
            .withColumn(name, value).drop("_t", "_b", "_carry")
        )
    return out.select(*rates.columns, *minutes)


def hourly_percentiles(events: DataFrame) -> DataFrame:
    """Exact median, 95th and 99th percentile of ``value`` per type and hour."""
    hourly = events.select(
        "event_type", int_div(epoch_minute(F.col("ts")), 60).alias("hour"), "value"
    )
    return exact_percentiles(hourly, ["event_type", "hour"], "value", PERCENTILES, null_keys=True)


def approximate_percentiles(events: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Like :func:`hourly_percentiles` with a sketch of fixed size, for wide value ranges."""
    hour = int_div(epoch_minute(F.col("ts")), 60).alias("hour")
    marks = F.percentile_approx("value", list(PERCENTILES.values()), accuracy)
    return (
        events.groupBy("event_type", hour)
        .agg(marks.alias("marks"))
        .select("event_type", "hour", *[F.col("marks")[i].alias(name) for i, name in enumerate(PERCENTILES)])
    )


def metric_rollup(events: DataFrame) -> DataFrame:
    """Trailing and weighted rates per minute beside the percentiles of the minute's hour.

    A minute without events in its hour has null percentiles; a null type is a type.
    """
    rates = weighted_rates(trailing_rates(events), {"ewma_1m": SHORT_MINUTES, "ewma_15m": LONG_MINUTES})
    marks = hourly_percentiles(events).withColumnsRenamed({"event_type": "_type", "hour": "_hour"})
    same = F.col("event_type").eqNullSafe(F.col("_type")) & (int_div(F.col("minute"), 60) == F.col("_hour"))
    return rates.join(marks, same, "left").select(
        "event_type",
        minute_start(F.col("minute")).alias("minute"),
        "n", "rate_1m", "rate_15m", "ewma_1m", "ewma_15m", "median", "p95", "p99",
    )


def approval_rate_minute(transactions: DataFrame, approved: Column) -> DataFrame:
    """Totals, approved counts and approved rate per minute and per clock hour.

    The hour figures are sums over the at most 60 minute rows of the hour, not a
    second pass over the transactions.
    """
    ts = F.col("ts")
    hour = [
        F.year(ts).alias("year"), F.month(ts).alias("month"), F.day(ts).alias("day"), F.hour(ts).alias("hour"),
    ]
    minutes = transactions.groupBy(*hour, F.minute(ts).alias("minute")).agg(
        F.count(F.lit(1)).alias("ttl_txn_min"),
        F.count(F.when(approved, True)).alias("approved_txn_min"),
    )
    return _with_hours(minutes)


def _with_hours(minutes: DataFrame) -> DataFrame:
    clock_hour = Window.partitionBy("year", "month", "day", "hour")
    return (
        minutes.withColumn("ttl_txn_hr", F.sum("ttl_txn_min").over(clock_hour))
        .withColumn("approved_txn_hr", F.sum("approved_txn_min").over(clock_hour))
        .select(
            "year", "month", "day", "hour", "minute",
            (F.col("approved_txn_hr") / F.col("ttl_txn_hr")).alias("approved_rate_hr"),
            (F.col("approved_txn_min") / F.col("ttl_txn_min")).alias("approved_rate_min"),
            "approved_txn_hr", "approved_txn_min", "ttl_txn_hr", "ttl_txn_min",
        )
    )


# --- sketches ---------------------------------------------------------------------

# Size of a sketch, and the error of a rank (as a share of the rows) that it has with 99 % certainty.
SKETCH_SIZE, RANK_ERROR = 800, 0.005


def minute_sketches(events: DataFrame) -> DataFrame:
    """``event_type, minute, n, sketch``: a quantile sketch of ``value`` per type and minute.

    Sketches have a bounded size whatever the number of events, and may be stored and merged.
    ``events`` may be a stream with a watermark on ``ts``: a minute is then given once it is over.
    """
    return events.filter("value IS NOT NULL").groupBy("event_type", F.window("ts", "1 minute")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(SKETCH_SIZE)).alias("sketch")
    ).select("event_type", F.col("window.start").alias("minute"), "n", "sketch")


def merged_quantiles(sketches: DataFrame, *keys: Column | str) -> DataFrame:
    """``keys, n`` and the percentiles of merged sketches: minutes to hours, hours to days."""
    merged = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"))
    marks = [F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in PERCENTILES.items()]
    names = [c for c in merged.columns if c not in ("n", "sketch")]
    return merged.select(*names, "n", *marks)


def rank_errors(events: DataFrame, quantiles: DataFrame, *keys: str) -> DataFrame:
    """``quantiles`` with the distance of each percentile from its wanted rank, as a share of the rows.

    A value stands for all ranks from the rows below it to those not above it."""
    same = [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in keys]
    rows = events.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("value").cast("double").alias("_value")).filter("_value IS NOT NULL")
    # One row per group on this side.
    both = rows.join(quantiles, same)
    sums = []
    for name in PERCENTILES:
        sums += [F.sum((F.col("_value") < F.col(name)).cast("int")).alias(f"_{name}_below"),
                 F.sum((F.col("_value") <= F.col(name)).cast("int")).alias(f"_{name}_until")]
    found = both.groupBy(*keys, "n", *PERCENTILES).agg(F.count(F.lit(1)).alias("_rows"), *sums)
    errors = []
    for name, p in PERCENTILES.items():
        low, high = F.col(f"_{name}_below") / F.col("_rows"), F.col(f"_{name}_until") / F.col("_rows")
        errors.append(F.greatest(low - p, F.lit(p) - high, F.lit(0.0)).alias(f"{name}_error"))
    return found.select(*keys, "n", *PERCENTILES, *errors)


# --- windows of a stream ------------------------------------------------------------


def approval_minutes_stream(transactions: DataFrame, approved: Column, delay: str, counted: Column | None = None) -> DataFrame:
    """Minute totals of a stream, each given once when the watermark has passed it.

    ``delay`` says how late a transaction may come; later ones do not count, and the progress of
    the query tells how many. Rows for which ``counted`` does not hold, such as heartbeats of an idle
    topic, move the watermark only.
    """
    counted = F.lit(True) if counted is None else counted
    minutes = transactions.withWatermark("ts", delay).groupBy(F.window("ts", "1 minute")).agg(
        F.count(F.when(counted, True)).alias("ttl_txn_min"), F.count(F.when(counted & approved, True)).alias("approved_txn_min")
    )
    return minutes.filter("ttl_txn_min > 0").select(F.col("window.start").alias("at"), "ttl_txn_min", "approved_txn_min")


def approval_hours(minutes: DataFrame) -> DataFrame:
    """The rows of :func:`approval_rate_minute` from minute totals ``at, ttl_txn_min, approved_txn_min``."""
    at = F.col("at")
    fields = [F.year(at).alias("year"), F.month(at).alias("month"), F.day(at).alias("day"), F.hour(at).alias("hour"), F.minute(at).alias("minute")]
    return _with_hours(minutes.select(*fields, "ttl_txn_min", "approved_txn_min"))
