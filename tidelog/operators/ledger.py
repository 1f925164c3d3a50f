"""The position ledger: which offset ranges an application claimed and finished.

The ledger is an append-only table of events. A claim (``processed`` false) is
written before a range is processed, a commit (``processed`` true) after its
output is complete. All views below are derived from the events.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.prefix import highest_before

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("application_id", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("from_offset", T.LongType()),
        T.StructField("until_offset", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("range_id", T.StringType()),
        T.StructField("processed", T.BooleanType()),
        T.StructField("event_time", T.TimestampNTZType()),
    ]
)
POSITION_KEY = ["application_id", "topic", "partition"]
RANGE_KEY = [*POSITION_KEY, "from_offset", "until_offset"]

# Fixed value: history rows are kept for seven days.
RETENTION_SECONDS = 604_800

# Offsets per group when ranges of one partition are put in order.
ORDER_SPAN = 1 << 28


def range_id(application_id: str, ranges: list[tuple[str, int, int, int]]) -> str:
    """Name of a set of ``(topic, partition, from, until)`` ranges, whatever their order."""
    text = "\n".join([application_id] + ["\t".join(map(str, r)) for r in sorted(ranges)])
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def ledger_current(events: DataFrame) -> DataFrame:
    """Newest finished range per application, topic and partition.

    One aggregation without a sort or window, combined before the shuffle. Events
    with the same time are put in order by offset.
    """
    newest = F.max(
        F.struct("event_time", "until_offset", "from_offset", "n")
    ).alias("newest")
    return (
        events.filter("processed").groupBy(*POSITION_KEY).agg(newest).select(
            *POSITION_KEY, "newest.event_time", "newest.from_offset", "newest.until_offset", "newest.n"
        )
    )


def ledger_history(events: DataFrame, application_id: str, topic: str) -> DataFrame:
    """Events of one application and topic, newest first."""
    return events.filter(
        (F.col("application_id") == application_id) & (F.col("topic") == topic)
    ).orderBy(F.col("event_time").desc(), F.col("partition"), F.col("until_offset").desc())


def range_continuity(
    events: DataFrame, *, transactional: bool = False, span: int = ORDER_SPAN
) -> DataFrame:
    """Finished ranges that do not start where all ranges before them ended.

    ``prev_until`` is the highest end of the ranges that start before. In strict mode
    the start must equal it; a transactional topic uses offsets for its own records,
    so there a later start is allowed.
    """
    ranges = events.filter("processed").groupBy(*RANGE_KEY).agg(F.max("n").alias("n"))
    placed = highest_before(
        ranges,
        keys=POSITION_KEY,
        order=["from_offset", "until_offset"],
        value="until_offset",
        result="prev_until",
        span=span,
    )
    broken = (
        F.col("from_offset") < F.col("prev_until")
        if transactional
        else F.col("from_offset") != F.col("prev_until")
    )
    return placed.filter(broken).select(
        *POSITION_KEY,
        "from_offset",
        "until_offset",
        "prev_until",
        F.when(F.col("from_offset") > F.col("prev_until"), F.lit("gap")).otherwise(F.lit("overlap")).alias("kind"),
    )


def ledger_retention(events: DataFrame, as_of: str) -> DataFrame:
    """Events not older than the retention time at ``as_of``."""
    oldest = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(RETENTION_SECONDS)
    )
    return events.filter(F.col("event_time") >= oldest)


def resume_position(events: DataFrame, application_id: str, topic: str) -> DataFrame:
    """Next offset per partition: the end of its last finished range."""
    return (
        events.filter(
            F.col("processed")
            & (F.col("application_id") == application_id)
            & (F.col("topic") == topic)
        )
        .groupBy("partition")
        .agg(F.max("until_offset").alias("next_offset"))
    )


def pending_ranges(events: DataFrame) -> DataFrame:
    """Claimed ranges that were never finished, one row per partition."""
    keys = ["application_id", "range_id"]
    finished = events.filter("processed").select(*keys)
    return (
        events.filter(~F.col("processed"))
        .join(finished, keys, "left_anti")
        .groupBy(*keys, "topic", "partition", "from_offset", "until_offset")
        .agg(F.max("n").alias("n"), F.max("batch_id").alias("batch_id"))
    )


def compact(events: DataFrame, as_of: str) -> DataFrame:
    """Events to keep when the ledger is rewritten.

    Kept are the events inside the retention time, the newest finished range of
    every partition however old it is, and claims that are not finished.
    """
    current = ledger_current(events).select(*RANGE_KEY).withColumn("processed", F.lit(True))
    pending = pending_ranges(events).select("application_id", "range_id")
    oldest = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(RETENTION_SECONDS)
    )
    expired = events.filter(F.col("event_time") < oldest)
    return (
        ledger_retention(events, as_of)
        .unionByName(expired.join(current, [*RANGE_KEY, "processed"], "left_semi"))
        .unionByName(expired.join(pending, ["application_id", "range_id"], "left_semi"))
    )
