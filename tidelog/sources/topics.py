"""Topics: partitioned logs of typed records, read as a batch, a range or a stream.

A file topic is a parquet directory ``<root>/topic=<t>/slice=<k>/partition=<p>``.
A slice holds one file per topic partition, with rising offsets, and slices
appear in order and are never changed. An index beside the topic,
``<root>/slice-index/topic=<t>``, has a row for each slice and partition (first and last
offset, number of records), so that appends and restarts read no finished records. Any prefix of the files is then a prefix of every partition, and
a micro-batch covers one contiguous offset range per partition. ``kind="kafka"`` uses Spark's Kafka connector when its jar is on the
class path.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.numbers import int_div
from tidelog.storage import child_names, exists, reveal_in_order, small_table

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)
RECORD_COLUMNS = RECORD_SCHEMA.fieldNames()

# Fixed values of a range spec: first and last available position.
EARLIEST = -2
LATEST = -1

# Partitions with similar bounds share a term of the range predicate beyond this many.
MAX_PREDICATE_TERMS = 64


class DataLossError(RuntimeError):
    """Records at a requested position are no longer available."""


@dataclass(frozen=True)
class TopicSpec:
    """Where a topic lives and how a stream takes it in."""

    topic: str
    root: str = ""
    kind: str = "file"
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    starting_offsets: str = "earliest"
    # Next offset of each partition of a file topic; what lies before is not read.
    positions: dict[int, int] = field(default_factory=dict)
    first_slice: int = 0
    fail_on_data_loss: bool = True
    read_committed: bool = True
    options: dict[str, str] = field(default_factory=dict)

    @property
    def path(self) -> str:
        return f"{self.root}/topic={self.topic}"


def as_records(
    df: DataFrame, *, key: Column, value: Column, topic: str | Column, partition: Column,
    offset: Column, timestamp: Column, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Shape any table as topic records (plus ``keep`` columns)."""
    topic_column = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(
        key.cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        topic_column.alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *keep,
    )


def _file_schema() -> T.StructType:
    stored = [f for f in RECORD_SCHEMA.fields if f.name not in ("topic", "partition")]
    return T.StructType(
        stored
        + [T.StructField("slice", T.LongType()), T.StructField("partition", T.IntegerType())]
    )


def _kafka_options(spec: TopicSpec) -> dict[str, str]:
    options = {
        "subscribe": spec.topic,
        "startingOffsets": spec.starting_offsets,
        "failOnDataLoss": str(spec.fail_on_data_loss).lower(),
        "kafka.isolation.level": "read_committed" if spec.read_committed else "read_uncommitted",
    }
    if spec.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(spec.max_offsets_per_trigger)
    return {**options, **spec.options}


def read_topic(spark: SparkSession, spec: TopicSpec) -> DataFrame:
    """Everything that is in the topic now."""
    if spec.kind == "kafka":
        options = _kafka_options(spec)
        options.pop("maxOffsetsPerTrigger", None)
        return _kafka_records(spark.read.format("kafka").options(**options).load())
    rows = spark.read.schema(_file_schema()).parquet(spec.path)
    return rows.withColumn("topic", F.lit(spec.topic)).select(*RECORD_COLUMNS)


def read_topic_stream(spark: SparkSession, spec: TopicSpec) -> DataFrame:
    """Subscribe to the topic from its earliest record, in capped micro-batches."""
    if spec.kind == "kafka":
        return _kafka_records(spark.readStream.format("kafka").options(**_kafka_options(spec)).load())
    reader = spark.readStream.schema(_file_schema()).options(**spec.options)
    if spec.max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", spec.max_files_per_trigger)
    rows = reader.parquet(spec.path)
    if spec.positions:
        rows = rows.filter((F.col("slice") >= spec.first_slice) & not_before(spec.positions))
    return rows.withColumn("topic", F.lit(spec.topic)).select(*RECORD_COLUMNS)


def _kafka_records(rows: DataFrame) -> DataFrame:
    """The connector's rows with the time type of a file topic."""
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).select(*RECORD_COLUMNS)


def not_before(positions: dict[int, int]) -> Column:
    """Records at or after the position of their partition; new partitions are taken whole.

    Partitions with similar positions share a term, so that the predicate stays short; the
    exact test is then an expression beside it.
    """
    terms = ~F.col("partition").isin(*positions)
    for group in _similar(positions, positions):
        term = F.col("partition").isin(*group) if len(group) > 1 else F.col("partition") == group[0]
        terms = terms | (term & (F.col("offset") >= min(positions[p] for p in group)))
    if len(positions) <= MAX_PREDICATE_TERMS:
        return terms
    return terms & (F.col("offset") >= F.coalesce(_by_partition(positions), F.lit(0)))


def _by_partition(values: dict[int, int]) -> Column:
    entries = [F.lit(x) for p in sorted(values) for x in (p, values[p])]
    return F.try_element_at(F.create_map(*entries), F.col("partition"))


def _similar(partitions: dict[int, int], bounds: dict[int, int]) -> list[list[int]]:
    """At most ``MAX_PREDICATE_TERMS`` groups of partitions, neighbours by bound."""
    ordered = sorted(partitions, key=lambda p: (bounds[p], p))
    size = -(-len(ordered) // MAX_PREDICATE_TERMS)
    return [ordered[k:k + size] for k in range(0, len(ordered), size)] if ordered else []


INDEX_SCHEMA = T.StructType(
    [
        T.StructField("slice", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("n", T.LongType()),
    ]
)


def index_path(spec: TopicSpec) -> str:
    """Folder of the slice index of a file topic."""
    return f"{spec.root}/slice-index/topic={spec.topic}"


def _slice_numbers(spark: SparkSession, spec: TopicSpec) -> list[int]:
    return [int(n.removeprefix("slice=")) for n in child_names(spark, spec.path) if n.startswith("slice=")]


def _add_to_index(spark: SparkSession, spec: TopicSpec, slices: list[int]) -> None:
    """Index these slices. Two columns of their files are read, and no other file."""
    paths = [f"{spec.path}/slice={k}" for k in slices]
    rows = spark.read.option("basePath", spec.path).schema(_file_schema()).parquet(*paths)
    found = rows.groupBy("slice", "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("n")
    )
    found.coalesce(1).write.mode("append").parquet(index_path(spec))


def slice_index(spark: SparkSession, spec: TopicSpec) -> DataFrame:
    """``slice, partition, first, last, n`` of every slice and partition of a file topic.

    Slices that a failed publish left without a row are read and indexed first; only slice
    numbers come to the driver. A slice that two writers indexed counts once.
    """
    there = _slice_numbers(spark, spec)
    if not there:
        return small_table(spark, [], INDEX_SCHEMA)
    known: set[int] = set()
    if exists(spark, index_path(spec)):
        index = spark.read.schema(INDEX_SCHEMA).parquet(index_path(spec))
        known = {row[0] for row in index.select("slice").distinct().collect()}
    if missing := sorted(set(there) - known):
        _add_to_index(spark, spec, missing)
    return spark.read.schema(INDEX_SCHEMA).parquet(index_path(spec)).distinct()


def first_open_slice(spark: SparkSession, spec: TopicSpec, positions: dict[int, int]) -> int:
    """The first slice of a file topic with a record at or after ``positions``.

    Reads the index only; later slices may hold finished records too.
    """
    is_open = F.col("last") >= F.coalesce(_by_partition(positions), F.lit(0))
    found = slice_index(spark, spec).agg(
        F.min(F.when(is_open, F.col("slice"))).alias("first"), F.max("slice").alias("end")
    ).first()
    return found["first"] if found["first"] is not None else (found["end"] or 0) + 1


def next_offsets(spark: SparkSession, spec: TopicSpec) -> dict[int, int]:
    """The offset after the last published one of every partition of a file topic.

    Reads the index only; one row per topic partition comes to the driver.
    """
    ends = slice_index(spark, spec).groupBy("partition").agg((F.max("last") + 1).alias("next"))
    return {r["partition"]: r["next"] for r in ends.collect()}


def publish(
    records: DataFrame, spec: TopicSpec, *, offsets_per_slice: int, tasks: int | None = None
) -> None:
    """Append records to a topic in offset order.

    A Kafka topic takes the rows as they are (the broker gives offsets). For a
    file topic the offsets are cut into slices of ``offsets_per_slice`` per
    partition, which bounds every file whatever the skew between partitions.
    Records whose partition and offset the topic holds are there from an earlier call
    and are skipped, so a call that failed may be repeated; all others are added, late ones
    too, whatever their order. ``tasks`` sets the number of writing tasks; somewhat more than
    there are files keeps them even.
    """
    if spec.kind == "kafka":
        records.select("key", "value", F.lit(spec.topic).alias("topic")).write.format("kafka").options(
            **spec.options
        ).save()
        return
    _write_slices(records.withColumn("slice", int_div(F.col("offset"), offsets_per_slice)), spec, tasks)


def publish_slice(records: DataFrame, spec: TopicSpec) -> None:
    """Append one slice to a file topic. For small appends: one file, written by one task,
    holds the records of a partition; :func:`publish` cuts larger ones."""
    _write_slices(records.withColumn("slice", F.lit(0).cast("bigint")), spec)


def _not_there(records: DataFrame, spec: TopicSpec) -> DataFrame:
    """The records whose offsets the topic does not hold.

    Finished slices are read only where the index says that their ranges overlap those of
    the new records, and then only offsets inside these ranges.
    """
    spark = records.sparkSession
    new = {
        r["partition"]: (r["lo"], r["hi"])
        for r in records.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()
    }
    bounds = small_table(spark, [(p, *new[p]) for p in sorted(new)], "partition int, lo bigint, hi bigint")
    # One row per topic partition on the broadcast side.
    met = slice_index(spark, spec).join(F.broadcast(bounds), "partition").filter("first <= hi AND last >= lo")
    span = met.agg(F.min("slice").alias("a"), F.max("slice").alias("b")).first()
    if span["a"] is None:
        return records
    there = read_topic_range(
        spark.read.schema(_file_schema()).parquet(spec.path).filter(F.col("slice").between(span["a"], span["b"])),
        {p: lo for p, (lo, _) in new.items()}, {p: hi + 1 for p, (_, hi) in new.items()}, require_all=False,
    )
    return records.join(there.select("partition", "offset"), ["partition", "offset"], "left_anti").select(*records.columns)


def _write_slices(numbered: DataFrame, spec: TopicSpec, tasks: int | None = None) -> None:
    """One job writes all files out of sight, then the slices appear in order and are indexed.

    Rows move once, to one task per slice and partition, and are not sorted: a
    file is one range of offsets, which is what scans are pruned by. A file stream takes
    files by modification time, so the times are set to rise from slice to slice.
    Stores that cannot set a time copy on rename, which gives the same order.
    New slices are numbered after those that are there; no slice is ever replaced.
    """
    spark = numbered.sparkSession
    staging = f"{spec.root}/_staging-{uuid.uuid4().hex}"
    there = _slice_numbers(spark, spec)
    if there:
        numbered = _not_there(numbered, spec).withColumn("slice", F.col("slice") + (max(there) + 1))
    (
        numbered.select("slice", *[c for c in RECORD_COLUMNS if c != "topic"])
        .repartition(*([tasks] if tasks else []), "slice", "partition")
        .write.partitionBy("slice", "partition")
        .parquet(staging)
    )
    reveal_in_order(spark, staging, spec.path, "slice=")
    if added := sorted(set(_slice_numbers(spark, spec)) - set(there)):
        _add_to_index(spark, spec, added)


def parse_offsets(spec_json: str, topic: str) -> dict[int, int]:
    """Positions of one topic from ``{"topic": {"0": 23, "1": -2}}``."""
    by_topic = json.loads(spec_json)
    if topic not in by_topic:
        raise ValueError(f"the offset spec does not name topic {topic!r}")
    return {int(partition): int(position) for partition, position in by_topic[topic].items()}


def format_offsets(topic: str, positions: dict[int, int]) -> str:
    return json.dumps({topic: {str(p): positions[p] for p in sorted(positions)}})


def _require_all_partitions(df: DataFrame, named: set[int]) -> None:
    unnamed = df.filter(~F.col("partition").isin(*named)) if named else df
    row = unnamed.select("partition").first()
    if row is not None:
        raise ValueError(f"partition {row[0]} is not named in the offset spec")


def read_topic_range(
    df: DataFrame, start: dict[int, int], end: dict[int, int], *, require_all: bool = True
) -> DataFrame:
    """Records with ``start <= offset < end`` in each partition.

    ``EARLIEST`` in ``start`` and ``LATEST`` in ``end`` leave that side open.
    Naming every partition of the topic is required unless ``require_all`` is off.
    The bounds become one predicate, which prunes directories and row groups. Beyond
    ``MAX_PREDICATE_TERMS`` partitions, neighbours by start share a term, and the exact
    bounds are joined: one row per partition.
    """
    if set(start) != set(end):
        raise ValueError("start and end must name the same partitions")
    for side, special in ((start, EARLIEST), (end, LATEST)):
        wrong = {p: o for p, o in side.items() if o < 0 and o != special}
        if wrong:
            raise ValueError(f"positions not allowed on this side of the range: {wrong}")
    if require_all:
        _require_all_partitions(df, set(start))
    if not start:
        return df.limit(0)

    def inside(group: list[int]) -> Column:
        condition = F.col("partition").isin(*group) if len(group) > 1 else F.col("partition") == group[0]
        lowest, ends = min(start[p] for p in group), [end[p] for p in group]
        if lowest != EARLIEST:
            condition = condition & (F.col("offset") >= lowest)
        if LATEST not in ends:
            condition = condition & (F.col("offset") < max(ends))
        return condition

    pruned = df.filter(reduce(Column.__or__, map(inside, _similar(start, start))))
    if len(start) <= MAX_PREDICATE_TERMS:
        return pruned
    bounds = small_table(
        df.sparkSession,
        [(p, start[p], end[p]) for p in sorted(start)],
        "partition int, range_start bigint, range_end bigint",
    )
    return (
        pruned.join(F.broadcast(bounds), "partition")
        .filter((F.col("range_start") == EARLIEST) | (F.col("offset") >= F.col("range_start")))
        .filter((F.col("range_end") == LATEST) | (F.col("offset") < F.col("range_end")))
        .select(*df.columns)
    )


def read_range(
    spark: SparkSession, spec: TopicSpec, start: dict[int, int], end: dict[int, int], *, require_all: bool = False
) -> DataFrame:
    """Records between two positions of the named partitions of a topic.

    Kafka is asked for exactly this range; a file topic is pruned to it. With
    ``require_all`` every partition of a file topic must be named; its partitions are
    known from the listed files, without reading any.
    """
    if spec.kind != "kafka":
        rows = read_topic(spark, spec)
        if require_all:
            found = {int(p) for name in rows.inputFiles() for p in re.findall(r"/partition=(\d+)/", name)}
            if unnamed := sorted(found - set(start)):
                raise ValueError(f"partition {unnamed[0]} is not named in the offset spec")
        return read_topic_range(rows, start, end, require_all=False)
    return (
        _kafka_records(spark.read.format("kafka").options(**_kafka_range_options(spec, start, end)).load())
    )


def _kafka_range_options(spec: TopicSpec, start: dict[int, int], end: dict[int, int]) -> dict[str, str]:
    options = _kafka_options(spec)
    for name in ("subscribe", "maxOffsetsPerTrigger"):
        options.pop(name, None)
    return {
        **options,
        "assign": json.dumps({spec.topic: sorted(start)}),
        "startingOffsets": format_offsets(spec.topic, start),
        "endingOffsets": format_offsets(spec.topic, end),
    }


def check_data_loss(df: DataFrame, start: dict[int, int], *, strict: bool = False) -> DataFrame:
    """Partitions whose earliest available offset lies after the requested start.

    A requested partition without any record is reported with a null earliest
    offset. ``strict`` raises when there is a loss.
    """
    requested = small_table(
        df.sparkSession,
        [(p, o) for p, o in sorted(start.items()) if o != EARLIEST],
        "partition int, requested_offset bigint",
    )
    # One row per topic partition on both sides of this join.
    earliest = df.groupBy("partition").agg(F.min("offset").alias("earliest_offset"))
    lost = (
        requested.join(earliest, "partition", "left")
        .filter(F.col("earliest_offset").isNull() | (F.col("earliest_offset") > F.col("requested_offset")))
        .select(
            "partition",
            "requested_offset",
            "earliest_offset",
            (F.col("earliest_offset") - F.col("requested_offset")).alias("lost"),
        )
    )
    if strict:
        worst = lost.orderBy("partition").first()
        if worst is not None:
            raise DataLossError(
                f"partition {worst['partition']}: requested {worst['requested_offset']}, "
                f"earliest available {worst['earliest_offset']}"
            )
    return lost
