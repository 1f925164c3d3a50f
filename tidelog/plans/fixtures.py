"""Views of the test tables as topics, ledgers, transactions and frames."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.avro import encode_record
from tidelog.functions.numbers import int_div
from tidelog.operators.committed import ABORT, COMMIT
from tidelog.operators.ledger import LEDGER_SCHEMA
from tidelog.operators.offsets import batch_number
from tidelog.sources.topics import TopicSpec, as_records, publish, publish_slice
from tidelog.storage import scratch

TOPIC = "events"
APPLICATION = "rollup"
PARTITIONS = 4
USER_SCHEMA_ID = 42

# Rows of a topic file; a micro-batch takes as many files as there are cores.
FILE_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partition_of(index: Column) -> Column:
    return (index % PARTITIONS).cast("int")


def offset_of(index: Column) -> Column:
    return int_div(index, PARTITIONS)


def last_offset(rows: int) -> int:
    """Highest offset when ``rows`` rows are dealt to the partitions (0 when empty)."""
    return max(0, (rows - 1) // PARTITIONS)


def events_topic(spark: SparkSession, sf_dir: str, value: Column | None = None) -> DataFrame:
    """The events as topic records: ``event_id`` gives partition and offset."""
    index = F.col("event_id")
    return as_records(
        table(spark, sf_dir, "events"),
        key=F.col("user_id"),
        value=F.col("props") if value is None else value,
        topic=TOPIC,
        partition=partition_of(index),
        offset=offset_of(index),
        timestamp=F.col("ts"),
    )


def event_json() -> Column:
    return F.to_json(F.struct("event_id", "user_id", "event_type", "value"))


EVENT_JSON_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


def published(spark: SparkSession, records: DataFrame, rows: int, topic: str, *, halves: bool = False) -> TopicSpec:
    """Write records (dealt evenly to the partitions) to a new file topic.

    A micro-batch keeps all cores busy, and there are two batches at least. With ``halves``
    the topic is published in two calls that meet inside a slice: the later records first, then
    the late ones, and some of the first call again.
    """
    offsets = last_offset(rows) + 1
    slices_per_batch = max(1, math.ceil(spark.sparkContext.defaultParallelism / PARTITIONS))
    slices = max(2 * slices_per_batch, math.ceil(offsets / FILE_ROWS))
    width = max(1, math.ceil(offsets / slices))
    spec = TopicSpec(
        topic=topic,
        root=scratch(spark, "topic"),
        max_files_per_trigger=slices_per_batch * PARTITIONS,
    )
    half = width * (slices // 2) + width // 2
    parts = (F.col("offset") >= half, F.col("offset") < half + width) if halves else (F.lit(True),)
    for part in parts:
        publish(records.filter(part), spec, offsets_per_slice=width, tasks=slices * PARTITIONS)
    return spec


def published_events(
    spark: SparkSession, sf_dir: str, value: Column | None = None, *, halves: bool = False
) -> TopicSpec:
    rows = table(spark, sf_dir, "events").count()
    return published(spark, events_topic(spark, sf_dir, value), rows, TOPIC, halves=halves)


def _user(*fields: dict) -> str:
    names = [{"name": "firstname", "type": "string"}, {"name": "lastname", "type": "string"}]
    return json.dumps({"type": "record", "name": "User", "fields": [*names, *fields]})


# Three versions of a record: fields are added, dropped, nested, and get defaults.
USER_V1 = _user()
USER_V2 = _user({"name": "nation", "type": "int"}, {"name": "cents", "type": "long"})
USER_V3 = _user(
    {"name": "nation", "type": ["null", "long"], "default": None},
    {"name": "tags", "type": {"type": "array", "items": "string"}, "default": ["none"]},
    {"name": "home", "type": {"type": "record", "name": "Home", "fields": [
        {"name": "label", "type": "string"}, {"name": "key", "type": "long"}]}, "default": {"label": "unknown", "key": 0}},
)
USER_SCHEMAS = {USER_SCHEMA_ID: USER_V1, USER_SCHEMA_ID + 1: USER_V2, USER_SCHEMA_ID + 2: USER_V3}


def schema_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the user schema: one per region, ids from 40."""
    schema_id = F.col("r_regionkey") + 40
    text = F.when(schema_id > USER_SCHEMA_ID + 1, USER_V3).when(schema_id > USER_SCHEMA_ID, USER_V2).otherwise(USER_V1)
    return table(spark, sf_dir, "region").select(
        F.lit("user-value").alias("subject"),
        F.col("r_regionkey").alias("version"),
        schema_id.alias("schema_id"),
        text.alias("schema"),
    )


def user_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as framed user records ``(c_custkey, frame)``, in three schema versions."""
    users = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("firstname"), F.col("c_mktsegment").alias("lastname"),
        F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("nation"),
        F.coalesce("c_nationkey", F.lit(0)).alias("nation_key"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
        F.array("c_mktsegment", "c_name").alias("tags"),
        F.struct(F.col("c_name").alias("label"), F.col("c_custkey").cast("bigint").alias("key")).alias("home"),
    )
    frames = [encode_record(schema_id, schema) for schema_id, schema in USER_SCHEMAS.items()]
    version = F.col("c_custkey") % 3
    # The second version has the nation of every user.
    second = users.filter(version == 1).withColumn("nation", F.col("nation_key")).select("c_custkey", frames[1].alias("frame"))
    others = F.when(version == 0, frames[0]).otherwise(frames[2])
    return users.filter(version != 1).select("c_custkey", others.alias("frame")).unionByName(second)


def damaged_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User frames of which four in a hundred are damaged, each in another way."""
    frame, kind = F.col("frame"), F.col("c_custkey") % 100
    body = F.substring(frame, F.lit(2), F.octet_length(frame) - 1)
    broken = (
        F.when(kind == 0, F.concat(F.unhex(F.lit("01")), body))
        .when(kind == 25, F.substring(frame, F.lit(1), F.octet_length(frame) - 3))
        .when(kind == 50, F.concat(F.unhex(F.lit("0000000063")), F.substring(frame, F.lit(6), F.octet_length(frame) - 5)))
        .when(kind == 75, F.concat(F.substring(frame, 1, 5), F.unhex(F.lit("FFFFFFFFFF01"))))
        .otherwise(frame)
    )
    return user_frames(spark, sf_dir).withColumn("frame", broken)


def transactions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events as transactional records, and the markers of the finished transactions.

    Three records per transaction; the marker takes the fourth offset. The last
    transaction of every partition is open.
    """
    events = table(spark, sf_dir, "events")
    rows = events.count()
    position = offset_of(F.col("event_id"))
    records = events.select(
        "event_id",
        partition_of(F.col("event_id")).alias("partition"),
        int_div(position, 3).alias("txn_id"),
        (int_div(position, 3) * 4 + position % 3).alias("offset"),
    )
    open_txn = int_div(int_div(F.lit(rows) - 1 - F.col("partition"), PARTITIONS), 3)
    aborted = (F.col("txn_id") * 7919 + F.col("partition")) % 100 > 50
    markers = (
        records.select("partition", "txn_id")
        .distinct()
        .filter(F.col("txn_id") < open_txn)
        .select(
            "partition",
            "txn_id",
            (F.col("txn_id") * 4 + 3).alias("marker_offset"),
            F.when(aborted, F.lit(ABORT)).otherwise(F.lit(COMMIT)).alias("state"),
        )
    )
    return records, markers


def events_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim and commit events of batches of 250 offsets per partition.

    Batch 1 of partition 0 is claimed only, batch 3 of partition 1 is missing and
    batch 5 of partition 2 starts ten offsets early.
    """
    batches = (
        events_topic(spark, sf_dir)
        .groupBy("topic", "partition", batch_number().alias("batch_id"))
        .agg(
            F.min("offset").alias("from_offset"),
            (F.max("offset") + 1).alias("until_offset"),
            F.count(F.lit(1)).alias("n"),
            F.min("timestamp").alias("first_ts"),
            F.max("timestamp").alias("last_ts"),
        )
    )
    p, b = F.col("partition"), F.col("batch_id")
    claimed_only = (p == 0) & (b == 1)
    early = (p == 2) & (b == 5)
    return (
        batches.filter(~((p == 1) & (b == 3)))
        .withColumn("from_offset", F.when(early, F.col("from_offset") - 10).otherwise(F.col("from_offset")))
        .withColumn("processed", F.explode(F.array(F.lit(False), F.lit(True))))
        .filter(~(claimed_only & F.col("processed")))
        .select(
            F.lit(APPLICATION).alias("application_id"),
            "topic", "partition", "from_offset", "until_offset", "n",
            F.lit("run").alias("run_id"),
            "batch_id",
            F.concat_ws("-", p, b).alias("range_id"),
            "processed",
            F.when(F.col("processed"), F.col("last_ts")).otherwise(F.col("first_ts")).alias("event_time"),
        )
        .select(*LEDGER_SCHEMA.fieldNames())
    )


def transaction_log(spark: SparkSession, sf_dir: str) -> TopicSpec:
    """The same transactions as one topic: markers stand in the log, behind their records."""
    records, markers = transactions(spark, sf_dir)
    each = records.select("partition", "offset", "txn_id", "event_id", F.lit(None).cast("string").alias("state"))
    ends = markers.select("partition", F.col("marker_offset").alias("offset"), "txn_id", F.lit(None).cast("bigint").alias("event_id"), "state")
    log = as_records(
        each.unionByName(ends).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")),
        key=F.col("txn_id"), value=F.to_json(F.struct("txn_id", "event_id", "state")).cast("string"), topic="transactions",
        partition=F.col("partition"), offset=F.col("offset"), timestamp=F.col("ts"),
    )
    # Slices end inside transactions, so that their markers come in a later batch.
    offsets = last_offset(table(spark, sf_dir, "events").count()) * 4 // 3 + 4
    width = max(2, offsets // 12 // 4 * 4 + 2)
    spec = TopicSpec("transactions", root=scratch(spark, "topic"), max_files_per_trigger=2 * PARTITIONS)
    publish(log, spec, offsets_per_slice=width)
    return spec


LOG_JSON_SCHEMA = "txn_id bigint, event_id bigint, state string"


HEARTBEAT = "heartbeat"


def published_with_heartbeat(spark: SparkSession, sf_dir: str) -> TopicSpec:
    """The event types as a topic, and after them a heartbeat of a day later, which ends all minutes."""
    spec = published_events(spark, sf_dir, F.col("event_type"))
    last = events_topic(spark, sf_dir).agg(F.max("offset").alias("o"), F.max("timestamp").alias("t"))
    beat = last.filter("o IS NOT NULL").select(
        F.lit(None).cast("binary").alias("key"), F.lit(HEARTBEAT).cast("binary").alias("value"), F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"), (F.col("o") + 1).alias("offset"), (F.col("t") + F.expr("INTERVAL 1 DAY")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    publish_slice(beat, spec)
    return spec
