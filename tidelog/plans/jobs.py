"""One job per query name, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import avro, frames, maps
from tidelog.functions.payloads import decode_json, encode_json, read_json_text
from tidelog.functions.timeuuid import timeuuid, timeuuid_time
from tidelog.operators import committed, ledger, lookup, offsets, rollups
from tidelog.operators.asyncmap import foreach_async, map_async
from tidelog.plans import fixtures
from tidelog.plans.fixtures import table
from tidelog.sources import generate, keyed, sinks, tables
from tidelog.sources.capped import run_capped
from tidelog.sources.topics import (
    LATEST, TopicSpec, as_records, check_data_loss, parse_offsets, read_range, read_topic, read_topic_stream,
)
from tidelog.storage import scratch
from tidelog.streaming.append import append_stream
from tidelog.streaming.exactly_once import (
    AFTER_CLAIM, ExactlyOnceSink, read_output, run_exactly_once,
)
from tidelog.streaming.progress import (
    ProgressRecorder, observe_ranges, observed_ranges, progress_table, read_events,
)
from tidelog.streaming.rows import RowWriter, foreach_rows, read_rows

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}

SEED = 7

# The map entry that is put, and the default of the extra key column.
PUT_KEY, PUT_VALUE = "yet-another_key", "toto"
EXTRA_VALUE = "42"


def job(name: str) -> Callable[[Job], Job]:
    def register(function: Job) -> Job:
        JOBS[name] = function
        return function

    return register


# --- topics -------------------------------------------------------------------


@job("topic_view")
def topic_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.events_topic(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", "timestampType",
    )


@job("topic_stream_append")
def topic_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fixtures.published_events(spark, sf_dir)
    rows = read_topic_stream(spark, spec).select(
        F.col("key").cast("string").alias("key"), "partition", "offset"
    )
    out = scratch(spark, "appended")
    append_stream(rows, out).awaitTermination()
    return spark.read.parquet(out)


@job("topic_stream_capped")
def topic_stream_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges and counts of micro-batches with a cap in records, counted from the records they got."""
    spec, out = fixtures.published_events(spark, sf_dir), scratch(spark, "capped")
    share = -(-(fixtures.last_offset(table(spark, sf_dir, "events").count()) + 1) // 6)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "partition", "offset").write.mode("append").parquet(out)

    run_capped(spark, spec, share * fixtures.PARTITIONS, keep)
    return spark.read.parquet(out).groupBy("batch_id", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"), F.count(F.lit(1)).alias("n")
    )


@job("topic_range_replay")
def topic_range_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = fixtures.last_offset(table(spark, sf_dir, "events").count())
    start = parse_offsets('{"events": {"0": 100, "1": -2, "2": 150, "3": 0}}', fixtures.TOPIC)
    end = {**dict.fromkeys(start, LATEST), 1: max(0, last - 100)}
    rows = read_range(spark, fixtures.published_events(spark, sf_dir), start, end, require_all=True)
    return rows.select("partition", "offset", F.col("key").cast("string").alias("key"))


@job("offset_gap_check")
def offset_gap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    retained = fixtures.events_topic(spark, sf_dir).filter(
        F.col("offset") >= 100 * (F.col("partition") + 1)
    )
    return check_data_loss(retained, {p: 150 for p in range(fixtures.PARTITIONS)})


@job("topic_publish")
def topic_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fixtures.published_events(spark, sf_dir, fixtures.event_json(), halves=True)
    return decode_json(
        read_topic(spark, spec), "value", fixtures.EVENT_JSON_SCHEMA, ["partition", "offset"]
    )


# --- keyed tables -------------------------------------------------------------


@job("csv_schema_scan")
def csv_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    cells = table(spark, sf_dir, "part").select(
        key.cast("string"),
        F.when(key % 50 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string")).alias("other"),
    )
    path = scratch(spark, "pairs")
    sinks.export_csv(cells, path)
    return tables.read_csv(spark, path, tables.PAIR_SCHEMA)


@job("keyed_table_scan")
def keyed_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.read_table(spark, sf_dir, "supplier", view="supplier_table")
    return spark.sql("SELECT * FROM supplier_table")


@job("range_source")
def range_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key rows ``(k, day, bucket)`` and ``(key, v1, v2)`` for the keys of the orders."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(*tables.key_columns(key), *tables.triple_columns(key))


@job("filter_scan")
def filter_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.read_table(spark, sf_dir, "part", view="part_table")
    return tables.filter_view(spark, "part_table", "p_size > 20")


@job("csv_export")
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "export")
    name = (
        F.when(F.col("p_size") % 5 == 0, F.lit(""))
        .when(F.col("p_size") % 5 == 1, F.lit(None))
        .when(F.col("p_size") % 5 == 2, F.concat("p_name", F.lit('\n"quoted", second line')))
        .otherwise(F.col("p_name"))
    )
    selected = table(spark, sf_dir, "part").filter("p_size > 20").select("p_partkey", "p_size", name.alias("p_name"))
    sinks.export_csv(selected, path)
    return tables.read_csv(spark, path, selected.schema)


@job("upsert_table")
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    customer = table(spark, sf_dir, "customer").withColumns(
        {"items": F.create_map(segment, F.col("c_acctbal")), "tags": F.array(segment, name)}
    )
    raised = customer.filter("c_acctbal < 5000")
    added = customer.withColumn("c_custkey", -1 - F.col("c_custkey"))
    changes = (
        raised.withColumn("c_acctbal", F.col("c_acctbal") + 100).withColumn("seq", F.lit(1))
        .unionByName(raised.withColumn("c_acctbal", F.col("c_acctbal") + 200).withColumn("seq", F.lit(2)))
        .unionByName(added.withColumn("seq", F.lit(3)))
    )
    target = keyed.create_table(customer, scratch(spark, "customers"), ["c_custkey"], 16)
    keyed.change_table(target, changes, "seq")
    return keyed.read_table(spark, target).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.map_values("items")[0].alias("item"), F.array_join("tags", "|").alias("tags"),
    )


# --- lookup joins -------------------------------------------------------------


@job("lookup_join_select")
def lookup_join_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The key side has a column of its own that the table names too.
    keys = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("c_mktsegment")
    )
    return keyed.keyed_lookup(
        keys, _keyed(spark, sf_dir, "customer", ["c_custkey"]), ["c_custkey"], select=["c_name", "c_mktsegment"]
    )


def _keyed(spark: SparkSession, sf_dir: str, name: str, keys: list[str], buckets: int = 16) -> keyed.KeyedTable:
    """A table in hash buckets of its key."""
    return keyed.create_table(table(spark, sf_dir, name), scratch(spark, name), keys, buckets)


@job("lookup_join_keyed")
def lookup_join_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few keys of a large table: only their buckets are read."""
    keys = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), "r_name")
    return keyed.keyed_lookup(
        keys, _keyed(spark, sf_dir, "orders", ["o_custkey"], 64), ["id"], key_map={"id": "o_custkey"},
        select=["o_orderkey", "o_totalprice"],
    )


@job("lookup_join_all")
def lookup_join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").select("c_custkey")
    return lookup.lookup_table_rows(
        keys, table(spark, sf_dir, "orders"), ["c_custkey"], {"c_custkey": "o_custkey"}
    )


LINE_KEYS = {"dummy": "l_partkey", "day": "l_suppkey", "bucket": "l_linenumber"}


@job("lookup_join_mapped")
def lookup_join_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = (
        lines.select(*[F.col(c).alias(k) for k, c in LINE_KEYS.items()])
        .distinct()
        .withColumn("toto", F.lit(EXTRA_VALUE))
        .withColumn("l_quantity", F.lit(-1))
    )
    entries = _keyed(spark, sf_dir, "lineitem", list(LINE_KEYS.values()))
    return keyed.keyed_lookup(
        keys, entries, list(LINE_KEYS), key_map=LINE_KEYS, select=["l_orderkey", "l_quantity"]
    )


@job("lookup_join_value")
def lookup_join_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = lines.select(*[F.col(c).alias(k) for k, c in LINE_KEYS.items()])
    values = lookup.lookup_join(
        keys, lines, list(LINE_KEYS), key_map=LINE_KEYS, value=("l_quantity", "value")
    )
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@job("sql_inner_join")
def sql_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    ).createOrReplaceTempView("ent")
    tables.read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ent_id"), F.col("o_orderkey").alias("ent_other")
    ).createOrReplaceTempView("ent_id")
    return tables.where_join(spark, "ent", "ent_id", "id", "ent_id")


@job("copartition_join")
def copartition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return lookup.copartition_join(keys, table(spark, sf_dir, "orders"), ["o_custkey"], parts)


# --- aggregations -------------------------------------------------------------


@job("offset_ranges")
def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.offset_ranges(fixtures.events_topic(spark, sf_dir))


@job("batch_offset_ranges")
def batch_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.batch_offset_ranges(fixtures.events_topic(spark, sf_dir))


@job("stream_offset_ranges")
def stream_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges and counts per partition, kept as state over all batches of a stream."""
    stream = read_topic_stream(spark, fixtures.published_events(spark, sf_dir))
    return _final_state(offsets.offset_ranges(stream))


@job("stream_running_total")
def stream_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final_state(offsets.stream_total(read_topic_stream(spark, fixtures.published_events(spark, sf_dir))))


def _final_state(aggregated: DataFrame) -> DataFrame:
    """Run an aggregated stream to its end; its last complete result is the table.

    Each batch replaces the result: a few rows, one per group.
    """
    spark, out = aggregated.sparkSession, scratch(aggregated.sparkSession, "state")
    query = (
        aggregated.writeStream.outputMode("complete").trigger(availableNow=True)
        .option("checkpointLocation", scratch(spark, "checkpoint"))
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)


@job("row_count")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.row_count(fixtures.events_topic(spark, sf_dir))


@job("batch_running_total")
def batch_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Some records have no offset.
    lost = F.when(F.col("offset") % 97 != 0, F.col("offset"))
    records = fixtures.events_topic(spark, sf_dir).withColumn("offset", lost)
    return offsets.batch_running_total(
        records, fixtures.last_offset(table(spark, sf_dir, "events").count())
    )


@job("metric_rollup")
def metric_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Some events have no type, and the values of some lie close together.
    events = table(spark, sf_dir, "events").select(
        "ts", F.when(F.col("event_id") % 50 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_type") == "view", F.col("value") / 1024 + 2**20).otherwise(F.col("value")).alias("value"),
    )
    rates = ["rate_1m", "rate_15m", "ewma_1m", "ewma_15m"]
    return _rounded(rollups.metric_rollup(events), [*rates, *rollups.PERCENTILES])


@job("approval_rate_minute")
def approval_rate_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = rollups.approval_rate_minute(table(spark, sf_dir, "events"), F.col("event_type") != "error")
    return _rounded(rates, ["approved_rate_hr", "approved_rate_min"])


@job("approval_rate_stream")
def approval_rate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rates from a stream of events with a watermark; minutes come when they are over."""
    spec = fixtures.published_with_heartbeat(spark, sf_dir)
    events = read_topic_stream(spark, spec).select(
        F.col("timestamp").cast("timestamp").alias("ts"), F.col("value").cast("string").alias("event_type")
    )
    out = scratch(spark, "minutes")
    minutes = rollups.approval_minutes_stream(
        events, F.col("event_type") != "error", "10 minutes", F.col("event_type") != fixtures.HEARTBEAT
    )
    append_stream(minutes, out).awaitTermination()
    rates = rollups.approval_hours(spark.read.parquet(out))
    return _rounded(rates, ["approved_rate_hr", "approved_rate_min"])


@job("metric_sketches")
def metric_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of merged minute sketches of a stream, and whether their ranks are within the stated error."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    source = scratch(spark, "events")
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp"))
    out = scratch(spark, "sketches")
    run = rollups.minute_sketches(stream).writeStream.outputMode("complete").trigger(availableNow=True)
    run.option("checkpointLocation", scratch(spark, "checkpoint")).foreachBatch(
        lambda batch, _: batch.write.mode("overwrite").parquet(out)
    ).start().awaitTermination()
    marks = rollups.merged_quantiles(spark.read.parquet(out), "event_type")
    checked = rollups.rank_errors(events, marks, "event_type")
    return checked.select("event_type", "n", *[
        (F.col(f"{name}_error") <= rollups.RANK_ERROR).alias(f"{name}_within") for name in rollups.PERCENTILES
    ])


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only for the comparison with another engine's last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- ledger -------------------------------------------------------------------


@job("ledger_current")
def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_current(fixtures.events_ledger(spark, sf_dir))


@job("ledger_history")
def ledger_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_history(
        fixtures.events_ledger(spark, sf_dir), fixtures.APPLICATION, fixtures.TOPIC
    )


@job("range_continuity")
def range_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One range of partition 3 covers the two after it as well.
    wide = (F.col("partition") == 3) & (F.col("batch_id") == 0)
    until = F.when(wide, F.col("until_offset") + 600).otherwise(F.col("until_offset"))
    return ledger.range_continuity(fixtures.events_ledger(spark, sf_dir).withColumn("until_offset", until))


@job("ledger_retention")
def ledger_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_retention(fixtures.events_ledger(spark, sf_dir), "2024-01-31 00:00:00")


@job("resume_position")
def resume_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.resume_position(
        fixtures.events_ledger(spark, sf_dir), fixtures.APPLICATION, fixtures.TOPIC
    )


# --- payloads -----------------------------------------------------------------


def _damaged_props() -> F.Column:
    """Event properties of which one in fifty is cut in the middle."""
    return F.when(F.col("event_id") % 50 == 0, F.lit('{"k": ')).otherwise(F.col("props"))


@job("json_decode")
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("props", _damaged_props())
    return decode_json(events, "props", "k int", ["event_id"])


@job("json_read_text")
def json_read_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("props", _damaged_props())
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return read_json_text(events, "props", schema, ["event_id"]).withColumnRenamed(
        "_corrupt_record", "corrupt_record"
    )


@job("json_encode")
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = table(spark, sf_dir, "events").select(
        "event_id", encode_json("event_type", "value", "user_id").alias("payload")
    )
    return decode_json(encoded, "payload", "event_type string, value double, user_id bigint", ["event_id"])


@job("framed_encode")
def framed_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = table(spark, sf_dir, "documents").select(
        "doc_id",
        frames.encode_frame(fixtures.USER_SCHEMA_ID, "source", "text").alias("frame"),
    )
    decoded = frames.decode_frames(framed, "frame", ("source", "text"))
    return decoded.select(
        "doc_id",
        F.md5("frame").alias("frame_md5"),
        "source",
        F.md5(F.col("text")).alias("text_md5"),
    )


def _user_columns() -> list:
    tags, label = F.array_join("tags", "|").alias("tags"), F.col("home.label").alias("label")
    return ["firstname", "lastname", "nation", tags, label, "error"]


@job("framed_decode")
def framed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of three schema versions as the newest one; those that cannot be read lie apart."""
    schemas, newest = avro.registered_schemas(fixtures.schema_registry(spark, sf_dir), "user-value")
    decoded = avro.decode_versions(fixtures.damaged_frames(spark, sf_dir), "frame", schemas, newest)
    path = scratch(spark, "decoded")
    avro.with_dead_letters(decoded.select("c_custkey", "schema_id", *_user_columns())).write.partitionBy("dead").parquet(path)
    rows = spark.read.parquet(path)
    good, dead = rows.filter("dead = 0"), rows.filter("dead = 1")
    return good.unionByName(dead).drop("dead")


@job("project_payload")
def project_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream, with the dead letters in an output of their own."""
    key = F.col("c_custkey")
    records = as_records(
        fixtures.damaged_frames(spark, sf_dir).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")),
        key=F.concat(F.lit("key"), key), value=F.col("frame"), topic="user",
        partition=fixtures.partition_of(key), offset=fixtures.offset_of(key), timestamp=F.col("ts"),
    )
    spec = fixtures.published(spark, records, table(spark, sf_dir, "customer").count(), "user")
    schemas, newest = avro.registered_schemas(fixtures.schema_registry(spark, sf_dir), "user-value")
    decoded = avro.decode_versions(read_topic_stream(spark, spec), "value", schemas, newest)
    rows = decoded.select("offset", F.col("key").cast("string").alias("key"), *_user_columns())
    out = scratch(spark, "users")
    append_stream(avro.with_dead_letters(rows), out, name="users", partition_by=("dead",)).awaitTermination()
    return spark.read.parquet(out).drop("dead")


@job("schema_version_lookup")
def schema_version_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("region"), F.col("n_regionkey"), F.lit("-value")).alias("subject"),
        F.col("n_nationkey").alias("version"),
        (F.col("n_nationkey") + 1000).alias("schema_id"),
    )
    records = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("region"), F.col("c_nationkey") % 6).alias("topic")
    )
    return frames.with_reader_schema(records, registry).select(
        "c_custkey", "topic", "version", "reader_schema_id"
    )


@job("map_put")
def map_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, value = PUT_KEY, PUT_VALUE
    plain = F.create_map(F.lit("type"), F.col("event_type"))
    taken = F.create_map(F.lit("type"), F.col("event_type"), F.lit(key), F.lit("old"))
    put = maps.map_put(F.when(F.col("event_id") % 2 == 0, taken).otherwise(plain), key, value)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.map_contains_key(put, "type").alias("has_type"),
        put["type"].alias("type"),
        put[key].alias("put_value"),
        F.size(put).alias("entries"),
    )


@job("map_get")
def map_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.create_map(F.col("event_type"), F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", maps.map_get(entries, "click").alias("click"))


@job("nested_collections")
def nested_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per user and type before the collection, so its size is the number of types.
    per_type = (
        table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("total"))
    )
    users = per_type.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "total"))).alias("items"),
        maps.as_set(F.collect_list("event_type")).alias("tags"),
    )
    return users.select(
        "user_id",
        F.size("items").alias("n_items"),
        F.round(maps.map_total(F.col("items")), 2).alias("total"),
        F.array_join("tags", ",").alias("tags"),
        F.array_contains("tags", "purchase").alias("buys"),
    )


@job("timeuuid_make")
def timeuuid_make(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", timeuuid(F.col("ts"), F.col("event_id")).alias("uuid")
    )


@job("timeuuid_time")
def timeuuid_time_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeuuid_make(spark, sf_dir).select("event_id", timeuuid_time(F.col("uuid")).alias("ts"))


@job("payload_generate")
def payload_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain messages, and messages with an abort flag (set for errors)."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    plain = generate.generate_payloads(events.select("event_id"), "event_id", SEED)
    flagged = generate.generate_payloads(events, "event_id", SEED, abort=F.col("event_type") == "error")
    return plain.join(flagged.select("event_id", "abort", F.col("value").alias("flagged_value")), "event_id")


# --- per-row calls ------------------------------------------------------------


@job("async_enrich")
def async_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    def double_length(client: None, row: dict) -> dict:
        return {"doc_id": row["doc_id"], "big": row["big"], "doubled": 2 * len(row["text"])}

    return map_async(
        table(spark, sf_dir, "documents").select("doc_id", "text", _big_id()),
        lambda: None, double_length, "doc_id bigint, big bigint, doubled bigint",
    )


def _big_id() -> F.Column:
    """A number above 2 ** 53, which is null for every third document."""
    return F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") + (2**53 + 1)).alias("big")


@job("async_foreach")
def async_foreach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return foreach_async(
        table(spark, sf_dir, "documents").select(_big_id(), "text"),
        lambda: None, lambda client, row: len(row["text"]), "big",
    )


@job("foreach_rows")
def foreach_rows_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fixtures.published_events(spark, sf_dir)
    rows = read_topic_stream(spark, spec)
    out = scratch(spark, "rows")
    foreach_rows(rows, RowWriter(out)).awaitTermination()
    back = read_rows(spark, out, rows.schema)
    return back.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


@job("query_progress")
def query_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fixtures.published_events(spark, sf_dir)
    path = scratch(spark, "progress")
    recorder = ProgressRecorder(spark, path)
    spark.streams.addListener(recorder)
    try:
        query = append_stream(
            read_topic_stream(spark, spec).select("partition", "offset"),
            scratch(spark, "watched"), name="watched",
        )
        run_id = str(query.runId)
        query.awaitTermination()
        if not recorder.wait_terminated(run_id):
            raise TimeoutError("the last event of the query did not arrive")
    finally:
        spark.streams.removeListener(recorder)
    return progress_table(spark, path).filter(F.col("run_id") == run_id).select(
        "name", (F.col("batches") > 0).alias("ran"), "input_rows", "terminated", "exception"
    )


@job("query_observed")
def query_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset ranges of a stream as its progress events tell them, over all batches."""
    spec, path = fixtures.published_events(spark, sf_dir), scratch(spark, "progress")
    recorder = ProgressRecorder(spark, path)
    spark.streams.addListener(recorder)
    try:
        rows = observe_ranges(read_topic_stream(spark, spec).select("partition", "offset"), fixtures.PARTITIONS)
        query = append_stream(rows, scratch(spark, "watched"), name="observed")
        run_id = str(query.runId)
        query.awaitTermination()
        if not recorder.wait_terminated(run_id):
            raise TimeoutError("the last event of the query did not arrive")
    finally:
        spark.streams.removeListener(recorder)
    ranges = observed_ranges(read_events(spark, path), fixtures.PARTITIONS).filter(F.col("run_id") == run_id)
    # Ranges of the batches follow one another without a hole.
    return ranges.groupBy("partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"), F.sum("n").alias("n"),
        (F.sum(F.col("until_offset") - F.col("from_offset")) == F.sum("n")).alias("whole"), (F.count(F.lit(1)) > 1).alias("several"),
    )


# --- transactions and exactly-once --------------------------------------------


@job("read_committed")
def read_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return committed.read_committed(*fixtures.transactions(spark, sf_dir))


@job("read_committed_stream")
def read_committed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = decode_json(
        read_topic_stream(spark, fixtures.transaction_log(spark, sf_dir)), "value", fixtures.LOG_JSON_SCHEMA, ["partition", "offset"]
    )
    out = scratch(spark, "committed")
    append_stream(committed.read_committed_stream(log), out).awaitTermination()
    return spark.read.parquet(out).select("event_id", "partition", "txn_id", "offset")


@job("transaction_generate")
def transaction_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    sent = generate.generate_transactions(
        events.select("event_id", "event_type"), "event_id", events.count(), SEED
    )
    return sent.select("txn_id", F.col("i").alias("place"), "abort", "event_id", "event_type", "value")


def _exactly_once(
    spark: SparkSession, spec: TopicSpec, ledger_path: str, output_path: str,
    on_stage: Callable[[str, int], None] = lambda stage, batch_id: None,
) -> ExactlyOnceSink:
    sink = ExactlyOnceSink(
        spark,
        application_id=fixtures.APPLICATION,
        topic=spec.topic,
        ledger_path=ledger_path,
        output_path=output_path,
        process=lambda rows: decode_json(rows, "value", fixtures.EVENT_JSON_SCHEMA, ["topic", "partition", "offset"]),
        on_stage=on_stage,
    )
    sink.recover(spec)
    return sink


@job("exactly_once_sink")
def exactly_once_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fixtures.published_events(spark, sf_dir, fixtures.event_json())
    ledger_path, output_path = scratch(spark, "ledger"), scratch(spark, "output")
    sink = _exactly_once(spark, spec, ledger_path, output_path)
    run_exactly_once(read_topic_stream(spark, spec), sink).awaitTermination()
    return read_output(spark, output_path, ledger_path)


class _Killed(RuntimeError):
    """Stands for the loss of the driver between two steps."""


@job("pending_replay")
def pending_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fixtures.published_events(spark, sf_dir, fixtures.event_json())
    ledger_path, output_path = scratch(spark, "ledger"), scratch(spark, "output")

    def die_in_second_batch(stage: str, batch_id: int) -> None:
        if stage == AFTER_CLAIM and batch_id == 1:
            raise _Killed

    first = _exactly_once(spark, spec, ledger_path, output_path, die_in_second_batch)
    try:
        run_exactly_once(read_topic_stream(spark, spec), first).awaitTermination()
    except StreamingQueryException as error:
        if _Killed.__name__ not in str(error):
            raise
    second = _exactly_once(spark, spec, ledger_path, output_path)
    run_exactly_once(read_topic_stream(spark, second.resume(spec)), second).awaitTermination()
    return read_output(spark, output_path, ledger_path)
