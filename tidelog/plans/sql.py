"""The same results as the jobs, as SQL over the test tables."""

from __future__ import annotations

from tidelog.functions.timeuuid import UUID_EPOCH_STEPS
from tidelog.plans.fixtures import APPLICATION, USER_SCHEMA_ID
from tidelog.plans.jobs import SEED
from tidelog.sources.generate import (
    ABORT_ABOVE, ABORT_RANGE, AGE_RANGE, MAX_RECORDS_PER_TXN, NAME_ALPHABET, NAME_LENGTH,
)

TOPIC_ROWS = """
  SELECT cast(event_id % 4 AS integer) AS "partition", event_id // 4 AS "offset",
         cast(user_id AS varchar) AS "key", event_id, ts, event_type, user_id, value, props
  FROM events
"""

LEDGER_ROWS = f"""
  SELECT '{APPLICATION}' AS application_id, 'events' AS topic, "partition",
         CASE WHEN "partition" = 2 AND batch_id = 5 THEN lo - 10 ELSE lo END AS from_offset,
         hi + 1 AS until_offset, n, 'run' AS run_id, batch_id,
         "partition" || '-' || batch_id AS range_id, processed,
         CASE WHEN processed THEN last_ts ELSE first_ts END AS event_time
  FROM (SELECT "partition", "offset" // 250 AS batch_id, min("offset") AS lo, max("offset") AS hi,
               count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
        FROM ({TOPIC_ROWS}) GROUP BY 1, 2),
       (VALUES (false), (true)) AS flags(processed)
  WHERE NOT ("partition" = 1 AND batch_id = 3)
    AND NOT ("partition" = 0 AND batch_id = 1 AND processed)
"""

DECODED_EVENTS = f"""
  SELECT 'events' AS topic, "partition", "offset", event_id, user_id, event_type, value
  FROM ({TOPIC_ROWS})
"""


def _draw(digest: str, start: int, digits: int, below: int) -> str:
    return f"cast(cast('0x' || substr({digest}, {start}, {digits}) AS bigint) % {below} AS integer)"


def _digest(purpose: str, index: str) -> str:
    return f"md5('{SEED}:{purpose}:' || {index})"


def _name(index: str) -> str:
    number = f"cast('0x' || substr({_digest('name', index)}, 1, 15) AS bigint)"
    base = len(NAME_ALPHABET)
    return " || ".join(
        f"substr('{NAME_ALPHABET}', cast(({number} // {base**i}) % {base} AS integer) + 1, 1)"
        for i in range(NAME_LENGTH)
    )


def _varint_hex(number: str) -> str:
    def form(count: int) -> str:
        parts = [f"printf('%02x', (({number} >> {7 * i}) & 127) | 128)" for i in range(count - 1)]
        return " || ".join([*parts, f"printf('%02x', ({number} >> {7 * (count - 1)}) & 127)"])

    cases = " ".join(f"WHEN {number} < {2 ** (7 * count)} THEN {form(count)}" for count in range(1, 5))
    return f"(CASE {cases} ELSE {form(5)} END)"


def _string_bytes(text: str) -> str:
    return f"unhex({_varint_hex(f'(2 * octet_length(encode({text})))')}) || encode({text})"


_UUID_STEPS = f"printf('%015x', epoch_us(ts) * 10 + {UUID_EPOCH_STEPS})"
_UUID_DIGEST = "md5(cast(event_id AS varchar))"

_BIG_ID = f"CASE WHEN doc_id % 3 <> 0 THEN doc_id + {2**53 + 1} END"

_DAMAGED_USERS = """SELECT *, CASE c_custkey % 100 WHEN 0 THEN 'bad_magic' WHEN 25 THEN 'truncated'
                        WHEN 50 THEN 'unknown_schema' WHEN 75 THEN 'bad_length' END AS error FROM customer"""
# What the newest schema has of the records of three versions.
_USER_COLUMNS = """CASE WHEN error IS NULL THEN c_name END AS firstname,
             CASE WHEN error IS NULL THEN c_mktsegment END AS lastname,
             CASE WHEN error IS NULL AND (c_custkey % 3 = 1 OR c_custkey % 3 = 2 AND c_nationkey % 5 <> 0)
               THEN c_nationkey END::BIGINT AS nation,
             CASE WHEN error IS NULL THEN CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment || '|' || c_name ELSE 'none' END END AS tags,
             CASE WHEN error IS NULL THEN CASE WHEN c_custkey % 3 = 2 THEN c_name ELSE 'unknown' END END AS label,
             error"""

ORACLE: dict[str, str] = {
    "topic_view": f"""
      SELECT "key", props AS value, 'events' AS topic, "partition", "offset", ts AS "timestamp",
             0 AS "timestampType" FROM ({TOPIC_ROWS})""",
    "topic_stream_append": f'SELECT "key", "partition", "offset" FROM ({TOPIC_ROWS})',
    "topic_stream_capped": f"""
      SELECT "offset" // share AS batch_id, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset, count(*) AS n
      FROM (SELECT *, (max("offset") OVER () + 6) // 6 AS share FROM ({TOPIC_ROWS})) GROUP BY 1, 2""",
    "topic_range_replay": f"""
      SELECT t."partition", "offset", "key" FROM ({TOPIC_ROWS}) t
      JOIN (VALUES (0, 100, NULL), (1, NULL, (SELECT (count(*) - 1) // 4 - 100 FROM events)),
                   (2, 150, NULL), (3, 0, NULL)) b(p, s, e)
        ON t."partition" = b.p
      WHERE (s IS NULL OR "offset" >= s) AND (e IS NULL OR "offset" < e)""",
    "offset_gap_check": f"""
      SELECT p AS "partition", cast(150 AS bigint) AS requested_offset, earliest AS earliest_offset,
             earliest - 150 AS lost
      FROM (VALUES (0), (1), (2), (3)) AS requested(p)
      LEFT JOIN (SELECT "partition", min("offset") AS earliest FROM ({TOPIC_ROWS})
                 WHERE "offset" >= 100 * ("partition" + 1) GROUP BY 1) ON p = "partition"
      WHERE earliest IS NULL OR earliest > 150""",
    "topic_publish": f"""
      SELECT "partition", "offset", event_id, user_id, event_type, value FROM ({TOPIC_ROWS})""",
    "csv_schema_scan": """
      SELECT cast(p_partkey AS integer) AS ent_id,
             CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_size END AS ent_other FROM part""",
    "keyed_table_scan": "SELECT * FROM supplier",
    "range_source": """
      SELECT o_orderkey AS k, 'd' || o_orderkey AS day, 'bucket' || o_orderkey AS bucket,
             o_orderkey AS "key", o_orderkey AS v1, o_orderkey AS v2 FROM orders""",
    "filter_scan": "SELECT * FROM part WHERE p_size > 20",
    "csv_export": """
      SELECT p_partkey, p_size,
             CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN NULL
                             WHEN 2 THEN p_name || chr(10) || '"quoted", second line' ELSE p_name END AS p_name
      FROM part WHERE p_size > 20""",
    "upsert_table": """
      SELECT c_custkey, c_name, c_nationkey,
             CASE WHEN c_acctbal < 5000 THEN c_acctbal + 200 ELSE c_acctbal END AS c_acctbal,
             c_mktsegment, c_acctbal AS item, c_mktsegment || '|' || c_name AS tags
      FROM customer
      UNION ALL
      SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_acctbal,
             c_mktsegment || '|' || c_name FROM customer""",
    "lookup_join_select": """
      SELECT o_custkey AS c_custkey, o_orderstatus AS c_mktsegment, c_name, c_mktsegment AS table_c_mktsegment
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "lookup_join_keyed": """
      SELECT r_regionkey AS id, r_name, o_orderkey, o_totalprice FROM region JOIN orders ON r_regionkey = o_custkey""",
    "lookup_join_all": "SELECT orders.* FROM customer JOIN orders ON o_custkey = c_custkey",
    "lookup_join_mapped": """
      SELECT dummy, day, bucket, '42' AS toto, -1 AS l_quantity, l_orderkey, l_quantity AS table_l_quantity
      FROM (SELECT DISTINCT l_partkey AS dummy, l_suppkey AS day, l_linenumber AS bucket FROM lineitem) k
      JOIN lineitem ON dummy = l_partkey AND day = l_suppkey AND bucket = l_linenumber""",
    "lookup_join_value": """
      SELECT r.l_quantity AS value, count(*) AS n
      FROM lineitem k JOIN lineitem r USING (l_partkey, l_suppkey, l_linenumber) GROUP BY 1""",
    "sql_inner_join": """
      SELECT c_custkey AS id, c_name AS name FROM customer, orders WHERE c_custkey = o_custkey""",
    "copartition_join": """
      SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
      FROM customer JOIN orders ON o_custkey = c_custkey""",
    "offset_ranges": f"""
      SELECT 'events' AS topic, "partition", min("offset") AS from_offset, max("offset") AS max_offset,
             max("offset") + 1 AS until_offset, count(*) AS n
      FROM ({TOPIC_ROWS}) GROUP BY "partition" """,
    "batch_offset_ranges": f"""
      SELECT 'events' AS topic, "partition", "offset" // 250 AS batch_id, min("offset") AS from_offset,
             max("offset") AS max_offset, max("offset") + 1 AS until_offset, count(*) AS n
      FROM ({TOPIC_ROWS}) GROUP BY "partition", "offset" // 250""",
    "row_count": "SELECT count(*) AS n FROM events",
    "stream_offset_ranges": f"""
      SELECT 'events' AS topic, "partition", min("offset") AS from_offset, max("offset") AS max_offset,
             max("offset") + 1 AS until_offset, count(*) AS n
      FROM ({TOPIC_ROWS}) GROUP BY "partition" """,
    "stream_running_total": "SELECT count(*) AS total FROM events",
    "batch_running_total": f"""
      SELECT batch_id, n,
             CASE WHEN batch_id IS NOT NULL
                  THEN cast(sum(n) OVER (ORDER BY batch_id NULLS LAST) AS bigint) END AS total
      FROM (SELECT CASE WHEN "offset" % 97 <> 0 THEN "offset" // 250 END AS batch_id, count(*) AS n
            FROM ({TOPIC_ROWS}) GROUP BY 1)""",
    "metric_rollup": """
      WITH e AS (
        SELECT ts, CASE WHEN event_id % 50 <> 0 THEN event_type END AS event_type,
               CASE WHEN event_type = 'view' THEN value / 1024 + 1048576::double ELSE value END AS value FROM events),
      spread AS (
        SELECT event_type, date_trunc('minute', ts) + to_minutes(cast(k AS integer)) AS "minute", k
        FROM e, range(15) r(k)),
      rates AS (
        SELECT event_type, "minute", count(*) FILTER (WHERE k = 0) AS n, count(*) AS n15
        FROM spread GROUP BY 1, 2),
      marks AS (
        SELECT event_type, date_trunc('hour', ts) AS h, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99
        FROM e GROUP BY 1, 2),
      gains AS (
        SELECT event_type, "minute" AS born, n / 60.0::double AS x, "minute" = min("minute") OVER (PARTITION BY event_type) AS starts
        FROM rates WHERE n > 0),
      weighted AS (
        SELECT r.event_type, r."minute",
          sum(x * CASE WHEN starts THEN 1 ELSE 1 - exp(-1.0::double) END * exp((epoch(born) - epoch(r."minute")) / 60::double)) AS ewma_1m,
          sum(x * CASE WHEN starts THEN 1 ELSE 1 - exp(-1 / 15.0::double) END * exp((epoch(born) - epoch(r."minute")) / 900::double)) AS ewma_15m
        FROM rates r JOIN gains g ON r.event_type IS NOT DISTINCT FROM g.event_type AND born <= r."minute" AND born > r."minute" - INTERVAL 600 MINUTE
        GROUP BY 1, 2)
      SELECT rates.event_type, rates."minute", n, round(n / 60.0::double, 6) AS rate_1m,
             round(n15 / 900.0::double, 6) AS rate_15m, round(ewma_1m, 6) AS ewma_1m, round(ewma_15m, 6) AS ewma_15m,
             round(median, 6) AS median, round(p95, 6) AS p95, round(p99, 6) AS p99
      FROM rates LEFT JOIN marks
        ON rates.event_type IS NOT DISTINCT FROM marks.event_type AND date_trunc('hour', rates."minute") = h
      JOIN weighted w ON rates.event_type IS NOT DISTINCT FROM w.event_type AND w."minute" = rates."minute"
    """,
    "approval_rate_minute": """
      WITH m AS (
        SELECT date_trunc('minute', ts) AS at, count(*) AS ttl,
               count(*) FILTER (WHERE event_type <> 'error') AS ok FROM events GROUP BY 1),
      h AS (
        SELECT date_trunc('hour', ts) AS at, count(*) AS ttl,
               count(*) FILTER (WHERE event_type <> 'error') AS ok FROM events GROUP BY 1)
      SELECT cast(year(m.at) AS integer) AS year, cast(month(m.at) AS integer) AS month,
             cast(day(m.at) AS integer) AS day, cast(hour(m.at) AS integer) AS hour,
             cast(minute(m.at) AS integer) AS minute,
             round(h.ok / h.ttl::double, 6) AS approved_rate_hr,
             round(m.ok / m.ttl::double, 6) AS approved_rate_min,
             h.ok AS approved_txn_hr, m.ok AS approved_txn_min, h.ttl AS ttl_txn_hr, m.ttl AS ttl_txn_min
      FROM m JOIN h ON date_trunc('hour', m.at) = h.at""",
    "ledger_current": f"""
      SELECT application_id, topic, "partition", event_time, from_offset, until_offset, n
      FROM (SELECT *, row_number() OVER (PARTITION BY application_id, topic, "partition"
                                         ORDER BY event_time DESC, until_offset DESC) AS place
            FROM ({LEDGER_ROWS}) WHERE processed) WHERE place = 1""",
    "ledger_history": f"SELECT * FROM ({LEDGER_ROWS})",
    "range_continuity": f"""
      SELECT application_id, topic, "partition", from_offset, until_offset, prev_until,
             CASE WHEN from_offset > prev_until THEN 'gap' ELSE 'overlap' END AS kind
      FROM (SELECT *, max(until_offset) OVER (PARTITION BY application_id, topic, "partition"
                                              ORDER BY from_offset, until_offset
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_until
            FROM (SELECT * REPLACE (until_offset + CASE WHEN "partition" = 3 AND batch_id = 0 THEN 600 ELSE 0 END
                                    AS until_offset) FROM ({LEDGER_ROWS}))
            WHERE processed)
      WHERE from_offset <> prev_until""",
    "ledger_retention": f"""
      SELECT * FROM ({LEDGER_ROWS})
      WHERE event_time >= timestamp '2024-01-31 00:00:00' - interval 604800 seconds""",
    "resume_position": f"""
      SELECT "partition", max(until_offset) AS next_offset FROM ({LEDGER_ROWS})
      WHERE processed GROUP BY 1""",
    "json_decode": """
      SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL
                            ELSE cast(json_extract(props, '$.k') AS integer) END AS k FROM events""",
    "json_read_text": """
      SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL
                            ELSE cast(json_extract(props, '$.k') AS integer) END AS k,
             CASE WHEN event_id % 50 = 0 THEN '{"k": ' END AS corrupt_record FROM events""",
    "json_encode": "SELECT event_id, event_type, value, user_id FROM events",
    "framed_encode": f"""
      SELECT doc_id,
             md5(unhex('00' || printf('%08x', {USER_SCHEMA_ID})) || {_string_bytes('source')}
                 || {_string_bytes('text')}) AS frame_md5,
             source, md5(text) AS text_md5
      FROM documents""",
    "framed_decode": f"""
      SELECT c_custkey, CASE WHEN error IS NULL THEN {USER_SCHEMA_ID} + c_custkey % 3 END AS schema_id,
             {_USER_COLUMNS}
      FROM ({_DAMAGED_USERS})""",
    "project_payload": f"""
      SELECT c_custkey // 4 AS "offset", 'key' || c_custkey AS "key", {_USER_COLUMNS} FROM ({_DAMAGED_USERS})""",
    "schema_version_lookup": """
      SELECT c_custkey, topic, version, reader_schema_id
      FROM (SELECT c_custkey, 'region' || (c_nationkey % 6) AS topic FROM customer)
      LEFT JOIN (SELECT 'region' || n_regionkey AS subject, max(n_nationkey) AS version,
                        arg_max(n_nationkey + 1000, n_nationkey) AS reader_schema_id
                 FROM nation GROUP BY 1) ON topic = subject""",
    "map_put": """
      SELECT event_id, true AS has_type, event_type AS type, 'toto' AS put_value, 2 AS entries
      FROM events""",
    "map_get": """
      SELECT event_id, CASE WHEN event_type = 'click' THEN value END AS click FROM events""",
    "nested_collections": """
      SELECT user_id, cast(count(DISTINCT event_type) AS integer) AS n_items,
             round(sum(value), 2) AS total,
             string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tags,
             bool_or(event_type = 'purchase') AS buys
      FROM events GROUP BY user_id""",
    "timeuuid_make": f"""
      SELECT event_id,
             substr(steps, 8, 8) || '-' || substr(steps, 4, 4) || '-1' || substr(steps, 1, 3) || '-'
             || substr('89ab', {_draw('digest', 1, 1, 4)} + 1, 1) || substr(digest, 2, 3) || '-'
             || substr(digest, 6, 1) || substr('13579bdf', {_draw('digest', 5, 1, 8)} + 1, 1)
             || substr(digest, 7, 10) AS uuid
      FROM (SELECT event_id, {_UUID_STEPS} AS steps, {_UUID_DIGEST} AS digest FROM events)""",
    "timeuuid_time": "SELECT event_id, ts FROM events",
    "payload_generate": f"""
      SELECT *, '{{"name":"' || name || '","age":' || age || '}}' AS value,
             '{{"abort":"' || abort || '","name":"' || name || '","age":' || age || '}}' AS flagged_value
      FROM (SELECT event_id, {_name('event_id')} AS name,
                   {_draw(_digest('age', 'event_id'), 1, 8, AGE_RANGE)} AS age,
                   CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS abort
            FROM events)""",
    "async_enrich": f"""
      SELECT doc_id, {_BIG_ID} AS big, cast(2 * length(text) AS bigint) AS doubled FROM documents""",
    "async_foreach": f"SELECT {_BIG_ID} AS big, true AS done FROM documents",
    "foreach_rows": f"""
      SELECT "key", props AS value, 'events' AS topic, "partition", "offset", ts AS "timestamp",
             0 AS "timestampType" FROM ({TOPIC_ROWS})""",
    "metric_sketches": """
      SELECT event_type, count(value) AS n, true AS median_within, true AS p95_within, true AS p99_within FROM events GROUP BY 1""",
    "query_observed": f"""
      SELECT "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset, count(*) AS n,
             true AS whole, true AS several
      FROM ({TOPIC_ROWS}) GROUP BY 1""",
    "query_progress": """
      SELECT 'watched' AS name, true AS ran, count(*) AS input_rows, true AS terminated,
             cast(NULL AS varchar) AS exception FROM events""",
    "read_committed": f"""
      WITH r AS (
        SELECT event_id, "partition", ("offset" // 3) AS txn_id,
               4 * ("offset" // 3) + "offset" % 3 AS "offset" FROM ({TOPIC_ROWS})),
      last AS (SELECT "partition", max(txn_id) AS open_txn, min("offset") FILTER (
                 WHERE txn_id = top) AS stable_until
               FROM (SELECT *, max(txn_id) OVER (PARTITION BY "partition") AS top FROM r) GROUP BY 1)
      SELECT event_id, r."partition", txn_id, "offset"
      FROM r JOIN last ON r."partition" = last."partition"
      WHERE txn_id < open_txn AND "offset" < stable_until
        AND (txn_id * 7919 + r."partition") % 100 <= 50""",
    "transaction_generate": f"""
      WITH draws AS (
        SELECT t AS txn_id,
               {_draw(_digest('count', 't'), 1, 8, MAX_RECORDS_PER_TXN)} + 1 AS wanted,
               {_draw(_digest('abort', 't'), 1, 8, ABORT_RANGE)} > {ABORT_ABOVE} AS abort
        FROM range((SELECT 2 * count(*) + 1000 FROM events)) r(t)),
      placed AS (
        SELECT txn_id, wanted, abort,
               coalesce(sum(CASE WHEN abort THEN 0 ELSE wanted END) OVER (
                 ORDER BY txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_record
        FROM draws),
      plan AS (
        SELECT txn_id, abort, first_record,
               least(wanted, (SELECT count(*) FROM events) - first_record) AS n
        FROM placed WHERE first_record < (SELECT count(*) FROM events))
      SELECT txn_id, cast(i AS integer) AS place, abort, event_id, event_type,
             '{{"abort":"' || CASE WHEN abort THEN 'true' ELSE 'false' END || '","name":"' || {_name('event_id')}
             || '","age":' || {_draw(_digest('age', 'event_id'), 1, 8, AGE_RANGE)} || '}}' AS value
      FROM plan, range({MAX_RECORDS_PER_TXN}) r(i), events
      WHERE i < n AND event_id = first_record + i""",
    "exactly_once_sink": DECODED_EVENTS,
    "pending_replay": DECODED_EVENTS,
}

# The streams give the rows of the batch views.
ORACLE["approval_rate_stream"] = ORACLE["approval_rate_minute"]
ORACLE["read_committed_stream"] = ORACLE["read_committed"]
