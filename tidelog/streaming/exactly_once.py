"""Exactly-once processing of a topic, with the ledger as the authority.

For every micro-batch the sink (1) takes the offset ranges of the rows that were
not finished before, (2) claims them in the ledger, (3) writes the output to a
directory named after the ranges, replacing what an earlier attempt left there,
and (4) records the ranges as finished. Readers see only output whose ranges are
finished, so an attempt that dies anywhere leaves nothing visible and is
repeated with the same bounds.

A claim is a file named after the positions that it starts from, and created
exclusively: of two writers that go on from the same positions one is refused at its
claim, before it writes anything. The file holds the claimed ranges, so a claim whose
writer died before the ledger knew of it is finished by the next ``recover``. That
is meant for a writer that is gone: ``recover`` must not be called while another one runs.
Every sink has an output folder of its own.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.ledger import LEDGER_SCHEMA, compact, pending_ranges, range_id, resume_position
from tidelog.operators.offsets import counted_offset_ranges, offset_ranges
from tidelog.sources.topics import (
    EARLIEST, DataLossError, TopicSpec, first_open_slice, format_offsets, read_range,
)
from tidelog.storage import (
    complete_version, create_text, drop_older, exists, newest_version, read_text, scratch, small_table, version_path,
)

# Rows of a ledger file after compaction.
LEDGER_FILE_ROWS = 1_000_000

Process = Callable[[DataFrame], DataFrame]

AFTER_CLAIM = "after_claim"
AFTER_WRITE = "after_write"
AFTER_COMMIT = "after_commit"


class ClaimRefusedError(RuntimeError):
    """Another writer has claimed ranges from the same positions."""


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All ledger events; empty when nothing was written yet."""
    version = newest_version(spark, path)
    if not version:
        return small_table(spark, [], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(version_path(path, version))


def compact_ledger(spark: SparkSession, path: str, as_of: datetime, keep_claims: timedelta = timedelta(days=7)) -> None:
    """Rewrite the ledger as few files (by their rows) without expired history.

    To be called by the writer while it does not run, best before a start. The
    new version takes over when it is complete. Claim files older than ``keep_claims`` go:
    a writer that slept for longer is not refused any more.
    """
    drop_older(spark, f"{path}/claims", as_of - keep_claims)
    version = newest_version(spark, path)
    if version:
        kept = compact(read_ledger(spark, path), as_of.isoformat(sep=" "))
        files = max(1, math.ceil(kept.count() / LEDGER_FILE_ROWS))
        kept.repartition(files).write.mode("overwrite").parquet(version_path(path, version + 1))
        complete_version(spark, path, version + 1)


def read_output(spark: SparkSession, output_path: str, ledger_path: str) -> DataFrame:
    """Output rows of finished ranges.

    A directory is hidden when its range was claimed but, before the directories
    were listed, not finished. A claim is written before any output, so the claims
    read after the listing cover everything listed. Only the last batches can be
    hidden: their names come to the driver and prune the scan, and the finished
    history, which may have expired, is not joined.
    """
    if not newest_version(spark, ledger_path):
        raise ValueError(f"no ledger at {ledger_path}")
    finished = read_ledger(spark, ledger_path).filter("processed").select("range_id")
    output = spark.read.parquet(output_path)
    claimed = read_ledger(spark, ledger_path).filter("NOT processed").select("range_id").distinct()
    hidden = [row[0] for row in claimed.join(finished, "range_id", "left_anti").collect()]
    visible = output.filter(~F.col("range_id").isin(hidden)) if hidden else output
    return visible.drop("range_id")


class ExactlyOnceSink:
    """``foreachBatch`` function of one application on one topic."""

    def __init__(
        self,
        spark: SparkSession,
        *,
        application_id: str,
        topic: str,
        ledger_path: str,
        output_path: str,
        process: Process,
        holes: bool = False,
        persist: bool = False,
        run_id: str | None = None,
        clock: Callable[[], datetime] = _utc_now,
        on_stage: Callable[[str, int], None] = lambda stage, batch_id: None,
    ) -> None:
        """``holes`` allows unused offsets (transactional topics): a range then
        starts where the one before ended. Without it a missing offset is an error.
        ``persist`` keeps the rows of a batch between the two jobs that read
        them, for sources that are slow to read twice; the first job reads two
        columns only. ``on_stage`` is called between the steps.
        """
        self.spark = spark
        self.application_id = application_id
        self.topic = topic
        self.ledger_path = ledger_path
        self.output_path = output_path
        self.process = process
        self.holes = holes
        self.persist = persist
        self.run_id = run_id or uuid.uuid4().hex
        self.clock = clock
        self.on_stage = on_stage
        self.positions: dict[int, int] = {}

    def recover(self, spec: TopicSpec) -> None:
        """Finish claimed ranges of the topic, then load the positions.

        A claim whose records are no longer all there is not finished, but an error.
        :meth:`resume` gives the spec of a stream that starts after the positions.
        """
        events = read_ledger(self.spark, self.ledger_path).filter(
            (F.col("application_id") == self.application_id) & (F.col("topic") == self.topic)
        )
        # One row per topic partition of each unfinished batch; a single writer
        # leaves at most one such batch.
        claims: dict[str, list] = {}
        for row in pending_ranges(events).collect():
            claims.setdefault(row["range_id"], []).append(row)
        for name, rows in claims.items():
            start = {r["partition"]: r["from_offset"] for r in rows}
            end = {r["partition"]: r["until_offset"] for r in rows}
            batch = read_range(self.spark, spec, start, end)
            ranges = [(r["partition"], r["from_offset"], r["until_offset"], r["n"]) for r in rows]
            self._require_claimed(batch, ranges)
            self._write_and_commit(batch, name, ranges, rows[0]["batch_id"])
        events = read_ledger(self.spark, self.ledger_path)
        self.positions = {
            row["partition"]: row["next_offset"]
            for row in resume_position(events, self.application_id, self.topic).collect()
        }
        # A claim from these positions that never reached the ledger.
        while exists(self.spark, path := self._claim_path()):
            claim = json.loads(read_text(self.spark, path))
            ranges = [tuple(r) for r in claim["ranges"]]
            batch = read_range(self.spark, spec, {p: lo for p, lo, _, _ in ranges}, {p: hi for p, _, hi, _ in ranges})
            self._require_claimed(batch, ranges)
            self._append_events(claim["range_id"], ranges, claim["batch_id"], processed=False)
            self._write_and_commit(batch, claim["range_id"], ranges, claim["batch_id"])
            self.positions.update({p: hi for p, _, hi, _ in ranges})

    def _claim_path(self) -> str:
        """Positions only rise, so a claim from the same ones has the same name and no other."""
        state = json.dumps([self.application_id, self.topic, sorted(self.positions.items())])
        return f"{self.ledger_path}/claims/{hashlib.sha256(state.encode()).hexdigest()}.json"

    def _claim(self, name: str, ranges: list[tuple], batch_id: int) -> None:
        path = self._claim_path()
        claim = {"run_id": self.run_id, "range_id": name, "batch_id": batch_id, "ranges": ranges}
        if create_text(self.spark, path, json.dumps(claim)):
            return
        other = json.loads(read_text(self.spark, path) or "{}")
        # The same batch tried again by this writer.
        if (other.get("run_id"), other.get("range_id")) != (self.run_id, name):
            raise ClaimRefusedError(f"run {other.get('run_id')} has claimed from the same positions of topic {self.topic!r}")

    def resume(self, spec: TopicSpec, partitions: int | None = None) -> TopicSpec:
        """``spec`` for a stream that goes on after the finished ranges.

        Slices of a file topic that hold nothing after them are not read. A Kafka stream must be told the
        number of ``partitions``, since its start names all of them.
        """
        if spec.kind != "kafka":
            if not self.positions:
                return spec
            first = first_open_slice(self.spark, spec, self.positions)
            return replace(spec, positions=dict(self.positions), first_slice=first)
        if partitions is None:
            raise ValueError("a Kafka stream needs the number of partitions to resume")
        return replace(spec, starting_offsets=self.starting_offsets(partitions))

    def starting_offsets(self, partitions: int) -> str:
        """Start spec of a Kafka stream; a partition that is new starts at its first record."""
        if not self.positions:
            return "earliest"
        return format_offsets(
            self.topic, {p: self.positions.get(p, EARLIEST) for p in range(partitions)}
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fresh = self._not_finished(batch)
        if self.persist:
            fresh = fresh.persist()
        try:
            # One row per topic partition comes to the driver.
            count = offset_ranges if self.holes else counted_offset_ranges
            found = count(fresh, ["partition"]).collect()
            if not found:
                return
            ranges = [
                (r["partition"], self._range_start(r["partition"], r["from_offset"]), r["until_offset"], r["n"])
                for r in found
            ]
            if not self.holes:
                self._require_complete(found)
            name = range_id(self.application_id, [(self.topic, p, lo, hi) for p, lo, hi, _ in ranges])
            self._claim(name, ranges, batch_id)
            self._append_events(name, ranges, batch_id, processed=False)
            self.on_stage(AFTER_CLAIM, batch_id)
            self._write_and_commit(fresh, name, ranges, batch_id)
            self.positions.update({p: hi for p, _, hi, _ in ranges})
        finally:
            if self.persist:
                fresh.unpersist()

    def _not_finished(self, batch: DataFrame) -> DataFrame:
        if not self.positions:
            return batch
        # One row per topic partition, counted on the driver already.
        done = small_table(
            batch.sparkSession, sorted(self.positions.items()), "partition int, next_offset bigint"
        )
        return (
            batch.join(F.broadcast(done), "partition", "left")
            .filter(F.col("next_offset").isNull() | (F.col("offset") >= F.col("next_offset")))
            .select(*batch.columns)
        )

    def _range_start(self, partition: int, first: int) -> int:
        expected = self.positions.get(partition)
        if expected is None or expected == first:
            return first
        if self.holes:
            return expected
        raise DataLossError(f"partition {partition}: expected offset {expected}, found {first}")

    def _require_complete(self, found: list) -> None:
        """A range without holes has every offset exactly once."""
        for r in found:
            if not r["n"] == r["n_different"] == r["until_offset"] - r["from_offset"]:
                raise DataLossError(
                    f"partition {r['partition']}: {r['n']} rows with {r['n_different']} offsets "
                    f"from {r['from_offset']} to {r['until_offset']}"
                )

    def _require_claimed(self, batch: DataFrame, ranges: list[tuple]) -> None:
        """The records read again must be those that were claimed."""
        found = {r["partition"]: r for r in counted_offset_ranges(batch, ["partition"]).collect()}
        for partition, first, until, rows in ranges:
            r = found.get(partition)
            if (r["n"] if r else 0) != rows or (r and r["n_different"] != rows):
                raise DataLossError(
                    f"partition {partition}: {rows} rows were claimed from {first} to {until}, "
                    f"{r['n'] if r else 0} are there"
                )

    def _write_and_commit(self, rows: DataFrame, name: str, ranges: list[tuple], batch_id: int) -> None:
        self.process(rows).write.mode("overwrite").parquet(f"{self.output_path}/range_id={name}")
        self.on_stage(AFTER_WRITE, batch_id)
        self._append_events(name, ranges, batch_id, processed=True)
        self.on_stage(AFTER_COMMIT, batch_id)

    def _append_events(self, name: str, ranges: list[tuple], batch_id: int, processed: bool) -> None:
        now = self.clock()
        rows = [
            (self.application_id, self.topic, p, lo, hi, n, self.run_id, batch_id, name, processed, now)
            for p, lo, hi, n in ranges
        ]
        events = small_table(self.spark, rows, LEDGER_SCHEMA).coalesce(1)
        version = newest_version(self.spark, self.ledger_path)
        events.write.mode("append").parquet(version_path(self.ledger_path, version or 1))
        if not version:
            complete_version(self.spark, self.ledger_path, 1)


def run_exactly_once(stream: DataFrame, sink: ExactlyOnceSink, *, checkpoint: str | None = None, trigger: dict | None = None):
    """Start the stream into the sink.

    Without ``checkpoint`` every start uses a new one: the ledger decides where
    to go on, not the checkpoint. The default trigger takes what is available
    and stops; pass ``{"processingTime": "1 second"}`` for a running job.
    """
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint or scratch(sink.spark, "checkpoint"))
        .foreachBatch(sink)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
