"""Lifecycle events of streaming queries as a table."""

from __future__ import annotations

import itertools
import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.storage import child_names, write_text

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("exception", T.StringType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("observed", T.StringType()),
    ]
)


class ProgressRecorder(StreamingQueryListener):
    """Writes started, progress and terminated events as JSON lines.

    Events arrive on another thread after the batch they tell about, so they
    serve monitoring only; offsets belong in the ledger. A file holds up to ``file_events``
    events, or those of ``seconds``; the end of a query closes it. Events that are not written
    yet are lost with the driver.
    """

    def __init__(self, spark: SparkSession, path: str, file_events: int = 100, seconds: float = 60.0) -> None:
        self.spark = spark
        self.path = path
        self._file_events, self._seconds = file_events, seconds
        self._waiting: list[str] = []
        self._since = time.monotonic()
        self._prefix = uuid.uuid4().hex
        self._numbers = itertools.count()
        self._terminated: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _record(self, last: bool = False, **event) -> None:
        with self._lock:
            self._waiting.append(json.dumps(event))
            full = len(self._waiting) >= self._file_events or time.monotonic() - self._since >= self._seconds
            if not (last or full):
                return
            lines, self._waiting, self._since = self._waiting, [], time.monotonic()
        file_name = f"{self._prefix}-{next(self._numbers):08d}.json"
        write_text(self.spark, f"{self.path}/{file_name}", "\n".join(lines) + "\n")

    def _flag(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._terminated.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._record(kind="started", id=str(event.id), run_id=str(event.runId), name=event.name)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._record(
            kind="progress",
            id=str(progress.id),
            run_id=str(progress.runId),
            name=progress.name,
            batch_id=progress.batchId,
            input_rows=progress.numInputRows,
            duration_ms=progress.batchDuration,
            late_rows=sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators),
            observed=json.dumps({name: row.asDict() for name, row in progress.observedMetrics.items()}, default=str),
        )

    def onQueryTerminated(self, event) -> None:
        self._record(
            last=True, kind="terminated", id=str(event.id), run_id=str(event.runId), exception=event.exception
        )
        self._flag(str(event.runId)).set()

    def onQueryIdle(self, event) -> None:
        pass

    def wait_terminated(self, run_id: str, seconds: float = 60.0) -> bool:
        """Wait until the last event of a run was recorded."""
        return self._flag(run_id).wait(seconds)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    if not child_names(spark, path):
        return spark.createDataFrame([], EVENT_SCHEMA)
    return spark.read.schema(EVENT_SCHEMA).json(path)


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """Batches, input rows, durations and state of each query run."""
    return (
        read_events(spark, path)
        .groupBy("id", "run_id")
        .agg(
            F.max("name").alias("name"),
            F.count_distinct(F.when(F.col("kind") == "progress", F.col("batch_id"))).alias("batches"),
            F.sum("input_rows").alias("input_rows"),
            F.sum("duration_ms").alias("duration_ms"),
            F.sum("late_rows").alias("late_rows"),
            F.max(F.when(F.col("kind") == "terminated", True).otherwise(False)).alias("terminated"),
            F.max("exception").alias("exception"),
        )
    )


RANGES = "ranges"


def observe_ranges(stream: DataFrame, partitions: int) -> DataFrame:
    """``stream`` with the offset range and count of each topic partition as observed metrics.

    They are counted while the rows pass, without a job of their own, and arrive with the progress
    events: three numbers a partition and batch.
    """
    metrics = []
    for p in range(partitions):
        here = F.col("partition") == p
        metrics += [F.min(F.when(here, F.col("offset"))).alias(f"first_{p}"), F.max(F.when(here, F.col("offset"))).alias(f"last_{p}"),
                    F.count(F.when(here, True)).alias(f"n_{p}")]
    return stream.observe(RANGES, *metrics)


def observed_ranges(events: DataFrame, partitions: int) -> DataFrame:
    """``run_id, batch_id, partition, from_offset, until_offset, n`` from progress events."""
    kind = "struct<" + ", ".join(f"first_{p}: bigint, last_{p}: bigint, n_{p}: bigint" for p in range(partitions)) + ">"
    body = F.from_json("observed", f"{RANGES} {kind}")[RANGES]
    each = F.array(*[
        F.struct(F.lit(p).alias("partition"), body[f"first_{p}"].alias("from_offset"), (body[f"last_{p}"] + 1).alias("until_offset"), body[f"n_{p}"].alias("n"))
        for p in range(partitions)
    ])
    rows = events.filter("kind = 'progress' AND observed IS NOT NULL").select("run_id", "batch_id", F.explode(each).alias("r"))
    return rows.select("run_id", "batch_id", "r.*").filter("n > 0")
