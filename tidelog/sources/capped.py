"""A file topic as a stream of offset ranges with a cap in records.

The file stream of Spark takes whole files. Here a Python data source keeps an offset for
each partition, looks into the slice index of the topic and gives the ranges of the
next micro-batch, no more records in all than the cap; partitions share it by what
they have waiting. Only ranges pass through it, one row a partition: the records of a
batch are then read by Spark from the files that the ranges prune to.

Positions, not a checkpoint, say where a stream goes on. The cap counts offsets, so holes
count as records. Records that were published late, below the positions, are not seen.
The index is read by the driver's Python, through pyarrow's file systems.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator

import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from tidelog.sources.topics import TopicSpec, index_path, next_offsets, read_range
from tidelog.storage import qualified, scratch, ship_package

SOURCE = "topic_ranges"


def shares(waiting: dict[int, int], cap: int) -> dict[int, int]:
    """How many of the waiting records each partition gives: all, or parts of the cap by size.

    Parts are rounded down; what that leaves goes to the largest remainders, so that any cap
    of 1 or more moves on."""
    total = sum(waiting.values())
    if total <= cap:
        return dict(waiting)
    given = {p: cap * n // total for p, n in waiting.items()}
    order = sorted(waiting, key=lambda p: (-(cap * waiting[p] % total), p))
    for p in order[:cap - sum(given.values())]:
        given[p] += 1
    return given


def _ends(path: str) -> dict[int, int]:
    """The offset after the last one of each partition, from the files of a slice index."""
    files, place = pafs.FileSystem.from_uri(path)
    if files.get_file_info(place).type == pafs.FileType.NotFound:
        return {}
    found = ds.dataset(place, filesystem=files, format="parquet", exclude_invalid_files=False).to_table(columns=["partition", "last"])
    ends: dict[int, int] = {}
    for row in found.group_by("partition").aggregate([("last", "max")]).to_pylist():
        ends[row["partition"]] = row["last_max"] + 1
    return ends


class _Ranges(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.cap = options["index"], int(options["cap"])
        self.start = {str(p): int(o) for p, o in json.loads(options["positions"]).items()}

    def initialOffset(self) -> dict:
        return self.start

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        ends = _ends(self.path)
        waiting = {p: end - int(start.get(str(p), 0)) for p, end in ends.items()}
        given = shares({p: n for p, n in waiting.items() if n > 0}, self.cap)
        end = {**start, **{str(p): int(start.get(str(p), 0)) + n for p, n in given.items()}}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        ranges = [(int(p), int(start.get(p, 0)), int(end[p])) for p in sorted(end, key=int)]
        return iter([r for r in ranges if r[2] > r[1]])


class TopicRanges(DataSource):
    """Options: ``index`` (path), ``cap`` (records a trigger) and ``positions`` (JSON)."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "partition int, from_offset bigint, until_offset bigint"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Ranges(dict(self.options))


def capped_ranges(spark: SparkSession, spec: TopicSpec, cap: int, positions: dict[int, int] | None = None) -> DataFrame:
    """Stream of ``partition, from_offset, until_offset``: ``cap`` records a trigger at most."""
    if cap < 1:
        raise ValueError("the cap must be one record at least")
    ship_package(spark)
    spark.dataSource.register(TopicRanges)
    options = {"index": qualified(spark, index_path(spec)), "cap": str(cap), "positions": json.dumps(positions or {})}
    return spark.readStream.format(SOURCE).options(**options).load()


def run_capped(
    spark: SparkSession, spec: TopicSpec, cap: int, function: Callable[[DataFrame, int], None], *,
    positions: dict[int, int] | None = None, trigger: str = "0 seconds", until_now: bool = True,
) -> StreamingQuery:
    """Call ``function(records, batch_id)`` for micro-batches of at most ``cap`` records.

    An exactly-once sink is such a function. ``until_now`` stops the query when it has passed
    what the topic held at the start, and waits for that; else it goes on.
    """
    target = next_offsets(spark, spec) if until_now else {}
    done = threading.Event()
    reached = {p: (positions or {}).get(p, 0) for p in target}

    def batch(ranges: DataFrame, batch_id: int) -> None:
        # One row per topic partition.
        rows = ranges.collect()
        start = {r["partition"]: r["from_offset"] for r in rows}
        end = {r["partition"]: r["until_offset"] for r in rows}
        if rows:
            function(read_range(ranges.sparkSession, spec, start, end), batch_id)
        reached.update(end)
        if until_now and all(reached.get(p, 0) >= o for p, o in target.items()):
            done.set()

    query = (
        capped_ranges(spark, spec, cap, positions).writeStream.foreachBatch(batch)
        .option("checkpointLocation", scratch(spark, "checkpoint")).trigger(processingTime=trigger).start()
    )
    if until_now and target and any(reached[p] < o for p, o in target.items()):
        while query.isActive and not done.wait(0.2):
            pass
        if query.exception() is not None:
            raise query.exception()
    if until_now:
        query.stop()
    return query
