"""Append-mode stream to parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidelog.storage import scratch


def append_stream(
    stream: DataFrame,
    path: str,
    *,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append the rows of a stream to a parquet directory.

    Spark's file sink logs finished batches beside the files, so a reader sees
    each batch once. The default trigger takes what is available and stops.
    ``partition_by`` gives rows a directory by these columns, such as good rows and dead
    letters of one stream.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or scratch(stream.sparkSession, "checkpoint"))
        .trigger(**(trigger or {"availableNow": True}))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.start(path)
