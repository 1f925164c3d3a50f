"""Row-level stream writer: open, process each row, close."""

from __future__ import annotations

import base64
import json
import uuid
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.storage import child_names, qualified, scratch, shared_dir, ship_package


# Names of file systems here and in the library that writes.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _plain(value: Any) -> Any:
    """A JSON value that Spark reads back as the same value under the same schema."""
    if isinstance(value, (bytes, bytearray)):
        return base64.b64encode(value).decode("ascii")
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


class RowWriter:
    """Writes rows as JSON lines, one file per partition and epoch.

    Rows go to a file of this attempt; a close without error renames it, so a
    retried partition replaces its file and a failed one leaves none. The path must be one
    that all executors share; :func:`foreach_rows` sees to that.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def open(self, partition_id: int, epoch_id: int) -> bool:
        scheme, _, rest = self.path.partition(":")
        uri = f"{SCHEMES[scheme]}://{rest.removeprefix('//')}"
        self.files, base = fs.FileSystem.from_uri(uri)
        self.files.create_dir(base, recursive=True)
        self.target = f"{base}/part-{epoch_id:08d}-{partition_id:06d}.json"
        self.attempt = f"{base}/_attempt-{uuid.uuid4().hex}"
        self.stream = self.files.open_output_stream(self.attempt)
        return True

    def process(self, row: Row) -> None:
        self.stream.write((json.dumps(self.render(row)) + "\n").encode("utf-8"))

    def render(self, row: Row) -> Any:
        """The JSON value of one row."""
        return _plain(row.asDict(recursive=True))

    def close(self, error: Exception | None) -> None:
        self.stream.close()
        if error is None:
            self.files.move(self.attempt, self.target)
        else:
            self.files.delete_file(self.attempt)


def foreach_rows(
    stream: DataFrame, writer: RowWriter, *, checkpoint: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Send every row of a stream to the writer, on the executors."""
    spark = stream.sparkSession
    writer.path = qualified(spark, writer.path)
    scheme = writer.path.partition(":")[0]
    if scheme not in SCHEMES:
        raise ValueError(f"rows cannot be written to {scheme}:")
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    if scheme == "file" and not local and not writer.path.startswith(qualified(spark, shared_dir(spark))):
        raise ValueError(f"{writer.path} is a folder of each executor; name one below the shared folder")
    ship_package(spark)
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint or scratch(stream.sparkSession, "checkpoint"))
        .foreach(writer)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows written by a :class:`RowWriter`."""
    if not child_names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)
