"""Per-row calls with bounded concurrency inside each partition."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.storage import ship_package

# Calls in flight per partition and seconds to wait for a result.
IN_FLIGHT = 49
TIMEOUT_SECONDS = 10.0

# Rows turned into Python values, and results handed back to Spark, at a time.
INPUT_ROWS = 256
OUTPUT_ROWS = 1000


def _results(
    batches: Iterator[pa.RecordBatch], submit: Callable[[dict], Any], in_flight: int, timeout: float
) -> Iterator[Any]:
    """Results in input order while at most ``in_flight`` calls are pending."""
    pending: deque = deque()
    for batch in batches:
        for start in range(0, batch.num_rows, INPUT_ROWS):
            for row in batch.slice(start, INPUT_ROWS).to_pylist():
                if len(pending) >= in_flight:
                    yield pending.popleft().result(timeout=timeout)
                pending.append(submit(row))
    while pending:
        yield pending.popleft().result(timeout=timeout)


def map_async(
    df: DataFrame,
    make_client: Callable[[], Any],
    call: Callable[[Any, dict], dict],
    schema: T.StructType | str,
    *,
    in_flight: int = IN_FLIGHT,
    timeout: float = TIMEOUT_SECONDS,
    close: Callable[[Any], None] | None = None,
) -> DataFrame:
    """``call(client, row)`` for every row; results keep the order of the rows.

    Each partition makes one client, keeps up to ``in_flight`` calls running in
    threads, and closes the client when the partition ends, also after an error
    and for an empty partition. A call that takes longer than ``timeout`` fails
    the task; Spark then runs the partition again, so calls must be repeatable. Rows
    are plain Python values: integers keep all their digits, nulls are None.
    """
    ship_package(df.sparkSession)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow_schema = to_arrow_schema(schema)

    def run_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()
        pool = ThreadPoolExecutor(max_workers=in_flight)
        try:
            rows: list[dict] = []
            for result in _results(batches, lambda row: pool.submit(call, client, row), in_flight, timeout):
                rows.append(result)
                if len(rows) >= OUTPUT_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)
        finally:
            pool.shutdown(wait=False, cancel_futures=True)
            if close is not None:
                close(client)

    return df.mapInArrow(run_partition, schema)


def foreach_async(
    df: DataFrame,
    make_client: Callable[[], Any],
    call: Callable[[Any, dict], Any],
    key: str,
    *,
    in_flight: int = IN_FLIGHT,
    timeout: float = TIMEOUT_SECONDS,
    close: Callable[[Any], None] | None = None,
) -> DataFrame:
    """Run ``call`` for its side effect and give one receipt ``(key, done)`` per row.

    The calls run when the receipts are read or written, and every row is awaited.
    """
    key_field = df.schema[key]
    schema = T.StructType([key_field, T.StructField("done", T.BooleanType())])

    def with_receipt(client: Any, row: dict) -> dict:
        call(client, row)
        return {key: row[key], "done": True}

    return map_async(
        df, make_client, with_receipt, schema, in_flight=in_flight, timeout=timeout, close=close
    )
