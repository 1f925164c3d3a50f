"""Compare a job's rows with the rows of its SQL (tests and local checks only)."""

from __future__ import annotations

from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame


def oracle_connection(sf_dir: str) -> Any:
    import duckdb

    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(table: pa.Table) -> list[tuple]:
    columns = [table.column(name).to_pylist() for name in sorted(table.column_names)]
    return sorted(zip(*columns), key=lambda row: tuple((v is not None, str(v)) for v in row))


def _types(schema: pa.Schema) -> dict[str, str]:
    """Column types; all-null columns and string widths do not count."""
    return {
        f.name: str(f.type).replace("large_", "").replace("ns]", "us]") for f in schema
    }


def same_rows(job_result: DataFrame, connection: Any, sql: str | None) -> str | None:
    """None when both give the same rows, else what differs."""
    actual = job_result.toArrow()
    if sql is None:
        return None if actual.num_rows else "no rows"
    expected = connection.execute(sql).to_arrow_table()
    if sorted(actual.column_names) != sorted(expected.column_names):
        return f"columns {sorted(actual.column_names)} != {sorted(expected.column_names)}"
    mine, theirs = _types(actual.schema), _types(expected.schema)
    for name in mine:
        if mine[name] != theirs[name]:
            return f"type of {name}: {mine[name]} != {theirs[name]}"
    if actual.num_rows != expected.num_rows:
        return f"{actual.num_rows} rows != {expected.num_rows} rows"
    for left, right in zip(_rows(actual), _rows(expected)):
        if left != right:
            return f"{left} != {right}"
    return None
