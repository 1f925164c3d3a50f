"""JSON payloads: text to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERSON_SCHEMA = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())]
)
CORRUPT_COLUMN = "_corrupt_record"


def decode_json(df: DataFrame, column: str, schema: T.StructType | str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus the fields of the JSON text in ``column``.

    Text that is not JSON gives null fields; the row stays.
    """
    parsed = F.from_json(F.col(column).cast("string"), schema)
    return df.select(*keep, parsed.alias("json")).select(*keep, "json.*")


def read_json_text(df: DataFrame, column: str, schema: T.StructType, keep: list[str]) -> DataFrame:
    """Like :func:`decode_json`, and bad text is kept in ``_corrupt_record``."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    parsed = F.from_json(
        F.col(column).cast("string"),
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN},
    )
    return df.select(*keep, parsed.alias("json")).select(*keep, "json.*")


def encode_json(*columns: str | Column) -> Column:
    """The given columns as one JSON object."""
    return F.to_json(F.struct(*columns))
