"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.storage import scratch

# Characters that separate words: the ASCII blanks, 0x20 and 0x09 to 0x0D.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"

# Rows up to which a table with one row per source may be broadcast; beyond it
# the join shuffles, with skewed partitions split at run time.
BROADCAST_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text as an array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and later
    joins know its size. Lost executors cost nothing that was written."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_side(table: DataFrame) -> DataFrame:
    """``table`` (materialized) with a broadcast hint if its row count is within the bound."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table
