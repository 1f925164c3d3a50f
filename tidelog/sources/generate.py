"""Synthetic payloads and transactions, repeatable for a given seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.numbers import int_div
from tidelog.functions.payloads import encode_json
from tidelog.operators.prefix import prefix_sum

# Fixed values of the generator: name alphabet and length, age range, abort threshold,
# records per transaction.
NAME_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
NAME_LENGTH = 10
AGE_RANGE = 99
ABORT_RANGE = 100
ABORT_ABOVE = 50
MAX_RECORDS_PER_TXN = 3


def _digest(seed: int, purpose: str, index: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), index.cast("string")))


def _draw(digest: Column, start: int, digits: int, below: int) -> Column:
    number = F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")
    return (number % below).cast("int")


def random_name(index: Column, seed: int) -> Column:
    """Ten letters and digits that depend on the index and the seed only."""
    # Ten base-62 digits of one number below 2 ** 60, which is above 62 ** 10.
    number = F.conv(F.substring(_digest(seed, "name", index), 1, 15), 16, 10).cast("bigint")
    base = len(NAME_ALPHABET)
    letters = [
        F.substring(F.lit(NAME_ALPHABET), (int_div(number, base**i) % base).cast("int") + 1, F.lit(1))
        for i in range(NAME_LENGTH)
    ]
    return F.concat(*letters)


def random_age(index: Column, seed: int) -> Column:
    return _draw(_digest(seed, "age", index), 1, 8, AGE_RANGE)


def payload_columns(index: Column, seed: int) -> list[Column]:
    return [random_name(index, seed).alias("name"), random_age(index, seed).alias("age")]


def generate_payloads(df: DataFrame, index: str, seed: int, abort: Column | None = None) -> DataFrame:
    """One ``{"name": ..., "age": ...}`` message per row of ``df``.

    With ``abort`` (a boolean), messages start with its text: ``{"abort": "true", ...}``.
    """
    flag = [] if abort is None else [abort.cast("string").alias("abort")]
    fields = [*["abort" for _ in flag], "name", "age"]
    return df.select(index, *flag, *payload_columns(F.col(index), seed)).withColumn("value", encode_json(*fields))


def transaction_plan(candidates: DataFrame, size: int, seed: int) -> DataFrame:
    """Transactions that send ``size`` records in order until all are committed.

    ``candidates`` has one row per transaction number ``txn_id`` from 0. Each
    transaction sends one to three records, never more than are left; about half
    abort, and the next transaction sends the same records again. Gives
    ``(txn_id, n, abort, first_record)``. The candidates are the numbers below
    :func:`candidates_needed`.
    """
    draws = candidates.select(
        "txn_id",
        (_draw(_digest(seed, "count", F.col("txn_id")), 1, 8, MAX_RECORDS_PER_TXN) + 1).alias("wanted"),
        (_draw(_digest(seed, "abort", F.col("txn_id")), 1, 8, ABORT_RANGE) > ABORT_ABOVE).alias("abort"),
    )
    # Only committed records advance the position, and the cap of the last
    # transaction changes no earlier position, so a plain prefix sum places them all.
    placed = prefix_sum(
        draws.withColumn("committed", F.when(F.col("abort"), 0).otherwise(F.col("wanted")).cast("bigint")),
        index="txn_id",
        value="committed",
        result="until_record",
        max_index=candidates_needed(size) - 1,
    )
    position = F.col("until_record") - F.col("committed")
    exhausted = (F.col("txn_id") == candidates_needed(size) - 1) & (F.col("until_record") < size)
    return (
        placed.withColumn("first_record", position)
        .filter(F.col("first_record") < size)
        .select(
            "txn_id",
            F.when(exhausted, F.raise_error(F.lit("not enough candidate transactions")).cast("bigint"))
            .otherwise(F.least(F.col("wanted").cast("bigint"), F.lit(size) - F.col("first_record")))
            .alias("n"),
            "abort",
            "first_record",
        )
    )


def candidates_needed(size: int) -> int:
    """Transaction numbers to consider for ``size`` committed records.

    A transaction commits 1.02 records on average; the margin is many times the
    spread of the sum, and :func:`transaction_plan` fails if it is not enough.
    """
    return size + size // 10 + 1000


def generate_transactions(records: DataFrame, index: str, size: int, seed: int) -> DataFrame:
    """Send every row of ``records`` through aborting and committing transactions.

    ``index`` numbers the rows 0 to ``size - 1``. The result has one row per
    record sent: ``txn_id``, place ``i`` in the transaction, ``abort``, and the
    columns of ``records``, and the message with the abort flag as ``value``. Each row is
    committed exactly once.
    """
    spark = records.sparkSession
    candidates = spark.range(candidates_needed(size)).withColumnRenamed("id", "txn_id")
    plan = transaction_plan(candidates, size, seed)
    sent = plan.select(
        "txn_id",
        "abort",
        F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("i"),
        "first_record",
    ).withColumn(index, F.col("first_record") + F.col("i"))
    joined = sent.drop("first_record").join(records, index)
    name, age = payload_columns(F.col(index), seed)
    message = F.to_json(F.struct(F.col("abort").cast("string").alias("abort"), name, age))
    return joined.withColumn("value", message)
