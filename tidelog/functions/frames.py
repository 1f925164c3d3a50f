"""Registry-framed Avro records of string fields, as column expressions.

A frame is one zero byte, a 4-byte big-endian schema id and the record body. In
the body every string is a zigzag varint byte length followed by UTF-8 bytes.
All work is done with built-in expressions, so it stays in generated JVM code.
They are written as SQL text, which is parsed at once; built call by call, their
many small terms would take longer to set up than to run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

USER_FIELDS = ("firstname", "lastname")

# Fixed values of the wire format.
MAGIC_HEX = "00"
HEADER_BYTES = 5
MAX_VARINT_BYTES = 5

BAD_MAGIC = "bad_magic"
UNKNOWN_SCHEMA = "unknown_schema"
TRUNCATED = "truncated"
BAD_LENGTH = "bad_length"
BAD_TEXT = "bad_text"


def _varint_sql(number: str) -> str:
    """Bytes of an unsigned varint: seven bits a byte, lowest first, 0x80 on all but the last.

    The bytes are put together as one integer and written once as hex digits.
    """

    def packed(count: int) -> str:
        terms = []
        for i in range(count):
            more = 0x80 if i < count - 1 else 0
            terms.append(f"shiftleft((shiftright({number}, {7 * i}) & 127) | {more}, {8 * (count - 1 - i)})")
        return " | ".join(terms)

    cases = " ".join(
        f"WHEN {number} < {2 ** (7 * count)} THEN {packed(count)}" for count in range(1, MAX_VARINT_BYTES + 1)
    )
    return f"unhex(hex(CASE {cases} END))"


def encode_frame(schema_id: int, *fields: str) -> Column:
    """Framed bytes of one record of the named string columns; null when one is null."""
    parts = [f"X'{MAGIC_HEX}{schema_id:08X}'"]
    for field in fields:
        zigzag = f"(2 * cast(octet_length(`{field}`) AS bigint))"
        parts += [_varint_sql(zigzag), f"encode(`{field}`, 'UTF-8')"]
    return F.expr(f"concat({', '.join(parts)})")


def decode_frames(
    df: DataFrame,
    column: str,
    fields: tuple[str, ...] = USER_FIELDS,
    known_ids: tuple[int, ...] | None = None,
) -> DataFrame:
    """Add ``schema_id``, one string column per field, and ``error``.

    ``error`` is null for a good frame; otherwise the fields are null and
    ``error`` is the reason. Bytes after the last field are ignored.
    """
    unknown = (
        f"WHEN _id NOT IN ({', '.join(map(str, known_ids))}) THEN '{UNKNOWN_SCHEMA}'" if known_ids else ""
    )
    out = df.selectExpr(
        "*",
        f"cast(octet_length(`{column}`) AS bigint) AS _size",
        f"cast(conv(hex(substring(`{column}`, 2, 4)), 16, 10) AS bigint) AS _id",
        f"{HEADER_BYTES + 1}L AS _pos0",
    ).selectExpr(
        "*",
        f"""CASE WHEN _size IS NULL OR _size < {HEADER_BYTES} THEN '{TRUNCATED}'
                 WHEN hex(substring(`{column}`, 1, 1)) <> '{MAGIC_HEX}' THEN '{BAD_MAGIC}'
                 {unknown} END AS _error0""",
    )
    for i in range(len(fields)):
        out = _decode_string(out, column, i)

    last = len(fields)
    names = ["schema_id", *fields, "error"]
    values = [f"CASE WHEN _error{last} IS NULL THEN _id END"]
    values += [f"CASE WHEN _error{last} IS NULL THEN _text{i} END" for i in range(len(fields))]
    values.append(f"_error{last}")
    # A filter on the result must stay above the decoding: pushed down, it would be
    # written out again in terms of every step before it. A generated row stops it.
    pairs = ", ".join(f"'{name}', {value}" for name, value in zip(names, values))
    return out.select(*df.columns, F.expr(f"inline(array(named_struct({pairs})))"))


def _decode_string(df: DataFrame, column: str, i: int) -> DataFrame:
    """Read string ``i`` at ``_pos<i>``; sets ``_text<i>`` and the next position and error."""
    # The five bytes at the position as one 40-bit number, first byte highest.
    word = f"cast(conv(rpad(hex(substring(`{column}`, cast(_pos{i} AS int), 5)), 10, '0'), 16, 10) AS bigint)"

    def byte_shift(k: int) -> int:
        return 8 * (MAX_VARINT_BYTES - 1 - k)

    width = " ".join(
        f"WHEN shiftright(_word{i}, {byte_shift(k)}) & 128 = 0 THEN {k + 1}" for k in range(MAX_VARINT_BYTES)
    )
    zigzag = " ".join(
        f"WHEN {count} THEN "
        + " | ".join(
            f"shiftleft(shiftright(_word{i}, {byte_shift(k)}) & 127, {7 * k})" for k in range(count)
        )
        for count in range(1, MAX_VARINT_BYTES + 1)
    )
    return (
        df.selectExpr("*", f"CASE WHEN _error{i} IS NULL THEN {word} END AS _word{i}")
        .selectExpr("*", f"CASE {width} END AS _width{i}")
        .selectExpr("*", f"CASE _width{i} {zigzag} END AS _zigzag{i}")
        .selectExpr(
            "*",
            f"_pos{i} + _width{i} AS _start{i}",
            f"_pos{i} + _width{i} + shiftright(_zigzag{i}, 1) AS _pos{i + 1}",
        )
        .selectExpr(
            "*",
            f"""CASE WHEN _error{i} IS NOT NULL THEN _error{i}
                     WHEN _pos{i} > _size THEN '{TRUNCATED}'
                     WHEN _width{i} IS NULL THEN '{BAD_LENGTH}'
                     WHEN _start{i} - 1 > _size THEN '{TRUNCATED}'
                     WHEN _zigzag{i} % 2 <> 0 THEN '{BAD_LENGTH}'
                     WHEN _pos{i + 1} - 1 > _size THEN '{TRUNCATED}' END AS _bounds{i}""",
        )
        .selectExpr(
            "*",
            f"""CASE WHEN _bounds{i} IS NULL THEN cast(substring(`{column}`, cast(_start{i} AS int),
                     cast(_pos{i + 1} - _start{i} AS int)) AS string) END AS _text{i}""",
        )
        .selectExpr(
            "*",
            f"""CASE WHEN _bounds{i} IS NOT NULL THEN _bounds{i}
                     WHEN NOT is_valid_utf8(_text{i}) THEN '{BAD_TEXT}' END AS _error{i + 1}""",
        )
    )


def decode_registered(
    df: DataFrame,
    column: str,
    registry: DataFrame,
    fields: tuple[str, ...] = USER_FIELDS,
    topic_column: str = "topic",
) -> DataFrame:
    """:func:`decode_frames` with the schema ids that the registry has for ``<topic>-value``.

    ``registry`` has ``subject`` and ``schema_id``. A frame with another id is unknown,
    whatever its body looks like. The ids of a topic are few; no hint is given, so the
    runtime size of the registry decides between a broadcast and a shuffle.
    """
    known = registry.select(
        F.col("subject").alias("_subject"), F.col("schema_id").cast("bigint").alias("_written_id"), F.lit(True).alias("_known")
    ).distinct()
    written = F.when(
        F.octet_length(column) >= HEADER_BYTES, F.conv(F.hex(F.substring(column, 2, 4)), 16, 10).cast("bigint")
    )
    looked_up = df.withColumn("_subject", F.concat(F.col(topic_column), F.lit("-value"))).withColumn("_written_id", written)
    decoded = decode_frames(looked_up.join(known, ["_subject", "_written_id"], "left"), column, fields)
    unknown = (
        F.col("_known").isNull() & F.col("_written_id").isNotNull() & ~F.coalesce(F.col("error") == BAD_MAGIC, F.lit(False))
    )
    return decoded.select(
        *df.columns,
        *[F.when(~unknown, F.col(c)).alias(c) for c in ("schema_id", *fields)],
        F.when(unknown, F.lit(UNKNOWN_SCHEMA)).otherwise(F.col("error")).alias("error"),
    )


def dead_letters(decoded: DataFrame) -> DataFrame:
    """The rows of a decoded frame table that could not be read."""
    return decoded.filter(F.col("error").isNotNull())


def latest_schema(registry: DataFrame) -> DataFrame:
    """Newest ``(subject, version, schema_id)`` row of each subject."""
    return registry.groupBy("subject").agg(
        F.max("version").alias("version"), F.max_by("schema_id", "version").alias("schema_id")
    )


def with_reader_schema(records: DataFrame, registry: DataFrame, topic_column: str = "topic") -> DataFrame:
    """Add ``version`` and ``reader_schema_id``: the newest schema of ``<topic>-value``.

    The registry is one row per subject after the group-by; no hint is given, so
    the runtime size decides between a broadcast and a shuffle. A topic without
    a subject keeps nulls.
    """
    subject = F.concat(F.col(topic_column), F.lit("-value"))
    latest = latest_schema(registry).withColumnRenamed("schema_id", "reader_schema_id")
    return records.withColumn("subject", subject).join(latest, "subject", "left")
