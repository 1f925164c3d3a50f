"""Read-committed visibility on a topic that carries transactions."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "commit"
ABORT = "abort"


def with_state(records: DataFrame, markers: DataFrame) -> DataFrame:
    """Records with the ``state`` of their transaction; null while it is open."""
    states = markers.groupBy("partition", "txn_id").agg(F.max("state").alias("state"))
    return records.join(states, ["partition", "txn_id"], "left")


def last_stable_offsets(stated: DataFrame) -> DataFrame:
    """First offset of the oldest open transaction, per partition that has one."""
    return (
        stated.filter(F.col("state").isNull())
        .groupBy("partition").agg(F.min("offset").alias("stable_until"))
    )


def read_committed(records: DataFrame, markers: DataFrame) -> DataFrame:
    """Records of committed transactions below the partition's last stable offset.

    ``records`` has ``(partition, offset, txn_id, ...)`` and ``markers`` a row
    ``(partition, txn_id, state)`` per finished transaction. Records meet the markers in
    one join, which gives the committed ones and those of open transactions. The last stable
    offsets are one row per topic partition and are broadcast.
    """
    stated = with_state(records, markers)
    stable = F.broadcast(last_stable_offsets(stated))
    return (
        stated.filter(F.col("state") == COMMIT)
        .join(stable, "partition", "left")
        .filter(F.col("stable_until").isNull() | (F.col("offset") < F.col("stable_until")))
        .select(*records.columns)
    )


# --- as a stream ------------------------------------------------------------------


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def release(held: pd.DataFrame, markers: pd.DataFrame, marker: str) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Records that become visible, and those that are held on.

    ``held`` has the records of a partition that were not given yet; its column ``marker`` is
    the state of their transaction, null while it is open, and is set from the markers.
    """
    states = dict(zip(markers["txn_id"], markers[marker]))
    found = held["txn_id"].map(states)
    held = held.assign(**{marker: held[marker].where(held[marker].notna(), found)})
    open_offsets = held.loc[held[marker].isna(), "offset"]
    below = held["offset"] < open_offsets.min() if len(open_offsets) else pd.Series(True, index=held.index)
    visible = held[below & (held[marker] == COMMIT)].sort_values("offset")
    # Aborted records are dropped at once; the others wait for the oldest open transaction.
    return visible, held[~below & (held[marker] != ABORT)]


def read_committed_stream(log: DataFrame, marker: str = "state") -> DataFrame:
    """Read-committed view of a streamed log of records and markers.

    ``log`` has ``partition, offset, txn_id``, the column ``marker`` (null for records, ``commit`` or
    ``abort`` for the marker that ends a transaction) and any others. A partition comes in
    the order of its log; within a micro-batch rows may be in any order. A record is
    given once its transaction is committed and no older one is open any more, so that what
    was given when the stream ends is :func:`read_committed` of what has come.

    The state of a partition are the records from its oldest open transaction on, as
    in any reader of such a log; what is visible or aborted leaves it.
    """
    columns = [f for f in log.schema.fields if f.name != marker]
    names = [f.name for f in columns]

    def step(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts), ignore_index=True)
        ends = rows[marker].notna()
        new = rows[~ends]
        held = pd.concat([_unpacked(state.get[0]), new], ignore_index=True) if state.exists else new
        if not len(held):
            return
        visible, held = release(held, rows[ends], marker)
        if len(held):
            state.update((_packed(held),))
        elif state.exists:
            state.remove()
        if len(visible):
            yield visible[names]

    return log.groupBy("partition").applyInPandasWithState(
        step, T.StructType(columns), "held binary", "append", "NoTimeout"
    )
