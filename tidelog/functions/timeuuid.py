"""Version-1 (time-ordered) UUID text made from, and read back to, a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.clock import epoch_micros, from_epoch_micros
from tidelog.functions.numbers import int_div

# Fixed value: 100-nanosecond steps between 1582-10-15 (UUID epoch) and 1970-01-01.
UUID_EPOCH_STEPS = 122_192_928_000_000_000


def timeuuid(ts: Column, identity: Column) -> Column:
    """UUID text whose time is ``ts`` and whose clock and node come from ``identity``.

    The same row always gives the same UUID, so a retried task writes the same
    value. ``identity`` should differ between rows that share a timestamp.
    """
    steps = F.lpad(F.hex(epoch_micros(ts) * 10 + F.lit(UUID_EPOCH_STEPS)), 15, "0")
    digest = F.md5(identity.cast("string"))
    # Variant digit 8, 9, a or b, then a node id that has its multicast bit set.
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 1, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    multicast = F.substring(
        F.lit("13579bdf"), (F.conv(F.substring(digest, 5, 1), 16, 10).cast("int") % 8) + 1, F.lit(1)
    )
    return F.lower(
        F.concat(
            F.substring(steps, 8, 8), F.lit("-"),
            F.substring(steps, 4, 4), F.lit("-1"),
            F.substring(steps, 1, 3), F.lit("-"),
            variant, F.substring(digest, 2, 3), F.lit("-"),
            F.substring(digest, 6, 1), multicast, F.substring(digest, 7, 10),
        )
    )


def timeuuid_time(uuid: Column) -> Column:
    """The ``timestamp_ntz`` held in version-1 UUID text."""
    steps = F.conv(
        F.concat(F.substring(uuid, 16, 3), F.substring(uuid, 10, 4), F.substring(uuid, 1, 8)), 16, 10
    ).cast("bigint")
    return from_epoch_micros(int_div(steps - UUID_EPOCH_STEPS, 10))
