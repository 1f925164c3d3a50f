"""Integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(number: Column, by: int) -> Column:
    """Whole quotient of a ``bigint``, without a detour over doubles."""
    return F.call_function("div", number.cast("bigint"), F.lit(by).cast("bigint"))
