"""Joins with a side whose size is known only at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.session import cut_lineage

#: Rows of a few short columns that every executor may hold.
BROADCAST_ROWS = 500_000


def counted(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The side, saved; marked for broadcast if it has at most ``rows`` rows, else left to a join by shuffle."""
    side = cut_lineage(side)
    return F.broadcast(side) if side.count() <= rows else side
