"""Ordered work over groups of any size.

A window over one hot group runs in one task. These helpers cut each group into slices of its ordering column,
summarise each (group, slice) cell with a partial aggregate, combine the few cells of a group in order, and finish
inside the cells. The rows one task sees are those of one cell, never those of one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"


def with_cells(sliced: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with what its cell carries. A null group and a null slice are groups and slices like others."""
    named = cells.select(*[F.col(k).alias(f"__cell_{k}") for k in keys], *[c for c in cells.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__cell_{k}")) for k in keys]
    return sliced.join(named, same).drop(*[f"__cell_{k}" for k in keys])


def id_slice(id_column: Column, rows: int) -> Column:
    """Slices of a unique id: as ids are unique, no slice holds more than ``rows`` rows."""
    return F.floor(id_column / F.lit(rows)).cast("bigint")


def time_slice(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def ranked(df: DataFrame, group: list[str], order: list[str], slice_: Column, name: str) -> DataFrame:
    """``row_number`` per group, starting at one. ``slice_`` must not decrease along ``order``."""
    sliced = df.withColumn(SLICE, slice_)
    cells = sliced.groupBy(*group, SLICE).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*group, SLICE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*group, SLICE).orderBy(*order)
    return (
        with_cells(sliced, offsets, [*group, SLICE])
        .withColumn(name, F.col("__before") + F.row_number().over(inside))
        .drop(SLICE, "__before")
    )


def previous(df: DataFrame, group: list[str], order: str, slice_: Column, value: str, name: str) -> DataFrame:
    """``lag(value)`` per group in ``order``, which must be unique inside the group."""
    sliced = df.withColumn(SLICE, slice_)
    # Of a slice of rows without an order, which come first, any row is its last one.
    cells = sliced.groupBy(*group, SLICE).agg(F.max_by(value, F.struct(order)).alias("__last"))
    along = Window.partitionBy(*group).orderBy(SLICE)
    carried = cells.select(*group, SLICE, F.lag("__last").over(along).alias("__carry"))
    inside = Window.partitionBy(*group, SLICE).orderBy(order)
    return (
        with_cells(sliced, carried, [*group, SLICE])
        .withColumn("__rn", F.row_number().over(inside))
        .withColumn(name, F.when(F.col("__rn") == 1, F.col("__carry")).otherwise(F.lag(value).over(inside)))
        .drop(SLICE, "__carry", "__rn")
    )


def last_seen(df: DataFrame, group: list[str], order: list[str], slice_: Column, value: str, name: str) -> DataFrame:
    """The newest non-null ``value`` of the group up to and including each row: an as-of lookup."""
    sliced = df.withColumn(SLICE, slice_)
    cells = sliced.groupBy(*group, SLICE).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("__last")
    )
    before = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.select(*group, SLICE, F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    inside = Window.partitionBy(*group, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        with_cells(sliced, carried, [*group, SLICE])
        .withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("__carry")))
        .drop(SLICE, "__carry")
    )
