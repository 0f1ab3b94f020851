"""Joins with a side whose size is checked first."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.session import cut_lineage


#: Rows of a partition of short rows; the least number of partitions that a table is drawn together to.
PART_ROWS, LEAST_PARTS = 50_000, 8


def few(df: DataFrame, rows: int, each: int = PART_ROWS) -> DataFrame:
    """The same rows in no more partitions than about so many of them need.

    A small table in hundreds of partitions costs a task and files for each of them in every step. ``rows`` only sets the
    number of partitions: more rows make these larger, and none is left out.
    """
    return df.coalesce(max(LEAST_PARTS, -(-rows // each)))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows, for jobs that run inside: their rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def if_small(side: DataFrame, rows: int, about: int | None = None) -> DataFrame:
    """The side, saved, marked for broadcast if it has at most ``rows`` rows; else for a join by shuffle.

    ``about`` how many rows it has, if that is known beforehand, sets its number of partitions.
    """
    side = cut_lineage(side if about is None else few(side, about))
    return F.broadcast(side) if side.count() <= rows else side.hint("merge")
