"""Stored summaries of distributions, one per group and minute, that merge to any longer range.

A summary holds count, sum, largest value and a KLL sketch, so percentiles of an hour, a day or of all groups together come
from the minutes alone, without the observations. A sketch of size ``k`` has some thousand bytes at most, whatever it has
seen. Its quantiles are exact as long as it has seen no more than ``k`` values; beyond that the rank of a quantile is off
by at most ``rank_error(k)`` in 99 % of the cases, merged or not. Sketches are merged by partial aggregates before the
shuffle, so a group with very many minutes costs one row per task.

Rows without a time or a value are no observations. A null group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of the sketches: the rank error is 0.13 %.
SKETCH = 4096
MEASURES = "minute_us BIGINT, n BIGINT, total DOUBLE, most DOUBLE, sketch BINARY"
MINUTE = 60_000_000


def rank_error(k: int = SKETCH) -> float:
    """Rank error of a single quantile at 99 % confidence, as published for these sketches."""
    return 2.296 / k**0.9021


def _measures(value: Column, k: int) -> list[Column]:
    value = value.cast("double")
    return [F.count(value).alias("n"), F.sum(value).alias("total"), F.max(value).alias("most"), F.kll_sketch_agg_double(value, k).alias("sketch")]


def minutes(df: DataFrame, group: list[str], ts: str, value: str, k: int = SKETCH) -> DataFrame:
    """One summary per group and minute."""
    known = df.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
    minute = F.floor(F.unix_micros(ts) / F.lit(MINUTE)).cast("bigint") * MINUTE
    return known.groupBy(*group, minute.alias("minute_us")).agg(*_measures(F.col(value), k))


def stream_minutes(stream: DataFrame, group: list[str], ts: str, value: str, delay: str, k: int = SKETCH) -> DataFrame:
    """The same on a stream: a minute is written once the watermark has passed it."""
    known = stream.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).withWatermark(ts, delay)
    wide = known.groupBy(F.window(ts, "1 minute").alias("w"), *group).agg(*_measures(F.col(value), k))
    return wide.select(*group, F.unix_micros("w.start").alias("minute_us"), "n", "total", "most", "sketch")


def with_day(summaries: DataFrame) -> DataFrame:
    """With the column that directories are made of, so that a range of time reads its own days only."""
    return summaries.withColumn("day", F.to_date(F.timestamp_micros("minute_us")))


def save(summaries: DataFrame, path: str) -> None:
    with_day(summaries).write.mode("append").partitionBy("day").parquet(path)


def stored(spark: SparkSession, path: str, group_schema: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Summaries of minutes in [start, end). Only the days that the range touches are listed in the plan."""
    rows = spark.read.schema(f"{group_schema}, {MEASURES}, day DATE").parquet(path)
    minute = F.timestamp_micros("minute_us")
    if start is not None:
        rows = rows.where((F.col("day") >= F.to_date(start)) & (minute >= start))
    if end is not None:
        rows = rows.where((F.col("day") <= F.to_date(end)) & (minute < end))
    return rows.drop("day")


def merged(summaries: DataFrame, group: Sequence[str | Column], k: int = SKETCH) -> DataFrame:
    """One summary for each group of summaries."""
    return summaries.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )


def with_quantiles(summaries: DataFrame, ranks: dict[str, float]) -> DataFrame:
    """Quantiles in place of the sketch: the smallest value whose rank reaches the given one."""
    found = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(rank))) for name, rank in ranks.items()}
    return summaries.withColumns(found).drop("sketch")
