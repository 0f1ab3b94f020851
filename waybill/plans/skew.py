"""Joins that keep working when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_per_key(
    rows: DataFrame, per_key: DataFrame, keys: list[str], count: str, unique: str, hot_rows: int = 10_000_000
) -> DataFrame:
    """Left join of ``rows`` with a table that has one row per key and the key's row number in ``count``.

    Keys with more than ``hot_rows`` rows are joined by broadcast. There are at most N / hot_rows of them for N rows,
    so the broadcast side is bounded; their rows are spread over all tasks by ``unique``. All other keys take the
    shuffle join. Every row of ``rows`` comes out once.
    """
    payload = [c for c in per_key.columns if c not in keys and c != count]
    nested = per_key.select(*keys, count, F.struct(*payload).alias("__payload"))
    hot = nested.filter(F.col(count) > hot_rows).select(*keys, F.col("__payload").alias("__hot"))
    cold = nested.filter(F.col(count) <= hot_rows).select(
        *keys, F.lit(-1).cast("bigint").alias("__spread"), F.col("__payload").alias("__cold")
    )
    # A hot row joins nothing on the cold side: its spread value is a bucket of its unique column, never -1.
    spread = F.when(F.col("__hot").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(unique), F.lit(1 << 20)))
    joined = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("__spread", spread.cast("bigint"))
        .join(cold, [*keys, "__spread"], "left")
        .withColumn("__payload", F.coalesce("__hot", "__cold"))
    )
    return joined.select(*[joined[c] for c in rows.columns], *[F.col(f"__payload.{c}").alias(c) for c in payload])
