"""The most frequent keys of each group, exactly, without counting every key.

First a frequent-items summary of fixed size per group (a mergeable Misra-Gries sketch, built by partial aggregates, which
can be stored per day and merged); then an exact count of the keys that it still holds. A summary that tracks m keys has
``size`` counters, m / 0.75 rounded up to a power of two, and a key that it lost occurs at most 3.5 / size times as often
as its group has rows. So a group's result is proven if its n-th exact count is larger than that, or if the exact
counts add up to all its rows, so that no key was lost. Groups that can't be proven, as their keys are too even, are counted
in full.

Rows without a key are left out; a null group is a group. Ties are ordered by the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.session import cut_lineage

#: Keys that a summary tracks.
TRACKED = 10_000


def counters(tracked: int) -> int:
    return 1 << (-(-tracked * 4 // 3) - 1).bit_length()


def summaries(rows: DataFrame, group: list[str], key: str, tracked: int = TRACKED) -> DataFrame:
    """``group, n, state``: a summary of each group's keys."""
    known = rows.where(F.col(key).isNotNull())
    return known.groupBy(*group).agg(F.count(key).alias("n"), F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("state"))


def merged(parts: DataFrame, group: list[str], tracked: int = TRACKED) -> DataFrame:
    """One summary for each group of summaries."""
    return parts.groupBy(*group).agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"))


def candidates(parts: DataFrame, group: list[str], key: str, tracked: int = TRACKED) -> DataFrame:
    """``group, key, n``: the keys that a summary still holds, at most ``tracked`` of a group, and the group's rows."""
    listed = parts.select(*group, "n", F.expr(f"approx_top_k_estimate(state, {tracked})").alias("found"))
    return listed.select(*group, "n", F.explode(F.col("found.item")).alias(key))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & F.col(f"left.{name}").eqNullSafe(F.col(f"right.{name}"))
    return test


def top(rows: DataFrame, group: list[str], key: str, n: int, tracked: int = TRACKED, parts: DataFrame | None = None) -> DataFrame:
    """``group, key, count, place`` of the ``n`` most frequent keys of each group.

    ``parts``: stored summaries of the same rows, whose groups may be finer; without them they are built here. ``n`` must
    be smaller than ``tracked``.
    """
    if n >= tracked:
        raise ValueError("a summary must track more keys than are asked for")
    known = rows.where(F.col(key).isNotNull()).select(*group, key)
    # One row of fixed size for each group.
    whole = cut_lineage(summaries(rows, group, key, tracked) if parts is None else merged(parts, group, tracked))
    wanted = candidates(whole, group, key, tracked)
    names = [*group, key]
    held = known.alias("left").join(wanted.alias("right"), _same(known, wanted, names)).select(*[F.col(f"left.{c}").alias(c) for c in names], "n")
    exact = cut_lineage(held.groupBy(*names).agg(F.count(F.lit(1)).alias("count"), F.max("n").alias("n")))
    ranked = _placed(exact, group, key, n)
    covered = exact.groupBy(*group).agg(F.sum("count").alias("counted"))
    last = ranked.groupBy(*group).agg(F.when(F.count(F.lit(1)) == n, F.min("count")).otherwise(F.lit(0)).alias("least"))
    found = covered.alias("left").join(last.alias("right"), _same(covered, last, group)).select(*[F.col(f"left.{c}").alias(c) for c in group], "counted", "least")
    # A summary may have lost all its keys, so groups come from the summaries and not from what was found.
    both = whole.select(*group, "n").alias("left").join(found.alias("right"), _same(whole, found, group), "left")
    lost = F.coalesce("counted", F.lit(0)) < F.col("n")
    unproven = both.where(lost & (F.coalesce("least", F.lit(0)) <= F.lit(3.5 / counters(tracked)) * F.col("n")))
    doubtful = cut_lineage(unproven.select(*[F.col(f"left.{c}").alias(c) for c in group]))
    if doubtful.isEmpty():
        return ranked.select(*names, "count", "place")
    again = known.alias("left").join(doubtful.alias("right"), _same(known, doubtful, group), "left_semi")
    counted = _placed(again.groupBy(*names).agg(F.count(F.lit(1)).alias("count")), group, key, n)
    proven = ranked.alias("left").join(doubtful.alias("right"), _same(ranked, doubtful, group), "left_anti")
    return proven.select(*names, "count", "place").unionByName(counted.select(*names, "count", "place"))


def _placed(counted: DataFrame, group: list[str], key: str, n: int) -> DataFrame:
    """Spark keeps the first ``n`` of each task's rows of a group before it shuffles them."""
    order = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    return counted.withColumn("place", F.row_number().over(order.orderBy(F.desc("count"), key)).cast("bigint")).where(F.col("place") <= n)
