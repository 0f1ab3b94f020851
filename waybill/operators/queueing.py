"""The publisher's id queue as data: admission, batches, the union with recovered ids, and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions import scalars
from waybill.plans import slices
from waybill.plans.skew import join_per_key


def not_in_flight(ids: DataFrame, in_flight: DataFrame) -> DataFrame:
    # Both sides are reduced to one row per id before they meet.
    return ids.select("id").distinct().join(in_flight.select("id").distinct(), "id", "left_anti")


def admission(
    offers: DataFrame, in_flight: DataFrame, capacity: int, in_queue: int = 0,
    slice_rows: int = 1_000_000, hot_rows: int = 10_000_000,
) -> DataFrame:
    """Every offer ``(instance_id, seq, id)`` with ``decision``: IN_FLIGHT, DUPLICATE, FULL or ACCEPTED.

    ``seq`` is unique and gives the order of arrival. An id is a duplicate only while it is in the queue: an id that was
    turned away by a full queue is turned away as FULL again.
    """
    key = ["instance_id", "id"]
    fresh = offers.join(in_flight.select(*key).distinct(), key, "left_anti")
    per_id = fresh.groupBy(*key).agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("offers"))
    by_arrival = slices.id_slice(F.col("first_seq"), slice_rows)
    ranked = slices.ranked(per_id, ["instance_id"], ["first_seq"], by_arrival, "place")
    decided = join_per_key(offers, ranked, key, "offers", "seq", hot_rows)
    fits = F.col("place") <= capacity - in_queue
    decision = (
        F.when(F.col("place").isNull(), "IN_FLIGHT")
        .when(~fits, "FULL")
        .when(F.col("seq") == F.col("first_seq"), "ACCEPTED")
        .otherwise("DUPLICATE")
    )
    return decided.withColumn("decision", decision).select("instance_id", "seq", "id", "decision", "place")


def batches(queued: DataFrame, size: int, slice_rows: int = 1_000_000) -> DataFrame:
    """Batch number per instance: ``size`` ids each, in the order of ``seq``."""
    by_arrival = slices.id_slice(F.col("seq"), slice_rows)
    placed = slices.ranked(queued, ["instance_id"], ["seq"], by_arrival, "place")
    return placed.withColumn("batch_no", F.floor((F.col("place") - 1) / F.lit(size)).cast("bigint"))


def next_ids(fast: DataFrame, recovered: DataFrame) -> DataFrame:
    """Ids of the fast path and of recovery, each once."""
    return fast.select("id").union(recovered.select("id")).dropDuplicates(["id"])


def queue_health(size: Column, capacity: Column, critical: float) -> Column:
    return F.when(scalars.pressure(size, capacity) >= critical, "DOWN").otherwise("UP")


def outbox_health(pending: Column, critical: int) -> Column:
    return F.when(pending >= critical, "DOWN").otherwise("UP")


def queue_moves(transitions: DataFrame, waiting: list[int], slice_s: int = 3600) -> DataFrame:
    """``id, ts, delta``: +1 where an id begins to wait for the publisher, -1 where it is claimed or ends.

    ``transitions`` has ``id, seq, ts, status``; the order is time, then ``seq``. An id waits for the first time with its
    first transition into a waiting status. Transitions between two waiting statuses move nothing. Rows without a time or
    a status are left out.
    """
    known = transitions.filter(F.col("ts").isNotNull() & F.col("status").isNotNull())
    flags = known.select("id", "ts", F.struct("ts", "seq").alias("at"), F.col("status").isin(waiting).cast("int").alias("waits"))
    before = slices.previous(flags, ["id"], "at", slices.time_slice(F.col("ts"), slice_s), "waits", "waited")
    delta = F.col("waits") - F.coalesce("waited", F.lit(0))
    return before.select("id", "ts", delta.alias("delta")).filter("delta <> 0")


def queue_sizes(moves: DataFrame, window_s: int, slice_s: int | None = None) -> DataFrame:
    """Size of each instance's queue over time, from ``instance_id, ts, delta``.

    One row per instance and window from its first to its last move: ``window_us``, ``size`` at the window's end, ``peak``
    (the largest size from its begin to its end), ``came`` and ``went``. Moves of one instant count together.

    Time is cut into slices, each summarised as its sum and the largest sum of its first moves; the slices' sums give the
    size each one starts with. So one task orders the moves of one slice, and one window function the slices of an instance.
    ``slice_s`` must divide ``window_s``.
    """
    slice_s = slice_s or window_s
    if window_s % slice_s:
        raise ValueError("slices must divide the window")
    cell = ["instance_id", "slice"]
    placed = moves.filter(F.col("ts").isNotNull()).withColumn("slice", slices.time_slice(F.col("ts"), slice_s))
    instants = placed.groupBy(*cell, "ts").agg(
        F.sum("delta").alias("net"), F.sum(F.greatest("delta", F.lit(0))).alias("came"), F.sum(F.greatest(-F.col("delta"), F.lit(0))).alias("went")
    )
    along = Window.partitionBy(*cell).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    running = instants.withColumn("so_far", F.sum("net").over(along))
    cells = running.groupBy(*cell).agg(*[F.sum(c).alias(c) for c in ("net", "came", "went")], F.max("so_far").alias("most"))
    ordered = Window.partitionBy("instance_id").orderBy("slice")
    start = F.coalesce(F.sum("net").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    window = F.floor(F.col("slice") / F.lit(window_s // slice_s)).cast("bigint")
    known = cells.withColumn("start", start).withColumn("window", window)
    windows = known.groupBy("instance_id", "window").agg(
        F.max_by(F.col("start") + F.col("net"), "slice").alias("size"),
        F.max(F.col("start") + F.greatest(F.col("most"), F.lit(0))).alias("peak"),
        F.sum("came").alias("came"), F.sum("went").alias("went"),
    )
    # Windows without moves keep the size that the one before them ended with.
    until = F.coalesce(F.lead("window").over(Window.partitionBy("instance_id").orderBy("window")) - 1, F.col("window"))
    spans = windows.withColumns({"own": F.col("window"), "until": until})
    filled = spans.withColumn("window", F.explode(F.sequence("own", "until")))
    moved = F.col("window") == F.col("own")
    return filled.select(
        "instance_id", (F.col("window") * F.lit(window_s * 1_000_000)).alias("window_us"), "size", F.when(moved, F.col("peak")).otherwise(F.col("size")).alias("peak"),
        *[F.when(moved, F.col(c)).otherwise(F.lit(0)).cast("bigint").alias(c) for c in ("came", "went")],
    )
