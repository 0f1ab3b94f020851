"""Outbox state: an append-only transition log, the current state it leads to, and the moves between states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import scalars

STATE = ["status", "retry_count", "locked_by", "locked_until", "sent_at"]
ROW_COLUMNS = ["id", "order_id", "customer_id", "event_type", "payload", "status", "retry_count", "trace_parent"]


def latest_state(transitions: DataFrame) -> DataFrame:
    """Current state per id: its transition with the highest ``seq``, combined before the shuffle."""
    newest = F.max(F.struct("seq", *STATE, "ts")).alias("newest")
    return transitions.groupBy("id").agg(newest).select("id", "newest.*")


def apply_state(outbox: DataFrame, state: DataFrame) -> DataFrame:
    """Outbox rows with the state the log gives them; rows without transitions keep theirs."""
    renamed = state.select("id", *[F.col(c).alias(f"__{c}") for c in STATE])
    joined = outbox.join(renamed, "id", "left")
    moved = F.col("__status").isNotNull()
    current = {c: F.when(moved, F.col(f"__{c}")).otherwise(F.col(c)) for c in STATE}
    return joined.select(*[current[c].alias(c) if c in STATE else F.col(c) for c in outbox.columns])


def with_part(outbox: DataFrame) -> DataFrame:
    """``part`` is the directory column of stored outbox rows."""
    return outbox.withColumn("part", F.when(scalars.is_active(F.col("status")), "active").otherwise("archive"))


def active_pending(outbox: DataFrame) -> DataFrame:
    return outbox.filter(scalars.is_active(F.col("status"))).agg(F.count(F.lit(1)).alias("pending"))


def free_active(outbox: DataFrame, now: Column) -> DataFrame:
    """Rows that may be claimed: active, and without a lease that still holds."""
    free = scalars.lease_is_free(F.col("locked_until"), now)
    claimable = outbox.filter(scalars.is_active(F.col("status")) & free)
    # On stored rows the directory column prunes the archive files.
    return claimable.filter("part = 'active'") if "part" in outbox.columns else claimable


def by_id(outbox: DataFrame, id_: int) -> DataFrame:
    return outbox.filter(F.col("id") == id_)


def recovery_candidates(outbox: DataFrame, now: Column, limit: int) -> DataFrame:
    """The lowest free active ids."""
    return free_active(outbox, now).orderBy("id").limit(limit)


def under_lease(rows: DataFrame, instance: str, now: Column, lease_seconds: int) -> DataFrame:
    return rows.withColumns(
        {
            "status": F.lit(S.PROCESSING),
            "locked_by": F.lit(instance),
            "locked_until": scalars.lease_until(now, lease_seconds),
        }
    )


def claim(outbox: DataFrame, ids: DataFrame, instance: str, now: Column, lease_seconds: int) -> DataFrame:
    """Rows among ``ids`` that this instance gets, moved to PROCESSING under its lease."""
    wanted = ids.select("id").distinct()
    return under_lease(free_active(outbox, now).join(wanted, "id", "left_semi"), instance, now, lease_seconds)


def reofferable(outbox: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Ids of a batch that could not be claimed but are free: they go back to the queue."""
    return free_active(outbox, now).join(ids.select("id").distinct(), "id", "left_semi").select("id")


def recovery_lease(candidates: DataFrame, instance: str, now: Column, lease_seconds: int) -> DataFrame:
    """The lease and release pair of a recovery tick, as transition rows: status stays, the lease is taken and freed."""
    leased = candidates.select(
        "id", F.lit(1).alias("step"), "status", "retry_count", F.lit(instance).alias("locked_by"),
        scalars.lease_until(now, lease_seconds).alias("locked_until"),
    )
    released = candidates.select(
        "id", F.lit(2).alias("step"), "status", "retry_count", F.lit(None).cast("string").alias("locked_by"),
        F.lit(None).cast("timestamp").alias("locked_until"),
    )
    return leased.unionByName(released)


def mark_sent(rows: DataFrame, sent_at: Column) -> DataFrame:
    return rows.withColumns(
        {
            "status": F.lit(S.SENT),
            "sent_at": sent_at,
            "locked_by": F.lit(None).cast("string"),
            "locked_until": F.lit(None).cast("timestamp"),
        }
    )


def mark_failed(rows: DataFrame, max_retries: int) -> DataFrame:
    """One more retry; the row is dead once the retries reach the limit."""
    return rows.withColumn("retry_count", F.col("retry_count") + 1).withColumns(
        {
            "status": F.when(F.col("retry_count") >= max_retries, S.DEAD).otherwise(S.FAILED),
            "locked_by": F.lit(None).cast("string"),
            "locked_until": F.lit(None).cast("timestamp"),
        }
    )


def as_transitions(rows: DataFrame, seq: Column, ts: Column) -> DataFrame:
    return rows.select("id", seq.cast("bigint").alias("seq"), *STATE, ts.alias("ts"))


def batch_outcome(attempts: DataFrame, batch: str) -> DataFrame:
    """A batch fails as a whole: each row with ``batch_failed``. A batch holds no more rows than the batch size."""
    return attempts.withColumn("batch_failed", F.max("failed").over(Window.partitionBy(batch)))


def delivery_counters(attempts: DataFrame, batch: str, period: Column) -> DataFrame:
    """Published events, failed batches and retries per period: failures count per batch, retries per row."""
    per_batch = attempts.groupBy(batch).agg(
        F.min("ts").alias("ts"), F.count(F.lit(1)).alias("rows"), F.max("failed").alias("failed")
    )
    rows_if = lambda test: F.sum(F.when(test, F.col("rows")).otherwise(0))
    return per_batch.groupBy(period.alias("period")).agg(
        rows_if(~F.col("failed")).alias("published"), F.count_if("failed").alias("failures"),
        rows_if(F.col("failed")).alias("retries"),
    )


def live_counts(rows: DataFrame, observed: Observation | str) -> DataFrame:
    """The rows as they are. Their number and state counts go to ``observed`` as they pass, without another job."""
    status = F.col("status")
    return rows.observe(
        observed, F.count(F.lit(1)).alias("rows"), F.count_if(status == S.SENT).alias("published"),
        F.count_if(status.isin(S.FAILED, S.DEAD)).alias("failed"), F.count_if(scalars.is_active(status)).alias("pending"),
    )


def replay_attempts(attempts: DataFrame, max_retries: int) -> DataFrame:
    """Final state per id from its send attempts: sent at the first success, dead at the last allowed failure.

    Only the first success and the first ``max_retries`` failures of an id can matter. Both are cut down before the
    shuffle (partial aggregate, partial rank limit), so an id with any number of attempts costs few rows.
    """
    success = (
        attempts.filter(~F.col("failed"))
        .groupBy("id")
        .agg(F.min(F.struct("ts", "attempt_id")).alias("success"))
    )
    earliest = Window.partitionBy("id").orderBy("ts", "attempt_id")
    failures = (
        attempts.filter("failed")
        .withColumn("n", F.row_number().over(earliest))
        .filter(F.col("n") <= max_retries)
        .select("id", "n", F.struct("ts", "attempt_id").alias("failure"))
    )
    before = F.col("success").isNull() | (F.col("failure") < F.col("success"))
    per_id = (
        failures.join(success, "id", "full")
        .groupBy("id")
        .agg(
            F.count(F.when(before, F.col("n"))).cast("int").alias("retry_count"),
            F.first("success").alias("success"),
            F.max(F.when(before, F.col("failure"))).alias("last_failure"),
        )
    )
    dead = F.col("retry_count") >= max_retries
    sent = ~dead & F.col("success").isNotNull()
    return per_id.select(
        "id",
        F.when(dead, S.DEAD).when(sent, S.SENT).otherwise(S.FAILED).alias("status"),
        "retry_count",
        F.when(sent, F.col("success.ts")).alias("sent_at"),
        F.when(sent, F.col("success.ts")).otherwise(F.col("last_failure.ts")).alias("ts"),
    )


def first_trace_parent(rows: DataFrame, batch: str, order: str) -> DataFrame:
    """First non-blank trace parent of each batch, null where there is none."""
    given = scalars.blank_to_null(F.col("trace_parent"))
    return rows.groupBy(batch).agg(
        F.min_by("trace_parent", F.when(given.isNotNull(), F.col(order))).alias("trace_parent"),
        F.count(F.lit(1)).alias("rows"),
    )
