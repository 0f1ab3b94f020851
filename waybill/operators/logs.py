"""Structured log rows: typing, enrichment, checks, searches and counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import scalars


def typed(raw: DataFrame) -> DataFrame:
    """Log documents with their dotted text fields -> typed snake-case columns. Values of a wrong type become null."""
    columns = []
    for field, (column, kind) in S.LOG_FIELDS.items():
        if field not in raw.columns:
            value = F.lit(None).cast(kind)
        elif kind == "TIMESTAMP":
            value = scalars.parse_log_time(F.col(f"`{field}`").cast("string"))
        else:
            value = F.col(f"`{field}`").try_cast(kind)
        columns.append(value.alias(column))
    return raw.select(*columns)


def enriched(logs: DataFrame) -> DataFrame:
    """Fields that carry the same value under two names, each filled from the other."""
    return logs.withColumns(
        {
            "instance_id": F.coalesce("instance_id", "locked_by"),
            "locked_by": F.coalesce("locked_by", "instance_id"),
            "customer_id_text": F.coalesce("customer_id_text", F.col("customer_id").cast("string")),
            "customer_id": F.coalesce("customer_id", F.col("customer_id_text").try_cast("bigint")),
        }
    )


def invariant_violations(logs: DataFrame) -> DataFrame:
    """Rows whose twin fields differ, with the names of the broken pairs. A missing twin differs from a present one."""
    pairs = {
        "locked_by": ~F.col("locked_by").eqNullSafe(F.col("instance_id")),
        "customer_id": ~F.col("customer_id_text").eqNullSafe(F.col("customer_id").cast("string")),
    }
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in pairs.items()]))
    return logs.withColumn("broken", broken).filter(F.size("broken") > 0)


def redacted(logs: DataFrame) -> DataFrame:
    """Keys as digests, customer text masked, and no message."""
    return logs.withColumns(
        {
            "idempotency_key": F.sha2("idempotency_key", 256),
            "customer_id_text": F.mask("customer_id_text"),
        }
    ).drop("message")


def within(logs: DataFrame, now: Column, hours: int) -> DataFrame:
    """The last hours before ``now``. On stored logs the day directory is filtered too, so older files are not read."""
    start = now - F.make_interval(hours=F.lit(hours))
    recent = logs.filter((F.col("ts") > start) & (F.col("ts") <= now))
    if "log_date" in logs.columns:
        recent = recent.filter(F.col("log_date").between(F.to_date(start), F.to_date(now)))
    return recent


def retained(logs: DataFrame, now: Column, days: int) -> DataFrame:
    """Rows of the days that retention keeps."""
    first = F.date_sub(F.to_date(now), days)
    day = F.col("log_date") if "log_date" in logs.columns else F.to_date("ts")
    return logs.filter(day > first)


# Fields that can be searched by exact value.
SEARCH_FIELDS = (
    "trace_id", "span_id", "correlation_id", "customer_id_text", "customer_id", "idempotency_key", "order_id",
    "outbox_id", "event_type", "event_action", "log_level", "service_name",
)


def matches(field: str, value: object) -> Column:
    if field not in SEARCH_FIELDS:
        raise ValueError(f"not a search field: {field}")
    return F.col(field) == F.lit(value)


def search(logs: DataFrame, field: str, value: object) -> DataFrame:
    return logs.filter(matches(field, value))


@dataclass(frozen=True)
class SavedSearch:
    field: str
    value: object
    columns: tuple[str, ...]
    prefix: bool = False
    hours: int | None = None


# The saved searches with their fields, values and output columns.
SAVED = {
    "discover_order_service": SavedSearch(
        "service_name", "order-service", ("ts", "service_name", "log_level", "event_action", "message")
    ),
    "discover_notification_stub": SavedSearch(
        "service_name", "notification-stub", ("ts", "service_name", "log_level", "event_action", "message")
    ),
    "discover_publish_failures": SavedSearch(
        "event_action", "outbox.publish.failed",
        ("ts", "service_name", "event_action", "trace_id", "correlation_id", "order_id", "message"),
    ),
    "discover_errors": SavedSearch("log_level", "ERROR", ("ts", "service_name", "log_level", "event_action", "message")),
    "customer_logs": SavedSearch(
        "customer_id_text", "42",
        ("ts", "service_name", "log_level", "event_action", "correlation_id", "order_id", "customer_id_text", "message"),
        hours=24,
    ),
    "publish_failures": SavedSearch(
        "event_action", "outbox.publish.failed",
        ("ts", "service_name", "correlation_id", "order_id", "outbox_id", "message"), hours=24,
    ),
    "rate_limit_rejected": SavedSearch(
        "event_action", "http.request.rejected",
        ("ts", "service_name", "customer_id_text", "correlation_id", "message"), hours=24,
    ),
    "response_reused": SavedSearch(
        "event_action", "idempotency.response.reused",
        ("ts", "customer_id_text", "idempotency_key", "correlation_id", "message"), hours=24,
    ),
    "correlation_prefix": SavedSearch(
        "correlation_id", "batch1k", ("ts", "service_name", "customer_id_text", "event_action", "message"),
        prefix=True, hours=24,
    ),
    "order_service": SavedSearch(
        "service_name", "order-service",
        ("ts", "log_level", "event_action", "customer_id_text", "correlation_id", "message"), hours=24,
    ),
    "error_logs": SavedSearch(
        "log_level", "ERROR",
        ("ts", "service_name", "event_action", "customer_id_text", "correlation_id", "message"), hours=24,
    ),
}
# Fixed value: the searches shown together on the overview.
OVERVIEW = ("discover_order_service", "discover_notification_stub", "discover_publish_failures")


def run_saved(
    logs: DataFrame, name: str, now: Column, value: object = None, hours: int | None = None, extra: tuple[str, ...] = ()
) -> DataFrame:
    """A saved search, newest first. ``value`` and ``hours`` replace the saved ones."""
    saved = SAVED[name]
    wanted = saved.value if value is None else value
    column = F.col(saved.field)
    found = logs.filter(column.startswith(wanted) if saved.prefix else column == F.lit(wanted))
    span = hours if hours is not None else saved.hours
    found = found if span is None else within(found, now, span)
    return found.orderBy(F.desc("ts")).select(*saved.columns, *extra)


def overview(logs: DataFrame, now: Column) -> dict[str, DataFrame]:
    return {name: run_saved(logs, name, now) for name in OVERVIEW}


def volume_by_customer(logs: DataFrame) -> DataFrame:
    known = logs.filter(F.col("customer_id_text").isNotNull())
    return known.groupBy("customer_id_text").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"))


# Funnel stage -> (action, id whose distinct values count; null where each line counts).
FUNNEL = {
    "requests": ("http.request.accepted", None),
    "completed": ("http.request.completed", None),
    "outbox_events": ("outbox.event.persisted", "outbox_id"),
    "published_batches": ("outbox.batch.published", None),
    "publish_failures": ("outbox.publish.failed", None),
    "retries": ("outbox.retry", None),
    "consumed_batches": ("notification.batch.received", None),
    "processed": ("notification.processed", "outbox_id"),
    "processing_failures": ("notification.processing.failed", None),
}


def funnel(logs: DataFrame, hours: int) -> DataFrame:
    """Counts per stage and time window. Actions that are logged twice count distinct ids; no lines count as zero.

    Distinct ids are reduced first, by (window, action, id); what follows are plain sums.
    """
    twice = [action for action, unique in FUNNEL.values() if unique]
    window = F.window("ts", f"{hours} hours").getField("start")
    # Lines of the other actions are summed up under a null id.
    one = F.when(F.col("event_action").isin(twice), F.col("outbox_id"))
    lines = logs.select(window.alias("window_start"), "event_action", one.alias("one"))
    per_id = lines.groupBy("window_start", "event_action", "one").agg(F.count(F.lit(1)).alias("lines"))
    counts = [
        F.coalesce(
            F.sum(
                F.when(
                    F.col("event_action") == action,
                    F.when(F.col("one").isNotNull(), 1).otherwise(0) if unique else F.col("lines"),
                )
            ),
            F.lit(0),
        ).cast("bigint").alias(stage)
        for stage, (action, unique) in FUNNEL.items()
    ]
    return per_id.groupBy("window_start").agg(*counts)


def for_index(logs: DataFrame, source: str) -> DataFrame:
    """Columns of the daily log store: the literal source and the day used as directory."""
    return logs.withColumn("log_source", F.lit(source)).withColumn("log_date", F.to_date("ts"))


def both_services(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second, allowMissingColumns=True)
