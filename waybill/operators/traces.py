"""Spans and traces: exclusion, sampling, summaries, search, span metrics and the service graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import scalars
from waybill.operators import metrics
from waybill.plans import sizes
from waybill.session import cut_lineage

# What marks spans of the management endpoints and of the recovery task.
ACTUATOR = "/actuator"
RECOVERY_TASK = "task recoveryWorker."


def _is_actuator() -> Column:
    uri = F.col("uri")
    own = (uri == ACTUATOR) | uri.startswith(f"{ACTUATOR}/") | F.col("name").contains(ACTUATOR)
    return F.coalesce(own, F.lit(False))


def actuator_spans(spans: DataFrame) -> DataFrame:
    """``trace_id, span_id`` of actuator spans and everything below them.

    Only traces that hold an actuator span are looked at. Each span points to its parent; in every round it learns what
    the span it points to knows, and then points where that one pointed, so a chain of n spans takes log2(n) rounds. Rows
    are joined by trace and span, so a trace of any size is spread over tasks. Spans whose parent is missing end a chain;
    spans whose parents form a circle end with the last round. A span that occurs with several
    parents is below all of them.
    """
    node = ["trace_id", "span_id"]
    traces = spans.filter(_is_actuator()).select("trace_id").distinct()
    inside = spans.join(sizes.counted(traces), "trace_id", "left_semi").filter(F.col("span_id").isNotNull())
    known = inside.groupBy(*node, F.col("parent_span_id").alias("up")).agg(F.max(_is_actuator()).alias("below"))
    known = cut_lineage(_settled(known))
    # A chain is no longer than all rows together, so a circle of parents ends too.
    rows, waiting = known.agg(F.count(F.lit(1)), F.count("up")).first()
    for _ in range(rows.bit_length()):
        if not waiting:
            break
        above = known.select("trace_id", F.col("span_id").alias("up"), F.col("up").alias("further"), F.col("below").alias("learned"))
        # Spans without a pointer learn nothing more and stay out of the join.
        moved = known.filter(F.col("up").isNotNull()).join(above, ["trace_id", "up"], "left")
        moved = moved.groupBy(*node, F.col("further").alias("up")).agg(F.max(F.col("below") | F.coalesce("learned", F.lit(False))).alias("below"))
        known = cut_lineage(_settled(known.filter(F.col("up").isNull()).unionByName(moved)))
        waiting = known.agg(F.count("up")).first()[0]
    return known.filter("below").select(*node).distinct()


def _settled(known: DataFrame) -> DataFrame:
    """Spans that are known to be below an actuator span need no pointer."""
    return known.withColumn("up", F.when(~F.col("below"), F.col("up")))


def exported(spans: DataFrame) -> DataFrame:
    """Spans that are kept: no actuator calls or their descendants, no recovery task."""
    own_task = F.coalesce(F.col("name").startswith(RECOVERY_TASK), F.lit(False))
    return spans.filter(~own_task).join(sizes.counted(actuator_spans(spans)), ["trace_id", "span_id"], "left_anti")


def sampled(spans: DataFrame, probability: float) -> DataFrame:
    """Whole traces by a digest of their id, so all spans of a trace stay or go together, on every run."""
    bucket = F.conv(F.substring(F.md5("trace_id"), 1, 8), 16, 10).cast("bigint") % 10_000
    return spans.filter(bucket < F.lit(round(probability * 10_000)))


def retained(spans: DataFrame, now: Column, hours: int) -> DataFrame:
    return spans.filter(F.col("start_ts") > now - F.make_interval(hours=F.lit(hours)))


def summaries(spans: DataFrame, matches: Column | None = None) -> DataFrame:
    """Per trace: root, start, duration and size; only traces with a span that ``matches``.

    One aggregate, combined before the shuffle: a trace with any number of spans costs one row per map task.
    """
    start_us = F.unix_micros("start_ts")
    end_us = start_us + (F.col("duration_ms") * 1000).cast("bigint")
    # The root is the span without parent; where it is missing, the earliest span.
    rank = F.struct(F.col("parent_span_id").isNotNull(), F.col("start_ts"), F.col("span_id"))
    root = F.min(F.struct(rank.alias("rank"), "service", "name")).alias("root")
    hits = F.lit(1) if matches is None else F.max(F.when(matches, 1).otherwise(0))
    grouped = spans.groupBy("trace_id").agg(
        root, F.min(start_us).alias("start_us"), F.max(end_us).alias("end_us"),
        F.count(F.lit(1)).alias("span_count"), F.count_if(F.col("status") == "error").alias("error_count"),
        hits.alias("hits"),
    )
    return grouped.filter("hits = 1").select(
        "trace_id", F.col("root.service").alias("root_service"), F.col("root.name").alias("root_name"), "start_us",
        ((F.col("end_us") - F.col("start_us")) / F.lit(1000.0)).alias("duration_ms"), "span_count", "error_count",
    )


def span_filter(service: str | None = None, name: str | None = None, pattern: str | None = None) -> Column:
    tests = [F.lit(True)]
    if service is not None:
        tests.append(F.col("service") == service)
    if name is not None:
        tests.append(F.col("name") == name)
    if pattern is not None:
        tests.append(F.col("name").rlike(f"^(?:{pattern})$"))
    kept = tests[0]
    for test in tests[1:]:
        kept = kept & test
    return kept


def search(spans: DataFrame, where: Column, limit: int) -> DataFrame:
    """Newest traces with a span that passes ``where``."""
    return summaries(spans, where).orderBy(F.desc("start_us"), "trace_id").limit(limit)


# The saved trace searches, with service, name or name pattern, and their limits.
SAVED = {
    "service_traces": ({"service": "order-service"}, 30),
    "order_requests": ({"service": "order-service", "name": "http post /api/v1/orders"}, 20),
    "notifications": ({"service": "notification-stub", "pattern": "notification.*"}, 20),
    "deliveries": ({"pattern": "outbox.*"}, 20),
}


def run_saved(spans: DataFrame, search_name: str, service: str | None = None, pattern: str | None = None) -> DataFrame:
    """A saved search; ``service`` and ``pattern`` are the dashboard's two choices."""
    where, limit = SAVED[search_name]
    chosen = dict(where)
    if service is not None:
        chosen["service"] = service
    if pattern is not None:
        chosen["pattern"] = pattern
    return search(spans, span_filter(**chosen), limit)


def services(spans: DataFrame) -> DataFrame:
    return spans.select("service").distinct()


def span_names(spans: DataFrame) -> DataFrame:
    return spans.select("name").distinct()


def span_metrics(spans: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Calls and latency per service, span name and status."""
    return metrics.timer_summary(spans, ["service", "name", "status"], "duration_ms", accuracy)


def span_histogram(spans: DataFrame, bounds: tuple[float, ...]) -> DataFrame:
    return metrics.cumulative_buckets(spans, ["service", "name"], "duration_ms", bounds)


def calls(spans: DataFrame) -> DataFrame:
    """Child spans with the service of their parent."""
    parents = spans.select("trace_id", F.col("span_id").alias("parent_span_id"), F.col("service").alias("client"))
    children = spans.filter(F.col("parent_span_id").isNotNull()).select(
        "trace_id", "parent_span_id", F.col("service").alias("server"), "duration_ms", "status"
    )
    return children.join(parents, ["trace_id", "parent_span_id"])


def service_graph(spans: DataFrame) -> DataFrame:
    """Edges between different services: calls, failures and latency."""
    across = calls(spans).filter(F.col("client") != F.col("server"))
    return across.groupBy("client", "server").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status") == "error").alias("failures"),
        F.sum("duration_ms").alias("total_ms"), F.max("duration_ms").alias("max_ms"),
    )


def with_log_lines(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Log lines with the span they were written in, joined on trace and span id."""
    written = spans.select("trace_id", "span_id", F.col("name").alias("span_name"), F.col("duration_ms").alias("span_ms"))
    return logs.join(written, ["trace_id", "span_id"])


def trace_parts(trace_parent: Column) -> list[Column]:
    return [part.alias(name) for name, part in scalars.traceparent_parts(trace_parent).items()]
