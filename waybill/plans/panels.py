"""The dashboard panels as parameters of the time-series operators. ``evaluate`` turns one into a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from waybill.operators import metrics as M


@dataclass(frozen=True)
class Last:
    """Last value of each series; folded by labels if ``fold`` is given."""

    metric: str
    where: tuple[M.Matcher, ...] = ()
    fold: str | None = None
    by: tuple[str, ...] = ()
    factor: float | None = None
    only_positive: bool = False


@dataclass(frozen=True)
class Rate:
    metric: str
    where: tuple[M.Matcher, ...]
    seconds: int
    fold: str | None = None
    by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Quantile:
    q: float
    metric: str
    where: tuple[M.Matcher, ...]
    seconds: int


@dataclass(frozen=True)
class Ratio:
    top: object
    bottom: object
    least: float | None = None


@dataclass(frozen=True)
class Share:
    part: object
    rest: object


@dataclass(frozen=True)
class Either:
    branches: tuple[object, ...]


@dataclass(frozen=True)
class OrZero:
    inner: object


def evaluate(panel: object, samples: DataFrame, grid: M.Grid) -> DataFrame:
    match panel:
        case Last():
            found = M.last_values(samples, panel.metric, panel.where, grid)
            found = M.positive(found) if panel.only_positive else found
            result = M.by_labels(found, panel.fold, panel.by) if panel.fold else M.plain(found)
            return M.scaled(result, panel.factor) if panel.factor else result
        case Rate():
            found = M.rates(samples, panel.metric, panel.where, grid, panel.seconds)
            return M.by_labels(found, panel.fold, panel.by) if panel.fold else M.plain(found)
        case Quantile():
            return M.quantile_of_rates(panel.q, M.rates(samples, panel.metric, panel.where, grid, panel.seconds))
        case Ratio():
            return M.ratio(evaluate(panel.top, samples, grid), evaluate(panel.bottom, samples, grid), panel.least)
        case Share():
            return M.share(evaluate(panel.part, samples, grid), evaluate(panel.rest, samples, grid))
        case Either():
            return M.either(*[evaluate(b, samples, grid) for b in panel.branches])
        case OrZero():
            return M.or_zero(evaluate(panel.inner, samples, grid), grid)
    raise TypeError(f"not a panel: {panel!r}")


def metrics_of(panel: object) -> set[str]:
    """Names of all metrics a panel reads."""
    if isinstance(panel, (Last, Rate, Quantile)):
        return {panel.metric}
    inner = {
        Ratio: lambda p: (p.top, p.bottom), Share: lambda p: (p.part, p.rest),
        Either: lambda p: p.branches, OrZero: lambda p: (p.inner,),
    }[type(panel)](panel)
    return set().union(*[metrics_of(p) for p in inner])


ORDER = (("job", "=", "order-service"),)
STUB = (("job", "=", "notification-stub"),)
ORDERS_URI = ORDER + (("uri", "=", "/api/v1/orders"),)
NOT_ACTUATOR = ORDER + (("uri", "!~", "/actuator/.*"),)
HEAP = ORDER + (("area", "=", "heap"),)
DB = (("datname", "=", "outbox"),)
ONE, FIVE = 60, 300
LEAST = 1e-9


def _quantile_first(q: float, name: str, where: tuple[M.Matcher, ...], *rest: object) -> Either:
    """Histogram quantile, else the mean of the quantile series, else what ``rest`` gives."""
    series = Last(name, where + (("quantile", "=", f"{q:g}"),), "avg")
    return Either((Quantile(q, f"{name}_bucket", where, FIVE), series, *rest))


def _mean(name: str, where: tuple[M.Matcher, ...], seconds: int, fold: str | None = None, least: float | None = LEAST) -> Ratio:
    return Ratio(Rate(f"{name}_sum", where, seconds, fold), Rate(f"{name}_count", where, seconds, fold), least)


HTTP = "http_server_requests_seconds"
ACQUIRE = "hikaricp_connections_acquire_seconds"
LATENCY = "outbox_publish_latency_seconds"
BATCH = "outbox_publish_batch_size"
LISTENER = "spring_kafka_listener_seconds"
BUSY, CURRENT = "tomcat_threads_busy_threads", "tomcat_threads_current_threads"
CONFIG_MAX, THREADS_MAX = "tomcat_threads_config_max_threads", "tomcat_threads_max_threads"

# Metric names, matchers, ranges and folds of the panels, by dashboard.
PANELS: dict[str, object] = {
    "delivery_service_up": Last("up", ORDER),
    "delivery_cpu": Last("process_cpu_usage", ORDER, factor=100.0),
    "delivery_queue_size": Last("outbox_queue_size", ORDER),
    "delivery_queue_pressure": Last("outbox_queue_pressure", ORDER),
    "delivery_publish_latency_mean": _mean(LATENCY, ORDER, FIVE, least=None),
    "delivery_publish_failures": Rate("outbox_publish_failures_total", ORDER, FIVE),
    "delivery_retries": Rate("outbox_retry_count_total", ORDER, FIVE),
    "delivery_recoveries": Rate("outbox_recovery_count_total", ORDER, FIVE),
    "delivery_rate_limit_rejects": Rate("outbox_rate_limit_rejects_total", ORDER, FIVE),
    "delivery_heap_used": Last("jvm_memory_used_bytes", HEAP),
    "delivery_http_request_rate": Rate(f"{HTTP}_count", ORDER, FIVE, "sum", ("uri", "status")),
    "orders_http_rps": Rate(f"{HTTP}_count", NOT_ACTUATOR, ONE, "sum"),
    "orders_http_error_rate": Ratio(
        OrZero(Rate(f"{HTTP}_count", NOT_ACTUATOR + (("outcome", "!=", "SUCCESS"),), ONE, "sum")),
        Rate(f"{HTTP}_count", NOT_ACTUATOR, ONE, "sum"),
        LEAST,
    ),
    "orders_http_p50": _quantile_first(0.5, HTTP, ORDERS_URI, _mean(HTTP, ORDERS_URI, FIVE, "sum")),
    "orders_http_p95": _quantile_first(0.95, HTTP, ORDERS_URI, _mean(HTTP, ORDERS_URI, FIVE, "sum")),
    "orders_http_p99": _quantile_first(0.99, HTTP, ORDERS_URI, _mean(HTTP, ORDERS_URI, FIVE, "sum")),
    "orders_active_requests": Last("http_server_requests_active_seconds_gcount", ORDER, "sum"),
    "orders_busy_threads": Last(BUSY, ORDER),
    "orders_threads_in_use": Either((Last(BUSY, ORDER), Last(CURRENT, ORDER))),
    "orders_threads_limit": Either((Last(CONFIG_MAX, ORDER), Last(THREADS_MAX, ORDER))),
    "orders_pool_active": Last("hikaricp_connections_active", ORDER),
    "orders_pool_max": Last("hikaricp_connections_max", ORDER),
    "orders_pool_pending": Last("hikaricp_connections_pending", ORDER),
    "orders_pool_acquire_p95": _quantile_first(0.95, ACQUIRE, ORDER, _mean(ACQUIRE, ORDER, FIVE)),
    "orders_pool_acquire_p99": _quantile_first(0.99, ACQUIRE, ORDER, Last(f"{ACQUIRE}_max", ORDER)),
    "orders_transaction_p95": _quantile_first(
        0.95, "order_transaction_seconds", ORDER, _mean("order_transaction_seconds", ORDER, FIVE)
    ),
    "orders_cpu": Last("process_cpu_usage", ORDER, factor=100.0),
    "orders_heap_used": Last("jvm_memory_used_bytes", HEAP, "sum"),
    "orders_heap_committed": Last("jvm_memory_committed_bytes", HEAP, "sum"),
    "orders_heap_max": Last("jvm_memory_max_bytes", HEAP, "max", only_positive=True),
    "orders_gc_pause_rate": Rate("jvm_gc_pause_seconds_sum", ORDER, FIVE, "sum", ("gc",)),
    "orders_gc_pause_max": Last("jvm_gc_pause_seconds_max", ORDER, "max", ("gc",)),
    "orders_queue_size": Last("outbox_queue_size", ORDER),
    "orders_enqueue_rate": Rate("outbox_queue_enqueue_total", ORDER, ONE),
    "orders_dequeue_rate": Rate("outbox_queue_dequeue_total", ORDER, ONE),
    "orders_publish_p95": _quantile_first(0.95, LATENCY, ORDER, _mean(LATENCY, ORDER, FIVE)),
    "orders_publish_p99": _quantile_first(0.99, LATENCY, ORDER),
    "orders_batch_size_mean": _mean(BATCH, ORDER, ONE),
    "orders_batch_size_p95": _quantile_first(0.95, BATCH, ORDER),
    "orders_publish_throughput": OrZero(Rate("outbox_publish_events_total", ORDER, ONE)),
    "orders_publish_errors": OrZero(Rate("outbox_publish_failures_total", ORDER, ONE)),
    "orders_template_errors": OrZero(
        Rate("spring_kafka_template_seconds_count", ORDER + (("exception", "!=", "none"),), ONE, "sum")
    ),
    "consumer_service_up": Last("up", STUB),
    "consumer_cpu": Last("process_cpu_usage", STUB, factor=100.0),
    "consumer_events_total": Last("notification_events_received_total", STUB),
    "consumer_batches_total": Last("notification_batches_received_total", STUB),
    "consumer_event_rate": Rate("notification_events_received_total", STUB, FIVE),
    "consumer_batch_rate": Rate("notification_batches_received_total", STUB, FIVE),
    "consumer_processing_mean": _mean("notification_batch_processing_seconds", STUB, FIVE, least=None),
    "consumer_listener_mean": _mean(LISTENER, STUB, FIVE, "sum", least=None),
    "consumer_heap_used": Last("jvm_memory_used_bytes", STUB + (("area", "=", "heap"),)),
    "consumer_listener_rate": Rate(f"{LISTENER}_count", STUB, FIVE, "sum", ("name", "result")),
    "database_up": Last("pg_up"),
    "database_connections": Last("pg_stat_database_numbackends", (), "sum", ("datname",)),
    "database_size": Last("pg_database_size_bytes", DB),
    "database_commits": Rate("pg_stat_database_xact_commit", DB, FIVE),
    "database_rollbacks": Rate("pg_stat_database_xact_rollback", DB, FIVE),
    "database_rows_inserted": Rate("pg_stat_database_tup_inserted", DB, FIVE),
    "database_rows_updated": Rate("pg_stat_database_tup_updated", DB, FIVE),
    "database_rows_deleted": Rate("pg_stat_database_tup_deleted", DB, FIVE),
    "database_cache_hit_ratio": Share(
        Rate("pg_stat_database_blks_hit", DB, FIVE), Rate("pg_stat_database_blks_read", DB, FIVE)
    ),
    "database_deadlocks": Rate("pg_stat_database_deadlocks", DB, FIVE),
    "database_locks_by_mode": Last("pg_locks_count", (), "sum", ("mode",)),
    "database_sessions_by_state": Last("pg_stat_activity_count", (), "sum", ("state",)),
    "database_rows_returned": Rate("pg_stat_database_tup_returned", DB, FIVE),
    "database_rows_fetched": Rate("pg_stat_database_tup_fetched", DB, FIVE),
    "database_waits": Last("pg_stat_activity_count", DB + (("wait_event_type", "!=", ""),), "sum", ("wait_event_type",)),
}
