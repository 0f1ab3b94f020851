"""Log and trace queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.operators import heavy
from waybill.operators import logs as L
from waybill.operators import metrics as M
from waybill.operators import traces as T
from waybill.queries.sql import with_tables
from waybill.sources import driver_tables as D

# The last event lies a day before NOW, so searches over the last hours look back from the end of the data.
END = "2024-01-31 00:00:00"


def end():
    return F.lit(END).cast("timestamp")


def shown(rows):
    return rows.withColumn("ts", F.unix_micros("ts")).withColumnRenamed("ts", "ts_us")


# Saved search -> value used on the driver tables where the saved one does not occur in them.
VALUES = {"correlation_prefix": "c1", "rate_limit_rejected": "http.request.completed", "response_reused": "http.request.accepted"}


def saved_search(name):
    def run(spark, folder):
        return shown(L.run_saved(D.logs(spark, folder), name, end(), VALUES.get(name), extra=("log_id",)))

    run.__name__ = f"logs_{name}"
    run.__doc__ = f"Saved search: {name.replace('_', ' ')}."
    return run


def log_overview(spark, folder):
    """The three overview panels by their sizes."""
    parts = [
        rows.agg(F.count(F.lit(1)).alias("lines")).select(F.lit(name).alias("panel"), "lines")
        for name, rows in L.overview(D.logs(spark, folder), end()).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def log_volume_by_customer(spark, folder):
    return L.volume_by_customer(L.within(D.logs(spark, folder), end(), 24 * 7))


# Search field -> value, one of each kind of identifier.
SEARCHES = {
    "trace_id": "c4ca4238a0b923820dcc509a6f75849b", "span_id": "346b81a32e7007ec", "correlation_id": "c6-1",
    "customer_id_text": "42", "customer_id": 42, "idempotency_key": "7", "order_id": 77, "outbox_id": 99,
    "event_type": "OrderCreated", "event_action": "notification.processed", "log_level": "ERROR",
    "service_name": "order-service",
}


def log_search(spark, folder):
    """Hits of an exact search on every field, counted in one pass."""
    tests = {field: L.matches(field, value) for field, value in SEARCHES.items()}
    hits = [
        F.struct(F.count_if(test).alias("hits"), F.coalesce(F.sum(F.when(test, F.col("log_id"))), F.lit(0)).alias("ids")).alias(field)
        for field, test in tests.items()
    ]
    rows = [F.struct(F.lit(f).alias("field"), F.col(f)["hits"].alias("hits"), F.col(f)["ids"].alias("ids")) for f in tests]
    return D.logs(spark, folder).agg(*hits).select(F.inline(F.array(*rows)))


def action_funnel(spark, folder):
    rows = L.funnel(D.logs(spark, folder), 24)
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


def log_invariants(spark, folder):
    rows = L.invariant_violations(D.logs(spark, folder))
    return rows.select("log_id", F.array_join("broken", ",").alias("broken"))


def log_enrichment(spark, folder):
    rows = L.enriched(D.logs(spark, folder))
    return rows.select("log_id", "instance_id", "locked_by", "customer_id_text", "customer_id")


def log_retention(spark, folder):
    rows = L.retained(D.logs(spark, folder), end(), 7)
    return rows.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("lines"))


def log_redaction(spark, folder):
    rows = L.redacted(D.logs(spark, folder))
    return rows.select("log_id", "idempotency_key", "customer_id_text", F.lit("message" in rows.columns).alias("has_message"))


def log_index_days(spark, folder):
    rows = L.for_index(D.logs(spark, folder), "waybill")
    return rows.groupBy("log_source", F.date_format("log_date", "yyyyMMdd").alias("index_day")).agg(F.count(F.lit(1)).alias("lines"))


def log_typing(spark, folder):
    """Log documents in their text form, with some values of a wrong type, read into typed columns."""
    raw = D.logs(spark, folder).select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("@timestamp"),
        F.col("log_level").alias("log.level"), F.col("service_name").alias("service.name"),
        F.when(F.col("log_id") % 10 == 0, "n/a").otherwise(F.col("customer_id").cast("string")).alias("customer.id"),
        F.col("order_id").cast("string").alias("order.id"), F.col("duration_ms").cast("string").alias("duration.ms"),
    )
    rows = L.typed(raw)
    return rows.select("order_id", "customer_id", "duration_ms", "log_level", F.unix_micros("ts").alias("ts_us"), "kafka_topic")


def both_services(spark, folder):
    """The files of the two services as one set; one of them lacks some columns."""
    logs = D.logs(spark, folder)
    first = logs.filter("service_name = 'order-service'").drop("notification_channel")
    second = logs.filter("service_name = 'notification-stub'").drop("outbox_id").withColumn("notification_channel", F.lit("log"))
    rows = L.both_services(first, second)
    return rows.groupBy("service_name").agg(
        F.count(F.lit(1)).alias("lines"), F.count("outbox_id").alias("with_outbox"),
        F.count("notification_channel").alias("with_channel"),
    )


def log_trace_correlation(spark, folder):
    rows = T.with_log_lines(D.logs(spark, folder), D.spans(spark, folder))
    return rows.select("log_id", "trace_id", "span_name", F.round("span_ms", 6).alias("span_ms"), "event_action")


def log_outbox_correlation(spark, folder):
    """Log lines with the current status of the outbox row they name. Lines are counted per row before the join."""
    lines = D.logs(spark, folder).groupBy("event_action", "outbox_id").agg(F.count(F.lit(1)).alias("lines"))
    rows = D.outbox(spark, folder).select(F.col("id").alias("outbox_id"), F.col("status").cast("bigint").alias("status"))
    return lines.join(rows, "outbox_id", "left").groupBy("event_action", "status").agg(F.sum("lines").alias("lines"))


# Traces.

def trace_summary(spark, folder):
    rows = T.summaries(D.spans(spark, folder))
    return rows.withColumn("duration_ms", F.round("duration_ms", 3))


def trace_search(name):
    def run(spark, folder):
        return T.run_saved(D.spans(spark, folder), name).withColumn("duration_ms", F.round("duration_ms", 3))

    run.__name__ = f"traces_{name}"
    run.__doc__ = f"Saved trace search: {name.replace('_', ' ')}."
    return run


def trace_variables(spark, folder):
    """The choices of the trace dashboard: services and span names."""
    spans = D.spans(spark, folder)
    return T.services(spans).select(F.lit("service").alias("kind"), F.col("service").alias("choice")).union(
        T.span_names(spans).select(F.lit("name"), "name")
    )


def span_exclusion(spark, folder):
    return T.exported(D.spans(spark, folder)).select("trace_id", "span_id", "name")


def trace_sampling(spark, folder):
    rows = T.sampled(D.spans(spark, folder), 0.1)
    return rows.groupBy("trace_id").agg(F.count(F.lit(1)).alias("spans"))


def trace_retention(spark, folder):
    rows = T.retained(D.spans(spark, folder), end(), 168)
    return rows.groupBy("service").agg(F.count(F.lit(1)).alias("spans"))


def span_metrics(spark, folder):
    rows = T.span_metrics(D.spans(spark, folder), accuracy=1_000_000)
    return rows.select("service", "name", "status", "n", F.round("total", 4).alias("total"), "most", "p50", "p95", "p99")


def span_histogram(spark, folder):
    rows = T.span_histogram(D.spans(spark, folder), (1.0, 10.0, 100.0))
    return rows.withColumn("le", F.when(F.col("le") == float("inf"), F.lit(-1.0)).otherwise(F.col("le")))


def service_graph(spark, folder):
    rows = T.service_graph(D.spans(spark, folder))
    return rows.select("client", "server", "calls", "failures", F.round("total_ms", 4).alias("total_ms"), "max_ms")


def top_customers(spark, folder):
    """The twenty customers with the most log lines, from a summary of fixed size and an exact second pass."""
    return heavy.top(D.logs(spark, folder), [], "customer_id", 20)


def top_customers_by_level(spark, folder):
    """The five customers with the most lines of each level, from summaries per level and day."""
    logs = D.logs(spark, folder).withColumn("day", F.to_date("ts"))
    daily = heavy.summaries(logs, ["log_level", "day"], "customer_id")
    return heavy.top(logs, ["log_level"], "customer_id", 5, parts=daily)


def span_calls(spark, folder):
    """All parent-child pairs, also inside one service."""
    rows = T.calls(D.spans(spark, folder))
    return rows.groupBy("client", "server", "status").agg(F.count(F.lit(1)).alias("calls"))


QUERIES = {f"logs_{name}": saved_search(name) for name in L.SAVED}
QUERIES |= {f"traces_{name}": trace_search(name) for name in T.SAVED}
QUERIES |= {
    f.__name__: f
    for f in (
        log_overview, log_volume_by_customer, log_search, action_funnel, log_invariants, log_enrichment, log_retention,
        log_redaction, log_index_days, log_typing, both_services, log_trace_correlation, log_outbox_correlation,
        trace_summary, trace_variables, span_exclusion, trace_sampling, trace_retention, span_metrics, span_histogram,
        service_graph, span_calls, top_customers, top_customers_by_level,
    )
}


def saved_sql(name):
    saved = L.SAVED[name]
    value = VALUES.get(name, saved.value)
    test = f"starts_with({saved.field}, '{value}')" if saved.prefix else f"{saved.field} = '{value}'"
    if saved.hours:
        test += f" AND ts > TIMESTAMP '{END}' - INTERVAL {saved.hours} HOUR AND ts <= TIMESTAMP '{END}'"
    columns = ", ".join("epoch_us(ts) AS ts_us" if c == "ts" else c for c in (*saved.columns, "log_id"))
    return with_tables("logs", f"SELECT {columns} FROM logs WHERE {test}")


def literal(value):
    return f"'{value}'" if isinstance(value, str) else str(value)


SUMMARY = """, summary AS (SELECT trace_id, min_by(service, row(parent_span_id IS NOT NULL, start_us, span_id)) AS root_service,
    min_by(name, row(parent_span_id IS NOT NULL, start_us, span_id)) AS root_name, min(start_us) AS start_us,
    round((max(start_us + CAST(trunc(duration_ms * 1000) AS BIGINT)) - min(start_us)) / 1000.0::DOUBLE, 3) AS duration_ms,
    count(*) AS span_count, count(*) FILTER (WHERE status = 'error') AS error_count, {hits} AS hit FROM spans GROUP BY trace_id)
"""
SUMMARY_COLUMNS = "trace_id, root_service, root_name, start_us, duration_ms, span_count, error_count"


def trace_sql(name):
    where, limit = T.SAVED[name]
    tests = {"service": "service = '{}'", "name": "name = '{}'", "pattern": "regexp_full_match(name, '{}')"}
    hits = "bool_or(" + " AND ".join(tests[k].format(v) for k, v in where.items()) + ")"
    body = f"SELECT {SUMMARY_COLUMNS} FROM summary WHERE hit ORDER BY start_us DESC, trace_id LIMIT {limit}"
    return with_tables("spans", SUMMARY.format(hits=hits) + body)


FUNNEL_SQL = ", ".join(
    (f"count(DISTINCT outbox_id) FILTER (WHERE event_action = '{action}')" if unique else f"count(*) FILTER (WHERE event_action = '{action}')")
    + f" AS {stage}"
    for stage, (action, unique) in L.FUNNEL.items()
)
DISC = ", ".join(f"quantile_disc(duration_ms, {p}) AS {n}" for n, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))

ORACLE = {f"logs_{name}": saved_sql(name) for name in L.SAVED}
ORACLE |= {f"traces_{name}": trace_sql(name) for name in T.SAVED}
ORACLE |= {
    "log_overview": with_tables("logs", """SELECT 'discover_order_service' AS panel, count(*) AS lines FROM logs WHERE service_name = 'order-service'
        UNION ALL SELECT 'discover_notification_stub', count(*) FROM logs WHERE service_name = 'notification-stub'
        UNION ALL SELECT 'discover_publish_failures', count(*) FROM logs WHERE event_action = 'outbox.publish.failed'"""),
    "log_volume_by_customer": with_tables("logs", f"""SELECT customer_id_text, count(*) AS cnt FROM logs WHERE customer_id_text IS NOT NULL
        AND ts > TIMESTAMP '{END}' - INTERVAL 168 HOUR AND ts <= TIMESTAMP '{END}' GROUP BY ALL"""),
    "log_search": with_tables("logs", """, named AS (SELECT *, CASE WHEN kind = 'purchase' THEN 'OrderCreated' END AS event_type FROM logs)
        """ + " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) AS hits, CAST(coalesce(sum(log_id), 0) AS BIGINT) AS ids FROM named WHERE {f} = {literal(v)}"
        for f, v in SEARCHES.items()
    )),
    "action_funnel": with_tables("logs", f"SELECT strftime(ts, '%Y-%m-%d') AS window_start, {FUNNEL_SQL} FROM logs GROUP BY ALL"),
    "log_invariants": with_tables("logs", """SELECT log_id, concat_ws(',', b1, b2) AS broken FROM (SELECT log_id,
        CASE WHEN locked_by IS DISTINCT FROM instance_id THEN 'locked_by' END AS b1,
        CASE WHEN customer_id_text IS DISTINCT FROM CAST(customer_id AS VARCHAR) THEN 'customer_id' END AS b2 FROM logs)
        WHERE b1 IS NOT NULL OR b2 IS NOT NULL"""),
    "log_enrichment": with_tables("logs", """SELECT log_id, instance_id, coalesce(locked_by, instance_id) AS locked_by,
        coalesce(customer_id_text, CAST(customer_id AS VARCHAR)) AS customer_id_text, customer_id FROM logs"""),
    "log_retention": with_tables("logs", f"""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS lines FROM logs
        WHERE CAST(ts AS DATE) > CAST(TIMESTAMP '{END}' AS DATE) - 7 GROUP BY ALL"""),
    "log_redaction": with_tables("logs", """SELECT log_id, sha256(idempotency_key) AS idempotency_key,
        regexp_replace(customer_id_text, '[0-9]', 'n', 'g') AS customer_id_text, false AS has_message FROM logs"""),
    "log_index_days": with_tables("logs", "SELECT 'waybill' AS log_source, strftime(ts, '%Y%m%d') AS index_day, count(*) AS lines FROM logs GROUP BY ALL"),
    "log_typing": with_tables("logs", """SELECT order_id, CASE WHEN log_id % 10 <> 0 THEN customer_id END AS customer_id, duration_ms, log_level,
        epoch_us(ts) // 1000 * 1000 AS ts_us, CAST(NULL AS VARCHAR) AS kafka_topic FROM logs"""),
    "both_services": with_tables("logs", """SELECT service_name, count(*) AS lines, count(CASE WHEN service_name = 'order-service' THEN outbox_id END) AS with_outbox,
        count(CASE WHEN service_name = 'notification-stub' THEN 1 END) AS with_channel FROM logs GROUP BY ALL"""),
    "log_trace_correlation": with_tables("logs spans", """SELECT log_id, trace_id, name AS span_name, round(s.duration_ms, 6) AS span_ms, event_action
        FROM logs JOIN spans s USING (trace_id, span_id)"""),
    "log_outbox_correlation": with_tables("logs outbox", """SELECT event_action, CAST(status AS BIGINT) AS status, count(*) AS lines
        FROM logs LEFT JOIN outbox o ON o.id = outbox_id GROUP BY ALL"""),
    "trace_summary": with_tables("spans", SUMMARY.format(hits="true") + f"SELECT {SUMMARY_COLUMNS} FROM summary"),
    "trace_variables": with_tables("spans", """SELECT DISTINCT 'service' AS kind, service AS choice FROM spans
        UNION ALL SELECT DISTINCT 'name', name FROM spans"""),
    "span_exclusion": with_tables("spans", """, marked AS (SELECT trace_id, span_id FROM spans
          WHERE name LIKE '%/actuator%' OR uri = '/actuator' OR uri LIKE '/actuator/%'
          UNION SELECT s.trace_id, s.span_id FROM spans s JOIN marked m ON s.trace_id = m.trace_id AND s.parent_span_id = m.span_id)
        SELECT trace_id, span_id, name FROM spans s WHERE name NOT LIKE 'task recoveryWorker.%'
        AND NOT EXISTS (SELECT 1 FROM marked m WHERE m.trace_id = s.trace_id AND m.span_id = s.span_id)""", recursive=True),
    "trace_sampling": with_tables("spans", """SELECT trace_id, count(*) AS spans FROM spans
        WHERE CAST('0x' || substr(md5(trace_id), 1, 8) AS BIGINT) % 10000 < 1000 GROUP BY ALL"""),
    "trace_retention": with_tables("spans", f"""SELECT service, count(*) AS spans FROM spans
        WHERE start_us > epoch_us(TIMESTAMP '{END}' - INTERVAL 168 HOUR) GROUP BY ALL"""),
    "span_metrics": with_tables("spans", f"""SELECT service, name, status, count(*) AS n, round(sum(duration_ms), 4) AS total,
        max(duration_ms) AS most, {DISC} FROM spans GROUP BY ALL"""),
    "span_histogram": with_tables("spans", " UNION ALL ".join(
        f"SELECT service, name, {b}::DOUBLE AS le, count(*) FILTER (WHERE duration_ms <= {b} OR {b} < 0) AS count FROM spans GROUP BY ALL"
        for b in (1.0, 10.0, 100.0, -1.0)
    )),
    "top_customers": with_tables("logs", """SELECT customer_id, count, row_number() OVER (ORDER BY count DESC, customer_id) AS place FROM (
        SELECT customer_id, count(*) AS count FROM logs WHERE customer_id IS NOT NULL GROUP BY customer_id) ORDER BY place LIMIT 20"""),
    "top_customers_by_level": with_tables("logs", """SELECT * FROM (SELECT log_level, customer_id, count(*) AS count,
        row_number() OVER (PARTITION BY log_level ORDER BY count(*) DESC, customer_id) AS place FROM logs WHERE customer_id IS NOT NULL
        GROUP BY log_level, customer_id) WHERE place <= 5"""),
    "service_graph": with_tables("spans", """SELECT p.service AS client, c.service AS server, count(*) AS calls,
        count(*) FILTER (WHERE c.status = 'error') AS failures, round(sum(c.duration_ms), 4) AS total_ms, max(c.duration_ms) AS max_ms
        FROM spans c JOIN spans p ON p.trace_id = c.trace_id AND p.span_id = c.parent_span_id
        WHERE p.service <> c.service GROUP BY ALL"""),
    "span_calls": with_tables("spans", """SELECT p.service AS client, c.service AS server, c.status, count(*) AS calls
        FROM spans c JOIN spans p ON p.trace_id = c.trace_id AND p.span_id = c.parent_span_id GROUP BY ALL"""),
}
