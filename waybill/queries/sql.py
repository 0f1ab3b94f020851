"""The model tables as DuckDB common table expressions, by the same rules as ``sources.driver_tables``."""

from __future__ import annotations

NOW = "TIMESTAMP '2024-02-01 00:00:00'"

CTES = {
    "items": """SELECT l_orderkey AS order_id, 'sku-' || l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
        CAST(l_extendedprice AS DECIMAL(19,2)) AS price, l_shipdate AS created_at FROM lineitem""",
    "with_items": "SELECT DISTINCT l_orderkey AS id FROM lineitem",
    "outbox": f"""SELECT id, order_id, customer_id, event_type, status, retry_count,
            CASE WHEN leased THEN 'pod-' || (id % 4) END AS locked_by,
            CASE WHEN leased THEN {NOW} + to_seconds(id % 120 - 60) END AS locked_until,
            CASE WHEN status = 110 THEN {NOW} END AS sent_at, created_at,
            CASE WHEN id % 7 <> 0 THEN '00-' || md5(CAST(id AS VARCHAR)) || '-' || substr(md5('s' || id), 1, 16) || '-01' END
              AS trace_parent
        FROM (SELECT *, status < 100 AND id % 3 <> 0 AS leased FROM (
            SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS customer_id, 'OrderCreated' AS event_type,
              CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 10 = 0 THEN 101 ELSE 110 END
                   WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END ELSE 0 END AS status,
              o_orderkey % 5 AS retry_count, o_orderdate AS created_at
            FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)))""",
    "correlated": """SELECT o_orderkey AS request_id,
        CASE WHEN o_orderkey % 5 <> 0 THEN 'corr-' || o_orderkey END AS correlation_id FROM orders""",
    "arrivals": """SELECT event_id AS request_id, ts AS arrival_ts, user_id AS customer_id,
        json_extract_string(props, '$.k') AS idempotency_key, sha256(user_id || '|' || event_type) AS request_hash,
        '10.0.0.' || (user_id % 16) AS client_ip, 'pod-' || (user_id % 4) AS instance_id, event_type FROM events""",
    "firsts": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, idempotency_key
        ORDER BY arrival_ts, request_id) AS rn FROM arrivals) WHERE rn = 1""",
    "stored": """SELECT customer_id, idempotency_key, request_hash, CASE request_id % 4 WHEN 0 THEN 0 WHEN 2 THEN 2 ELSE 1 END AS status,
        CASE WHEN request_id % 4 = 1 THEN '{"orderId":' || request_id || ',"status":"ACCEPTED"}' END AS response_body
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, idempotency_key ORDER BY request_id) AS rn
              FROM arrivals WHERE arrival_ts < TIMESTAMP '2024-01-10') WHERE rn = 1""",
    "attempts": """SELECT event_id % 500 AS id, event_id AS attempt_id, ts, event_type = 'error' AS failed FROM events""",
    "transitions": """SELECT event_id % 500 AS id, event_id AS seq,
        CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 110 ELSE 101 END AS status,
        event_id % 5 AS retry_count, CASE WHEN event_type = 'click' THEN 'pod-' || (user_id % 4) END AS locked_by,
        CASE WHEN event_type = 'click' THEN ts + to_seconds(30) END AS locked_until,
        CASE WHEN event_type = 'purchase' THEN ts END AS sent_at, ts FROM events""",
    "records": """SELECT o.*, c.correlation_id, o.customer_id % 10 AS part,
        row_number() OVER (PARTITION BY o.customer_id % 10 ORDER BY o.id) - 1 AS off
        FROM outbox o JOIN correlated c ON c.request_id = o.id""",
    "pressures": """SELECT 'pod-' || (user_id % 4) AS instance_id, ts, least(value / 100.0::DOUBLE, 1.0::DOUBLE) AS pressure
        FROM events WHERE event_type = 'error'""",
    "counted": """SELECT event_id, ts, event_type, CAST(n % 500 AS DOUBLE) AS counter, value AS gauge, n
        FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events)""",
    "logs": """SELECT event_id AS log_id, ts, CASE WHEN value > 200 THEN 'ERROR' ELSE 'INFO' END AS log_level,
        CASE event_type WHEN 'click' THEN 'http.request.accepted' WHEN 'view' THEN 'http.request.completed'
          WHEN 'purchase' THEN 'outbox.batch.published' WHEN 'signup' THEN 'notification.processed'
          ELSE 'outbox.publish.failed' END AS event_action,
        event_action || ' id=' || event_id AS message,
        CASE WHEN event_type = 'signup' THEN 'notification-stub' ELSE 'order-service' END AS service_name,
        'pod-' || (user_id % 4) AS instance_id, CASE WHEN event_id % 11 <> 0 THEN 'pod-' || (user_id % 4) END AS locked_by,
        CASE WHEN event_id % 9 <> 0 THEN md5(CAST(event_id AS VARCHAR)) END AS trace_id,
        substr(md5('h' || event_id), 1, 16) AS span_id, 'c' || (user_id % 20) || '-' || event_id AS correlation_id,
        CASE WHEN event_id % 6 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id_text,
        CASE WHEN event_id % 13 = 0 THEN user_id + 1 ELSE user_id END AS customer_id,
        json_extract_string(props, '$.k') AS idempotency_key, event_id AS order_id, event_id % 500 AS outbox_id,
        CAST(floor(value) AS BIGINT) AS duration_ms, event_type AS kind FROM events""",
    "spans": """SELECT md5(CAST(event_id AS VARCHAR)) AS trace_id, substr(md5(mark || event_id), 1, 16) AS span_id,
          CASE WHEN parent IS NOT NULL THEN substr(md5(parent || event_id), 1, 16) END AS parent_span_id,
          service, name, uri, epoch_us(ts) + delay AS start_us, value / share AS duration_ms,
          CASE WHEN mark = 'p' AND event_type = 'error' THEN 'error' ELSE 'ok' END AS status
        FROM events, (VALUES
          ('h', NULL, 'order-service', 'http post /api/v1/orders', '/api/v1/orders', 0, 1.0::DOUBLE),
          ('p', 'h', 'order-service', 'outbox.publish', NULL, 1000, 2.0::DOUBLE),
          ('n', 'p', 'notification-stub', 'notification.consume', NULL, 2000, 4.0::DOUBLE))
          AS v(mark, parent, service, name, uri, delay, share)
        UNION ALL
        SELECT md5('a' || event_id), substr(md5(mark || event_id), 1, 16),
          CASE WHEN parent IS NOT NULL THEN substr(md5(parent || event_id), 1, 16) END,
          'order-service', name, uri, epoch_us(ts) + delay, value / share, 'ok'
        FROM events, (VALUES
          (0, 'x', NULL, 'http get /actuator/health', '/actuator/health', 0, 8.0::DOUBLE),
          (0, 'y', 'x', 'security check', NULL, 1000, 16.0::DOUBLE),
          (25, 't', NULL, 'task recoveryWorker.recover', NULL, 0, 8.0::DOUBLE))
          AS v(rest, mark, parent, name, uri, delay, share)
        WHERE event_id % 50 = rest""",
}

# What a table is derived from, so that a query names only what it reads.
NEEDS = {
    "firsts": ("arrivals",),
    "stored": ("arrivals",),
    "records": ("outbox", "correlated"),
}


def with_tables(names: str, body: str, recursive: bool = False) -> str:
    """``body`` with the named model tables in front of it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} {head}\n{body}" if not body.lstrip().startswith(",") else f"{word} {head}{body}"
