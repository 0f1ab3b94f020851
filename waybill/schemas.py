"""Table schemas as Spark DDL, and the fixed codes that stored rows carry."""

from __future__ import annotations

# Prices as posted: ten places, and as many digits before them as the stored cents have. Times a quantity they still fit.
PRICE = "DECIMAL(27,10)"
ITEMS = f"ARRAY<STRUCT<productId: STRING, quantity: INT, price: {PRICE}>>"
# The text of a line that is no request.
UNREADABLE = "unreadable"

REQUEST = (
    "request_id LONG, arrival_ts TIMESTAMP, idempotency_key STRING, method STRING, uri STRING, "
    "forwarded_for STRING, remote_addr STRING, customer_id LONG, "
    f"items {ITEMS}, correlation_id STRING"
)
# The body a client posts, before the intake adds header values and an arrival time.
REQUEST_BODY = f"customerId LONG, items {ITEMS}, correlationId STRING"

ORDERS = (
    "id LONG, customer_id LONG, status STRING, total_amount DECIMAL(19,2), "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)
ORDER_ITEMS = (
    "id LONG, order_id LONG, customer_id LONG, product_id STRING, quantity INT, "
    "price DECIMAL(19,2), created_at TIMESTAMP"
)
IDEMPOTENCY_KEYS = (
    "id LONG, customer_id LONG, idempotency_key STRING, request_hash STRING, status INT, "
    "response_body STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)
OUTBOX_EVENTS = (
    "id LONG, order_id LONG, customer_id LONG, event_type STRING, payload STRING, status INT, "
    "retry_count INT, locked_by STRING, locked_until TIMESTAMP, sent_at TIMESTAMP, "
    "created_at TIMESTAMP, trace_parent STRING"
)
OUTBOX_TRANSITIONS = (
    "id LONG, seq LONG, status INT, retry_count INT, locked_by STRING, locked_until TIMESTAMP, "
    "sent_at TIMESTAMP, ts TIMESTAMP"
)
PAYLOAD = f"orderId LONG, customerId LONG, items {ITEMS}, correlationId STRING"
ENVELOPE = (
    "eventId LONG, orderId LONG, customerId LONG, eventType STRING, payload STRING, "
    "correlationId STRING, occurredAt TIMESTAMP"
)
RESPONSE = "orderId LONG, eventId LONG, status STRING, createdAt TIMESTAMP"
TOPIC_RECORDS = (
    "key STRING, value STRING, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, topic STRING, "
    "partition INT, offset LONG, timestamp TIMESTAMP"
)
NOTIFICATIONS = (
    "event_id LONG, order_id LONG, customer_id LONG, event_type STRING, correlation_id STRING, "
    "topic STRING, partition INT, offset LONG, channel STRING, status STRING, trace_parent STRING"
)
METRIC_SAMPLES = "ts TIMESTAMP, metric STRING, labels MAP<STRING,STRING>, value DOUBLE"
SPANS = (
    "trace_id STRING, span_id STRING, parent_span_id STRING, service STRING, name STRING, "
    "uri STRING, start_ts TIMESTAMP, duration_ms DOUBLE, status STRING"
)

# Field name in a log line -> (column, type of the column).
LOG_FIELDS = {
    "@timestamp": ("ts", "TIMESTAMP"),
    "log.level": ("log_level", "STRING"),
    "message": ("message", "STRING"),
    "service.name": ("service_name", "STRING"),
    "service.version": ("service_version", "STRING"),
    "deployment.environment": ("deployment_environment", "STRING"),
    "instance.id": ("instance_id", "STRING"),
    "locked_by": ("locked_by", "STRING"),
    "logger.name": ("logger_name", "STRING"),
    "thread.name": ("thread_name", "STRING"),
    "trace.id": ("trace_id", "STRING"),
    "span.id": ("span_id", "STRING"),
    "correlationId": ("correlation_id", "STRING"),
    "customerId": ("customer_id_text", "STRING"),
    "customer.id": ("customer_id", "LONG"),
    "idempotencyKey": ("idempotency_key", "STRING"),
    "order.id": ("order_id", "LONG"),
    "outbox.id": ("outbox_id", "LONG"),
    "event.type": ("event_type", "STRING"),
    "event.action": ("event_action", "STRING"),
    "outbox.status": ("outbox_status", "STRING"),
    "outbox.status_code": ("outbox_status_code", "INT"),
    "outbox.retry_count": ("outbox_retry_count", "INT"),
    "outbox.batch_size": ("outbox_batch_size", "INT"),
    "kafka.topic": ("kafka_topic", "STRING"),
    "kafka.partition": ("kafka_partition", "INT"),
    "kafka.offset": ("kafka_offset", "LONG"),
    "duration.ms": ("duration_ms", "LONG"),
    "notification.channel": ("notification_channel", "STRING"),
    "notification.status": ("notification_status", "STRING"),
}
LOGS = ", ".join(f"{column} {kind}" for column, kind in LOG_FIELDS.values())

# Delivery status codes; codes below ARCHIVE_FROM are active.
NEW, PROCESSING, FAILED, DEAD, SENT = 0, 1, 2, 101, 110
ARCHIVE_FROM = 100
OUTBOX_STATUS = {0: "NEW", 1: "PROCESSING", 2: "FAILED", 101: "DEAD", 110: "SENT"}

# Idempotency key status codes.
KEY_PROCESSING, KEY_COMPLETED, KEY_FAILED = 0, 1, 2
IDEMPOTENCY_STATUS = {0: "PROCESSING", 1: "COMPLETED", 2: "FAILED"}

# Names written into rows, records and responses.
ORDER_STATUS_CREATED = "CREATED"
RESPONSE_STATUS_ACCEPTED = "ACCEPTED"
EVENT_TYPE_ORDER_CREATED = "OrderCreated"
ORDERS_ROUTE = "/api/v1/orders"
HEADER_NAMES = ("eventId", "orderId", "customerId", "correlationId", "traceparent", "tracestate")
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
