"""Intake queries: validation, totals, hashes, payloads, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import scalars
from waybill.operators import intake, outbox, publish
from waybill.queries.sql import NOW, with_tables
from waybill.session import scratch_path
from waybill.sources import driver_tables as D
from waybill.sources import tables


def validate_requests(spark, folder):
    checked = intake.validated(D.damaged_requests(spark, folder))
    return checked.select("request_id", F.array_join("errors", ",").alias("errors"), (F.size("errors") == 0).alias("valid"))


def quarantine_reasons(spark, folder):
    _, rejected = intake.split_valid(D.damaged_requests(spark, folder))
    return (
        rejected.select(F.explode("errors").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("requests"))
    )


DAMAGED = """, damaged AS (SELECT order_id AS request_id,
    CASE WHEN product_id LIKE '%77' THEN '  ' WHEN product_id LIKE '%88' THEN NULL ELSE product_id END AS product_id,
    CASE WHEN product_id LIKE '%66' THEN -quantity ELSE quantity END AS quantity,
    CASE WHEN product_id LIKE '%55' THEN 0 WHEN product_id LIKE '%44' THEN NULL ELSE price END AS price FROM items),
flags AS (SELECT request_id, max(CASE WHEN product_id IS NULL OR trim(product_id) = '' THEN 1 ELSE 0 END) AS bad_product,
    max(CASE WHEN coalesce(quantity, 0) <= 0 THEN 1 ELSE 0 END) AS bad_quantity,
    max(CASE WHEN coalesce(price, 0) <= 0 THEN 1 ELSE 0 END) AS bad_price FROM damaged GROUP BY request_id),
checked AS (SELECT o_orderkey AS request_id,
    CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_custkey <= 0 THEN 'customerId' END AS e1,
    CASE WHEN f.request_id IS NULL THEN 'items' END AS e2,
    CASE WHEN bad_product = 1 THEN 'items.productId' END AS e3,
    CASE WHEN bad_quantity = 1 THEN 'items.quantity' END AS e4,
    CASE WHEN bad_price = 1 THEN 'items.price' END AS e5
    FROM orders o LEFT JOIN flags f ON f.request_id = o.o_orderkey)
"""


def order_totals(spark, folder):
    totals = intake.order_totals(D.order_items(spark, folder))
    return totals.select("order_id", F.col("total_amount").cast("double").alias("total_amount"), "item_count")


def order_totals_nested(spark, folder):
    requests = D.requests(spark, folder)
    return requests.select(
        "request_id", scalars.items_total(F.col("items")).cast("double").alias("total_amount"),
        F.lit(S.ORDER_STATUS_CREATED).alias("status"),
    )


def order_totals_unrounded(spark, folder):
    """Totals of prices with five places: cents come from the sum, not from the prices."""
    cents = D.order_items(spark, folder)
    items = D.nested_items(cents.withColumn("price", (F.col("price") * F.lit("0.001").cast("decimal(4,3)")).cast(S.PRICE)))
    return items.select("order_id", scalars.items_total(F.col("items")).cast("double").alias("total_amount"), F.size("items").cast("bigint").alias("item_count"))


def request_quarantine(spark, folder):
    """Requests as lines, some cut short, some with a customer that is no number: what is read and what is put aside."""
    path = scratch_path(spark, "lines")
    order, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    body = F.concat(F.lit('{"request_id":'), order, F.lit(',"customer_id":'), F.when(F.col("o_orderkey") % 9 == 0, F.lit('"none"')).otherwise(customer))
    line = F.when(F.col("o_orderkey") % 7 == 0, body).otherwise(F.concat(body, F.lit(',"items":[{"productId":"sku-1","quantity":3,"price":0.335}]}')))
    D.table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    read = tables.read_requests(spark, path)
    lost = F.col(S.UNREADABLE).isNotNull()
    return read.select(
        F.when(~lost, F.col("request_id")).alias("request_id"), F.when(~lost, F.col("customer_id")).alias("customer_id"),
        F.when(~lost, scalars.items_total(F.col("items")).cast("double")).alias("total_amount"), S.UNREADABLE,
    )


def order_items_exploded(spark, folder):
    rows = intake.item_rows(D.requests(spark, folder))
    return rows.select(
        "order_id", "customer_id", F.col("item_no").cast("bigint").alias("item_no"), "product_id",
        F.col("quantity").cast("bigint").alias("quantity"), F.col("price").cast("double").alias("price"),
    )


def orphan_items(spark, folder):
    """Items whose order is missing when the order table only holds orders placed before 2001."""
    kept = D.orders(spark, folder).filter(F.col("created_at") < F.lit("2001-01-01").cast("timestamp"))
    orphans = intake.orphan_items(D.order_items(spark, folder), kept)
    return orphans.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.col("quantity").cast("bigint")).alias("quantity")
    )


def request_hash(spark, folder):
    requests = D.requests(spark, folder)
    digest = scalars.request_hash(F.col("customer_id"), F.col("items"), F.col("correlation_id"))
    return requests.select("request_id", digest.alias("request_hash"))


def outbox_payload(spark, folder):
    """Payload documents, read back field by field."""
    requests, _ = intake.split_valid(D.requests(spark, folder))
    payload = intake.order_payload(F.col("request_id"), F.col("customer_id"), F.col("items"), F.col("correlation_id"))
    text = F.col("payload")
    parsed = F.from_json(text, S.PAYLOAD)
    return requests.select("request_id", payload.alias("payload")).select(
        "request_id",
        scalars.json_long(text, "orderId").alias("order_id"),
        scalars.json_long(text, "customerId").alias("customer_id"),
        scalars.json_text(text, "correlationId").alias("correlation_id"),
        F.size(parsed["items"]).cast("bigint").alias("item_count"),
        parsed["items"][0]["productId"].alias("first_product"),
        parsed["items"][0]["price"].cast("double").alias("first_price"),
        text.contains("correlationId").alias("has_correlation"),
    )


def outbox_with_payload(spark, folder):
    """Outbox rows with their payload, which comes from the items of the same order."""
    requests = D.requests(spark, folder)
    payload = intake.order_payload(F.col("request_id"), F.col("customer_id"), F.col("items"), F.col("correlation_id"))
    # Every ninth payload is no JSON, as a row to quarantine.
    spoilt = F.when(F.col("request_id") % 9 == 0, F.lit("not-json")).otherwise(payload)
    return D.outbox(spark, folder).join(requests.select(F.col("request_id").alias("id"), spoilt.alias("payload")), "id")


def envelope_fields(spark, folder):
    good, _ = publish.split_envelopes(outbox_with_payload(spark, folder), D.now())
    return good.select(
        "event_id", "order_id", "customer_id", "event_type", "correlation_id",
        F.unix_micros("occurred_at").alias("occurred_us"),
        scalars.json_long(F.col("payload"), "orderId").alias("payload_order_id"),
    )


def envelope_quarantine(spark, folder):
    _, bad = publish.split_envelopes(outbox_with_payload(spark, folder), D.now())
    return bad.select("event_id", "payload", "correlation_id")


def outbox_projection(spark, folder):
    return outbox_with_payload(spark, folder).select(*outbox.ROW_COLUMNS).select(
        "id", "order_id", "customer_id", "event_type", F.col("status").cast("bigint").alias("status"),
        F.col("retry_count").cast("bigint").alias("retry_count"), "trace_parent",
        scalars.json_text(F.col("payload"), "orderId").alias("payload_order"),
    )


def new_outbox_rows(spark, folder):
    """Rows that valid requests add: NEW, no retry, no lease."""
    requests, _ = intake.split_valid(D.requests(spark, folder))
    rows = intake.outbox_rows(requests.withColumn("order_id", F.col("request_id")).withColumn("event_id", F.col("request_id")))
    return rows.select(
        "id", "customer_id", "event_type", F.col("status").cast("bigint").alias("status"),
        F.col("retry_count").cast("bigint").alias("retry_count"), F.col("locked_by").isNull().alias("unlocked"),
        scalars.json_long(F.col("payload"), "orderId").alias("payload_order"),
        F.unix_micros("created_at").alias("created_us"),
    )


def status_names(spark, folder):
    rows = D.outbox(spark, folder)
    status = F.col("status")
    named = rows.select(
        scalars.code_name(status, S.OUTBOX_STATUS).alias("status_name"),
        scalars.is_active(status).alias("active"), scalars.is_archive(status).alias("archived"),
    )
    return named.groupBy("status_name", "active", "archived").agg(F.count(F.lit(1)).alias("rows"))


def traceparent_parts(spark, folder):
    rows = D.outbox(spark, folder)
    # A third of the rows gets a text that is no trace parent.
    text = F.when(F.col("id") % 3 == 0, F.concat("trace_parent", F.lit("-x"))).otherwise(F.col("trace_parent"))
    parts = [c.alias(n) for n, c in scalars.traceparent_parts(text).items()]
    return rows.select("id", *parts)


def client_ip(spark, folder):
    rows = D.arrivals(spark, folder)
    return rows.select("request_id", scalars.client_ip(F.col("forwarded_for"), F.col("remote_addr")).alias("client_ip"))


def route_filter(spark, folder):
    rows = D.arrivals(spark, folder).filter(scalars.is_order_route(F.col("method"), F.col("uri")))
    return rows.groupBy("method", "uri").agg(F.count(F.lit(1)).alias("requests"))


def lenient_json(spark, folder):
    """Fields of ``props``, where some documents are cut short."""
    events = D.table(spark, folder, "events")
    text = F.when(F.col("event_id") % 10 == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    return events.select(
        "event_id", scalars.json_long(text, "k").alias("k"), scalars.json_text(text, "missing").alias("missing")
    )


def default_correlation(spark, folder):
    requests = D.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("corr-"), F.col("o_orderkey").cast("string"))).alias("given"),
    )
    made = scalars.default_correlation(F.col("given"), F.col("customer_id"), F.col("request_id"))
    return requests.select("request_id", made.alias("correlation_id"))


def customer_partitions(spark, folder):
    rows = D.orders(spark, folder).select(scalars.customer_partition(F.col("customer_id"), 10).cast("bigint").alias("part"))
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("orders"))


def small_scalars(spark, folder):
    """Lease end, whole milliseconds, UTF-8 length, ISO text and its way back, per outbox row."""
    rows = D.outbox(spark, folder)
    nanos = F.col("id") * 1_234_567 + 999
    iso = scalars.iso_instant(F.col("created_at"))
    return rows.select(
        "id", F.unix_micros(scalars.lease_until(F.col("created_at"), 30)).alias("lease_us"),
        scalars.nanos_to_millis(nanos).alias("millis"),
        F.length(scalars.utf8(scalars.decimal_text(F.col("customer_id")))).cast("bigint").alias("key_bytes"),
        F.unix_micros(scalars.parse_log_time(iso)).alias("parsed_us"),
        scalars.token_cost(F.lit(1.0) / (F.col("id") % 4 + 1)).alias("cost"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        validate_requests, quarantine_reasons, order_totals, order_totals_nested, order_totals_unrounded, request_quarantine, order_items_exploded, orphan_items,
        request_hash, outbox_payload, envelope_fields, envelope_quarantine, outbox_projection, new_outbox_rows,
        status_names, traceparent_parts, client_ip, route_filter, lenient_json, default_correlation,
        customer_partitions, small_scalars,
    )
}

TRACE = r"^([0-9a-f]{2})-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})$"
PARTS = ", ".join(
    f"nullif(regexp_extract(t, '{TRACE}', {k}), '') AS {n}"
    for k, n in enumerate(("version", "trace_id", "parent_id", "flags"), start=1)
)

ORACLE = {
    "validate_requests": with_tables("items", DAMAGED + """SELECT request_id, concat_ws(',', e1, e2, e3, e4, e5) AS errors,
        coalesce(e1, e2, e3, e4, e5) IS NULL AS valid FROM checked"""),
    "quarantine_reasons": with_tables("items", DAMAGED + """SELECT reason, count(*) AS requests FROM (
        SELECT e1 AS reason FROM checked UNION ALL SELECT e2 FROM checked UNION ALL SELECT e3 FROM checked
        UNION ALL SELECT e4 FROM checked UNION ALL SELECT e5 FROM checked) WHERE reason IS NOT NULL GROUP BY reason"""),
    "order_totals_unrounded": with_tables("items", """SELECT order_id, CAST(CAST(sum(price * 0.001::DECIMAL(4,3) * quantity) AS DECIMAL(19,2)) AS DOUBLE) AS total_amount,
        count(*) AS item_count FROM items GROUP BY order_id"""),
    "request_quarantine": """WITH lines AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 7 = 0 OR o_orderkey % 9 = 0 AS lost,
          '{"request_id":' || o_orderkey || ',"customer_id":' || CASE WHEN o_orderkey % 9 = 0 THEN '"none"' ELSE CAST(o_custkey AS VARCHAR) END
          || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE ',"items":[{"productId":"sku-1","quantity":3,"price":0.335}]}' END AS line FROM orders)
        SELECT CASE WHEN NOT lost THEN k END AS request_id, CASE WHEN NOT lost THEN c END AS customer_id,
        CASE WHEN NOT lost THEN 1.01::DOUBLE END AS total_amount, CASE WHEN lost THEN line END AS unreadable FROM lines""",
    "order_totals": with_tables("items", """SELECT order_id, CAST(CAST(sum(price * quantity) AS DECIMAL(19,2)) AS DOUBLE) AS total_amount,
        count(*) AS item_count FROM items GROUP BY order_id"""),
    "order_totals_nested": with_tables("items", """SELECT o_orderkey AS request_id,
        CAST(coalesce(t.total, 0) AS DOUBLE) AS total_amount, 'CREATED' AS status FROM orders
        LEFT JOIN (SELECT order_id, CAST(sum(price * quantity) AS DECIMAL(19,2)) AS total FROM items GROUP BY order_id) t
        ON t.order_id = o_orderkey"""),
    "order_items_exploded": with_tables("items", """SELECT i.order_id, o_custkey AS customer_id,
        row_number() OVER (PARTITION BY i.order_id ORDER BY product_id, quantity, price) AS item_no, product_id,
        CAST(quantity AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS price
        FROM items i JOIN orders ON o_orderkey = i.order_id"""),
    "orphan_items": with_tables("items", """SELECT order_id, count(*) AS items, CAST(sum(quantity) AS BIGINT) AS quantity FROM items
        WHERE order_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01') GROUP BY order_id"""),
    "request_hash": with_tables("items correlated", """SELECT o_orderkey AS request_id, sha256('{' || concat_ws(',',
        '"correlationId":' || CAST(to_json(correlation_id) AS VARCHAR), '"customerId":' || o_custkey, '"items":[' || coalesce(t.txt, '') || ']') || '}')
        AS request_hash FROM orders JOIN correlated ON request_id = o_orderkey LEFT JOIN (SELECT order_id,
        string_agg('{"price":' || CAST(price AS VARCHAR) || ',"productId":' || CAST(to_json(product_id) AS VARCHAR) || ',"quantity":'
        || quantity || '}', ',' ORDER BY product_id, quantity, price) AS txt FROM items GROUP BY order_id) t ON t.order_id = o_orderkey"""),
    "outbox_payload": with_tables("items correlated", """SELECT o_orderkey AS request_id, o_orderkey AS order_id, o_custkey AS customer_id,
        correlation_id, item_count, first_product, first_price, correlation_id IS NOT NULL AS has_correlation
        FROM orders JOIN correlated ON request_id = o_orderkey JOIN (SELECT order_id, count(*) AS item_count,
        min_by(product_id, row(product_id, quantity, price)) AS first_product,
        CAST(min_by(price, row(product_id, quantity, price)) AS DOUBLE) AS first_price FROM items GROUP BY order_id) t
        ON t.order_id = o_orderkey WHERE o_custkey > 0"""),
    "envelope_fields": with_tables("outbox correlated", f"""SELECT id AS event_id, order_id, customer_id, event_type, correlation_id,
        epoch_us({NOW}) AS occurred_us, id AS payload_order_id
        FROM outbox JOIN correlated ON request_id = id WHERE id % 9 <> 0"""),
    "envelope_quarantine": with_tables("outbox", """SELECT id AS event_id, 'not-json' AS payload,
        CAST(NULL AS VARCHAR) AS correlation_id FROM outbox WHERE id % 9 = 0"""),
    "outbox_projection": with_tables("outbox", """SELECT id, order_id, customer_id, event_type, CAST(status AS BIGINT) AS status,
        CAST(retry_count AS BIGINT) AS retry_count, trace_parent,
        CASE WHEN id % 9 <> 0 THEN CAST(id AS VARCHAR) END AS payload_order FROM outbox"""),
    "new_outbox_rows": with_tables("with_items", """SELECT o_orderkey AS id, o_custkey AS customer_id, 'OrderCreated' AS event_type,
        CAST(0 AS BIGINT) AS status, CAST(0 AS BIGINT) AS retry_count, true AS unlocked, o_orderkey AS payload_order,
        epoch_us(o_orderdate) AS created_us FROM orders JOIN with_items ON id = o_orderkey WHERE o_custkey > 0"""),
    "status_names": with_tables("outbox", """SELECT CASE status WHEN 0 THEN 'NEW' WHEN 1 THEN 'PROCESSING' WHEN 2 THEN 'FAILED'
        WHEN 101 THEN 'DEAD' WHEN 110 THEN 'SENT' END AS status_name, status < 100 AS active, status >= 100 AS archived,
        count(*) AS rows FROM outbox GROUP BY ALL"""),
    "traceparent_parts": with_tables("outbox", f"""SELECT id, {PARTS} FROM (SELECT id,
        CASE WHEN id % 3 = 0 THEN trace_parent || '-x' ELSE trace_parent END AS t FROM outbox)"""),
    "client_ip": with_tables("arrivals", "SELECT request_id, client_ip FROM arrivals"),
    "route_filter": """SELECT CASE event_type WHEN 'click' THEN 'post' ELSE 'POST' END AS method,
        CASE event_type WHEN 'signup' THEN '/internal/api/v1/orders' ELSE '/api/v1/orders' END AS uri, count(*) AS requests
        FROM events WHERE event_type IN ('click', 'signup', 'error') GROUP BY ALL""",
    "lenient_json": """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
        CAST(NULL AS VARCHAR) AS missing FROM events""",
    "default_correlation": """SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 5 <> 0 THEN 'corr-' || o_orderkey ELSE
        concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) END AS correlation_id
        FROM (SELECT o_orderkey, md5(o_custkey || '|' || o_orderkey) AS h FROM orders)""",
    "customer_partitions": "SELECT o_custkey % 10 AS part, count(*) AS orders FROM orders GROUP BY ALL",
    "small_scalars": with_tables("outbox", """SELECT id, epoch_us(created_at) + 30000000 AS lease_us,
        (id * 1234567 + 999) // 1000000 AS millis, CAST(strlen(CAST(customer_id AS VARCHAR)) AS BIGINT) AS key_bytes,
        epoch_us(created_at) AS parsed_us, CAST(id % 4 + 1 AS BIGINT) AS cost FROM outbox"""),
}
