"""Order requests: validation, totals, item rows, payloads and the rows an accepted request turns into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import scalars

# The field each rule is about, as reported to the client.
RULES = ("idempotencyKey", "customerId", "items", "items.productId", "items.quantity", "items.price")


def violations(customer_id: Column, items: Column, idempotency_key: Column | None = None) -> Column:
    """The key is a required header, looked at where it is given. The fields of a request that break a rule, in the order of ``RULES``; an empty array for a valid request."""
    some = F.coalesce(F.size(items), F.lit(0)) > 0
    broken = {
        "idempotencyKey": F.lit(False) if idempotency_key is None else idempotency_key.isNull(),
        "customerId": customer_id.isNull() | (customer_id <= 0),
        "items": ~some,
        "items.productId": some & F.exists(items, lambda i: scalars.is_blank(i["productId"])),
        "items.quantity": some & F.exists(items, lambda i: F.coalesce(i["quantity"], F.lit(0)) <= 0),
        "items.price": some & F.exists(items, lambda i: F.coalesce(i["price"], F.lit(0).cast("decimal(19,2)")) <= 0),
    }
    return F.array_compact(F.array(*[F.when(broken[rule], F.lit(rule)) for rule in RULES]))


def validated(requests: DataFrame) -> DataFrame:
    key = F.col("idempotency_key") if "idempotency_key" in requests.columns else None
    return requests.withColumn("errors", violations(F.col("customer_id"), F.col("items"), key))


def split_valid(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = validated(requests)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def order_totals(items: DataFrame) -> DataFrame:
    """Total per order from item rows."""
    return items.groupBy("order_id").agg(
        F.sum(F.col("price") * F.col("quantity")).cast("decimal(19,2)").alias("total_amount"),
        F.count(F.lit(1)).alias("item_count"),
    )


def item_rows(requests: DataFrame) -> DataFrame:
    """One row per item of a request."""
    exploded = requests.select("request_id", "customer_id", "arrival_ts", F.posexplode("items").alias("pos", "item"))
    return exploded.select(
        F.col("request_id").alias("order_id"),
        "customer_id",
        (F.col("pos") + 1).alias("item_no"),
        F.col("item.productId").alias("product_id"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.price").alias("price"),
        F.col("arrival_ts").alias("created_at"),
    )


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items without an order row."""
    return items.join(orders.select(F.col("id").alias("order_id")), "order_id", "left_anti")


def order_payload(order_id: Column, customer_id: Column, items: Column, correlation_id: Column) -> Column:
    """Event payload as JSON, with prices as posted. A missing correlation id is left out."""
    one = lambda i: F.struct(i["productId"].alias("productId"), i["quantity"].alias("quantity"), scalars.price_text(i["price"]).alias("price"))
    return scalars.json_with_prices(
        F.struct(
            order_id.alias("orderId"), customer_id.alias("customerId"), F.transform(items, one).alias("items"),
            correlation_id.alias("correlationId"),
        )
    )


def response_body(order_id: Column, event_id: Column, created_at: Column) -> Column:
    return F.to_json(
        F.struct(
            order_id.alias("orderId"), event_id.alias("eventId"),
            F.lit(S.RESPONSE_STATUS_ACCEPTED).alias("status"), scalars.iso_instant(created_at).alias("createdAt"),
        )
    )


def with_ids(created: DataFrame) -> DataFrame:
    """Order and event take the id of the request that created them: unique, and the same on every run."""
    return created.withColumn("order_id", F.col("request_id")).withColumn("event_id", F.col("request_id"))


def order_rows(created: DataFrame) -> DataFrame:
    return created.select(
        F.col("order_id").alias("id"),
        "customer_id",
        F.lit(S.ORDER_STATUS_CREATED).alias("status"),
        scalars.items_total(F.col("items")).alias("total_amount"),
        F.col("arrival_ts").alias("created_at"),
        F.col("arrival_ts").alias("updated_at"),
    )


def created_item_rows(created: DataFrame) -> DataFrame:
    """Item rows with prices in cents; ``id`` numbers the items of an order, so (order_id, id) is unique."""
    rows = item_rows(created.withColumn("request_id", F.col("order_id")))
    number = F.col("item_no").cast("bigint").alias("id")
    cents = F.col("price").cast("decimal(19,2)").alias("price")
    return rows.select(number, "order_id", "customer_id", "product_id", "quantity", cents, "created_at")


def key_rows(created: DataFrame) -> DataFrame:
    """The keys of created requests, completed and with the response to replay."""
    body = response_body(F.col("order_id"), F.col("event_id"), F.col("arrival_ts"))
    return created.select(
        F.col("order_id").alias("id"), "customer_id", "idempotency_key", "request_hash",
        F.lit(S.KEY_COMPLETED).alias("status"), body.alias("response_body"),
        F.col("arrival_ts").alias("created_at"), F.col("arrival_ts").alias("updated_at"),
    )


def outbox_rows(created: DataFrame) -> DataFrame:
    """New outbox rows: status NEW, no retries, no lease."""
    payload = order_payload(F.col("order_id"), F.col("customer_id"), F.col("items"), F.col("correlation_id"))
    trace = F.col("trace_parent") if "trace_parent" in created.columns else F.lit(None).cast("string")
    none = F.lit(None).cast("timestamp")
    return created.select(
        F.col("event_id").alias("id"), "order_id", "customer_id",
        F.lit(S.EVENT_TYPE_ORDER_CREATED).alias("event_type"), payload.alias("payload"),
        F.lit(S.NEW).alias("status"), F.lit(0).alias("retry_count"),
        F.lit(None).cast("string").alias("locked_by"), none.alias("locked_until"), none.alias("sent_at"),
        F.col("arrival_ts").alias("created_at"), scalars.blank_to_null(trace).alias("trace_parent"),
    )
