"""From outbox rows to topic records: envelopes, headers, JSON values, key order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import scalars
from waybill.plans import slices


def payload_ok(payload: Column) -> Column:
    """Whether a payload is a JSON object."""
    return F.coalesce(F.ltrim(payload).startswith("{") & F.try_parse_json(payload).isNotNull(), F.lit(False))


def envelopes(rows: DataFrame, now: Column) -> DataFrame:
    """Envelope columns per outbox row. ``payload_ok`` tells whether the payload can be read."""
    return rows.select(
        F.col("id").alias("event_id"), "order_id", "customer_id", "event_type", "payload",
        scalars.json_text(F.col("payload"), "correlationId").alias("correlation_id"),
        now.alias("occurred_at"), "trace_parent",
        (F.col("trace_state") if "trace_state" in rows.columns else F.lit(None).cast("string")).alias("trace_state"),
        payload_ok(F.col("payload")).alias("payload_ok"),
    )


def split_envelopes(rows: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that can be published, and rows whose payload cannot be read."""
    built = envelopes(rows, now)
    return built.filter("payload_ok").drop("payload_ok"), built.filter("not payload_ok").drop("payload_ok")


def envelope_json() -> Column:
    """The record value: payload as a nested object, instants in ISO form, nulls and the trace parent left out."""
    return F.to_json(
        F.struct(
            F.col("event_id").alias("eventId"), F.col("order_id").alias("orderId"),
            F.col("customer_id").alias("customerId"), F.col("event_type").alias("eventType"),
            F.parse_json("payload").alias("payload"), F.col("correlation_id").alias("correlationId"),
            scalars.iso_instant(F.col("occurred_at")).alias("occurredAt"),
        )
    )


def record_headers() -> Column:
    """Ids as decimal text, then correlation id, trace parent and, with a trace parent, trace state where present; all values as UTF-8 bytes."""
    texts = {
        "eventId": scalars.decimal_text(F.col("event_id")),
        "orderId": scalars.decimal_text(F.col("order_id")),
        "customerId": scalars.decimal_text(F.col("customer_id")),
        "correlationId": F.col("correlation_id"),
        "traceparent": scalars.blank_to_null(F.col("trace_parent")),
        "tracestate": F.when(~scalars.is_blank(F.col("trace_parent")), scalars.blank_to_null(F.col("trace_state"))),
    }
    entries = [
        F.when(text.isNotNull(), F.struct(F.lit(name).alias("key"), scalars.utf8(text).alias("value")))
        for name, text in texts.items()
    ]
    return F.array_compact(F.array(*entries))


def records(envelopes_: DataFrame, topic: str, partitions: int) -> DataFrame:
    """Topic records. The partition follows from the customer, so one customer's records keep their order."""
    if "trace_state" not in envelopes_.columns:
        envelopes_ = envelopes_.withColumn("trace_state", F.lit(None).cast("string"))
    return envelopes_.select(
        scalars.decimal_text(F.col("customer_id")).alias("key"),
        envelope_json().alias("value"),
        record_headers().alias("headers"),
        F.lit(topic).alias("topic"),
        scalars.customer_partition(F.col("customer_id"), partitions).alias("partition"),
        "event_id", "customer_id",
        F.col("occurred_at").alias("timestamp"),
    )


def with_offsets(records_: DataFrame, slice_rows: int = 1_000_000) -> DataFrame:
    """Offset per partition, from zero, in the order of the event id."""
    by_id = slices.id_slice(F.col("event_id"), slice_rows)
    numbered = slices.ranked(records_, ["partition"], ["event_id"], by_id, "__n")
    return numbered.withColumn("offset", F.col("__n") - 1).drop("__n")


def in_key_order(batch: DataFrame) -> DataFrame:
    """Layout for a sink that needs each key's records in order from one task. For batches of bounded size."""
    return batch.repartition("customer_id").sortWithinPartitions("customer_id", "event_id")


def order_violations(published: DataFrame, slice_rows: int = 1_000_000) -> DataFrame:
    """Records whose event id is lower than the one before them, per partition and key in offset order."""
    by_offset = slices.id_slice(F.col("offset"), slice_rows)
    seen = slices.previous(published, ["partition", "key"], "offset", by_offset, "event_id", "previous_event_id")
    return seen.filter(F.col("event_id") < F.col("previous_event_id"))
