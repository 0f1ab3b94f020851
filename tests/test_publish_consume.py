import datetime as dt
import json

from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import consume, publish

NOW = dt.datetime(2024, 2, 1, 1, 2, 3, 456000)
OUTBOX = "id long, order_id long, customer_id long, event_type string, payload string, trace_parent string"


def outbox(spark, *rows):
    return spark.createDataFrame(rows, OUTBOX)


def records(spark, *rows):
    good, bad = publish.split_envelopes(outbox(spark, *rows), F.lit(NOW))
    return publish.records(good, "orders.events", 10), bad


def test_record_of_an_envelope(spark):
    payload = '{"customerId":42, "orderId":99, "correlationId":"corr-99", "extra":[1]}'
    made, _ = records(spark, (1, 99, 42, "OrderCreated", payload, "00-a-b-01"))
    row = made.first()
    assert (row.key, row.topic, row.partition) == ("42", "orders.events", 2)
    assert [(h.key, bytes(h.value).decode()) for h in row.headers] == [
        ("eventId", "1"), ("orderId", "99"), ("customerId", "42"), ("correlationId", "corr-99"), ("traceparent", "00-a-b-01"),
    ]
    assert json.loads(row.value) == {
        "eventId": 1, "orderId": 99, "customerId": 42, "eventType": "OrderCreated", "correlationId": "corr-99",
        "payload": {"customerId": 42, "orderId": 99, "correlationId": "corr-99", "extra": [1]},
        "occurredAt": "2024-02-01T01:02:03.456000Z",
    }


def test_missing_values_are_left_out(spark):
    made, _ = records(spark, (1, 99, 42, "OrderCreated", '{"orderId":99}', "  "))
    row = made.first()
    assert [h.key for h in row.headers] == ["eventId", "orderId", "customerId"]
    assert "correlationId" not in json.loads(row.value)


def test_unreadable_payloads_are_set_apart(spark):
    made, bad = records(spark, (1, 1, 1, "t", "not-json", None), (2, 2, 2, "t", "{}", None), (3, 3, 3, "t", None, None), (4, 4, 4, "t", "[1]", None))
    assert made.count() == 1
    assert sorted(r.event_id for r in bad.collect()) == [1, 3, 4]


def test_round_trip_to_notification(spark):
    made, _ = records(spark, (5, 7, 3, "OrderCreated", '{"orderId":7,"correlationId":"c"}', "00-x-y-01"), (6, 8, 3, "OrderCreated", "{}", None))
    topic = publish.with_offsets(made, slice_rows=1)
    readable, unreadable = consume.split_readable(topic)
    found = consume.notifications(readable).orderBy("event_id").collect()
    assert unreadable.count() == 0
    assert [tuple(r) for r in found] == [
        (5, 7, 3, "OrderCreated", "c", "orders.events", 3, 0, "log", "sent", "00-x-y-01"),
        (6, 8, 3, "OrderCreated", None, "orders.events", 3, 1, "log", "sent", None),
    ]


def test_envelope_reading_is_lenient_about_fields_only(spark):
    values = ['{"eventId":1,"unknown":{"a":1},"payload":{"orderId":1}}', '{"eventId":', "", '{"orderId":1}']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    readable, unreadable = consume.split_readable(df)
    assert [json.loads(r.event.payload) for r in readable.collect()] == [{"orderId": 1}]
    assert unreadable.count() == 3


def test_last_header_wins(spark):
    headers = [{"key": "traceparent", "value": b"a"}, {"key": "x", "value": b"z"}, {"key": "traceparent", "value": b"b"}]
    df = spark.createDataFrame([(headers,), ([],), (None,), ([{"key": "traceparent", "value": None}],)], "headers array<struct<key:string,value:binary>>")
    assert [r[0] for r in df.select(consume.header_text(F.col("headers"), "traceparent")).collect()] == ["b", None, None, None]


def test_order_violations_across_slices(spark):
    ids = [1, 2, 3, 9, 4, 10, 11, 5]
    df = spark.createDataFrame([(0, "k", i, o) for o, i in enumerate(ids)] + [(0, "other", 2, 100)], "partition int, key string, event_id long, offset long")
    for rows in (1, 3, 1000):
        found = publish.order_violations(df, slice_rows=rows).collect()
        assert sorted((r.event_id, r.previous_event_id) for r in found) == [(4, 9), (5, 11)]


def test_key_order_layout(spark):
    df = spark.createDataFrame([(c, e) for e in range(20) for c in (1, 2, 3)], "customer_id long, event_id long")
    laid = publish.in_key_order(df).withColumn("p", F.spark_partition_id()).withColumn("n", F.monotonically_increasing_id()).collect()
    for customer in (1, 2, 3):
        mine = sorted((r.n, r.event_id, r.p) for r in laid if r.customer_id == customer)
        assert [e for _, e, _ in mine] == list(range(20)) and len({p for _, _, p in mine}) == 1


def test_one_notification_per_event(spark):
    df = spark.createDataFrame([(1, 0, 5, "a"), (1, 0, 9, "b"), (2, 1, 0, "c")], "event_id long, partition int, offset long, status string")
    assert sorted((r.event_id, r.offset, r.status) for r in consume.once_per_event(df).collect()) == [(1, 5, "a"), (2, 0, "c")]


def test_schemas_parse(spark):
    for text in (S.REQUEST, S.ORDERS, S.ORDER_ITEMS, S.IDEMPOTENCY_KEYS, S.OUTBOX_EVENTS, S.OUTBOX_TRANSITIONS, S.PAYLOAD, S.ENVELOPE,
                 S.RESPONSE, S.TOPIC_RECORDS, S.NOTIFICATIONS, S.METRIC_SAMPLES, S.LOGS, S.SPANS, S.REQUEST_BODY):
        assert spark.createDataFrame([], text).columns
