import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import idempotency, intake
from waybill.sources import driver_tables

T0 = dt.datetime(2024, 1, 1)
REQUESTS = "request_id long, arrival_ts timestamp, customer_id long, idempotency_key string, request_hash string"


def item(product="sku-1", quantity=2, price="5.00"):
    return {"productId": product, "quantity": quantity, "price": None if price is None else D(price)}


def bodies(spark, rows):
    return spark.createDataFrame(rows, f"request_id long, customer_id long, items {S.ITEMS}, correlation_id string")


def test_validation_reports_each_broken_rule(spark):
    rows = [
        (1, 42, [item()], "c"), (2, None, [item()], "c"), (3, 0, [], "c"), (4, 1, None, "c"), (5, 1, [item(" ")], "c"),
        (6, 1, [item(quantity=0)], None), (7, 1, [item(price=None)], None), (8, 1, [item(None, None, "0.00")], None),
    ]
    found = {r.request_id: r.errors for r in intake.validated(bodies(spark, rows)).collect()}
    assert found == {
        1: [], 2: ["customerId"], 3: ["customerId", "items"], 4: ["items"], 5: ["items.productId"], 6: ["items.quantity"],
        7: ["items.price"], 8: ["items.productId", "items.quantity", "items.price"],
    }
    valid, rejected = intake.split_valid(bodies(spark, rows))
    assert (valid.count(), rejected.count()) == (1, 7)


def test_orders_without_items_are_quarantined(spark, folder):
    _, rejected = intake.split_valid(driver_tables.requests(spark, folder))
    ids = {r.o_orderkey for r in driver_tables.table(spark, folder, "orders").select("o_orderkey").collect()}
    with_items = {r[0] for r in driver_tables.table(spark, folder, "lineitem").select("l_orderkey").distinct().collect()}
    empty = {r.request_id for r in rejected.collect() if "items" in r.errors}
    assert empty == ids - with_items


def test_created_rows(spark):
    df = bodies(spark, [(99, 42, [item()], "corr-1"), (100, 42, [item()], None)]).withColumns(
        {"arrival_ts": F.lit(T0), "idempotency_key": F.lit("k"), "request_hash": F.lit("h")}
    )
    created = intake.with_ids(df)
    order = intake.order_rows(created).orderBy("id").first()
    assert (order.total_amount, order.status, order.created_at, order.updated_at) == (D("10.00"), "CREATED", T0, T0)
    assert intake.created_item_rows(created).count() == 2
    rows = intake.outbox_rows(created).orderBy("id").collect()
    first, second = (json.loads(r.payload) for r in rows)
    assert first == {"orderId": 99, "customerId": 42, "items": [{"productId": "sku-1", "quantity": 2, "price": 5.0}], "correlationId": "corr-1"}
    assert "correlationId" not in second
    assert (rows[0].status, rows[0].retry_count, rows[0].locked_by, rows[0].event_type) == (0, 0, None, "OrderCreated")
    key = intake.key_rows(created).orderBy("id").first()
    assert key.status == S.KEY_COMPLETED
    assert json.loads(key.response_body) == {
        "orderId": 99, "eventId": 99, "status": "ACCEPTED", "createdAt": "2024-01-01T00:00:00.000000Z",
    }


def classify(spark, rows, stored=None, **options):
    df = spark.createDataFrame(rows, REQUESTS)
    kept = None if stored is None else spark.createDataFrame(
        stored, "customer_id long, idempotency_key string, request_hash string, status int, response_body string"
    )
    return {r.request_id: (r.outcome, r.http_status, r.owner_request_id) for r in idempotency.classified(df, kept, **options).collect()}


def test_first_request_wins(spark):
    rows = [
        (1, T0, 7, "K", "a"), (2, T0 + dt.timedelta(seconds=1), 7, "K", "a"), (3, T0, 8, "K", "s1"),
        (4, T0 + dt.timedelta(seconds=1), 8, "K", "s2"), (5, T0, 9, "K", "a"), (6, T0, 9, "K", "a"),
    ]
    assert classify(spark, rows) == {
        1: ("CREATED", 201, 1), 2: ("REPLAYED", 200, 1), 3: ("CREATED", 201, 3), 4: ("CONFLICT_HASH", 409, 3),
        5: ("CREATED", 201, 5), 6: ("REPLAYED", 200, 5),
    }


@pytest.mark.parametrize(
    "status, body, request_hash, outcome",
    [
        (S.KEY_PROCESSING, None, "h", "CONFLICT_PROCESSING"), (S.KEY_FAILED, None, "h", "NO_USABLE_ROW"),
        (S.KEY_COMPLETED, None, "h", "NO_USABLE_ROW"), (S.KEY_COMPLETED, '{"orderId":1}', "h", "REPLAYED"),
        (S.KEY_COMPLETED, "not-json", "h", "UNREADABLE_BODY"), (S.KEY_COMPLETED, "not-json", "x", "CONFLICT_HASH"),
        (S.KEY_PROCESSING, None, "x", "CONFLICT_HASH"), (S.KEY_FAILED, None, "x", "CONFLICT_HASH"),
    ],
)
def test_stored_key(spark, status, body, request_hash, outcome):
    found = classify(spark, [(1, T0, 5, "K", request_hash)], [(5, "K", "h", status, body)])
    assert found[1] == (outcome, idempotency.HTTP_STATUS[outcome], None)


def test_hot_and_cold_paths_agree(spark):
    rows = [(i, T0 + dt.timedelta(seconds=i), 1 if i % 3 else i, "K", str(i % 2)) for i in range(600)]
    assert classify(spark, rows, hot_rows=1) == classify(spark, rows, hot_rows=10) == classify(spark, rows)
    assert len(classify(spark, rows, hot_rows=10)) == 600


def test_insert_if_absent(spark):
    df = spark.createDataFrame([(1, T0, 5, "K", "h"), (2, T0, 5, "L", "h"), (3, T0, 5, "L", "x")], REQUESTS)
    stored = spark.createDataFrame([(5, "K")], "customer_id long, idempotency_key string")
    assert [r.owner_request_id for r in idempotency.insert_if_absent(df, stored).collect()] == [2]


def test_requests_without_key_are_invalid(spark):
    rows = [(1, T0, 5, None, "a"), (2, T0, 5, None, "b"), (3, T0, 5, "K", "a")]
    assert classify(spark, rows) == {1: ("INVALID", 400, None), 2: ("INVALID", 400, None), 3: ("CREATED", 201, 3)}
