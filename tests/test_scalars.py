import datetime as dt
import hashlib
import json

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import scalars
from waybill.operators import intake


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_client_ip_takes_first_forwarded_address(spark):
    rows = [("203.0.113.1, 198.51.100.2", "10.0.0.1"), (" \t", "10.0.0.2"), (None, "10.0.0.3"), (" 192.0.2.9 ,x", "a")]
    df = spark.createDataFrame(rows, "f string, r string")
    assert [r[0] for r in df.select(scalars.client_ip(F.col("f"), F.col("r"))).collect()] == [
        "203.0.113.1", "10.0.0.2", "10.0.0.3", "192.0.2.9",
    ]


def test_traceparent_parts(spark):
    text = "00-4bf92f3577b34da6a3ce929d0e0e4736-00f067aa0ba902b7-01"
    row = one(spark, **scalars.traceparent_parts(F.lit(text)))
    assert tuple(row) == ("00", "4bf92f3577b34da6a3ce929d0e0e4736", "00f067aa0ba902b7", "01")
    assert tuple(one(spark, **scalars.traceparent_parts(F.lit("  ")))) == (None,) * 4
    assert tuple(one(spark, **scalars.traceparent_parts(F.lit(text + "0")))) == (None,) * 4


@pytest.mark.parametrize("multiplier, cost", [(1.0, 1), (2.0, 1), (0.5, 2), (0.4, 3), (0.1, 10)])
def test_token_cost(spark, multiplier, cost):
    assert one(spark, c=scalars.token_cost(F.lit(multiplier))).c == cost


def test_adaptive_cost_under_pressure(spark):
    cost = lambda p: one(spark, c=scalars.token_cost(scalars.throttle_multiplier(F.lit(p), 0.5, 0.5))).c
    assert (cost(0.9), cost(0.5), cost(0.1)) == (2, 1, 1)


def test_pressure(spark):
    row = one(spark, a=scalars.pressure(F.lit(1), F.lit(2)), b=scalars.pressure(F.lit(1), F.lit(0)))
    assert tuple(row) == (0.5, 0.0)


def test_status_codes(spark):
    df = spark.createDataFrame([(c,) for c in S.OUTBOX_STATUS], "code int")
    rows = df.select(
        scalars.code_name(F.col("code"), S.OUTBOX_STATUS), scalars.is_active(F.col("code")), scalars.is_archive(F.col("code"))
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("NEW", True, False), ("PROCESSING", True, False), ("FAILED", True, False), ("DEAD", False, True), ("SENT", False, True),
    ]
    assert one(spark, n=scalars.code_name(F.lit(7), S.OUTBOX_STATUS, strict=False)).n == "UNKNOWN"
    with pytest.raises(SparkRuntimeException):
        one(spark, n=scalars.code_name(F.lit(7), S.OUTBOX_STATUS))


def test_lease_is_strict(spark):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    at = lambda text: scalars.lease_is_free(F.lit(text).cast("timestamp"), now)
    row = one(spark, none=at(None), past=at("2024-01-31 23:59:59"), now=at("2024-02-01 00:00:00"), later=at("2024-02-01 00:00:01"))
    assert tuple(row) == (True, True, False, False)


def test_lenient_json(spark):
    good, bad = F.lit('{"correlationId":"corr-1","customerId":42}'), F.lit("not-json")
    row = one(
        spark, a=scalars.json_text(good, "correlationId"), b=scalars.json_text(bad, "correlationId"),
        c=scalars.json_long(good, "customerId"), d=scalars.json_long(good, "correlationId"), e=scalars.json_long(bad, "customerId"),
    )
    assert tuple(row) == ("corr-1", None, 42, None, None)


def test_request_hash_covers_order_scale_and_correlation(spark):
    item = lambda p, q, price: {"productId": p, "quantity": q, "price": price}
    from decimal import Decimal as D

    bodies = [
        (42, [item("sku-1", 2, D("5.00"))], "c"), (42, [item("sku-1", 2, D("5.00"))], None),
        (42, [item("sku-1", 2, D("5.01"))], "c"), (42, [item("sku-2", 2, D("5.00"))], "c"),
        (42, [item("a", 1, D("1.00")), item("b", 1, D("1.00"))], "c"), (42, [item("b", 1, D("1.00")), item("a", 1, D("1.00"))], "c"),
    ]
    df = spark.createDataFrame(bodies, f"customer_id long, items {S.ITEMS}, c string")
    hashes = [r[0] for r in df.select(scalars.request_hash(F.col("customer_id"), F.col("items"), F.col("c"))).collect()]
    assert len(set(hashes)) == 6
    text = b'{"correlationId":"c","customerId":42,"items":[{"price":5.00,"productId":"sku-1","quantity":2}]}'
    assert hashes[0] == hashlib.sha256(text).hexdigest()


def test_request_hash_tells_separators_from_text(spark):
    from decimal import Decimal as D

    one_item = [{"productId": 'a":1,"b', "quantity": 2, "price": D("2.00")}]
    odd = [{"productId": "a:1:2.00;b", "quantity": 1, "price": D("2.00")}]
    two = [{"productId": "a", "quantity": 1, "price": D("2.00")}, {"productId": "b", "quantity": 1, "price": D("2.00")}]
    df = spark.createDataFrame([(1, one_item, None), (1, odd, None), (1, two, None), (1, None, None), (None, two, None)], f"customer_id long, items {S.ITEMS}, c string")
    assert df.select(scalars.request_hash(F.col("customer_id"), F.col("items"), F.col("c"))).distinct().count() == 5


def test_log_time_and_iso(spark):
    for text in ("2024-01-01T00:00:07.179+0000", "2024-01-01T00:00:07.179Z", "2024-01-01T02:00:07.179+02:00"):
        assert one(spark, t=scalars.parse_log_time(F.lit(text))).t == dt.datetime(2024, 1, 1, 0, 0, 7, 179000), text
    assert one(spark, t=scalars.parse_log_time(F.lit("yesterday"))).t is None
    stamp = F.lit("2024-01-01 00:00:07.179575").cast("timestamp")
    assert one(spark, t=scalars.iso_instant(stamp)).t == "2024-01-01T00:00:07.179575Z"


def test_label_matchers(spark):
    labels = F.create_map(F.lit("uri"), F.lit("/actuator/health"), F.lit("job"), F.lit("order-service"))
    m = lambda name, op, wanted: scalars.label_matches(labels, name, op, wanted)
    row = one(
        spark, a=m("job", "=", "order-service"), b=m("uri", "!~", "/actuator/.*"), c=m("uri", "=~", "/actuator"),
        d=m("gone", "=", ""), e=m("gone", "!=", ""), f=m("job", "!=", "x"),
    )
    assert tuple(row) == (True, False, False, True, False, True)


def test_small_ones(spark):
    row = one(
        spark, ms=scalars.nanos_to_millis(F.lit(1_999_999)), part=scalars.customer_partition(F.lit(42), 10),
        raw=scalars.utf8(scalars.decimal_text(F.lit(42))), blank=scalars.is_blank(F.lit(" \t\n")),
        given=scalars.default_correlation(F.lit("x"), F.lit(1)), made=scalars.default_correlation(F.lit(None).cast("string"), F.lit(1)),
        again=scalars.default_correlation(F.lit(None).cast("string"), F.lit(1)), least=scalars.clamp_min(F.lit(0.0), 1e-9),
        route=scalars.is_order_route(F.lit("post"), F.lit("/internal/api/v1/orders")),
    )
    assert (row.ms, row.part, bytes(row.raw), row.blank, row.given, row.least, row.route) == (1, 2, b"42", True, "x", 1e-9, True)
    assert row.made == row.again and len(row.made) == 36


def test_prices_keep_their_places(spark):
    from decimal import Decimal

    item = lambda price, q=3: [("sku", q, Decimal(price))]
    bodies = [(1, item("0.335")), (1, item("0.34")), (1, item("12.3")), (1, item("0.0000000001", 1)), (1, item("9999999999999999.9999999999", 1))]
    df = spark.createDataFrame(bodies, f"customer_id long, items {S.ITEMS}")
    none = F.lit(None).cast("string")
    rows = df.select(
        scalars.items_total(F.col("items")).alias("total"), scalars.request_hash(F.col("customer_id"), F.col("items"), none).alias("digest"),
        intake.order_payload(F.lit(7), F.col("customer_id"), F.col("items"), none).alias("payload"),
    ).collect()
    # 3 x 0.335 = 1.005; cents come from the total, rounded half up.
    assert [str(r.total) for r in rows[:4]] == ["1.01", "1.02", "36.90", "0.00"]
    assert len({r.digest for r in rows}) == len(rows)
    prices = [r.payload.split('"price":')[1].split("}")[0] for r in rows]
    assert prices == ["0.335", "0.34", "12.30", "0.0000000001", "9999999999999999.9999999999"]
    odd = spark.createDataFrame([(1, [('a"price":"1"', 1, Decimal("1"))])], f"customer_id long, items {S.ITEMS}")
    text = odd.select(intake.order_payload(F.lit(7), F.col("customer_id"), F.col("items"), none)).first()[0]
    assert json.loads(text)["items"] == [{"productId": 'a"price":"1"', "quantity": 1, "price": 1.0}]
