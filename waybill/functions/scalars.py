"""Row-level functions on columns. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill import schemas as S


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\r\n"))


def is_blank(text: Column) -> Column:
    return text.isNull() | (trimmed(text) == "")


def blank_to_null(text: Column) -> Column:
    return F.when(~is_blank(text), text)


def decimal_text(number: Column) -> Column:
    """A long as decimal text, the form used for record keys and header values."""
    return number.cast("string")


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def price_text(price: Column) -> Column:
    """A price as decimal text with all its places, two at least."""
    return F.regexp_replace(price.cast("string"), r"(\.\d\d\d*?)0+$", "$1")


def json_with_prices(document: Column, fields: str = "price") -> Column:
    """JSON of a struct whose prices are text (``price_text``), with the prices as numbers. Quotes inside values are escaped
    in JSON, so nothing but a field matches."""
    return F.regexp_replace(F.to_json(document), f'"{fields}":"(-?[0-9.]+)"', f'"{fields}":$1')


def request_hash(customer_id: Column, items: Column, correlation_id: Column) -> Column:
    """Lower-case hex SHA-256 of the request as JSON: fields in alphabetical order, items in theirs, nulls left out."""
    one = lambda i: F.struct(price_text(i["price"]).alias("price"), i["productId"].alias("productId"), i["quantity"].alias("quantity"))
    whole = F.struct(
        correlation_id.alias("correlationId"), customer_id.alias("customerId"), F.transform(items, one).alias("items")
    )
    return F.sha2(json_with_prices(whole), 256)


def items_total(items: Column) -> Column:
    """Sum of price times quantity on unrounded prices; rounding to cents happens on the final cast."""
    zero = F.lit(0).cast("decimal(38,10)")
    add = lambda total, i: (total + i["price"] * i["quantity"]).cast("decimal(38,10)")
    return F.aggregate(items, zero, add).cast("decimal(19,2)")


def json_text(document: Column, field: str) -> Column:
    """A top-level field as text; null when the field is missing or the document is no JSON."""
    return F.get_json_object(document, f"$.{field}")


def json_long(document: Column, field: str) -> Column:
    return json_text(document, field).try_cast("bigint")


def traceparent_parts(trace_parent: Column) -> dict[str, Column]:
    """Version, trace id, parent id and flags of a W3C trace parent; nulls for blank or malformed text."""
    # Fixed value: the W3C layout 2-32-16-2 of lower-case hex digits.
    layout = "^([0-9a-f]{2})-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})$"
    text = trimmed(trace_parent)
    names = ("version", "trace_id", "parent_id", "flags")
    return {n: F.when(text.rlike(layout), F.regexp_extract(text, layout, k)) for k, n in enumerate(names, start=1)}


def client_ip(forwarded_for: Column, remote_addr: Column) -> Column:
    first = trimmed(F.split(forwarded_for, ",")[0])
    return F.when(~is_blank(forwarded_for), first).otherwise(remote_addr)


def token_cost(multiplier: Column) -> Column:
    """Tokens per request: one at full speed, more as the multiplier falls."""
    inverse = F.floor(1.0 / multiplier + 0.5)
    return F.when(multiplier >= 1.0, F.lit(1)).otherwise(F.greatest(F.lit(1), inverse)).cast("bigint")


def pressure(size: Column, capacity: Column) -> Column:
    return F.when(capacity == 0, F.lit(0.0)).otherwise(size / capacity.cast("double"))


def throttle_multiplier(pressure_: Column, threshold: float, multiplier: float) -> Column:
    return F.when(pressure_ > F.lit(threshold), F.lit(multiplier)).otherwise(F.lit(1.0))


def lease_until(now: Column, seconds: int) -> Column:
    return now + F.make_interval(secs=F.lit(seconds))


def nanos_to_millis(nanos: Column) -> Column:
    return F.floor(nanos / 1_000_000).cast("bigint")


def default_correlation(correlation_id: Column, *keys: Column) -> Column:
    """The given id, else one in UUID form made from the business keys, so a replay gives the same id."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.coalesce(correlation_id, F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]))


def customer_partition(customer_id: Column, partitions: int) -> Column:
    return F.pmod(customer_id, F.lit(partitions)).cast("int")


def is_order_route(method: Column, uri: Column) -> Column:
    return (F.upper(method) == "POST") & uri.endswith(S.ORDERS_ROUTE)


def is_active(status: Column) -> Column:
    return status < S.ARCHIVE_FROM


def is_archive(status: Column) -> Column:
    return status >= S.ARCHIVE_FROM


def lease_is_free(locked_until: Column, now: Column) -> Column:
    """Strict: a lease that ends exactly now still holds."""
    return locked_until.isNull() | (locked_until < now)


def code_name(code: Column, names: dict[int, str], strict: bool = True) -> Column:
    """Name of a stored code. Unknown codes fail the job in strict mode, else read ``UNKNOWN``."""
    chain = None
    for value, name in names.items():
        chain = F.when(code == value, name) if chain is None else chain.when(code == value, name)
    chain = chain.when(code.isNull(), None)
    if strict:
        return chain.otherwise(F.raise_error(F.concat(F.lit("unknown status code: "), code.cast("string"))))
    return chain.otherwise("UNKNOWN")


def parse_log_time(text: Column) -> Column:
    """Log time with fraction and zone, e.g. ``2024-01-01T00:00:07.179+0000`` or with ``+00:00`` / ``Z``."""
    # The accepted layouts.
    layouts = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]Z")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in layouts])


def iso_instant(ts: Column) -> Column:
    return F.date_format(ts, S.ISO_INSTANT)


# Label matchers. A label that a series lacks compares as the empty string.

def label(labels: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(labels, F.lit(name)), F.lit(""))


def label_matches(labels: Column, name: str, op: str, wanted: str) -> Column:
    value = label(labels, name)
    if op == "=":
        return value == wanted
    if op == "!=":
        return value != wanted
    anchored = f"^(?:{wanted})$"
    if op == "=~":
        return value.rlike(anchored)
    if op == "!~":
        return ~value.rlike(anchored)
    raise ValueError(f"unknown label matcher {op!r}")


def clamp_min(value: Column, least: float) -> Column:
    return F.greatest(value, F.lit(least))
