"""Idempotency keys: the first request of a (customer, key) creates, later ones are replays or conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.plans.skew import join_per_key

KEY = ["customer_id", "idempotency_key"]

# Outcome -> response code.
HTTP_STATUS = {
    "INVALID": 400,
    "CREATED": 201,
    "REPLAYED": 200,
    "CONFLICT_HASH": 409,
    "CONFLICT_PROCESSING": 409,
    "NO_USABLE_ROW": 500,
    "UNREADABLE_BODY": 500,
}


def first_requests(requests: DataFrame) -> DataFrame:
    """The winner of each key: earliest arrival, then lowest id. Requests without key own nothing. Combined before the shuffle, so hot keys are cheap."""
    first = F.min(F.struct("arrival_ts", "request_id", "request_hash")).alias("first")
    return requests.dropna(subset=KEY).groupBy(*KEY).agg(first, F.count(F.lit(1)).alias("requests")).select(
        *KEY,
        F.col("first.request_id").alias("owner_request_id"),
        F.col("first.request_hash").alias("owner_hash"),
        F.col("first.arrival_ts").alias("owner_arrival_ts"),
        "requests",
    )


def by_key(stored: DataFrame, customer_id: int, key: str) -> DataFrame:
    return stored.filter((F.col("customer_id") == customer_id) & (F.col("idempotency_key") == key))


def insert_if_absent(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Winners whose key is not stored yet."""
    return first_requests(requests).join(stored.select(*KEY), KEY, "left_anti")


def outcome(is_stored: Column) -> Column:
    """A request without key is invalid. The request hash is compared before any status is looked at."""
    other_hash = F.col("request_hash") != F.col("owner_hash")
    has_body = F.col("stored_body").isNotNull()
    stored_case = (
        F.when(other_hash, "CONFLICT_HASH")
        .when((F.col("stored_status") == S.KEY_COMPLETED) & has_body & F.try_parse_json("stored_body").isNull(), "UNREADABLE_BODY")
        .when((F.col("stored_status") == S.KEY_COMPLETED) & has_body, "REPLAYED")
        .when(F.col("stored_status") == S.KEY_PROCESSING, "CONFLICT_PROCESSING")
        .otherwise("NO_USABLE_ROW")
    )
    fresh_case = (
        F.when(F.col("request_id") == F.col("owner_request_id"), "CREATED")
        .when(other_hash, "CONFLICT_HASH")
        .when(F.col("owner_request_id").isNotNull(), "REPLAYED")
        .otherwise(F.raise_error(F.lit("a request whose key has no owner")))
    )
    no_key = F.col("customer_id").isNull() | F.col("idempotency_key").isNull()
    return F.when(no_key, "INVALID").when(is_stored, stored_case).otherwise(fresh_case)


def classified(requests: DataFrame, stored: DataFrame | None = None, hot_rows: int = 10_000_000) -> DataFrame:
    """Every request with ``outcome``, ``http_status`` and the request that owns its key (null for a stored key).

    ``stored`` has one row per key. Rows of keys without limit on their size are handled by ``join_per_key``.
    """
    owners = first_requests(requests)
    if stored is None:
        per_key = owners.withColumns(
            {
                "stored_status": F.lit(None).cast("int"),
                "stored_body": F.lit(None).cast("string"),
                "is_stored": F.lit(False),
            }
        )
    else:
        known = stored.select(
            *KEY, F.col("request_hash").alias("stored_hash"), F.col("status").alias("stored_status"),
            F.col("response_body").alias("stored_body"),
        )
        is_stored = F.col("stored_status").isNotNull()
        per_key = (
            owners.join(known, KEY, "left")
            .withColumn("is_stored", is_stored)
            .withColumn("owner_hash", F.coalesce("stored_hash", "owner_hash"))
            .withColumn("owner_request_id", F.when(~is_stored, F.col("owner_request_id")))
            .drop("stored_hash")
        )
    joined = join_per_key(requests, per_key.drop("owner_arrival_ts"), KEY, "requests", "request_id", hot_rows)
    named = joined.withColumn("outcome", outcome(F.col("is_stored")))
    code = F.lit(None).cast("int")
    for name, status in HTTP_STATUS.items():
        code = F.when(F.col("outcome") == name, status).otherwise(code)
    return named.withColumn("http_status", code).drop("owner_hash", "stored_status", "stored_body", "is_stored")
