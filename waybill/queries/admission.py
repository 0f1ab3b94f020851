"""Token-bucket queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.config import AdmissionConfig, BucketLimit
from waybill.functions import scalars
from waybill.operators import ratelimit as R
from waybill.queries.sql import with_tables
from waybill.sources import driver_tables as D

# The arrivals of the driver tables lie minutes apart. Their times are compressed so that buckets run empty.
COMPRESSION = 20_000
START_US = D.METRICS_START_US
LIMITS = AdmissionConfig(
    overall=BucketLimit(50, 60), per_ip=BucketLimit(6, 4), per_customer=BucketLimit(2, 1)
)


def arrivals(spark, folder):
    shifted = F.floor((F.unix_micros("arrival_ts") - START_US) / F.lit(COMPRESSION))
    return D.arrivals(spark, folder).select(
        "request_id", F.timestamp_micros(F.lit(START_US) + shifted).alias("arrival_ts"), "customer_id",
        scalars.client_ip(F.col("forwarded_for"), F.col("remote_addr")).alias("client_ip"), "instance_id",
    )


def pressures(spark, folder):
    shifted = F.floor((F.unix_micros("ts") - START_US) / F.lit(COMPRESSION))
    return D.pressure_samples(spark, folder).withColumn("ts", F.timestamp_micros(F.lit(START_US) + shifted))


def decisions(rows):
    return rows.select(F.col("id").alias("request_id"), "key", "admitted", "level_after")


def token_bucket_customer(spark, folder):
    rows = arrivals(spark, folder)
    return decisions(R.token_bucket(rows, F.col("customer_id"), F.col("arrival_ts"), F.col("request_id"), LIMITS.per_customer))


def token_bucket_ip(spark, folder):
    rows = arrivals(spark, folder)
    return decisions(R.token_bucket(rows, F.col("client_ip"), F.col("arrival_ts"), F.col("request_id"), LIMITS.per_ip))


def token_bucket_global(spark, folder):
    """One bucket for all requests: a single key, cut into runs."""
    rows = arrivals(spark, folder)
    return decisions(R.token_bucket(rows, F.lit("all"), F.col("arrival_ts"), F.col("request_id"), LIMITS.overall))


def pressure_as_of(spark, folder):
    rows = R.pressure_as_of(D.arrivals(spark, folder), D.pressure_samples(spark, folder))
    return rows.select("request_id", "instance_id", "pressure")


def costed(spark, folder):
    seen = R.pressure_as_of(arrivals(spark, folder), pressures(spark, folder))
    cost = R.adaptive_cost(F.col("pressure"), 0.8, 0.5)
    return seen.withColumn("cost", cost)


def adaptive_cost(spark, folder):
    rows = costed(spark, folder)
    return rows.groupBy("instance_id", "cost").agg(F.count(F.lit(1)).alias("requests"))


def token_bucket_adaptive(spark, folder):
    """Per address, with two tokens per request while the queue of the instance is under pressure."""
    rows = arrivals(spark, folder).join(costed(spark, folder).select("request_id", "cost"), "request_id")
    return decisions(
        R.token_bucket(rows, F.col("client_ip"), F.col("arrival_ts"), F.col("request_id"), LIMITS.per_ip, F.col("cost"))
    )


def three_tier_admission(spark, folder):
    rows = arrivals(spark, folder).withColumn("cost", F.lit(1))
    outcome, _ = R.admit_three_tiers(rows, LIMITS)
    return outcome.select("request_id", "decision", "tier")


def without_address(rows):
    """Every fifth request comes without an address."""
    return rows.withColumn("client_ip", F.when(F.col("request_id") % 5 != 0, F.col("client_ip")))


def bucket_null_keys(spark, folder):
    """Buckets per address; requests without one share a bucket."""
    rows = without_address(arrivals(spark, folder))
    return decisions(R.token_bucket(rows, F.col("client_ip"), F.col("arrival_ts"), F.col("request_id"), LIMITS.per_ip))


def admission_null_address(spark, folder):
    """A request without address passes the tier of addresses, and its customer's bucket decides."""
    rows = without_address(arrivals(spark, folder)).withColumn("cost", F.lit(1))
    outcome, _ = R.admit_three_tiers(rows, LIMITS)
    return outcome.select("request_id", "decision", "tier")


def admission_rejects(spark, folder):
    """Rejected requests per tier."""
    rows = arrivals(spark, folder).withColumn("cost", F.lit(1))
    outcome, _ = R.admit_three_tiers(rows, LIMITS)
    return outcome.groupBy(F.coalesce("tier", F.lit("none")).alias("tier")).agg(F.count(F.lit(1)).alias("requests"))


QUERIES = {
    f.__name__: f
    for f in (
        token_bucket_customer, token_bucket_ip, token_bucket_global, pressure_as_of, adaptive_cost, token_bucket_adaptive,
        three_tier_admission, admission_rejects, bucket_null_keys, admission_null_address,
    )
}

# In SQL a bucket is a recursive walk over the requests of each key, in lockstep by their number.

SHIFTED = f"""arrived AS (SELECT request_id, customer_id, client_ip, instance_id,
    {START_US} + (epoch_us(arrival_ts) - {START_US}) // {COMPRESSION} AS us FROM arrivals),
sampled AS (SELECT instance_id, {START_US} + (epoch_us(ts) - {START_US}) // {COMPRESSION} AS us, pressure FROM pressures)"""


def walk(name, source, key, limit, cost="1"):
    """Steps ``name(request_id, key, admitted, level)`` over ``source``."""
    cap, rate = limit.capacity * R.MICRO, limit.refill_per_second
    return f"""{name}_in AS MATERIALIZED (SELECT request_id, CAST({key} AS VARCHAR) AS key, us, CAST({cost} AS BIGINT) * {R.MICRO} AS cost,
    row_number() OVER (PARTITION BY {key} ORDER BY us, request_id) AS n FROM {source}),
{name} AS (SELECT request_id, key, us, n, {cap} >= cost AS admitted, CASE WHEN {cap} >= cost THEN {cap} - cost ELSE {cap} END AS level
    FROM {name}_in WHERE n = 1
  UNION ALL
  SELECT i.request_id, i.key, i.us, i.n, least({cap}, s.level + (i.us - s.us) * {rate}) >= i.cost,
    CASE WHEN least({cap}, s.level + (i.us - s.us) * {rate}) >= i.cost THEN least({cap}, s.level + (i.us - s.us) * {rate}) - i.cost
      ELSE least({cap}, s.level + (i.us - s.us) * {rate}) END
    FROM {name} s JOIN {name}_in i ON i.key = s.key AND i.n = s.n + 1)"""


def bucket_sql(key, limit, cost="1", source="arrived", extra="", shown="key"):
    body = f", {SHIFTED}{extra}, {walk('steps', source, key, limit, cost)}\nSELECT request_id, {shown} AS key, admitted, level AS level_after FROM steps"
    return with_tables("arrivals pressures", body, recursive=True)


COSTED = """, costed AS (SELECT a.*, CASE WHEN p.pressure > 0.8 THEN 2 ELSE 1 END AS cost
    FROM arrived a ASOF LEFT JOIN sampled_last p ON p.instance_id = a.instance_id AND a.us >= p.us)"""
# Several samples may share an instant after compression; the last in sort order counts, the highest.
LAST = ", sampled_last AS (SELECT instance_id, us, max(pressure) AS pressure FROM sampled GROUP BY ALL)"

TIERS = f""", {SHIFTED}, {walk('t1', 'arrived', "'all'", LIMITS.overall)},
a2 AS (SELECT * FROM arrived WHERE request_id IN (SELECT request_id FROM t1 WHERE admitted)), {walk('t2', 'a2', 'client_ip', LIMITS.per_ip)},
a3 AS (SELECT * FROM a2 WHERE request_id IN (SELECT request_id FROM t2 WHERE admitted)), {walk('t3', 'a3', 'customer_id', LIMITS.per_customer)},
refused AS (SELECT request_id, 'global' AS tier FROM t1 WHERE NOT admitted UNION ALL SELECT request_id, 'ip' FROM t2 WHERE NOT admitted
    UNION ALL SELECT request_id, 'customer' FROM t3 WHERE NOT admitted)
"""

SOME_ADDRESS = "CASE WHEN request_id % 5 <> 0 THEN client_ip ELSE 'none' END"
SKIPPING = f""", {SHIFTED}, {walk('t1', 'arrived', "'all'", LIMITS.overall)},
a2 AS (SELECT * FROM arrived WHERE request_id IN (SELECT request_id FROM t1 WHERE admitted)),
b2 AS (SELECT * FROM a2 WHERE request_id % 5 <> 0), {walk('t2', 'b2', 'client_ip', LIMITS.per_ip)},
a3 AS (SELECT * FROM a2 WHERE request_id % 5 = 0 OR request_id IN (SELECT request_id FROM t2 WHERE admitted)),
{walk('t3', 'a3', 'customer_id', LIMITS.per_customer)},
refused AS (SELECT request_id, 'global' AS tier FROM t1 WHERE NOT admitted UNION ALL SELECT request_id, 'ip' FROM t2 WHERE NOT admitted
    UNION ALL SELECT request_id, 'customer' FROM t3 WHERE NOT admitted)
SELECT request_id, CASE WHEN tier IS NULL THEN 'ADMITTED' ELSE 'REJECTED' END AS decision, tier
FROM arrived LEFT JOIN refused USING (request_id)"""

ORACLE = {
    "bucket_null_keys": bucket_sql(SOME_ADDRESS, LIMITS.per_ip, shown="nullif(key, 'none')"),
    "admission_null_address": with_tables("arrivals pressures", SKIPPING, recursive=True),
    "token_bucket_customer": bucket_sql("customer_id", LIMITS.per_customer),
    "token_bucket_ip": bucket_sql("client_ip", LIMITS.per_ip),
    "token_bucket_global": bucket_sql("'all'", LIMITS.overall),
    "pressure_as_of": with_tables("arrivals pressures", """SELECT a.request_id, a.instance_id, p.pressure FROM arrivals a
        ASOF LEFT JOIN pressures p ON p.instance_id = a.instance_id AND a.arrival_ts >= p.ts"""),
    "adaptive_cost": with_tables("arrivals pressures", f""", {SHIFTED}{LAST}{COSTED}
        SELECT instance_id, CAST(cost AS BIGINT) AS cost, count(*) AS requests FROM costed GROUP BY ALL"""),
    "token_bucket_adaptive": bucket_sql("client_ip", LIMITS.per_ip, "cost", "costed", LAST + COSTED),
    "three_tier_admission": with_tables("arrivals pressures", TIERS + """SELECT request_id, CASE WHEN tier IS NULL THEN 'ADMITTED' ELSE 'REJECTED' END
        AS decision, tier FROM arrived LEFT JOIN refused USING (request_id)""", recursive=True),
    "admission_rejects": with_tables("arrivals pressures", TIERS + """SELECT coalesce(tier, 'none') AS tier, count(*) AS requests
        FROM arrived LEFT JOIN refused USING (request_id) GROUP BY ALL""", recursive=True),
}
