"""Idempotency, outbox state, queue, publishing and consumption queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.config import DEFAULTS
from waybill.functions import scalars
from waybill.operators import consume, idempotency, intake, outbox, publish, queueing
from waybill.queries.orders import outbox_with_payload
from waybill.queries.sql import NOW, with_tables
from waybill.plans import slices
from waybill.sources import driver_tables as D

LATER = "2024-01-10"


def us(column):
    return F.unix_micros(column).alias(f"{column.removesuffix('_until').removesuffix('_at')}_us")


# Idempotency.

def idempotency_first_wins(spark, folder):
    return idempotency.first_requests(D.arrivals(spark, folder)).select(
        "customer_id", "idempotency_key", "owner_request_id", "owner_hash", "requests"
    )


def idempotency_outcomes(spark, folder):
    rows = idempotency.classified(D.arrivals(spark, folder))
    return rows.select(
        "request_id", "outcome", F.col("http_status").cast("bigint").alias("http_status"), "owner_request_id"
    )


def idempotency_outcome_counts(spark, folder):
    rows = idempotency.classified(D.arrivals(spark, folder))
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("requests"))


def idempotency_missing_key(spark, folder):
    """Every seventh request comes without a key: invalid, and no owner of anything."""
    keyed = F.when(F.col("request_id") % 7 != 0, F.col("idempotency_key"))
    rows = idempotency.classified(D.arrivals(spark, folder).withColumn("idempotency_key", keyed))
    return rows.select(
        "request_id", "outcome", F.col("http_status").cast("bigint").alias("http_status"), "owner_request_id"
    )


def ranked_null_group(spark, folder):
    """Numbers of the events of each type, those without a type being a group as well."""
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    rows = D.table(spark, folder, "events").select("event_id", kind.alias("kind"))
    numbered = slices.ranked(rows, ["kind"], ["event_id"], slices.id_slice(F.col("event_id"), 1_000_000), "n")
    return numbered.select("event_id", "kind", F.col("n").cast("bigint").alias("n"))


def later_arrivals(spark, folder):
    return D.arrivals(spark, folder).filter(F.col("arrival_ts") >= F.lit(LATER).cast("timestamp"))


def idempotency_against_store(spark, folder):
    rows = idempotency.classified(later_arrivals(spark, folder), D.stored_keys(spark, folder))
    return rows.select("request_id", "outcome", F.col("http_status").cast("bigint").alias("http_status"))


def idempotency_insert_if_absent(spark, folder):
    rows = idempotency.insert_if_absent(later_arrivals(spark, folder), D.stored_keys(spark, folder))
    return rows.select("customer_id", "idempotency_key", "owner_request_id")


def idempotency_completed_keys(spark, folder):
    """Rows stored for created requests: COMPLETED, with the response to replay."""
    arrivals = D.arrivals(spark, folder)
    created = idempotency.classified(arrivals).filter("outcome = 'CREATED'")
    rows = intake.key_rows(created.withColumn("order_id", F.col("request_id")).withColumn("event_id", F.col("request_id")))
    body = F.from_json("response_body", S.RESPONSE)
    return rows.select(
        "id", "customer_id", "idempotency_key", "request_hash", F.col("status").cast("bigint").alias("status"),
        body["orderId"].alias("order_id"), body["status"].alias("response"),
        F.unix_micros(body["createdAt"]).alias("created_us"),
    )


# Outbox state.

def active_pending(spark, folder):
    return outbox.active_pending(D.outbox(spark, folder))


def recovery_candidates(spark, folder):
    rows = outbox.recovery_candidates(D.outbox(spark, folder), D.now(), DEFAULTS.recovery.batch_size)
    return rows.select("id", F.col("status").cast("bigint").alias("status"), us("locked_until"))


def recovery_envelopes(spark, folder):
    """The flagship: candidates from narrow outbox rows; payloads and records are built for these ids only."""
    limit = DEFAULTS.recovery.batch_size
    ids = outbox.recovery_candidates(D.outbox(spark, folder), D.now(), limit)
    narrow = F.broadcast(ids.select(F.col("id").alias("order_id")))  # at most ``limit`` ids
    bodies = D.nested_items(D.order_items(spark, folder).join(narrow, "order_id", "left_semi"))
    payload = intake.order_payload(F.col("order_id"), F.col("customer_id"), F.col("items"), F.lit(None).cast("string"))
    rows = ids.join(bodies, "order_id").withColumn("payload", payload)
    good, _ = publish.split_envelopes(rows, D.now())
    sent = publish.records(good, DEFAULTS.publisher.topic, DEFAULTS.publisher.topic_partitions)
    return sent.select(
        "event_id", "key", F.col("partition").cast("bigint").alias("part"),
        scalars.json_long(F.col("value"), "orderId").alias("order_id"),
        scalars.json_text(F.col("value"), "eventType").alias("event_type"),
        scalars.json_long(scalars.json_text(F.col("value"), "payload"), "customerId").alias("payload_customer"),
        F.size("headers").cast("bigint").alias("headers"),
    )


def recovery_lease(spark, folder):
    candidates = outbox.recovery_candidates(D.outbox(spark, folder), D.now(), DEFAULTS.recovery.batch_size)
    rows = outbox.recovery_lease(candidates, "pod-0", D.now(), DEFAULTS.publisher.lease_seconds)
    return rows.select(
        "id", F.col("step").cast("bigint").alias("step"), F.col("status").cast("bigint").alias("status"),
        "locked_by", us("locked_until"),
    )


def wanted_ids(spark, folder):
    """Ids offered to the publisher: those of orders placed by customers of one market segment."""
    chosen = D.table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("customer_id"))
    return D.orders(spark, folder).join(chosen, "customer_id", "left_semi").select("id")


def claim_by_ids(spark, folder):
    rows = outbox.claim(
        D.outbox(spark, folder), wanted_ids(spark, folder), "pod-9", D.now(), DEFAULTS.publisher.lease_seconds
    )
    return rows.select("id", F.col("status").cast("bigint").alias("status"), "locked_by", us("locked_until"))


def reenqueueable_ids(spark, folder):
    return outbox.reofferable(D.outbox(spark, folder), wanted_ids(spark, folder), D.now())


def retry_transition(spark, folder):
    failing = D.outbox(spark, folder).filter(F.col("status").isin(S.PROCESSING, S.FAILED))
    rows = outbox.mark_failed(failing, DEFAULTS.publisher.max_retries)
    return rows.select(
        "id", F.col("status").cast("bigint").alias("status"), F.col("retry_count").cast("bigint").alias("retry_count"),
        F.col("locked_by").isNull().alias("unlocked"),
    )


def sent_transition(spark, folder):
    claimed = outbox.claim(
        D.outbox(spark, folder), wanted_ids(spark, folder), "pod-9", D.now(), DEFAULTS.publisher.lease_seconds
    )
    rows = outbox.with_part(outbox.mark_sent(claimed, D.now()))
    return rows.select(
        "id", F.col("status").cast("bigint").alias("status"), us("sent_at"), F.col("locked_by").isNull().alias("unlocked"), "part"
    )


def attempt_replay(spark, folder):
    rows = outbox.replay_attempts(D.attempts(spark, folder), DEFAULTS.publisher.max_retries)
    return rows.select(
        "id", F.col("status").cast("bigint").alias("status"), F.col("retry_count").cast("bigint").alias("retry_count"),
        us("sent_at"), F.unix_micros("ts").alias("ts_us"),
    )


def latest_state(spark, folder):
    rows = outbox.latest_state(D.transitions(spark, folder))
    return rows.select(
        "id", "seq", F.col("status").cast("bigint").alias("status"), F.col("retry_count").cast("bigint").alias("retry_count"),
        "locked_by", us("locked_until"), us("sent_at"),
    )


def state_after_log(spark, folder):
    """Outbox rows after the transition log, counted by directory and status."""
    rows = outbox.apply_state(D.outbox(spark, folder), outbox.latest_state(D.transitions(spark, folder)))
    counted = outbox.with_part(rows).groupBy("part", F.col("status").cast("bigint").alias("status"))
    return counted.agg(F.count(F.lit(1)).alias("rows"), F.count("locked_by").alias("leased"))


def active_archive_routing(spark, folder):
    rows = outbox.with_part(D.outbox(spark, folder))
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def batch_outcome(spark, folder):
    """Batches of five attempts: one failure fails them all."""
    rows = D.attempts(spark, folder).withColumn("batch_no", F.floor(F.col("attempt_id") / F.lit(5)).cast("bigint"))
    return outbox.batch_outcome(rows, "batch_no").select("attempt_id", "batch_no", "failed", "batch_failed")


def delivery_counters(spark, folder):
    """Published events, failed batches and retries, per day, for batches of five attempts."""
    rows = D.attempts(spark, folder).withColumn("batch_no", F.floor(F.col("attempt_id") / F.lit(5)).cast("bigint"))
    counted = outbox.delivery_counters(rows, "batch_no", F.date_format("ts", "yyyy-MM-dd"))
    return counted.withColumnRenamed("period", "day")


def point_lookups(spark, folder):
    """One outbox row by id, and one stored key by customer and key."""
    row = outbox.by_id(D.outbox(spark, folder), 7).select(
        F.lit("outbox").alias("kind"), F.col("customer_id"), F.col("event_type").alias("text")
    )
    key = idempotency.by_key(D.stored_keys(spark, folder), 0, "1").select(
        F.lit("key"), "customer_id", F.col("request_hash")
    )
    return row.union(key)


def first_trace_parent(spark, folder):
    rows = D.outbox(spark, folder)
    batch = F.floor(F.col("id") / F.lit(3)).cast("bigint")
    # Some texts are blank and must be passed over.
    text = F.when(F.col("id") % 4 == 0, F.lit("  ")).otherwise(F.col("trace_parent"))
    return outbox.first_trace_parent(rows.withColumn("trace_parent", text).withColumn("batch_no", batch), "batch_no", "id")


# Queue.

def offers(spark, folder):
    return D.table(spark, folder, "events").select(
        F.concat(F.lit("pod-"), (F.col("user_id") % 3).cast("string")).alias("instance_id"),
        F.col("event_id").alias("seq"), (F.col("event_id") % 4000).alias("id"),
    )


def in_flight(spark, folder):
    return offers(spark, folder).filter(F.col("seq") % 17 == 0).select("instance_id", "id").distinct()


def queue_admission(spark, folder):
    rows = queueing.admission(
        offers(spark, folder), in_flight(spark, folder), capacity=900, in_queue=100
    )
    return rows.select("instance_id", "seq", "id", "decision")


def not_in_flight(spark, folder):
    busy = D.attempts(spark, folder).filter("failed").select("id")
    return queueing.not_in_flight(D.attempts(spark, folder).select("id").union(D.outbox(spark, folder).select("id")), busy)


def publish_batches(spark, folder):
    rows = queueing.batches(offers(spark, folder), DEFAULTS.queue.batch_size)
    return rows.groupBy("instance_id", "batch_no").agg(
        F.count(F.lit(1)).alias("ids"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


def fast_and_recovery_union(spark, folder):
    fast = D.outbox(spark, folder).filter(F.col("status") == S.NEW)
    recovered = outbox.recovery_candidates(D.outbox(spark, folder), D.now(), DEFAULTS.recovery.batch_size)
    return queueing.next_ids(fast, recovered)


def queue_pressure(spark, folder):
    """Pressure and health per instance, from the number of all offers over a capacity of 3,400."""
    sizes = offers(spark, folder).groupBy("instance_id").agg(F.count(F.lit(1)).alias("size"))
    capacity = F.lit(3400)
    return sizes.select(
        "instance_id", "size", F.round(scalars.pressure(F.col("size"), capacity), 6).alias("pressure"),
        queueing.queue_health(F.col("size"), capacity, DEFAULTS.health.queue_pressure_critical).alias("health"),
    )


QUEUE_WINDOW_S, QUEUE_CAPACITY = 6 * 3600, 60


def queue_size_over_time(spark, folder):
    """Size, peak, pressure and health of each instance's queue every six hours, from the transition log."""
    moves = queueing.queue_moves(D.transitions(spark, folder), [S.NEW, S.FAILED], 86_400)
    instance = F.concat(F.lit("pod-"), (F.col("id") % 4).cast("string")).alias("instance_id")
    sizes = queueing.queue_sizes(moves.select(instance, "ts", "delta"), QUEUE_WINDOW_S, QUEUE_WINDOW_S // 6)
    capacity = F.lit(QUEUE_CAPACITY)
    return sizes.withColumns({
        "pressure": F.round(scalars.pressure(F.col("peak"), capacity), 6),
        "health": queueing.queue_health(F.col("peak"), capacity, DEFAULTS.health.queue_pressure_critical),
    })


def health_status(spark, folder):
    limit = DEFAULTS.health.outbox_pending_critical
    return outbox.active_pending(D.outbox(spark, folder)).select(
        "pending", F.lit(limit).cast("bigint").alias("critical"), queueing.outbox_health(F.col("pending"), limit).alias("health")
    )


# Publishing and consumption.

def topic_records(spark, folder):
    """Records of all outbox rows with their offsets."""
    requests = D.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("corr-"), F.col("o_orderkey").cast("string"))).alias("corr"),
    )
    payload = F.to_json(
        F.struct(F.col("id").alias("orderId"), F.col("customer_id").alias("customerId"), F.col("corr").alias("correlationId"))
    )
    rows = D.outbox(spark, folder).join(requests, "id").withColumn("payload", payload)
    good, _ = publish.split_envelopes(rows, D.now())
    made = publish.records(good, DEFAULTS.publisher.topic, DEFAULTS.publisher.topic_partitions)
    return publish.with_offsets(made)


def kafka_records(spark, folder):
    rows = topic_records(spark, folder)
    header = lambda name: consume.header_text(F.col("headers"), name)
    return rows.select(
        "event_id", "key", F.col("partition").cast("bigint").alias("part"), F.col("offset").alias("off"),
        header("eventId").alias("h_event"), header("orderId").alias("h_order"), header("customerId").alias("h_customer"),
        header("correlationId").alias("h_correlation"), header("traceparent").alias("h_trace"),
        scalars.json_text(F.col("value"), "correlationId").alias("correlation_id"),
        scalars.json_text(F.col("value"), "occurredAt").alias("occurred_at"),
        F.col("value").contains("traceParent").alias("leaks_trace"),
    )


def publish_order_check(spark, folder):
    """Records out of order per key; every 50th offset is swapped with its neighbour to have some."""
    rows = topic_records(spark, folder).select("partition", "key", "event_id", "offset")
    swapped = F.when(F.col("offset") % 50 == 0, F.col("offset") + 40).when(F.col("offset") % 50 == 40, F.col("offset") - 40)
    moved = rows.withColumn("offset", F.coalesce(swapped, F.col("offset")))
    bad = publish.order_violations(moved)
    return bad.select(F.col("partition").cast("bigint").alias("part"), "key", "event_id", "previous_event_id")


def consumer_notifications(spark, folder):
    readable, _ = consume.split_readable(topic_records(spark, folder))
    rows = consume.notifications(readable)
    return rows.select(
        "event_id", "order_id", "customer_id", "event_type", "correlation_id", "topic",
        F.col("partition").cast("bigint").alias("part"), F.col("offset").alias("off"), "channel", "status", "trace_parent",
    )


def unreadable_records(spark, folder):
    """Records whose value was cut short."""
    rows = topic_records(spark, folder)
    cut = rows.withColumn("value", F.when(F.col("event_id") % 20 == 0, F.substring("value", 1, 12)).otherwise(F.col("value")))
    _, bad = consume.split_readable(cut)
    return bad.select("event_id", "key")


def consumer_batch_metrics(spark, folder):
    rows = consume.poll_batches(topic_records(spark, folder), DEFAULTS.consumer.max_poll_records)
    timed = rows.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + F.col("event_id") * 1000))
    return consume.batch_metrics(timed).select(F.col("partition").cast("bigint").alias("part"), "batch_no", "events", "span_us")


def consumer_totals(spark, folder):
    rows = consume.poll_batches(topic_records(spark, folder), DEFAULTS.consumer.max_poll_records)
    timed = rows.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + F.col("event_id") * 1000))
    return consume.consumer_totals(consume.batch_metrics(timed))


def consumer_dedup(spark, folder):
    """Every third record is delivered twice; the first delivery stays."""
    readable, _ = consume.split_readable(topic_records(spark, folder))
    once = consume.notifications(readable)
    again = once.filter(F.col("event_id") % 3 == 0).withColumn("offset", F.col("offset") + 1_000_000)
    rows = consume.once_per_event(once.unionByName(again))
    return rows.select("event_id", F.col("partition").cast("bigint").alias("part"), F.col("offset").alias("off"), "correlation_id")


def trace_continuity(spark, folder):
    """Trace parents from the outbox row to the notification: kept, absent or lost."""
    readable, _ = consume.split_readable(topic_records(spark, folder))
    arrived = consume.notifications(readable).select("event_id", F.col("trace_parent").alias("arrived"))
    rows = D.outbox(spark, folder).select(F.col("id").alias("event_id"), "trace_parent").join(arrived, "event_id")
    same = F.col("trace_parent").eqNullSafe(F.col("arrived"))
    state = F.when(~same, "lost").when(F.col("arrived").isNull(), "absent").otherwise("kept")
    return rows.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("events"))


QUERIES = {
    f.__name__: f
    for f in (
        idempotency_first_wins, idempotency_missing_key, ranked_null_group, idempotency_outcomes, idempotency_outcome_counts, idempotency_against_store,
        idempotency_insert_if_absent, idempotency_completed_keys, active_pending, recovery_candidates, recovery_envelopes,
        recovery_lease, claim_by_ids, reenqueueable_ids, retry_transition, sent_transition, attempt_replay, latest_state,
        state_after_log, active_archive_routing, batch_outcome, delivery_counters, point_lookups, first_trace_parent, queue_admission,
        not_in_flight, publish_batches, fast_and_recovery_union, queue_pressure, queue_size_over_time, health_status, kafka_records,
        publish_order_check, consumer_notifications, unreadable_records, consumer_batch_metrics, consumer_totals,
        consumer_dedup, trace_continuity,
    )
}

FREE = f"status < 100 AND (locked_until IS NULL OR locked_until < {NOW})"
WANTED = """, wanted AS (SELECT o_orderkey AS id FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
"""
CODES = "CASE outcome WHEN 'CREATED' THEN 201 WHEN 'REPLAYED' THEN 200 WHEN 'NO_USABLE_ROW' THEN 500 ELSE 409 END"
OUTCOMES = """, outcomes AS (SELECT a.request_id, f.request_id AS owner_request_id, CASE WHEN a.request_id = f.request_id THEN 'CREATED'
    WHEN a.request_hash <> f.request_hash THEN 'CONFLICT_HASH' ELSE 'REPLAYED' END AS outcome
    FROM arrivals a JOIN firsts f USING (customer_id, idempotency_key))
"""
LATE = f""", late AS (SELECT * FROM arrivals WHERE arrival_ts >= TIMESTAMP '{LATER}'),
late_firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, idempotency_key
    ORDER BY arrival_ts, request_id) AS rn FROM late) WHERE rn = 1)
"""
BATCHES = ", batched AS (SELECT *, attempt_id // 5 AS batch_no, bool_or(failed) OVER (PARTITION BY attempt_id // 5) AS batch_failed FROM attempts)\n"
OFFERS = """WITH offers AS (SELECT 'pod-' || (user_id % 3) AS instance_id, event_id AS seq, event_id % 4000 AS id FROM events),
busy AS (SELECT DISTINCT instance_id, id FROM offers WHERE seq % 17 = 0),
placed AS (SELECT instance_id, id, first_seq, row_number() OVER (PARTITION BY instance_id ORDER BY first_seq) AS place FROM (
    SELECT instance_id, id, min(seq) AS first_seq FROM offers o
    WHERE NOT EXISTS (SELECT 1 FROM busy b WHERE b.instance_id = o.instance_id AND b.id = o.id) GROUP BY ALL))
"""

ORACLE = {
    "idempotency_first_wins": with_tables("firsts", """SELECT customer_id, idempotency_key, f.request_id AS owner_request_id,
        f.request_hash AS owner_hash, n AS requests FROM firsts f JOIN (SELECT customer_id, idempotency_key, count(*) AS n
        FROM arrivals GROUP BY ALL) USING (customer_id, idempotency_key)"""),
    "idempotency_outcomes": with_tables("firsts", OUTCOMES + f"""SELECT request_id, outcome, CAST({CODES} AS BIGINT) AS http_status,
        owner_request_id FROM outcomes"""),
    "idempotency_missing_key": with_tables("arrivals", """, keyed AS (SELECT request_id, arrival_ts, customer_id, request_hash,
        CASE WHEN request_id % 7 <> 0 THEN idempotency_key END AS k FROM arrivals),
        owners AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, k ORDER BY arrival_ts, request_id) AS rn
          FROM keyed WHERE k IS NOT NULL) WHERE rn = 1),
        named AS (SELECT a.request_id, o.request_id AS owner_request_id, CASE WHEN a.k IS NULL THEN 'INVALID'
          WHEN a.request_id = o.request_id THEN 'CREATED' WHEN a.request_hash <> o.request_hash THEN 'CONFLICT_HASH'
          ELSE 'REPLAYED' END AS outcome FROM keyed a LEFT JOIN owners o ON a.customer_id = o.customer_id AND a.k = o.k)
        SELECT request_id, outcome, CAST(CASE outcome WHEN 'INVALID' THEN 400 WHEN 'CREATED' THEN 201 WHEN 'REPLAYED' THEN 200
          ELSE 409 END AS BIGINT) AS http_status, owner_request_id FROM named"""),
    "ranked_null_group": """SELECT event_id, nullif(event_type, 'view') AS kind,
        row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events""",
    "idempotency_outcome_counts": with_tables("firsts", OUTCOMES + "SELECT outcome, count(*) AS requests FROM outcomes GROUP BY outcome"),
    "idempotency_against_store": with_tables("stored", LATE + f"""SELECT request_id, outcome, CAST({CODES} AS BIGINT) AS http_status
        FROM (SELECT a.request_id, CASE
          WHEN s.request_hash IS NOT NULL THEN CASE WHEN a.request_hash <> s.request_hash THEN 'CONFLICT_HASH'
            WHEN s.status = 1 AND s.response_body IS NOT NULL THEN 'REPLAYED' WHEN s.status = 0 THEN 'CONFLICT_PROCESSING'
            ELSE 'NO_USABLE_ROW' END
          WHEN a.request_id = f.request_id THEN 'CREATED' WHEN a.request_hash <> f.request_hash THEN 'CONFLICT_HASH'
          ELSE 'REPLAYED' END AS outcome
        FROM late a JOIN late_firsts f USING (customer_id, idempotency_key) LEFT JOIN stored s USING (customer_id, idempotency_key))"""),
    "idempotency_insert_if_absent": with_tables("stored", LATE + """SELECT customer_id, idempotency_key, request_id AS owner_request_id
        FROM late_firsts f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.customer_id = f.customer_id
        AND s.idempotency_key = f.idempotency_key)"""),
    "idempotency_completed_keys": with_tables("firsts", """SELECT request_id AS id, customer_id, idempotency_key, request_hash,
        CAST(1 AS BIGINT) AS status, request_id AS order_id, 'ACCEPTED' AS response, epoch_us(arrival_ts) AS created_us FROM firsts"""),
    "active_pending": with_tables("outbox", "SELECT count(*) AS pending FROM outbox WHERE status < 100"),
    "recovery_candidates": with_tables("outbox", f"""SELECT id, CAST(status AS BIGINT) AS status, epoch_us(locked_until) AS locked_us
        FROM outbox WHERE {FREE} ORDER BY id LIMIT 500"""),
    "recovery_envelopes": with_tables("outbox", f"""SELECT id AS event_id, CAST(customer_id AS VARCHAR) AS key, customer_id % 10 AS part,
        id AS order_id, event_type, customer_id AS payload_customer,
        CAST(CASE WHEN trace_parent IS NULL THEN 3 ELSE 4 END AS BIGINT) AS headers
        FROM outbox WHERE {FREE} ORDER BY id LIMIT 500"""),
    "recovery_lease": with_tables("outbox", f"""SELECT id, CAST(step AS BIGINT) AS step, CAST(status AS BIGINT) AS status,
        CASE WHEN step = 1 THEN 'pod-0' END AS locked_by, CASE WHEN step = 1 THEN epoch_us({NOW}) + 30000000 END AS locked_us
        FROM (SELECT * FROM outbox WHERE {FREE} ORDER BY id LIMIT 500), (VALUES (1), (2)) AS v(step)"""),
    "claim_by_ids": with_tables("outbox", WANTED + f"""SELECT id, CAST(1 AS BIGINT) AS status, 'pod-9' AS locked_by,
        epoch_us({NOW}) + 30000000 AS locked_us FROM outbox WHERE {FREE} AND id IN (SELECT id FROM wanted)"""),
    "reenqueueable_ids": with_tables("outbox", WANTED + f"SELECT id FROM outbox WHERE {FREE} AND id IN (SELECT id FROM wanted)"),
    "retry_transition": with_tables("outbox", """SELECT id, CAST(CASE WHEN retry_count + 1 >= 5 THEN 101 ELSE 2 END AS BIGINT) AS status,
        CAST(retry_count + 1 AS BIGINT) AS retry_count, true AS unlocked FROM outbox WHERE status IN (1, 2)"""),
    "sent_transition": with_tables("outbox", WANTED + f"""SELECT id, CAST(110 AS BIGINT) AS status, epoch_us({NOW}) AS sent_us,
        true AS unlocked, 'archive' AS part FROM outbox WHERE {FREE} AND id IN (SELECT id FROM wanted)"""),
    "attempt_replay": with_tables("attempts", """, running AS (SELECT *, count(*) FILTER (WHERE failed) OVER w AS fails,
          count(*) FILTER (WHERE NOT failed) OVER w AS wins FROM attempts
          WINDOW w AS (PARTITION BY id ORDER BY ts, attempt_id ROWS UNBOUNDED PRECEDING)),
        ended AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, attempt_id) AS rn FROM running
          WHERE (NOT failed AND wins = 1 AND fails < 5) OR (failed AND fails = 5 AND wins = 0)),
        final AS (SELECT id, ts, attempt_id, failed, fails FROM ended WHERE rn = 1
          UNION ALL SELECT id, max(ts), 0, NULL, count(*) FROM attempts
          WHERE id NOT IN (SELECT id FROM ended) GROUP BY id)
        SELECT id, CAST(CASE WHEN failed THEN 101 WHEN NOT failed THEN 110 ELSE 2 END AS BIGINT) AS status,
        CAST(fails AS BIGINT) AS retry_count, CASE WHEN NOT failed THEN epoch_us(ts) END AS sent_us, epoch_us(ts) AS ts_us FROM final"""),
    "latest_state": with_tables("transitions", """SELECT id, seq, CAST(status AS BIGINT) AS status, CAST(retry_count AS BIGINT) AS retry_count,
        locked_by, epoch_us(locked_until) AS locked_us, epoch_us(sent_at) AS sent_us
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM transitions) WHERE rn = 1"""),
    "state_after_log": with_tables("outbox transitions", """, newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC)
          AS rn FROM transitions) WHERE rn = 1),
        state AS (SELECT CASE WHEN n.id IS NULL THEN o.status ELSE n.status END AS status,
          CASE WHEN n.id IS NULL THEN o.locked_by ELSE n.locked_by END AS locked_by FROM outbox o LEFT JOIN newest n USING (id))
        SELECT CASE WHEN status < 100 THEN 'active' ELSE 'archive' END AS part, CAST(status AS BIGINT) AS status, count(*) AS rows,
        count(locked_by) AS leased FROM state GROUP BY ALL"""),
    "active_archive_routing": with_tables("outbox", """SELECT CASE WHEN status < 100 THEN 'active' ELSE 'archive' END AS part,
        count(*) AS rows, min(id) AS first_id, max(id) AS last_id FROM outbox GROUP BY ALL"""),
    "batch_outcome": with_tables("attempts", BATCHES + "SELECT attempt_id, batch_no, failed, batch_failed FROM batched"),
    "delivery_counters": with_tables("attempts", BATCHES + """SELECT day, CAST(sum(CASE WHEN bad THEN 0 ELSE n END) AS BIGINT) AS published,
        count(*) FILTER (WHERE bad) AS failures, CAST(sum(CASE WHEN bad THEN n ELSE 0 END) AS BIGINT) AS retries
        FROM (SELECT batch_no, strftime(min(ts), '%Y-%m-%d') AS day, count(*) AS n, bool_or(batch_failed) AS bad FROM batched GROUP BY batch_no)
        GROUP BY day"""),
    "point_lookups": with_tables("outbox stored", """SELECT 'outbox' AS kind, customer_id, event_type AS text FROM outbox WHERE id = 7
        UNION ALL SELECT 'key', customer_id, request_hash FROM stored WHERE customer_id = 0 AND idempotency_key = '1'"""),
    "first_trace_parent": with_tables("outbox", """SELECT id // 3 AS batch_no,
        min_by(t, id) FILTER (WHERE trim(t) <> '') AS trace_parent, count(*) AS rows
        FROM (SELECT id, CASE WHEN id % 4 = 0 THEN '  ' ELSE trace_parent END AS t FROM outbox) GROUP BY ALL"""),
    "queue_admission": OFFERS + """SELECT o.instance_id, o.seq, o.id, CASE WHEN p.place IS NULL THEN 'IN_FLIGHT'
        WHEN p.place > 800 THEN 'FULL' WHEN o.seq = p.first_seq THEN 'ACCEPTED' ELSE 'DUPLICATE' END AS decision
        FROM offers o LEFT JOIN placed p USING (instance_id, id)""",
    "not_in_flight": with_tables("outbox attempts", """SELECT DISTINCT id FROM (SELECT id FROM attempts UNION ALL SELECT id FROM outbox)
        WHERE id NOT IN (SELECT id FROM attempts WHERE failed)"""),
    "publish_batches": OFFERS + """SELECT instance_id, batch_no, count(*) AS ids, min(seq) AS first_seq, max(seq) AS last_seq FROM (
        SELECT *, (row_number() OVER (PARTITION BY instance_id ORDER BY seq) - 1) // 250 AS batch_no FROM offers) GROUP BY ALL""",
    "fast_and_recovery_union": with_tables("outbox", f"""SELECT id FROM outbox WHERE status = 0 UNION
        (SELECT id FROM outbox WHERE {FREE} ORDER BY id LIMIT 500)"""),
    "queue_pressure": OFFERS + """SELECT instance_id, count(*) AS size, round(count(*) / 3400.0::DOUBLE, 6) AS pressure,
        CASE WHEN count(*) / 3400.0::DOUBLE >= 0.95 THEN 'DOWN' ELSE 'UP' END AS health FROM offers GROUP BY instance_id""",
    "queue_size_over_time": with_tables("transitions", f""", flags AS (SELECT id, ts, CAST(status IN (0, 2) AS INT) AS waits,
          lag(CAST(status IN (0, 2) AS INT), 1, 0) OVER (PARTITION BY id ORDER BY ts, seq) AS waited FROM transitions),
        instants AS (SELECT 'pod-' || (id % 4) AS instance_id, epoch_us(ts) AS us, sum(waits - waited) AS net,
          count(*) FILTER (WHERE waits > waited) AS came, count(*) FILTER (WHERE waits < waited) AS went FROM flags WHERE waits <> waited GROUP BY ALL),
        running AS (SELECT *, us // {QUEUE_WINDOW_S * 1_000_000} AS w, sum(net) OVER (PARTITION BY instance_id ORDER BY us) AS size FROM instants),
        grid AS (SELECT instance_id, unnest(range(min(w), max(w) + 1)) AS w FROM running GROUP BY instance_id),
        joined AS (SELECT g.instance_id, g.w, arg_max(r.size, r.us) AS ended, max(r.size) FILTER (WHERE r.w = g.w) AS most,
          arg_max(r.size, r.us) FILTER (WHERE r.w < g.w) AS started, sum(r.came) FILTER (WHERE r.w = g.w) AS came, sum(r.went) FILTER (WHERE r.w = g.w) AS went
          FROM grid g JOIN running r ON r.instance_id = g.instance_id AND r.w <= g.w GROUP BY ALL)
        SELECT instance_id, w * {QUEUE_WINDOW_S * 1_000_000} AS window_us, CAST(ended AS BIGINT) AS size,
          CAST(greatest(coalesce(most, 0), coalesce(started, 0)) AS BIGINT) AS peak, CAST(coalesce(came, 0) AS BIGINT) AS came, CAST(coalesce(went, 0) AS BIGINT) AS went,
          round(greatest(coalesce(most, 0), coalesce(started, 0)) / {QUEUE_CAPACITY}.0::DOUBLE, 6) AS pressure,
          CASE WHEN greatest(coalesce(most, 0), coalesce(started, 0)) / {QUEUE_CAPACITY}.0::DOUBLE >= 0.95 THEN 'DOWN' ELSE 'UP' END AS health FROM joined"""),
    "health_status": with_tables("outbox", """SELECT count(*) AS pending, CAST(10000 AS BIGINT) AS critical,
        CASE WHEN count(*) >= 10000 THEN 'DOWN' ELSE 'UP' END AS health FROM outbox WHERE status < 100"""),
    "kafka_records": with_tables("records", f"""SELECT id AS event_id, CAST(customer_id AS VARCHAR) AS key, part, off,
        CAST(id AS VARCHAR) AS h_event, CAST(order_id AS VARCHAR) AS h_order, CAST(customer_id AS VARCHAR) AS h_customer,
        correlation_id AS h_correlation, trace_parent AS h_trace, correlation_id,
        strftime({NOW}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS occurred_at, false AS leaks_trace FROM records"""),
    "publish_order_check": with_tables("records", """SELECT part, key, event_id, previous_event_id FROM (
        SELECT part, CAST(customer_id AS VARCHAR) AS key, id AS event_id, lag(id) OVER (PARTITION BY part, customer_id ORDER BY moved) AS previous_event_id
        FROM (SELECT *, CASE WHEN off % 50 = 0 THEN off + 40 WHEN off % 50 = 40 THEN off - 40 ELSE off END AS moved FROM records))
        WHERE event_id < previous_event_id"""),
    "consumer_notifications": with_tables("records", """SELECT id AS event_id, order_id, customer_id, event_type, correlation_id,
        'orders.events' AS topic, part, off, 'log' AS channel, 'sent' AS status, trace_parent FROM records"""),
    "unreadable_records": with_tables("records", "SELECT id AS event_id, CAST(customer_id AS VARCHAR) AS key FROM records WHERE id % 20 = 0"),
    "consumer_batch_metrics": with_tables("records", """SELECT part, off // 100 AS batch_no, count(*) AS events,
        (max(id) - min(id)) * 1000 AS span_us FROM records GROUP BY ALL"""),
    "consumer_totals": with_tables("records", """SELECT count(*) AS batches, CAST(sum(n) AS BIGINT) AS events, CAST(sum(span) AS BIGINT) AS processing_us
        FROM (SELECT part, off // 100, count(*) AS n, (max(id) - min(id)) * 1000 AS span FROM records GROUP BY ALL)"""),
    "consumer_dedup": with_tables("records", "SELECT id AS event_id, part, off, correlation_id FROM records"),
    "trace_continuity": with_tables("records", """SELECT CASE WHEN trace_parent IS NULL THEN 'absent' ELSE 'kept' END AS state,
        count(*) AS events FROM records GROUP BY ALL"""),
}
