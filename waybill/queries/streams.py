"""Streaming queries. Each drains a stream over the given tables and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.config import DEFAULTS
from waybill.operators import logs as L
from waybill.operators import outbox
from waybill.queries import admission, delivery, observability, telemetry
from waybill.queries.orders import outbox_with_payload
from waybill.queries.sql import NOW, with_tables
from waybill.session import cut_lineage, scratch_path
from waybill.sources import driver_tables as D
from waybill.sources import tables
from waybill.streaming import batches, counters, graph, run, state
from waybill.streaming import delivery as delivery_streams
from waybill.streaming import intake as intake_stream

FILES_PER_TRIGGER = 64
#: Files that a query writes for its own stream hold so many rows at most, so that a trigger does too.
ROWS_PER_FILE = 100_000


def event_stream(spark, folder):
    """``events`` as a stream of its files. The pattern lets the table be a single file or a folder."""
    path = f"{folder}/events.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(f"{path}*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


RATES = "event_type STRING, window_end TIMESTAMP, n LONG, events_per_s DOUBLE, value_per_s DOUBLE"


def event_span(spark, folder):
    """First and last event time in microseconds: one row."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return D.table(spark, folder, "events").agg(F.coalesce(F.min(us), F.lit(0)), F.coalesce(F.max(us), F.lit(0))).first()


def posted_requests(spark, folder):
    """Requests of all orders, some sent again, and some sent again with another correlation id."""
    requests = D.requests(spark, folder).withColumns(
        {
            "method": F.lit("POST"), "uri": F.lit(S.ORDERS_ROUTE), "forwarded_for": F.lit(None).cast("string"),
            "remote_addr": F.lit("10.0.0.1"),
        }
    )
    last = F.col("request_id") % 10
    again, other = F.lit("again"), F.lit("other")
    sent = F.array_compact(F.array(F.lit("first"), F.when(last == 0, again), F.when(last == 5, other)))
    requests = requests.withColumn("sent", F.explode(sent))
    requests = requests.withColumns(
        {
            "request_id": F.when(F.col("sent") == "first", F.col("request_id")).otherwise(F.col("request_id") + F.lit(1_000_000_000_000)),
            "correlation_id": F.when(F.col("sent") == other, other).otherwise(F.col("correlation_id")),
        }
    )
    columns = [c.split(" ")[0] for c in S.REQUEST.split(", ") if c.split(" ")[0] in requests.columns]
    return requests.select(*columns)


def post_requests(spark, folder):
    """The requests as compressed files of JSON lines: their folder."""
    posted = scratch_path(spark, "requests")
    posted_requests(spark, folder).write.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE).json(posted)
    return posted


def stream_intake(spark, folder):
    """Requests as JSON files through validation and deduplication into the tables; rows and sums per table."""
    return intake_tables(spark, folder, lambda stream: stream)


def stream_intake_by_state(spark, folder):
    """The same with the owners of the keys in the stream's state."""
    with run.state_on_disk(spark):
        return intake_tables(spark, folder, intake_stream.with_outcomes)


def intake_tables(spark, folder, prepare):
    posted, root = post_requests(spark, folder), scratch_path(spark, "intake")
    stream = prepare(tables.read_requests(spark, posted, streaming=True, max_files=FILES_PER_TRIGGER))
    run.drain(stream, intake_stream.handle_requests(root), f"{root}/_checkpoint")
    read = lambda table, schema: batches.committed(spark, root, table, schema)
    none = F.lit(0.0)
    parts = [
        read("orders", S.ORDERS).groupBy(F.lit("orders").alias("kind")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("total_amount").cast("double").alias("amount")),
        read("order_items", S.ORDER_ITEMS).groupBy(F.lit("order_items").alias("kind")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.col("price") * F.col("quantity")).cast("double").alias("amount")),
        read("idempotency_keys", S.IDEMPOTENCY_KEYS).groupBy(F.lit("idempotency_keys").alias("kind")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(none).alias("amount")),
        read("outbox_events", S.OUTBOX_EVENTS).groupBy(F.lit("outbox_events").alias("kind")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(none).alias("amount")),
        read("outcomes", intake_stream.OUTCOMES).groupBy(F.col("outcome").alias("kind")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(none).alias("amount")),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def stored_outbox(spark, folder, path):
    """Outbox rows in their active and archive directories."""
    rows = outbox_with_payload(spark, folder)
    columns = [c.split(" ")[0] for c in S.OUTBOX_EVENTS.split(", ")]
    tables.write_outbox_snapshot(rows.select(*columns), path)
    return tables.read_outbox_snapshot(spark, path)


def stream_publisher(spark, folder):
    """Outbox files through the publisher; states of the transition log and records on the topic."""
    stored, root, topic = (scratch_path(spark, n) for n in ("outbox", "publisher", "topic"))
    stored_outbox(spark, folder, stored)
    stream = (
        spark.readStream.schema(f"{S.OUTBOX_EVENTS}, part STRING").option("maxFilesPerTrigger", FILES_PER_TRIGGER)
        .parquet(stored).filter("part = 'active'")
    )
    handler = delivery_streams.publish_batch(root, DEFAULTS, "pod-9", D.now(), topic)
    run.drain(stream, handler, f"{root}/_checkpoint")
    moved = outbox.latest_state(batches.committed(spark, root, "outbox_transitions", S.OUTBOX_TRANSITIONS).drop("batch_id"))
    records = batches.committed(spark, topic, "records", delivery_streams.PUBLISHED).select(F.col("event_id").alias("id"), "key")
    return moved.join(records, "id", "left").select(
        "id", F.col("status").cast("bigint").alias("status"), F.col("locked_by").isNull().alias("unlocked"), "key"
    )


def stream_publisher_failures(spark, folder):
    """The sink refuses batches with ids of one lane: their rows are FAILED or DEAD, those of other batches are sent."""
    stored, root, topic = (scratch_path(spark, n) for n in ("outbox", "publisher", "topic"))
    rows = outbox_with_payload(spark, folder).withColumn("lane", (F.col("id") % 4).cast("int"))
    rows.repartition("lane").write.partitionBy("lane").parquet(stored)
    # A file holds rows of one lane.
    stream = spark.readStream.schema(f"{S.OUTBOX_EVENTS}, lane INT").option("maxFilesPerTrigger", 1).parquet(stored)

    def refusing(records, number):
        if not records.filter("event_id % 4 = 1").isEmpty():
            raise ConnectionError("the broker is away")
        batches.write(records.drop("customer_id"), topic, "records", number)
        batches.commit(records.sparkSession, topic, number)

    handler = delivery_streams.publish_batch(root, DEFAULTS, "pod-9", D.now(), topic, send=refusing)
    run.drain(stream, handler, f"{root}/_checkpoint")
    moved = outbox.latest_state(batches.committed(spark, root, "outbox_transitions", S.OUTBOX_TRANSITIONS).drop("batch_id"))
    records = batches.committed(spark, topic, "records", delivery_streams.PUBLISHED).select(F.col("event_id").alias("id"), "key")
    return moved.join(records, "id", "left").select(
        "id", F.col("status").cast("bigint").alias("status"), F.col("retry_count").cast("bigint").alias("retry_count"),
        F.col("locked_by").isNull().alias("unlocked"), "key",
    )


def recovery_tick(spark, folder):
    """Snapshot plus transition log: ids of the direct path and of recovery. Only the active directory is read."""
    rows = stored_outbox(spark, folder, scratch_path(spark, "outbox")).filter("part = 'active'")
    fast = D.outbox(spark, folder).filter(F.col("status") == S.NEW)
    return delivery_streams.recovery_tick(rows, D.transitions(spark, folder), fast, D.now(), DEFAULTS.recovery.batch_size)


def stream_consumer(spark, folder):
    """Topic files through the consumer into notifications."""
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "consumer")
    columns = [f.name for f in spark.createDataFrame([], S.TOPIC_RECORDS).schema]
    tables.write_topic(delivery.topic_records(spark, folder).select(*columns), topic, DEFAULTS.publisher.topic, "parquet", ROWS_PER_FILE)
    stream = tables.read_topic_stream(spark, topic, DEFAULTS.publisher.topic, DEFAULTS.consumer, "parquet", FILES_PER_TRIGGER)
    run.drain(stream, delivery_streams.consume_batch(root), f"{root}/_checkpoint")
    return delivery_streams.notifications(spark, root).select(
        "event_id", "order_id", "customer_id", "event_type", "correlation_id", "topic",
        F.col("partition").cast("bigint").alias("part"), F.col("offset").alias("off"), "channel", "status", "trace_parent",
    )


def stream_end_to_end(spark, folder):
    """Posted requests through intake, outbox, publisher and consumer; each step reads what the one before it committed.

    Per topic partition: notifications, different offsets, the next offset, and sums over what the notifications carry.
    """
    accepted, published, topic, consumed = (scratch_path(spark, n) for n in ("intake", "publisher", "topic", "consumer"))
    requests = tables.read_requests(spark, post_requests(spark, folder), streaming=True, max_files=FILES_PER_TRIGGER)
    run.drain(requests, intake_stream.handle_requests(accepted), f"{accepted}/_checkpoint")
    steps = (
        (accepted, "outbox_events", S.OUTBOX_EVENTS, delivery_streams.publish_batch(published, DEFAULTS, "pod-9", D.now(), topic), published),
        (topic, "records", delivery_streams.PUBLISHED, delivery_streams.consume_batch(consumed), consumed),
    )
    for source, table, schema, handler, root in steps:
        markers = delivery_streams.committed_batches(spark, source)
        run.drain(markers, delivery_streams.each_committed(source, table, schema, handler), f"{root}/_checkpoint")
    kept = delivery_streams.notifications(spark, consumed)
    return kept.groupBy(F.col("partition").cast("bigint").alias("part")).agg(
        F.count(F.lit(1)).alias("notifications"), F.countDistinct("offset").alias("offsets"), (F.max("offset") + 1).alias("next_offset"),
        F.sum("event_id").alias("event_ids"), F.sum("customer_id").alias("customer_ids"),
        F.count_if(F.col("correlation_id") == F.concat(F.lit("corr-"), F.col("order_id").cast("string"))).alias("own_correlation"),
    )


def stream_token_bucket(spark, folder):
    """Buckets per customer with their levels as stream state."""
    shifted = F.floor((F.unix_micros("ts") - admission.START_US) / F.lit(admission.COMPRESSION))
    stream = event_stream(spark, folder).select(
        F.col("event_id").alias("request_id"), F.timestamp_micros(F.lit(admission.START_US) + shifted).alias("arrival_ts"), "user_id"
    )
    decided = state.token_bucket(
        stream, F.col("user_id"), F.col("arrival_ts"), F.col("request_id"), admission.LIMITS.per_customer
    )
    return admission.decisions(run.drain_to_table(spark, decided, "stream-buckets"))


def stream_first_requests(spark, folder):
    """Stateful deduplication of requests; keys per customer."""
    stream = event_stream(spark, folder).select(
        F.col("user_id").alias("customer_id"), F.get_json_object("props", "$.k").alias("idempotency_key")
    )
    rows = run.drain_to_table(spark, state.first_requests(stream), "stream-keys")
    return rows.groupBy("customer_id").agg(F.count(F.lit(1)).alias("keys"))


def stream_sliding_rates(spark, folder):
    """Sliding windows of five hours every hour, closed ones only.

    Files may come in any order, so the watermark waits for the whole span of the table, and windows are written as they
    change; the last writing of a window holds all its events.
    """
    first, last = event_span(spark, folder)
    stream = event_stream(spark, folder).select("ts", "event_type", "value")
    rates = state.sliding_rates(stream, ["event_type"], "value", 5 * 3600, 3600, f"{(last - first) // 1_000_000 + 1} seconds")
    root = scratch_path(spark, "stream-rates")

    def changed(batch, number):
        batches.write(batch, root, "rates", number)
        batches.commit(spark, root, number)

    run.drain(rates, changed, f"{root}/_checkpoint", "update")
    written = batches.committed(spark, root, "rates", RATES)
    newest = F.max_by(F.struct("n", "events_per_s", "value_per_s"), "batch_id").alias("newest")
    rows = written.groupBy("event_type", "window_end").agg(newest).select("event_type", "window_end", "newest.*")
    rows = rows.filter(F.unix_micros("window_end") <= last - 60_000_000)
    return rows.select(
        "event_type", F.unix_micros("window_end").alias("window_end_us"), "n",
        F.round("events_per_s", 9).alias("events_per_s"), F.round("value_per_s", 6).alias("value_per_s"),
    )


COUNTER_SLICES = 8
GRAPH_SLICES = 4


def stream_service_graph(spark, folder):
    """Edges of the service graph from spans that arrive as files, those of one quarter of the time in any order.

    Children are put ahead of their parents: the spans without a parent are written last in each quarter.
    """
    spans = D.spans(spark, folder)
    us = F.unix_micros("start_ts")
    first, last = spans.agg(F.coalesce(F.min(us), F.lit(0)), F.coalesce(F.max(us), F.lit(0))).first()
    width, root = (last - first) // GRAPH_SLICES + 1, scratch_path(spark, "spans")
    for k in range(GRAPH_SLICES):
        part = spans.where(us.between(first + k * width, first + (k + 1) * width - 1))
        for side in (F.col("parent_span_id").isNotNull(), F.col("parent_span_id").isNull()):
            part.where(side).write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(root)
    stream = tables.read_spans(spark, root, streaming=True, max_files=FILES_PER_TRIGGER)
    found = graph.calls(stream, f"{width // 1000 + 1} milliseconds", "1 minute")
    with run.state_on_disk(spark):
        rows = graph.edges(run.drain_to_table(spark, found, "calls"))
    return rows.select("client", "server", "calls", "failures", F.round("total_ms", 4).alias("total_ms"), "max_ms")


def stream_counter_rates(spark, folder):
    """Rates of counters over five minutes, every 15 seconds, from samples that arrive as files.

    The files of one eighth of the time come in any order, so the watermark waits for as long as that.
    """
    ts = F.timestamp_micros("ts_us").alias("ts")
    samples = cut_lineage(telemetry.compressed_counters(spark, folder).select(F.col("event_type").alias("series"), ts, "value", "ts_us"))
    first, last = samples.agg(F.coalesce(F.min("ts_us"), F.lit(0)), F.coalesce(F.max("ts_us"), F.lit(0))).first()
    width, root = (last - first) // COUNTER_SLICES + 1, scratch_path(spark, "counter-samples")
    for k in range(COUNTER_SLICES):
        part = samples.where(F.col("ts_us").between(first + k * width, first + (k + 1) * width - 1))
        part.select("series", "ts", "value").write.mode("append").parquet(root)
    stream = spark.readStream.schema("series STRING, ts TIMESTAMP, value DOUBLE").option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(root)
    delay_ms = width // 1000 + 1
    rates = counters.counter_rates(stream, 300, 15, f"{delay_ms} milliseconds")
    with run.state_on_disk(spark):
        rows = run.drain_to_table(spark, rates, "counter-rates")
    rows = rows.where(F.col("eval_us") <= last - delay_ms * 1000 - 1_000_000)
    return rows.select("series", "eval_us", F.round("rate", 9).alias("rate"), "n")


def stream_event_dedup(spark, folder):
    """Notifications delivered twice within the delay: one row per event id."""
    events = event_stream(spark, folder).select(
        F.explode(F.array(F.lit(0), F.lit(1))).alias("delivery"), "event_id", "ts", "event_type"
    )
    rows = run.drain_to_table(spark, delivery_streams.deduplicated(events, "ts", "40 days"), "stream-dedup")
    return rows.select("event_id", "event_type")


def stream_log_store(spark, folder):
    """Log lines as JSON files into the daily store; lines per day and level."""
    lines, root = scratch_path(spark, "log-lines"), scratch_path(spark, "log-store")
    names = {column: field for field, (column, _) in S.LOG_FIELDS.items()}
    logs = D.logs(spark, folder).drop("log_id")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    logs.select(*[(text if c == "ts" else F.col(c)).cast("string").alias(names[c]) for c in logs.columns]).write.json(lines)
    stream = L.for_index(tables.read_logs(spark, lines, streaming=True), "waybill")
    writer = stream.writeStream.format("parquet").partitionBy("log_date").option("path", f"{root}/data")
    writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.schema(f"{S.LOGS}, log_source STRING, log_date DATE").parquet(f"{root}/data")
    return stored.groupBy(F.date_format("log_date", "yyyy-MM-dd").alias("day"), "log_level", "log_source").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("order_id").alias("order_ids"), F.count("customer_id").alias("customers")
    )


QUERIES = {
    f.__name__: f
    for f in (
        stream_intake, stream_intake_by_state, stream_publisher, stream_publisher_failures, recovery_tick, stream_consumer, stream_end_to_end, stream_token_bucket, stream_first_requests,
        stream_sliding_rates, stream_counter_rates, stream_service_graph, stream_event_dedup, stream_log_store,
    )
}

FREE = delivery.FREE

ORACLE = {
    "stream_intake": with_tables("items", """, valid AS (SELECT o_orderkey AS id FROM orders WHERE o_custkey > 0 AND o_orderkey IN (SELECT order_id FROM items)),
        sent AS (SELECT o_orderkey AS id FROM orders UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0)
        SELECT 'orders' AS kind, count(DISTINCT id) AS rows, CAST(sum(price * quantity) AS DOUBLE) AS amount FROM valid JOIN items ON order_id = id
        UNION ALL SELECT 'order_items', count(*), CAST(sum(price * quantity) AS DOUBLE) FROM valid JOIN items ON order_id = id
        UNION ALL SELECT 'idempotency_keys', count(*), 0 FROM valid UNION ALL SELECT 'outbox_events', count(*), 0 FROM valid
        UNION ALL SELECT 'CREATED', count(*), 0 FROM valid
        UNION ALL SELECT 'REPLAYED', count(*), 0 FROM valid WHERE id % 10 = 0
        UNION ALL SELECT 'CONFLICT_HASH', count(*), 0 FROM valid WHERE id % 10 = 5
        UNION ALL SELECT 'INVALID', count(*), 0 FROM sent WHERE id NOT IN (SELECT id FROM valid)"""),
    "stream_intake_by_state": None,
    "stream_publisher": with_tables("outbox", f"""SELECT id, CAST(CASE WHEN id % 9 = 0 THEN 1 ELSE 110 END AS BIGINT) AS status, id % 9 <> 0 AS unlocked,
        CASE WHEN id % 9 <> 0 THEN CAST(customer_id AS VARCHAR) END AS key FROM outbox WHERE {FREE}"""),
    "stream_publisher_failures": with_tables("outbox", f"""SELECT id, CAST(CASE WHEN id % 9 = 0 THEN 1 WHEN id % 4 <> 1 THEN 110
          WHEN retry_count + 1 >= 5 THEN 101 ELSE 2 END AS BIGINT) AS status,
        CAST(CASE WHEN id % 4 = 1 AND id % 9 <> 0 THEN retry_count + 1 ELSE retry_count END AS BIGINT) AS retry_count,
        id % 9 <> 0 AS unlocked, CASE WHEN id % 9 <> 0 AND id % 4 <> 1 THEN CAST(customer_id AS VARCHAR) END AS key
        FROM outbox WHERE {FREE}"""),
    "recovery_tick": with_tables("outbox transitions", f""", newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
          FROM transitions) WHERE rn = 1),
        current AS (SELECT o.id, CASE WHEN n.id IS NULL THEN o.status ELSE n.status END AS status,
          CASE WHEN n.id IS NULL THEN o.locked_until ELSE n.locked_until END AS locked_until
          FROM outbox o LEFT JOIN newest n USING (id) WHERE o.status < 100)
        SELECT id FROM outbox WHERE status = 0 UNION (SELECT id FROM current WHERE {FREE} ORDER BY id LIMIT 500)"""),
    "stream_consumer": delivery.ORACLE["consumer_notifications"],
    "stream_end_to_end": """SELECT o_custkey % 10 AS part, count(*) AS notifications, count(*) AS offsets, count(*) AS next_offset,
        CAST(sum(o_orderkey) AS BIGINT) AS event_ids, CAST(sum(o_custkey) AS BIGINT) AS customer_ids, count(*) FILTER (WHERE o_orderkey % 5 <> 0) AS own_correlation
        FROM orders WHERE o_custkey > 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL""",
    "stream_token_bucket": admission.ORACLE["token_bucket_customer"],
    "stream_first_requests": with_tables("arrivals", "SELECT customer_id, count(DISTINCT idempotency_key) AS keys FROM arrivals GROUP BY ALL"),
    "stream_sliding_rates": """WITH copies AS (SELECT event_type, value, unnest(generate_series(0, 4)) + epoch_us(ts) // 3600000000 + 1 AS h FROM events)
        SELECT event_type, h * 3600000000 AS window_end_us, count(*) AS n, round(count(*) / 18000.0::DOUBLE, 9) AS events_per_s,
        round(sum(value) / 18000.0::DOUBLE, 6) AS value_per_s FROM copies
        WHERE h * 3600000000 <= (SELECT max(epoch_us(ts)) - 60000000 FROM events) GROUP BY ALL""",
    "stream_counter_rates": with_tables("counted", f""", samples AS (SELECT event_type AS series, counter AS value,
          {D.METRICS_START_US} + CAST(floor((epoch_us(ts) - {D.METRICS_START_US}) / {D.COMPRESSION}) AS BIGINT) AS us FROM counted),
        ordered AS (SELECT *, lag(value) OVER w AS before, lag(us) OVER w AS before_us FROM samples WINDOW w AS (PARTITION BY series ORDER BY us, value)),
        placed AS (SELECT *, CASE WHEN value < before THEN value ELSE value - before END AS grown,
          unnest(range((us + 14999999) // 15000000, (us + 14999999) // 15000000 + 20)) * 15000000 AS eval_us FROM ordered),
        closed AS (SELECT max(us) - (((max(us) - min(us)) // {COUNTER_SLICES} + 1) // 1000 + 1) * 1000 - 1000000 AS until FROM samples)
        SELECT series, eval_us, round(sum(CASE WHEN before_us > eval_us - 300000000 THEN grown ELSE 0 END) / 300.0::DOUBLE, 9) AS rate, count(*) AS n
        FROM placed, closed WHERE eval_us <= until GROUP BY series, eval_us HAVING count(*) >= 2"""),
    "stream_service_graph": observability.ORACLE["service_graph"],
    "stream_event_dedup": "SELECT event_id, event_type FROM events",
    "stream_log_store": with_tables("logs", """SELECT strftime(ts, '%Y-%m-%d') AS day, log_level, 'waybill' AS log_source, count(*) AS lines,
        CAST(sum(order_id) AS BIGINT) AS order_ids, count(customer_id) AS customers FROM logs GROUP BY ALL"""),
}
ORACLE["stream_intake_by_state"] = ORACLE["stream_intake"]
