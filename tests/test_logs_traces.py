import datetime as dt
import json
import random

from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import logs as L
from waybill.operators import traces as T
from waybill.sources import tables

NOW = dt.datetime(2024, 1, 10, 12)


def test_log_files_become_typed_rows(spark, tmp_path):
    lines = [
        {"@timestamp": "2024-01-01T00:00:07.179+0000", "log.level": "INFO", "event.action": "outbox.retry", "customer.id": "42", "order.id": 7},
        {"@timestamp": "bad", "customer.id": "n/a", "unknown": 1},
    ]
    (tmp_path / "app.json").write_text("\n".join(map(json.dumps, lines)))
    found = tables.read_logs(spark, str(tmp_path / "*.json")).orderBy(F.desc("ts")).collect()
    assert (found[0].ts, found[0].event_action, found[0].customer_id, found[0].order_id) == (
        dt.datetime(2024, 1, 1, 0, 0, 7, 179000), "outbox.retry", 42, 7)
    assert (found[1].ts, found[1].customer_id) == (None, None)
    assert found[0].asDict().keys() == {c for c, _ in S.LOG_FIELDS.values()}


def lines(spark, rows):
    """Rows of (hours before NOW, action, outbox id, customer text)."""
    df = spark.createDataFrame(rows, "h double, event_action string, outbox_id long, customer_id_text string")
    return df.withColumn("ts", F.timestamp_micros(F.unix_micros(F.lit(NOW)) - (F.col("h") * 3_600_000_000).cast("long"))).drop("h")


def test_funnel_counts_doubled_actions_once(spark):
    rows = [(1.0, "notification.processed", 5, None)] * 2 + [(1.0, "notification.processed", None, None), (1.0, "outbox.event.persisted", 5, None)]
    rows += [(1.0, "outbox.event.persisted", 5, None), (1.0, "http.request.accepted", 1, None), (1.0, "http.request.accepted", 1, None)]
    row = L.funnel(lines(spark, rows), 24).first()
    assert (row.processed, row.outbox_events, row.requests, row.retries, row.processing_failures) == (1, 1, 2, 0, 0)


def test_relative_range_and_retention(spark):
    df = lines(spark, [(1.0, "a", 1, "1"), (24.0, "b", 1, "1"), (23.9, "c", 1, "1"), (24.0 * 8, "d", 1, None)])
    assert {r.event_action for r in L.within(df, F.lit(NOW), 24).collect()} == {"a", "c"}
    assert {r.event_action for r in L.retained(df, F.lit(NOW), 7).collect()} == {"a", "b", "c"}
    assert [(r.customer_id_text, r.cnt) for r in L.volume_by_customer(df).collect()] == [("1", 3)]


def test_day_directories_are_pruned(spark, tmp_path):
    df = lines(spark, [(1.0, "a", 1, "1"), (24.0 * 8, "d", 1, None)])
    tables.write_logs(df, str(tmp_path / "logs"), "app")
    stored = spark.read.parquet(str(tmp_path / "logs"))
    recent = L.within(stored, F.lit(NOW), 24)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan
    assert [r.log_source for r in recent.collect()] == ["app"]
    tables.compact_logs(spark, str(tmp_path / "logs"), str(tmp_path / "kept"), F.lit(NOW), 7)
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 1


def test_redaction_and_invariants(spark):
    df = spark.createDataFrame(
        [("p", "p", "42", 42, "key", "m"), ("p", "q", "42", 43, None, "m"), (None, None, None, None, None, "m"), ("p", None, "1", None, None, "m")],
        "locked_by string, instance_id string, customer_id_text string, customer_id long, idempotency_key string, message string",
    )
    assert sorted(r.broken for r in L.invariant_violations(df).collect()) == [["locked_by", "customer_id"], ["locked_by", "customer_id"]]
    first = L.redacted(df).first()
    assert first.customer_id_text == "nn" and len(first.idempotency_key) == 64 and "message" not in first.asDict()
    filled = L.enriched(df).collect()[3]
    assert (filled.instance_id, filled.customer_id) == ("p", 1)


def spans(spark, rows):
    """Rows of (trace, span, parent, service, name, uri, second, ms, status)."""
    df = spark.createDataFrame(
        rows, "trace_id string, span_id string, parent_span_id string, service string, name string, uri string, s long, duration_ms double, status string"
    )
    return df.withColumn("start_ts", F.timestamp_micros(F.col("s") * 1_000_000)).drop("s")


TREE = [
    ("t", "1", None, "a", "get", "/actuator/health", 0, 5.0, "ok"), ("t", "2", "1", "a", "x", None, 1, 1.0, "ok"),
    ("t", "3", "2", "b", "y", None, 2, 1.0, "ok"), ("t", "4", "3", "b", "z", None, 2, 1.0, "ok"),
    ("u", "1", None, "a", "http post", "/api/v1/orders", 5, 10.0, "ok"), ("u", "2", "1", "b", "outbox.publish", None, 6, 3000.0, "error"),
    ("v", "1", None, "a", "task recoveryWorker.recover", None, 7, 1.0, "ok"), ("w", "1", "gone", "b", None, "/actuatorish", 8, 1.0, "ok"),
]


def test_excluded_spans_take_all_descendants_with_them(spark):
    kept = {(r.trace_id, r.span_id) for r in T.exported(spans(spark, TREE)).collect()}
    assert kept == {("u", "1"), ("u", "2"), ("w", "1")}


def test_trace_summary_and_search(spark):
    df = spans(spark, TREE)
    row = T.search(df, T.span_filter(pattern="outbox.*"), 5).first()
    assert (row.trace_id, row.root_service, row.root_name, row.span_count, row.error_count, row.duration_ms) == ("u", "a", "http post", 2, 1, 4000.0)
    assert [r.trace_id for r in T.search(df, T.span_filter(service="b"), 2).collect()] == ["w", "u"]
    assert T.search(df, T.span_filter(service="a", name="y"), 5).count() == 0


def test_service_graph(spark):
    found = {(r.client, r.server): (r.calls, r.failures) for r in T.service_graph(spans(spark, TREE)).collect()}
    assert found == {("a", "b"): (2, 1)}


def test_sampling_keeps_whole_traces(spark):
    df = spark.range(4000).selectExpr("md5(string(id div 4)) as trace_id", "id")
    counts = {r["count"] for r in T.sampled(df, 0.1).groupBy("trace_id").count().collect()}
    assert counts == {4}
    share = T.sampled(df, 0.1).count() / 4000
    assert 0.05 < share < 0.15 and T.sampled(df, 1.0).count() == 4000 and T.sampled(df, 0.0).count() == 0


SPAN = "trace_id string, span_id string, parent_span_id string, name string, uri string"


def spans_of(spark, rows):
    return spark.createDataFrame(rows, SPAN)


def test_a_long_chain_takes_log_depth_rounds(spark, monkeypatch):
    chain = [("t", str(k), str(k - 1) if k else None, "x", "/actuator/health" if k == 0 else None) for k in range(1000)]
    side = [("t", "s", "gone", "x", None), ("u", "0", None, "x", None), ("u", "1", "0", "x", None)]
    saved = []
    monkeypatch.setattr(T, "cut_lineage", lambda df, real=T.cut_lineage: (saved.append(1), real(df))[1])
    found = {(r.trace_id, r.span_id) for r in T.actuator_spans(spans_of(spark, chain + side)).collect()}
    assert found == {("t", str(k)) for k in range(1000)}
    assert len(saved) <= 1 + 11


def test_excluded_descendants_equal_a_plain_walk(spark):
    rng = random.Random(6)
    rows = []
    for trace in range(40):
        n = rng.randrange(1, 25)
        for k in range(n):
            parent = rng.choice([None, "gone", *[str(p) for p in range(n)]])  # parents may come later, or form circles
            rows.append((str(trace), str(k), parent, rng.choice(["a", "b", None]), rng.choice([None, "/x", "/actuator"]) if rng.random() < 0.15 else None))
    rows += rows[:10] + [("z", None, None, "x", "/actuator"), (None, "1", None, "x", "/actuator"), ("0", "0", "1", "second parent", None)]
    marked = {(t, s) for t, s, _, name, uri in rows if uri == "/actuator" and t and s}
    while True:
        more = {(t, s) for t, s, p, _, _ in rows if t and s and (t, p) in marked} - marked
        if not more:
            break
        marked |= more
    assert {(r.trace_id, r.span_id) for r in T.actuator_spans(spans_of(spark, rows)).collect()} == marked
