"""Calls of a span stream in several orders against the batch join."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import traces
from waybill.queries import streams
from waybill.session import scratch_path
from waybill.sources import tables
from waybill.streaming import graph, run


def spans_of(seed, traces_, start=0):
    rng = random.Random(seed)
    rows = []
    for trace in range(traces_):
        for k in range(rng.randrange(1, 6)):
            parent = None if k == 0 else rng.choice([str(rng.randrange(k)), "gone"] if rng.random() < 0.1 else [str(rng.randrange(k))])
            rows.append((f"t{seed}-{trace}", str(k), parent, rng.choice(["orders", "stub", "broker"]), "call", start + trace * 2 + rng.randrange(3), float(rng.randrange(50)), rng.choice(["ok", "error"])))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, service string, name string, s long, duration_ms double, status string")
    return df.select("trace_id", "span_id", "parent_span_id", "service", "name", F.lit(None).cast("string").alias("uri"), F.timestamp_seconds("s").alias("start_ts"), "duration_ms", "status")


def drained(spark, files, delay, reach="1 minute"):
    root = scratch_path(spark, "span-files")
    for rows in files:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(root)
    stream = spark.readStream.schema(S.SPANS).option("maxFilesPerTrigger", 1).parquet(root)
    return run.drain_to_table(spark, graph.calls(stream, delay, reach), "calls-test")


@pytest.mark.parametrize("order", [0, 1])
def test_graph_equals_the_batch_join_in_any_order(spark, order):
    rows = spans_of(1, 60)
    shuffled = rows + rows[:7]  # some are delivered twice
    random.Random(order).shuffle(shuffled)
    found = drained(spark, [shuffled[k::4] for k in range(4)], "10 minutes")
    plain = lambda df: sorted(tuple(r) for r in df.select("client", "server", "calls", "failures", "total_ms", "max_ms").collect())
    assert plain(graph.edges(found)) == plain(traces.service_graph(frame(spark, rows)))


def test_children_without_a_parent_are_written_once(spark):
    early, late = spans_of(2, 30), spans_of(3, 3, start=100_000)
    found = drained(spark, [early, late, spans_of(4, 2, start=200_000)], "30 seconds", "1 minute").collect()
    assert len({(r.trace_id, r.span_id) for r in found}) == len(found)
    keys = {(t, s) for t, s, *_ in early + late}
    lone = Counter((t, s) for t, s, p, *_ in early + late if p and (t, p) not in keys)
    assert lone and Counter((r.trace_id, r.span_id) for r in found if r.client is None and not r.trace_id.startswith("t4")) == lone


def test_the_query_reads_few_files_at_once_and_keeps_state_on_disk(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FILES_PER_TRIGGER", 3)
    monkeypatch.setattr(streams, "scratch_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(run, "scratch_path", lambda _, name: str(tmp_path / name))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.unset(provider)
    try:
        streams.stream_service_graph(spark, folder)
    finally:
        spark.conf.set(provider, before)
    kept = tmp_path / "calls" / "checkpoint"
    assert len([p for p in (kept / "offsets").iterdir() if p.name.isdigit()]) >= 3
    assert list(kept.glob("state/*/*/**/*.changelog")) and not list(kept.glob("state/*/*/**/*.delta"))


def test_spans_without_ids_are_left_out(spark):
    rows = [(None, "1", "0", "a", "x", 1, 1.0, "ok"), ("t", None, "0", "a", "x", 1, 1.0, "ok"), ("t", "1", "0", "b", "x", None, 1.0, "ok"), ("t", "0", None, "a", "x", 1, 1.0, "ok"), ("t", "2", "0", None, "x", 1, None, None)]
    found = drained(spark, [rows], "1 minute").collect()
    assert [(r.span_id, r.client, r.server) for r in found] == [("2", "a", None)]
