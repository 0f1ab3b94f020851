import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import outbox, queueing
from waybill.queries import delivery
from waybill.sources import driver_tables, tables

NOW = dt.datetime(2024, 2, 1)
ROWS = "id long, status int, retry_count int, locked_by string, locked_until timestamp, sent_at timestamp"


def rows(spark, *values):
    return spark.createDataFrame([(i, s, r, None if u is None else "pod", u, None) for i, s, r, u in values], ROWS)


def later(seconds):
    return NOW + dt.timedelta(seconds=seconds)


def test_retry_or_dead(spark):
    found = outbox.mark_failed(rows(spark, (1, 1, 2, None), (2, 1, 4, None)), 5).orderBy("id").collect()
    assert [(r.retry_count, r.status) for r in found] == [(3, S.FAILED), (5, S.DEAD)]


def test_recovery_takes_lowest_free_active_ids(spark):
    df = rows(
        spark, (5, 0, 0, None), (3, 1, 0, later(-1)), (4, 1, 0, later(0)), (1, 110, 0, None), (2, 2, 1, None), (9, 101, 5, None), (8, 0, 0, later(9)),
    )
    found = outbox.recovery_candidates(df, F.lit(NOW), 2)
    assert [r.id for r in found.collect()] == [2, 3]


def test_claim_and_reoffer(spark):
    df = rows(spark, (1, 0, 0, None), (2, 0, 0, later(5)), (3, 110, 0, None), (4, 0, 0, None))
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    claimed = outbox.claim(df, ids, "pod-1", F.lit(NOW), 30).collect()
    assert [(r.id, r.status, r.locked_by, r.locked_until) for r in claimed] == [(1, S.PROCESSING, "pod-1", later(30))]
    assert [r.id for r in outbox.reofferable(df, ids, F.lit(NOW)).collect()] == [1]


def test_active_pending_is_zero_on_empty(spark):
    assert outbox.active_pending(rows(spark, (1, 110, 0, None))).first().pending == 0


def replay(attempts, limit):
    state = {}
    for id_, ts, failed in attempts:
        status, retries, at = state.get(id_, (None, 0, None))
        if status in (S.SENT, S.DEAD):
            continue
        if failed:
            retries += 1
            state[id_] = (S.DEAD if retries >= limit else S.FAILED, retries, ts)
        else:
            state[id_] = (S.SENT, retries, ts)
    return state


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.booleans()), min_size=1, max_size=60))
def test_attempts_replay_to_the_state_of_a_plain_loop(spark, attempts):
    listed = [(i, NOW + dt.timedelta(seconds=k), failed) for k, (i, failed) in enumerate(attempts)]
    df = spark.createDataFrame([(i, k, ts, f) for k, (i, ts, f) in enumerate(listed)], "id long, attempt_id long, ts timestamp, failed boolean")
    found = {r.id: (r.status, r.retry_count, r.ts) for r in outbox.replay_attempts(df, 5).collect()}
    assert found == replay(listed, 5)


def test_batch_fails_as_a_whole(spark):
    df = spark.createDataFrame([(1, 1, False), (2, 1, True), (3, 2, False)], "id long, batch_no long, failed boolean")
    assert {r.id: r.batch_failed for r in outbox.batch_outcome(df, "batch_no").collect()} == {1: True, 2: True, 3: False}


def test_first_trace_parent_skips_blanks(spark):
    df = spark.createDataFrame([(1, 1, " "), (2, 1, None), (3, 1, "b"), (4, 1, "c"), (5, 2, "")], "id long, batch_no long, trace_parent string")
    assert {r.batch_no: r.trace_parent for r in outbox.first_trace_parent(df, "batch_no", "id").collect()} == {1: "b", 2: None}


def test_recovery_plan_reads_only_the_active_directory(spark, folder, tmp_path):
    stored = driver_tables.outbox(spark, folder).withColumn("payload", F.lit("{}"))
    tables.write_outbox_snapshot(stored, str(tmp_path / "outbox"))
    rows_ = tables.read_outbox_snapshot(spark, str(tmp_path / "outbox"))
    found = outbox.recovery_candidates(rows_, F.lit(NOW), 10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "= active)" in plan
    assert "TakeOrderedAndProject" in plan
    assert [r.id for r in found.collect()] == [
        r.id for r in outbox.recovery_candidates(stored, F.lit(NOW), 10).collect()
    ]


OFFERS = "instance_id string, seq long, id long"


def admit(spark, ids, busy=(), **options):
    offers = spark.createDataFrame([("pod", k, i) for k, i in enumerate(ids)], OFFERS)
    in_flight = spark.createDataFrame([("pod", i) for i in busy], "instance_id string, id long")
    found = queueing.admission(offers, in_flight, **options).orderBy("seq").collect()
    return [r.decision for r in found]


def test_queue_of_two(spark):
    assert admit(spark, [1, 1, 2, 3], capacity=2) == ["ACCEPTED", "DUPLICATE", "ACCEPTED", "FULL"]
    assert admit(spark, [1, 1, 2, 3, 3], capacity=2, hot_rows=1, slice_rows=1) == ["ACCEPTED", "DUPLICATE", "ACCEPTED", "FULL", "FULL"]


def test_in_flight_ids_are_turned_away(spark):
    assert admit(spark, [5, 6], busy=[5], capacity=2) == ["IN_FLIGHT", "ACCEPTED"]
    assert admit(spark, [5, 6], capacity=2, in_queue=1) == ["ACCEPTED", "FULL"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.sets(st.integers(0, 9), max_size=3), st.integers(0, 6))
def test_admission_equals_a_plain_queue(spark, ids, busy, capacity):
    queue, expected = [], []
    for i in ids:
        if i in busy:
            expected.append("IN_FLIGHT")
        elif i in queue:
            expected.append("DUPLICATE")
        elif len(queue) >= capacity:
            expected.append("FULL")
        else:
            queue.append(i)
            expected.append("ACCEPTED")
    assert admit(spark, ids, busy, capacity=capacity, slice_rows=4, hot_rows=3) == expected


def test_batches_of_fixed_size(spark):
    queued = spark.createDataFrame([("pod", k) for k in range(7)], "instance_id string, seq long")
    found = queueing.batches(queued, 3, slice_rows=2).orderBy("seq").collect()
    assert [r.batch_no for r in found] == [0, 0, 0, 1, 1, 1, 2]


def test_health_limits(spark):
    row = spark.range(1).select(
        queueing.outbox_health(F.lit(10_000), 10_000), queueing.outbox_health(F.lit(9_999), 10_000),
        queueing.queue_health(F.lit(95), F.lit(100), 0.95), queueing.queue_health(F.lit(94), F.lit(100), 0.95),
    ).first()
    assert tuple(row) == ("DOWN", "UP", "DOWN", "UP")


def test_recovery_envelopes_read_items_of_candidates_only(spark, folder):
    plan = delivery.recovery_envelopes(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_live_counts_and_lookups(spark):
    from pyspark.sql import Observation

    df = rows(spark, (1, 110, 0, None), (2, 2, 1, None), (3, 0, 0, None))
    seen = Observation("delivery")
    assert outbox.live_counts(df, seen).count() == 3
    assert seen.get == {"rows": 3, "published": 1, "failed": 1, "pending": 2}
    assert [r.id for r in outbox.by_id(df, 2).collect()] == [2]


def test_queue_sizes_equal_a_running_sum(spark):
    import random

    rng = random.Random(8)
    # A hot instance over many slices, one with gaps, one that only shrinks, moves of one instant, and no time.
    rows = [("hot", rng.randrange(200_000) * 10_000, rng.choice([1, -1])) for _ in range(6000)]
    rows += [("gaps", 5_000_000, 1), ("gaps", 5_000_000, 1), ("gaps", 5_000_000, -1), ("gaps", 95_000_000, -1), ("down", 1, -1), (None, 7, 1), ("hot", None, 1)]
    moves = spark.createDataFrame(rows, "instance_id string, us long, delta int").select("instance_id", F.timestamp_micros("us").alias("ts"), "delta")
    found = {(r.instance_id, r.window_us): (r.size, r.peak, r.came, r.went) for r in queueing.queue_sizes(moves, 30, 2).collect()}
    expected = {}
    for instance in {r[0] for r in rows}:
        mine = [(us, d) for i, us, d in rows if i == instance and us is not None]
        windows = range(min(us for us, _ in mine) // 30_000_000, max(us for us, _ in mine) // 30_000_000 + 1)
        for w in windows:
            instants = sorted({us for us, _ in mine if us // 30_000_000 == w})
            sizes = [sum(d for us, d in mine if us <= t) for t in instants]
            start = sum(d for us, d in mine if us < w * 30_000_000)
            here = [d for us, d in mine if us // 30_000_000 == w]
            expected[instance, w * 30_000_000] = (sizes[-1] if sizes else start, max([start, *sizes]), sum(d > 0 for d in here), sum(d < 0 for d in here))
    assert found == expected


def test_moves_follow_the_transition_log(spark):
    rows = [(1, 1, 10, 0), (1, 2, 20, 2), (1, 3, 30, 1), (1, 4, 30, 2), (1, 5, 7300, 110), (2, 6, 5, 1), (3, 7, None, 0), (3, 8, 9, None)]
    log = spark.createDataFrame(rows, "id long, seq long, s long, status int").withColumn("ts", F.timestamp_seconds("s"))
    found = sorted((r.id, r.s, r.delta) for r in queueing.queue_moves(log, [0, 2], 10).select("id", F.unix_seconds("ts").alias("s"), "delta").collect())
    assert found == [(1, 10, 1), (1, 30, -1), (1, 30, 1), (1, 7300, -1)]
