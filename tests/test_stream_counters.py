"""Counter rates on a stream against a plain version, with files in any order."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.session import scratch_path
from waybill.streaming import counters

SCHEMA = "series string, ts timestamp, value double"


def plain(rows, range_s, step_s, until_us):
    out = set()
    by = {}
    for series, us, value in rows:
        by.setdefault(series, []).append((us, value))
    for series, held in by.items():
        held.sort()
        last = held[-1][0] + range_s * 10**6
        for at in range(held[0][0] // (step_s * 10**6) * step_s * 10**6, min(last, until_us) + 1, step_s * 10**6):
            inside = [v for us, v in held if at - range_s * 10**6 < us <= at]
            if len(inside) >= 2:
                grown = sum(b - a if b >= a else b for a, b in zip(inside, inside[1:]))
                out.add((series, at, round(grown / range_s, 9), len(inside)))
    return out


def sample_rows(seed, series, seconds, per_second=1.0):
    rng = random.Random(seed)
    rows = []
    for name in series:
        value = 0.0
        for us in sorted(rng.randrange(seconds * 10**6) for _ in range(int(seconds * per_second))):
            value = 0.0 if rng.random() < 0.02 else value + rng.randrange(9)
            rows.append((name, us, value))
    return rows


def written(spark, rows, order):
    """A folder with one file for each list of rows, older ones first."""
    root = scratch_path(spark, "samples")
    for part in order:
        frame = spark.createDataFrame([rows[k] for k in part], "series string, us long, value double")
        frame.select("series", F.timestamp_micros("us").alias("ts"), "value").coalesce(1).write.mode("append").parquet(f"{root}/in")
    return root


def run(spark, root, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    rates = counters.counter_rates(stream, **options)
    writer = rates.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(counters.RATES).parquet(f"{root}/out").collect()
    assert len({(r.series, r.eval_us) for r in rows}) == len(rows)
    return {(r.series, r.eval_us, round(r.rate, 9), r.n) for r in rows}, query


@pytest.mark.parametrize("slice_s", [None, 2.5])
def test_rates_of_shuffled_files(spark, slice_s):
    rows = sample_rows(1, ["a", "b", None], 300)
    # Six files of neighbouring samples, each pair of files swapped: up to 110 seconds late.
    by_time = sorted(range(len(rows)), key=lambda k: rows[k][1])
    files = [list(f) for f in np.array_split(by_time, 6)]
    order = [files[k] for k in (1, 0, 3, 2, 5, 4)]
    newest = max(us for _, us, _ in rows)
    found, query = run(spark, written(spark, rows, order), range_s=30, step_s=5, delay="110 seconds", slice_s=slice_s)
    until = (newest // 1000 - 110_000) * 1000
    assert found == plain(rows, 30, 5, until) and counters.late_rows(query) == 0


def test_state_does_not_grow_with_the_stream(spark):
    rows = sample_rows(2, ["a", "b"], 1200)
    by_time = sorted(range(len(rows)), key=lambda k: rows[k][1])
    found, query = run(spark, written(spark, rows, [list(f) for f in np.array_split(by_time, 8)]), range_s=30, step_s=10, delay="20 seconds")
    assert found == plain(rows, 30, 10, max(us for _, us, _ in rows) // 1000 * 1000 - 20_000_000)
    # A batch has 150 seconds: 300 samples at most wait with what belongs to timers, and never those of earlier batches.
    sizes = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    assert max(sizes[4:]) <= 1.5 * max(sizes[:4]) and sizes[-1] < 200


def test_late_samples_are_left_out_and_counted(spark):
    rows = sample_rows(3, ["a"], 200)
    late = [("a", 5_000_000, 1e9), ("a", 6_000_000, 2e9)]
    by_time = sorted(range(len(rows)), key=lambda k: rows[k][1])
    order = [*[list(f) for f in np.array_split(by_time, 4)], [len(rows), len(rows) + 1]]
    found, query = run(spark, written(spark, rows + late, order), range_s=20, step_s=10, delay="10 seconds")
    assert found == plain(rows, 20, 10, max(us for _, us, _ in rows) // 1000 * 1000 - 10_000_000)
    assert counters.late_rows(query) == 2


def test_query_in_a_session_with_another_state_store(spark, folder):
    """Spark's own default keeps no state with timers."""
    from waybill.queries import streams

    name, other = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set(name, other)
    rows = streams.stream_counter_rates(session, folder).collect()
    assert session.conf.get(name) == other
    assert rows and sorted(rows) == sorted(streams.stream_counter_rates(spark, folder).collect())


def test_slices_must_fit(spark):
    stream = spark.readStream.format("rate").load().select(F.lit("a").alias("series"), F.col("timestamp").alias("ts"), "value")
    with pytest.raises(ValueError):
        counters.counter_rates(stream, 30, 10, "1 second", slice_s=4)
