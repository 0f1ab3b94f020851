"""Stored sketches against exact percentiles."""

import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import rollups
from waybill.session import scratch_path

RANKS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
SCHEMA = "g string, us long, value double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select("g", F.timestamp_micros("us").alias("ts"), "value")


def rows_of(seed, n, span_s):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.randrange(span_s * 10**6), rng.lognormvariate(3, 1)) for _ in range(n)]


def disc(values, rank):
    values = sorted(values)
    return values[max(-(-rank * len(values) // 1) - 1, 0).__int__()] if values else None


def test_small_groups_are_exact_from_the_minutes_alone(spark):
    rows = rows_of(1, 4000, 3 * 86_400) + [("a", None, 1.0), ("a", 5, None)]
    root = scratch_path(spark, "rollup")
    rollups.save(rollups.minutes(frame(spark, rows), ["g"], "ts", "value"), root)
    kept = rollups.stored(spark, root, "g string")
    day = F.floor(F.col("minute_us") / 86_400_000_000).alias("day")
    found = {(r.g, r.day): r for r in rollups.with_quantiles(rollups.merged(kept, ["g", day]), RANKS).collect()}
    groups = {}
    for g, us, value in rows:
        if us is not None and value is not None:
            groups.setdefault((g, us // 86_400_000_000), []).append(value)
    assert found.keys() == groups.keys()
    for key, values in groups.items():
        r = found[key]
        assert (r.n, r.most) == (len(values), max(values)) and r.total == pytest.approx(sum(values))
        assert [r[name] for name in RANKS] == [disc(values, rank) for rank in RANKS.values()]


def test_large_groups_keep_the_stated_error_merged_or_direct(spark):
    k, n = 400, 120_000
    data = spark.range(n, numPartitions=6).select(F.lit("a").alias("g"), F.timestamp_micros(F.col("id") * 1_000_000).alias("ts"), (F.xxhash64("id") % 1_000_003).cast("double").alias("value"))
    values = sorted(r.value for r in data.collect())
    merged = rollups.merged(rollups.minutes(data, ["g"], "ts", "value", k), ["g"], k)
    direct = data.groupBy("g").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch"))
    for summary in (merged, direct):
        r = rollups.with_quantiles(summary, RANKS).first()
        assert r.n == n
        for name, rank in RANKS.items():
            low = sum(v < r[name] for v in values) / n
            assert abs(low - rank) <= 1.5 * rollups.rank_error(k)
    assert merged.select(F.octet_length("sketch")).first()[0] < 20_000


def test_a_range_reads_its_days_only(spark):
    root = scratch_path(spark, "rollup")
    rollups.save(rollups.minutes(frame(spark, rows_of(2, 3000, 10 * 86_400)), ["g"], "ts", "value"), root)
    start, end = F.lit("1970-01-04 12:00:00").cast("timestamp"), F.lit("1970-01-06 00:30:00").cast("timestamp")
    part = rollups.stored(spark, root, "g string", start, end)
    read = {r.f.split("day=")[1][:10] for r in part.select(F.input_file_name().alias("f")).collect()}
    assert read == {"1970-01-04", "1970-01-05", "1970-01-06"}
    wanted = [r for r in rows_of(2, 3000, 10 * 86_400) if 3.5 * 86_400e6 <= r[1] // 60_000_000 * 60_000_000 < 5 * 86_400e6 + 30 * 60e6]
    assert part.agg(F.sum("n")).first()[0] == len(wanted)
    scan = part._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert scan.partitionFilters().size() == 3 and scan.selectedPartitions().partitionCount() == 3


def test_stream_writes_the_same_minutes(spark):
    rows = rows_of(3, 2000, 7200)
    root = scratch_path(spark, "rollup")
    frame(spark, rows).repartition(3).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("g string, ts timestamp, value double").parquet(f"{root}/in")
    out = rollups.stream_minutes(stream, ["g"], "ts", "value", "10 minutes")
    writer = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    found = rollups.with_quantiles(spark.read.parquet(f"{root}/out"), RANKS).collect()
    newest = max(us for _, us, _ in rows)
    closed = (newest // 1000 - 600_000) * 1000
    batch = rollups.with_quantiles(rollups.minutes(frame(spark, rows), ["g"], "ts", "value"), RANKS).where(F.col("minute_us") + rollups.MINUTE <= closed)
    key = lambda r: (r.g or "", r.minute_us)
    plain = lambda r: (r.g, r.minute_us, r.n, r.most, round(r.total, 6), r.p50, r.p95, r.p99)
    assert list(map(plain, sorted(found, key=key))) == list(map(plain, sorted(batch.collect(), key=key)))


def test_empty_table(spark):
    empty = rollups.minutes(frame(spark, []), ["g"], "ts", "value")
    assert rollups.with_quantiles(rollups.merged(empty, ["g"]), RANKS).count() == 0
