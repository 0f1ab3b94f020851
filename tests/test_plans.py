import random
from pathlib import Path

from pyspark.sql import Window
from pyspark.sql import functions as F

from waybill.plans import slices
from waybill.plans.skew import join_per_key

ROOT = Path(__file__).resolve().parent.parent


def sample(spark):
    random.seed(5)
    rows = [("hot" if random.random() < 0.4 else f"g{random.randint(0, 5)}", k, random.choice([None, k * 2])) for k in range(500)]
    random.shuffle(rows)
    return spark.createDataFrame(rows, "g string, seq long, v long")


def test_ranked_equals_row_number(spark):
    df = sample(spark)
    wanted = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("seq")).cast("long"))
    for rows in (1, 7, 10_000):
        found = slices.ranked(df, ["g"], ["seq"], slices.id_slice(F.col("seq"), rows), "n")
        assert sorted(found.select("g", "seq", "n").collect()) == sorted(wanted.select("g", "seq", "n").collect())


def test_previous_equals_lag(spark):
    df = sample(spark)
    key = lambda r: (r.g, r.seq)
    wanted = df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy("seq")))
    for rows in (1, 7, 10_000):
        found = slices.previous(df, ["g"], "seq", slices.id_slice(F.col("seq"), rows), "v", "p")
        assert [tuple(r) for r in sorted(found.select("g", "seq", "p").collect(), key=key)] == [
            tuple(r) for r in sorted(wanted.select("g", "seq", "p").collect(), key=key)
        ]


def test_last_seen_equals_a_running_last(spark):
    df = sample(spark)
    key = lambda r: (r.g, r.seq)
    running = Window.partitionBy("g").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    wanted = df.withColumn("p", F.last("v", ignorenulls=True).over(running))
    for rows in (1, 7, 10_000):
        found = slices.last_seen(df, ["g"], ["seq"], slices.id_slice(F.col("seq"), rows), "v", "p")
        assert [tuple(r) for r in sorted(found.select("g", "seq", "p").collect(), key=key)] == [
            tuple(r) for r in sorted(wanted.select("g", "seq", "p").collect(), key=key)
        ]


def test_join_per_key_keeps_every_row_once(spark):
    df = sample(spark).unionByName(spark.createDataFrame([("absent", 999, 1)], "g string, seq long, v long"))
    per_key = sample(spark).groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("top"))
    wanted = df.join(per_key.drop("n"), "g", "left")
    for hot in (0, 70, 10_000):
        found = join_per_key(df, per_key, ["g"], "n", "seq", hot)
        assert sorted(map(str, found.select("g", "seq", "v", "top").collect())) == sorted(map(str, wanted.select("g", "seq", "v", "top").collect()))


def library():
    return [(p, p.read_text()) for p in (ROOT / "waybill").rglob("*.py") if "llm" not in p.parts]


def test_library_stays_on_the_executors():
    for path, text in library():
        for call in (".collect()", ".toPandas()", ".localCheckpoint(", ".rdd", ".crossJoin(", "F.udf(", ".toLocalIterator("):
            assert call not in text, f"{path}: {call}"


def test_windows_without_partition_are_absent(spark, folder):
    from waybill.queries import catalog

    for name in ("kafka_records", "publish_batches", "queue_admission", "rate_5m", "pressure_as_of", "panel_orders_http_p95"):
        plan = catalog.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "SinglePartition" not in plan.split("Window", 1)[1].split("\n")[0], name


def test_attempts_are_cut_down_before_the_shuffle(spark, folder):
    from waybill.operators import outbox
    from waybill.sources import driver_tables

    plan = outbox.replay_attempts(driver_tables.attempts(spark, folder), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_slices_keep_rows_without_group_or_order(spark):
    rows = [(None, 1), (None, None), ("a", 2), ("a", None), ("a", 5), (None, 9)]
    df = spark.createDataFrame(rows, "g string, seq long")
    slice_ = slices.id_slice(F.col("seq"), 2)
    ranked = sorted((str(r.g), r.n) for r in slices.ranked(df, ["g"], ["seq"], slice_, "n").collect())
    assert ranked == [("None", 1), ("None", 2), ("None", 3), ("a", 1), ("a", 2), ("a", 3)]
    assert slices.previous(df, ["g"], "seq", slice_, "seq", "before").count() == 6
    assert slices.last_seen(df, ["g"], ["seq"], slice_, "seq", "seen").count() == 6


def test_shared_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    import pytest
    from waybill.session import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None)))
