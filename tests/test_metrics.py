import math
import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import metrics as M
from waybill.plans import panels as P

SECOND = 1_000_000
GRID = M.Grid(0, 600 * SECOND)


def samples(spark, rows):
    """Rows of (second, metric, labels, value)."""
    df = spark.createDataFrame(rows, "s double, metric string, labels map<string,string>, value double")
    return df.withColumn("ts", F.timestamp_micros((F.col("s") * SECOND).cast("long"))).drop("s")


def result(df):
    return {(r.eval_us // SECOND, r.series): r.value for r in df.collect()}


def plain_rate(points, at, span):
    inside = [v for s, v in points if at - span < s <= at]
    if len(inside) < 2:
        return None
    return sum(b if b < a else b - a for a, b in zip(inside, inside[1:])) / span


def random_counters(seed):
    random.seed(seed)
    rows, points = [], {}
    for name in ("a", "b", "c"):
        s, v = 0.0, 0.0
        for _ in range(150):
            s += random.choice([0.5, 3.0, 20.0])
            v = 0.0 if random.random() < 0.1 else v + random.randint(0, 5)
            rows.append((s, "m", {"n": name, "job": "j"}, v))
            points.setdefault(f"job=j,n={name}", []).append((s, v))
    return rows, points


@pytest.mark.parametrize("span", [60, 300])
def test_rates_on_the_grid_equal_a_plain_walk(spark, span):
    rows, points = random_counters(span)
    found = result(M.plain(M.rates(samples(spark, rows), "m", (), GRID, span)))
    wanted = {
        (at, series): rate for series, listed in points.items() for at in range(0, 601, 15)
        if (rate := plain_rate(listed, at, span)) is not None
    }
    assert found.keys() == wanted.keys()
    assert all(math.isclose(found[k], wanted[k]) for k in wanted)


@pytest.mark.parametrize("slice_s", [7, 60, 1000])
def test_rates_at_samples_do_not_depend_on_the_slices(spark, slice_s):
    rows, points = random_counters(3)
    df = samples(spark, rows).select(F.col("labels")["n"].alias("n"), F.unix_micros("ts").alias("ts_us"), "value")
    found = {(r.n, r.ts_us): r.rate for r in M.rate_at_samples(df, ["n"], 60, slice_s).collect()}
    wanted = {
        (series[-1], int(s * SECOND)): rate for series, listed in points.items() for s, _ in listed
        if (rate := plain_rate(listed, s, 60)) is not None
    }
    assert found.keys() == wanted.keys()
    assert all(math.isclose(found[k], wanted[k]) for k in wanted)


def test_last_value_within_lookback(spark):
    found = result(M.plain(M.last_values(samples(spark, [(15.0, "m", {}, 1.0), (16.0, "m", {}, 2.0), (20.0, "m", {}, 3.0)]), "m", (), GRID)))
    assert found[(15, "")] == 1.0 and found[(30, "")] == 3.0 and found[(315, "")] == 3.0
    assert (0, "") not in found and (330, "") not in found


def buckets(spark, rows):
    return spark.createDataFrame(rows, "g string, le double, value double")


@pytest.mark.parametrize(
    "counts, q, wanted",
    [
        ([10.0, 20.0, 30.0, 30.0], 0.5, 1.5), ([10.0, 20.0, 30.0, 40.0], 0.95, 4.0), ([10.0, 10.0, 10.0, 10.0], 0.5, 0.5),
        ([0.0, 0.0, 0.0, 0.0], 0.5, None), ([0.0, 10.0, 10.0, 10.0], 0.1, 1.1),
    ],
)
def test_histogram_quantile(spark, counts, q, wanted):
    bounds = [1.0, 2.0, 4.0, math.inf]
    row = M.histogram_quantile(q, buckets(spark, [("g", b, c) for b, c in zip(bounds, counts)]), ["g"]).first()
    assert row.value is None if wanted is None else math.isclose(row.value, wanted)


def test_either_keeps_the_first_and_adds_missing_series(spark):
    schema = "eval_us long, series string, value double"
    a = spark.createDataFrame([(0, "", 1.0), (15 * SECOND, "x", 2.0)], schema)
    b = spark.createDataFrame([(0, "", 9.0), (0, "y", 3.0)], schema)
    assert result(M.either(a, b)) == {(0, ""): 1.0, (15, "x"): 2.0, (0, "y"): 3.0}
    zero = result(M.or_zero(a, M.Grid(0, 30 * SECOND)))
    assert zero == {(0, ""): 1.0, (15, "x"): 2.0, (15, ""): 0.0, (30, ""): 0.0}


def test_ratio_over_zero(spark):
    schema = "eval_us long, series string, value double"
    top, bottom = spark.createDataFrame([(0, "", 1.0)], schema), spark.createDataFrame([(0, "", 0.0)], schema)
    assert result(M.ratio(top, bottom)) == {(0, ""): None}
    assert result(M.ratio(top, bottom, 1e-9)) == {(0, ""): 1.0 / 1e-9}
    assert result(M.share(bottom, bottom)) == {(0, ""): None}


def test_cumulative_buckets_and_bands(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("a", 99.0), ("b", 2.0)], "g string, v double")
    found = {(r.g, r.le): r["count"] for r in M.cumulative_buckets(df, ["g"], "v", (1.0, 10.0)).collect()}
    assert found == {("a", 1.0): 1, ("a", 10.0): 2, ("a", math.inf): 3, ("b", 1.0): 0, ("b", 10.0): 1, ("b", math.inf): 1}
    row = spark.range(1).select(*[M.bands(F.lit(v), M.CPU_BANDS, "green") for v in (69.9, 70.0, 90.0)], M.up_text(F.lit(1))).first()
    assert tuple(row) == ("green", "yellow", "red", "UP")


def test_slo(spark):
    df = spark.createDataFrame([("a", float(i), i == 0) for i in range(1000)] + [("b", 1.0, False)], "stage string, ms double, bad boolean")
    found = {r.stage: (r.met, r.failed_pct) for r in M.slo(df, ["stage"], "ms", "bad", 0.5, 200.0).collect()}
    assert found == {"a": (False, 0.1), "b": (True, 0.0)}


def test_every_panel_is_listed_once():
    assert len(P.PANELS) == 67
    assert all(P.metrics_of(p) for p in P.PANELS.values())
