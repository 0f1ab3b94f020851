"""Time-series functions over labelled samples ``(ts, metric, labels, value)``: rates, last values, quantiles, ratios.

Results are series on an evaluation grid: ``(eval_us, series, value)``, where ``series`` is the text of the labels that
are left, sorted by name. Two results match where ``eval_us`` and ``series`` are equal.

Samples are first reduced to one row per (series, grid step). A range of several steps is then put together from these
rows only, so the work after the first aggregate grows with series times steps and not with samples.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions import scalars

MICRO = 1_000_000
KEY = ["eval_us", "series"]
Matcher = tuple[str, str, str]


@dataclass(frozen=True)
class Grid:
    """Evaluation times ``start + k * step`` up to ``end``. Step k covers the samples after k - 1, up to and with k."""

    start_us: int
    end_us: int
    step_us: int = 15 * MICRO

    @property
    def last(self) -> int:
        return (self.end_us - self.start_us) // self.step_us

    def steps(self, seconds: int) -> int:
        whole, rest = divmod(seconds * MICRO, self.step_us)
        if rest:
            raise ValueError("a range must be a whole number of grid steps")
        return whole

    def eval_us(self, step: Column) -> Column:
        return F.lit(self.start_us) + step * F.lit(self.step_us)


def series_text(labels: Column) -> Column:
    entries = F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(entries), ",")


def labels_text(labels: Column, names: Sequence[str]) -> Column:
    """Text of some labels; a label that is missing is left out."""
    pairs = [F.concat(F.lit(f"{n}="), F.try_element_at(labels, F.lit(n))) for n in sorted(names)]
    return F.concat_ws(",", *pairs) if pairs else F.lit("")


def select(samples: DataFrame, metric: str, matchers: Sequence[Matcher], grid: Grid, lookback_s: int) -> DataFrame:
    """Samples of a metric that pass all matchers and can matter on the grid, with their step number."""
    earliest = grid.start_us - lookback_s * MICRO
    chosen = samples.filter(F.col("metric") == metric).filter(
        (F.col("ts") > F.timestamp_micros(F.lit(earliest))) & (F.col("ts") <= F.timestamp_micros(F.lit(grid.end_us)))
    )
    for name, op, wanted in matchers:
        chosen = chosen.filter(scalars.label_matches(F.col("labels"), name, op, wanted))
    ts_us = F.unix_micros("ts")
    step = F.ceil((ts_us - grid.start_us) / F.lit(grid.step_us)).cast("bigint")
    return chosen.select(ts_us.alias("ts_us"), step.alias("step"), "labels", "value")


def _spread(reduced: DataFrame, grid: Grid, steps: int) -> DataFrame:
    """Copy each reduced row to every grid point whose range contains its step."""
    points = F.sequence(F.col("step"), F.col("step") + F.lit(steps - 1))
    return reduced.withColumn("at", F.explode(points)).filter(F.col("at").between(0, grid.last))


def last_values(samples: DataFrame, metric: str, matchers: Sequence[Matcher], grid: Grid, lookback_s: int = 300) -> DataFrame:
    """Last sample of each series within the lookback, as ``(eval_us, series, labels, value)``."""
    chosen = select(samples, metric, matchers, grid, lookback_s).withColumn("series", series_text(F.col("labels")))
    reduced = chosen.groupBy("series", "step").agg(
        F.max_by("value", "ts_us").alias("value"), F.any_value("labels").alias("labels")
    )
    spread = _spread(reduced, grid, grid.steps(lookback_s))
    newest = spread.groupBy("series", "at").agg(
        F.max_by("value", "step").alias("value"), F.any_value("labels").alias("labels")
    )
    return newest.select(grid.eval_us(F.col("at")).alias("eval_us"), "series", "labels", "value")


def increase(value: Column, previous: Column) -> Column:
    """Growth of a counter from one sample to the next; a lower value means that the counter started again at zero."""
    return F.when(previous.isNull(), F.lit(0.0)).when(value < previous, value).otherwise(value - previous)


def rates(samples: DataFrame, metric: str, matchers: Sequence[Matcher], grid: Grid, range_s: int) -> DataFrame:
    """Per-second increase of each series over the range, as ``(eval_us, series, labels, value)``.

    Only pairs of samples inside the range count; there is no extrapolation to its edges. Fewer than two samples in
    the range give no row.
    """
    chosen = select(samples, metric, matchers, grid, range_s).withColumn("series", series_text(F.col("labels")))
    inside = Window.partitionBy("series", "step").orderBy("ts_us")
    grown = chosen.withColumn("inc", increase(F.col("value"), F.lag("value").over(inside)))
    reduced = grown.groupBy("series", "step").agg(
        F.sum("inc").alias("inc"), F.min_by("value", "ts_us").alias("first"), F.max_by("value", "ts_us").alias("last"),
        F.count(F.lit(1)).alias("n"), F.any_value("labels").alias("labels"),
    )
    # From the last sample of a step to the first one of the next step that has any.
    along = Window.partitionBy("series").orderBy("step")
    joined = reduced.withColumn("gap_inc", increase(F.col("first"), F.lag("last").over(along)))
    total = F.sum("inc") + F.sum("gap_inc") - F.min_by("gap_inc", "step")
    over_range = (
        _spread(joined, grid, grid.steps(range_s))
        .groupBy("series", "at")
        .agg((total / F.lit(float(range_s))).alias("value"), F.sum("n").alias("n"), F.any_value("labels").alias("labels"))
    )
    return over_range.filter(F.col("n") >= 2).select(
        grid.eval_us(F.col("at")).alias("eval_us"), "series", "labels", "value"
    )


def rate_at_samples(samples: DataFrame, series: list[str], window_s: int, slice_s: int | None = None) -> DataFrame:
    """``rate`` at every sample ``(series..., ts_us, value)`` over the time range that ends with it.

    Series are cut into time slices. A sample also goes to the following slices that its range reaches into, where it
    is only looked back at. So one task holds one slice plus one range of one series. A sliding frame would add up its
    rows anew for each sample; here running totals are subtracted instead. The total to subtract is that of the first
    sample after the range's start, found by a running ``last`` from the newest sample down.
    """
    window_us = window_s * MICRO
    slice_us = (slice_s or window_s) * MICRO
    own = F.floor(F.col("ts_us") / F.lit(slice_us))
    reach = F.floor((F.col("ts_us") + F.lit(window_us - 1)) / F.lit(slice_us))
    group = [*series, "__slice"]
    copies = samples.withColumn("__own", own).withColumn("__slice", F.explode(F.sequence(own, reach)))
    upwards = Window.partitionBy(*group).orderBy("ts_us")
    so_far = upwards.rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        copies.withColumn("__inc", increase(F.col("value"), F.lag("value").over(upwards)))
        .withColumn("__total", F.sum("__inc").over(so_far))
        .withColumn("__n", F.row_number().over(upwards))
    )
    sample = F.struct(
        F.col("ts_us").alias("at"), F.lit(1).alias("kind"), F.col("__total").alias("first_total"), F.col("__n").alias("first_n")
    )
    # The start of a sample's range is excluded, so at equal times it is met before the sample there.
    start = F.struct(
        (F.col("ts_us") - window_us).alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("double").alias("first_total"),
        F.lit(None).cast("int").alias("first_n"),
    )
    both = F.when(F.col("__slice") == F.col("__own"), F.array(sample, start)).otherwise(F.array(sample))
    points = totals.select(*group, "ts_us", "__total", "__n", F.inline(both))
    downwards = Window.partitionBy(*group).orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = points.withColumn("__from", F.last("first_total", ignorenulls=True).over(downwards)).withColumn(
        "__from_n", F.last("first_n", ignorenulls=True).over(downwards)
    )
    return found.filter((F.col("kind") == 0) & (F.col("__n") > F.col("__from_n"))).select(
        *series, "ts_us", ((F.col("__total") - F.col("__from")) / F.lit(float(window_s))).alias("rate")
    )


# Operators on results.

def plain(result: DataFrame) -> DataFrame:
    return result.select(*KEY, "value")


def by_labels(result: DataFrame, how: str, names: Sequence[str] = ()) -> DataFrame:
    """``sum`` / ``avg`` / ``max`` by labels."""
    fold = {"sum": F.sum, "avg": F.avg, "max": F.max}[how]
    kept = result.select("eval_us", labels_text(F.col("labels"), names).alias("series"), "value")
    return kept.groupBy(*KEY).agg(fold("value").alias("value"))


def positive(result: DataFrame) -> DataFrame:
    return result.filter(F.col("value") > 0)


def scaled(result: DataFrame, factor: float) -> DataFrame:
    return result.withColumn("value", F.col("value") * F.lit(factor))


def either(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All of the first, then what the next one has for other label sets, and so on."""

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        fallback = right.select(*KEY, F.col("value").alias("__other"))
        filled = left.join(fallback, KEY, "full")
        return filled.select(*KEY, F.coalesce("value", "__other").alias("value"))

    return reduce(step, others, first)


def zeros(grid: Grid, spark) -> DataFrame:
    points = spark.range(0, grid.last + 1)
    return points.select(grid.eval_us(F.col("id")).alias("eval_us"), F.lit("").alias("series"), F.lit(0.0).alias("value"))


def or_zero(result: DataFrame, grid: Grid) -> DataFrame:
    """A zero at every grid point that has no value without labels."""
    return either(result, zeros(grid, result.sparkSession))


def ratio(top: DataFrame, bottom: DataFrame, least: float | None = None) -> DataFrame:
    """Quotient of matching series; null over zero unless ``least`` clamps the denominator."""
    under = bottom.select(*KEY, F.col("value").alias("__under"))
    below = F.col("__under") if least is None else scalars.clamp_min(F.col("__under"), least)
    return top.join(under, KEY).select(*KEY, F.try_divide(F.col("value"), below).alias("value"))


def share(part: DataFrame, rest: DataFrame) -> DataFrame:
    """part / (part + rest) of matching series."""
    other = rest.select(*KEY, F.col("value").alias("__rest"))
    return part.join(other, KEY).select(
        *KEY, F.try_divide(F.col("value"), F.col("value") + F.col("__rest")).alias("value")
    )


def bound(le: Column) -> Column:
    return F.when(le == "+Inf", F.lit(float("inf"))).otherwise(le.cast("double"))


def histogram_quantile(q: float, buckets: DataFrame, group: list[str]) -> DataFrame:
    """Quantile from cumulative buckets ``(group..., le DOUBLE, value)``, linear inside a bucket.

    In the last bucket it is the highest finite bound; the first bucket starts at zero; null when nothing was counted.
    """
    ascending = Window.partitionBy(*group).orderBy("le")
    whole = Window.partitionBy(*group)
    placed = buckets.withColumns(
        {
            "rank": F.lit(q) * F.max("value").over(whole),
            "total": F.max("value").over(whole),
            "low": F.coalesce(F.lag("le").over(ascending), F.lit(0.0)),
            "below": F.coalesce(F.lag("value").over(ascending), F.lit(0.0)),
        }
    )
    first = placed.filter(F.col("value") >= F.col("rank")).groupBy(*group).agg(
        F.min_by(F.struct("le", "low", "below", "value", "rank", "total"), "le").alias("b")
    )
    b = {c: F.col(f"b.{c}") for c in ("le", "low", "below", "value", "rank", "total")}
    inside = b["low"] + (b["le"] - b["low"]) * F.try_divide(b["rank"] - b["below"], b["value"] - b["below"])
    value = (
        F.when(b["total"] <= 0, F.lit(None).cast("double"))
        .when(b["le"] == float("inf"), b["low"])
        .otherwise(F.coalesce(inside, b["low"]))
    )
    return first.select(*group, value.alias("value"))


def quantile_of_rates(q: float, rated: DataFrame) -> DataFrame:
    """``histogram_quantile(q, sum by (le) (rate(...)))``, positive values only; one series without labels."""
    le = bound(scalars.label(F.col("labels"), "le"))
    buckets = rated.select("eval_us", le.alias("le"), "value").groupBy("eval_us", "le").agg(F.sum("value").alias("value"))
    result = histogram_quantile(q, buckets, ["eval_us"]).withColumn("series", F.lit(""))
    return positive(result).select(*KEY, "value")


# Meters over raw observations.

def cumulative_buckets(df: DataFrame, group: list[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Count of observations up to each bound, and up to infinity; one pass, one row per group and bound."""
    names = [f"b{k}" for k in range(len(bounds))]
    counts = [F.count_if(F.col(value) <= F.lit(b)).alias(n) for n, b in zip(names, bounds)]
    wide = df.groupBy(*group).agg(*counts, F.count(value).alias("b_all"))
    entries = [F.struct(F.lit(float(b)).alias("le"), F.col(n).alias("count")) for n, b in zip(names, bounds)]
    entries.append(F.struct(F.lit(float("inf")).alias("le"), F.col("b_all").alias("count")))
    return wide.select(*group, F.inline(F.array(*entries)))


def timer_summary(df: DataFrame, group: list[str], value: str, accuracy: int = 10_000) -> DataFrame:
    """Count, sum, max and three percentiles per group. Percentile ranks are exact up to n / accuracy."""
    ps = F.percentile_approx(value, [0.5, 0.95, 0.99], accuracy)
    return df.groupBy(*group).agg(
        F.count(value).alias("n"), F.sum(value).alias("total"), F.max(value).alias("most"), ps.alias("__p")
    ).select(*group, "n", "total", "most", *[F.col("__p")[k].alias(n) for k, n in enumerate(("p50", "p95", "p99"))])


def bands(value: Column, steps: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Name of the highest threshold that the value reaches."""
    chain = F.lit(lowest)
    for least, name in sorted(steps):
        chain = F.when(value >= least, name).otherwise(chain)
    return chain


# Panel thresholds and the texts for an up / down series.
CPU_BANDS = ((70.0, "yellow"), (90.0, "red"))
UP_TEXT = {0: "DOWN", 1: "UP"}


def up_text(value: Column) -> Column:
    return F.when(value == 1, UP_TEXT[1]).when(value == 0, UP_TEXT[0])


def slo(df: DataFrame, group: list[str], duration: str, failed: str, max_failed_pct: float, p95_ms: float,
        accuracy: int = 10_000) -> DataFrame:
    """Share of failed requests and 95th percentile per group, against their limits."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("requests"),
        (F.count_if(failed) * F.lit(100.0) / F.count(F.lit(1))).alias("failed_pct"),
        F.percentile_approx(duration, 0.95, accuracy).alias("p95_ms"),
    ).withColumn("met", (F.col("failed_pct") < max_failed_pct) & (F.col("p95_ms") < p95_ms))
