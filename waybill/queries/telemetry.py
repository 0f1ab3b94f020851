"""Metric queries: every dashboard panel, and the meters over raw observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.operators import metrics as M
from waybill.operators import rollups as R
from waybill.plans import panels as P
from waybill.queries.sql import with_tables
from waybill.session import scratch_path
from waybill.sources import driver_tables as D

GRID = M.Grid(D.METRICS_START_US, D.METRICS_START_US + D.METRICS_SPAN_US)
BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def six_digits(value):
    """Cut to six digits off centre, as engines differ in how they round an exact half."""
    return F.floor(value * F.lit(1e6) + F.lit(0.618034)) / F.lit(1e6)


def panel_query(name):
    panel = P.PANELS[name]

    def run(spark, folder):
        samples = D.metric_samples(spark, folder, P.metrics_of(panel))
        result = P.evaluate(panel, samples, GRID)
        return result.select("eval_us", "series", six_digits(F.col("value")).alias("value"))

    run.__name__ = f"panel_{name}"
    run.__doc__ = f"Dashboard panel {name.replace('_', ' ')}."
    return run


def compressed_counters(spark, folder):
    shifted = F.floor((F.unix_micros("ts") - D.METRICS_START_US) / F.lit(D.COMPRESSION))
    return D.counter_samples(spark, folder).select(
        "event_type", (F.lit(D.METRICS_START_US) + shifted).alias("ts_us"), F.col("counter").alias("value")
    )


def rate_5m(spark, folder):
    """Rate at every sample, with counters that start again every 500 events."""
    rows = M.rate_at_samples(compressed_counters(spark, folder), ["event_type"], 300)
    return rows.select("event_type", "ts_us", F.round("rate", 9).alias("rate"))


def rate_1m_in_slices(spark, folder):
    """As above over one minute, in slices shorter than the range."""
    rows = M.rate_at_samples(compressed_counters(spark, folder), ["event_type"], 60, slice_s=20)
    return rows.select("event_type", "ts_us", F.round("rate", 9).alias("rate"))


def durations(spark, folder):
    return D.table(spark, folder, "events").select("event_type", "ts", F.col("value").alias("ms"))


def timer_summary(spark, folder):
    rows = M.timer_summary(durations(spark, folder), ["event_type"], "ms", accuracy=1_000_000)
    return rows.withColumn("total", F.round("total", 4))


def batch_size_summary(spark, folder):
    """Sizes of the publisher's batches as a distribution: batches of one user's events per day."""
    sizes = durations_by_user_day(spark, folder)
    return M.timer_summary(sizes, ["day"], "size", accuracy=1_000_000)


def durations_by_user_day(spark, folder):
    events = D.table(spark, folder, "events")
    return events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("size"))


def histogram_buckets(spark, folder):
    rows = M.cumulative_buckets(durations(spark, folder), ["event_type"], "ms", BOUNDS)
    return rows.withColumn("le", F.when(F.col("le") == float("inf"), F.lit(-1.0)).otherwise(F.col("le")))


def quantiles(q):
    def run(spark, folder):
        buckets = M.cumulative_buckets(durations(spark, folder), ["event_type"], "ms", BOUNDS)
        value = buckets.select("event_type", "le", F.col("count").cast("double").alias("value"))
        return M.histogram_quantile(q, value, ["event_type"]).select("event_type", six_digits(F.col("value")).alias("value"))

    return run


def threshold_bands(spark, folder):
    events = D.table(spark, folder, "events")
    band = M.bands(F.col("value"), M.CPU_BANDS, "green")
    up = M.up_text(F.when(F.col("value") < 100, 1).otherwise(0))
    return events.groupBy(band.alias("band"), up.alias("up")).agg(F.count(F.lit(1)).alias("samples"))


def slo_check(spark, folder):
    """Failed share and 95th percentile per load stage, here the week of the event."""
    events = D.table(spark, folder, "events").select(
        F.floor(F.dayofmonth("ts") / F.lit(8)).cast("bigint").alias("stage"), F.col("value").alias("ms"),
        ((F.col("event_type") == "error") & (F.col("event_id") % 50 == 0)).alias("failed"),
    )
    rows = M.slo(events, ["stage"], "ms", "failed", 0.5, 200.0, accuracy=1_000_000)
    return rows.select("stage", "requests", F.round("failed_pct", 6).alias("failed_pct"), "p95_ms", "met")


RANKS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
WEEK_US = 7 * 86_400 * 1_000_000


def rolled_up(spark, folder):
    """Summaries of the event values per type and minute, stored by day; their path."""
    root = scratch_path(spark, "latency")
    R.save(R.minutes(durations(spark, folder).withColumn("ts", F.col("ts").cast("timestamp")), ["event_type"], "ts", "ms"), root)
    return root


def latency_rollup(spark, folder):
    """Percentiles per type and day, from the stored minutes only."""
    kept = R.stored(spark, rolled_up(spark, folder), "event_type STRING")
    day = F.date_format(F.timestamp_micros("minute_us"), "yyyy-MM-dd").alias("day")
    return R.with_quantiles(R.merged(kept, ["event_type", day]), RANKS).withColumn("total", F.round("total", 4))


def latency_rollup_week(spark, folder):
    """Percentiles per type over the newest seven days, reading the days of that range only."""
    newest = durations(spark, folder).agg(F.coalesce(F.max(F.unix_micros(F.col("ts").cast("timestamp"))), F.lit(0))).first()[0]
    end_us = newest // R.MINUTE * R.MINUTE
    start, end = F.timestamp_micros(F.lit(end_us - WEEK_US)), F.timestamp_micros(F.lit(end_us))
    kept = R.stored(spark, rolled_up(spark, folder), "event_type STRING", start, end)
    return R.with_quantiles(R.merged(kept, ["event_type"]), RANKS).withColumn("total", F.round("total", 4))


def span_rollup(spark, folder):
    """Percentiles of span durations per service, name and hour, merged from minutes."""
    per_minute = R.minutes(D.spans(spark, folder), ["service", "name"], "start_ts", "duration_ms")
    hour = F.floor(F.col("minute_us") / F.lit(60 * R.MINUTE)).cast("bigint").alias("hour")
    return R.with_quantiles(R.merged(per_minute, ["service", "name", hour]), RANKS).withColumn("total", F.round("total", 7))


QUERIES = {f"panel_{name}": panel_query(name) for name in P.PANELS}
QUERIES |= {
    f.__name__: f
    for f in (rate_5m, rate_1m_in_slices, timer_summary, batch_size_summary, histogram_buckets, threshold_bands, slo_check, latency_rollup, latency_rollup_week, span_rollup)
}
QUERIES["histogram_quantile_p50"] = quantiles(0.5)
QUERIES["histogram_quantile_p95"] = quantiles(0.95)
QUERIES["histogram_quantile_p99"] = quantiles(0.99)

# SQL of the panels. It compares every sample with every grid point it can matter for.

LABELS = sorted({name for pairs in D.SERIES_LABELS.values() for name in pairs} | {"le"})
SERIES = "concat_ws(',', " + ", ".join(f"'{n}=' || \"{n}\"" for n in LABELS) + ")"


def quoted(text):
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def samples_sql(metrics):
    rows = []
    for metric in sorted(metrics):
        kind = D.metric_kind(metric)
        for le, share in D.BUCKET_SHARES.items() if kind == "bucket" else ((None, None),):
            rows.append(f"({quoted(metric)}, '{kind}', {quoted(le)}, CAST({share or 0} AS DOUBLE))")
    names = [n for n in LABELS if n != "le"]
    label_rows = [
        f"({quoted(kind)}, " + ", ".join(quoted(pairs.get(n)) for n in names) + ")" for kind, pairs in D.SERIES_LABELS.items()
    ]
    name_list = ", ".join(f'"{n}"' for n in names)
    return f""", kinds(metric, kind, le, share) AS (VALUES {', '.join(rows)}),
label_rows(event_type, {name_list}) AS (VALUES {', '.join(label_rows)}),
samples AS (SELECT {D.METRICS_START_US} + (epoch_us(ts) - {D.METRICS_START_US}) // {D.COMPRESSION} AS ts_us, metric, le, {name_list},
    CASE kind WHEN 'counter' THEN counter WHEN 'sum' THEN counter * (n // 500 + 1) * CAST(0.5 AS DOUBLE)
      WHEN 'bucket' THEN floor(counter * share) WHEN 'flag' THEN CASE WHEN gauge < 100 THEN 1 ELSE 0 END ELSE gauge END AS value
    FROM counted JOIN label_rows USING (event_type), kinds)
"""


def matcher_sql(name, op, wanted):
    value = f"coalesce(\"{name}\", '')"
    if op in ("=", "!="):
        return f"{value} {'=' if op == '=' else '<>'} {quoted(wanted)}"
    return f"{'' if op == '=~' else 'NOT '}regexp_full_match({value}, {quoted(wanted)})"


def in_range_sql(metric, where, seconds):
    tests = "".join(f" AND {matcher_sql(*m)}" for m in where)
    steps = GRID.steps(seconds)
    return f"""SELECT *, {SERIES} AS all_labels FROM (SELECT *, unnest(generate_series(step, step + {steps - 1})) AS tick FROM (
        SELECT *, CAST(ceil((ts_us - {GRID.start_us}) / CAST({GRID.step_us} AS DOUBLE)) AS BIGINT) AS step FROM samples
        WHERE metric = {quoted(metric)} AND ts_us <= {GRID.end_us}{tests})) WHERE tick BETWEEN 0 AND {GRID.last}"""


EVAL = f"{GRID.start_us} + tick * {GRID.step_us}"
KEEP = ", ".join(f'any_value("{n}") AS "{n}"' for n in LABELS)


def last_sql(metric, where):
    return f"""SELECT {EVAL} AS eval_us, all_labels, {KEEP}, arg_max(value, ts_us) AS value
        FROM ({in_range_sql(metric, where, 300)}) GROUP BY tick, all_labels"""


def rate_sql(metric, where, seconds):
    return f"""SELECT {EVAL} AS eval_us, all_labels, {KEEP}, sum(inc) / CAST({seconds} AS DOUBLE) AS value FROM (
        SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS inc FROM (
          SELECT *, lag(value) OVER (PARTITION BY tick, all_labels ORDER BY ts_us) AS before
          FROM ({in_range_sql(metric, where, seconds)}))) GROUP BY tick, all_labels HAVING count(*) >= 2"""


def folded_sql(inner, fold, by):
    if not fold:
        return f"SELECT eval_us, all_labels AS series, value FROM ({inner})"
    series = "concat_ws(',', " + ", ".join(f"'{n}=' || \"{n}\"" for n in sorted(by)) + ")" if by else "''"
    return f"SELECT eval_us, series, {fold}(value) AS value FROM (SELECT eval_us, {series} AS series, value FROM ({inner})) GROUP BY ALL"


def quantile_sql(q, inner, group):
    """Quantile of cumulative buckets ``(group, le, value)``."""
    return f"""SELECT {group}, CASE WHEN total <= 0 THEN NULL WHEN isinf(le) THEN low
            WHEN value = below THEN low ELSE low + (le - low) * (({q}::DOUBLE * total - below) / (value - below)) END AS value FROM (
          SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY le) AS pick FROM (
            SELECT *, max(value) OVER (PARTITION BY {group}) AS total,
              coalesce(lag(le) OVER (PARTITION BY {group} ORDER BY le), 0) AS low,
              coalesce(lag(value) OVER (PARTITION BY {group} ORDER BY le), 0) AS below
            FROM ({inner})) WHERE value >= {q}::DOUBLE * total) WHERE pick = 1"""


def panel_sql(panel):
    match panel:
        case P.Last():
            found = last_sql(panel.metric, panel.where)
            found = f"SELECT * FROM ({found}) WHERE value > 0" if panel.only_positive else found
            result = folded_sql(found, panel.fold, panel.by)
            return f"SELECT eval_us, series, value * {panel.factor}::DOUBLE AS value FROM ({result})" if panel.factor else result
        case P.Rate():
            return folded_sql(rate_sql(panel.metric, panel.where, panel.seconds), panel.fold, panel.by)
        case P.Quantile():
            buckets = f"""SELECT eval_us, CASE WHEN le = '+Inf' THEN 'Infinity'::DOUBLE ELSE le::DOUBLE END AS le, sum(value) AS value
                FROM ({rate_sql(panel.metric, panel.where, panel.seconds)}) GROUP BY ALL"""
            return f"SELECT eval_us, '' AS series, value FROM ({quantile_sql(panel.q, buckets, 'eval_us')}) WHERE value > 0"
        case P.Ratio():
            under = "b.value" if panel.least is None else f"greatest(b.value, {panel.least}::DOUBLE)"
            return f"""SELECT eval_us, series, CASE WHEN {under} <> 0 THEN a.value / {under} END AS value
                FROM ({panel_sql(panel.top)}) a JOIN ({panel_sql(panel.bottom)}) b USING (eval_us, series)"""
        case P.Share():
            return f"""SELECT eval_us, series, CASE WHEN a.value + b.value <> 0 THEN a.value / (a.value + b.value) END AS value
                FROM ({panel_sql(panel.part)}) a JOIN ({panel_sql(panel.rest)}) b USING (eval_us, series)"""
        case P.Either():
            text = panel_sql(panel.branches[0])
            for branch in panel.branches[1:]:
                text = f"""SELECT eval_us, series, coalesce(a.value, b.value) AS value FROM ({text}) a
                    FULL JOIN ({panel_sql(branch)}) b USING (eval_us, series)"""
            return text
        case P.OrZero():
            zero = f"SELECT {GRID.start_us} + k * {GRID.step_us} AS eval_us, '' AS series, 0.0::DOUBLE AS value FROM range({GRID.last + 1}) AS r(k)"
            return f"""SELECT eval_us, series, coalesce(a.value, b.value) AS value FROM ({panel_sql(panel.inner)}) a
                FULL JOIN ({zero}) b USING (eval_us, series)"""
    raise TypeError(panel)


def panel_oracle(panel):
    body = f"SELECT eval_us, series, floor(value * 1e6::DOUBLE + 0.618034::DOUBLE) / 1e6::DOUBLE AS value FROM ({panel_sql(panel)})"
    return with_tables("counted", samples_sql(P.metrics_of(panel)) + body)


def rate_at_samples_sql(seconds):
    us = seconds * 1_000_000
    return with_tables("counted", f""", s AS (SELECT event_type, {D.METRICS_START_US} + (epoch_us(ts) - {D.METRICS_START_US}) // {D.COMPRESSION} AS ts_us,
          counter AS value FROM counted),
        pairs AS (SELECT e.event_type, e.ts_us AS tick, p.ts_us, p.value, lag(p.value) OVER (PARTITION BY e.event_type, e.ts_us ORDER BY p.ts_us) AS before
          FROM s e JOIN s p ON p.event_type = e.event_type AND p.ts_us <= e.ts_us AND p.ts_us > e.ts_us - {us})
        SELECT event_type, tick AS ts_us, round(sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END)
          / CAST({seconds} AS DOUBLE), 9) AS rate FROM pairs GROUP BY ALL HAVING count(*) >= 2""")


def disc(p, column):
    return f"quantile_disc({column}, {p})"


BUCKET_ROWS = " UNION ALL ".join(
    f"SELECT event_type, {b}::DOUBLE AS le, count(*) FILTER (WHERE value <= {b}) AS count FROM events GROUP BY event_type" for b in BOUNDS
)
ALL_BUCKETS = BUCKET_ROWS + " UNION ALL SELECT event_type, 'Infinity'::DOUBLE AS le, count(*) AS count FROM events GROUP BY event_type"


def quantile_oracle(q):
    inner = f"SELECT event_type, le, count::DOUBLE AS value FROM ({ALL_BUCKETS})"
    return f"SELECT event_type, floor(value * 1e6::DOUBLE + 0.618034::DOUBLE) / 1e6::DOUBLE AS value FROM ({quantile_sql(q, inner, 'event_type')})"


ORACLE = {f"panel_{name}": panel_oracle(panel) for name, panel in P.PANELS.items()}
ORACLE |= {
    "rate_5m": rate_at_samples_sql(300),
    "rate_1m_in_slices": rate_at_samples_sql(60),
    "timer_summary": f"""SELECT event_type, count(value) AS n, round(sum(value), 4) AS total, max(value) AS most,
        {disc(0.5, 'value')} AS p50, {disc(0.95, 'value')} AS p95, {disc(0.99, 'value')} AS p99 FROM events GROUP BY event_type""",
    "batch_size_summary": f"""SELECT day, count(size) AS n, CAST(sum(size) AS BIGINT) AS total, max(size) AS most,
        {disc(0.5, 'size')} AS p50, {disc(0.95, 'size')} AS p95, {disc(0.99, 'size')} AS p99
        FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, count(*) AS size FROM events GROUP BY ALL) GROUP BY day""",
    "histogram_buckets": f"SELECT event_type, CASE WHEN isinf(le) THEN -1 ELSE le END AS le, count FROM ({ALL_BUCKETS})",
    "threshold_bands": """SELECT CASE WHEN value >= 90 THEN 'red' WHEN value >= 70 THEN 'yellow' ELSE 'green' END AS band,
        CASE WHEN value < 100 THEN 'UP' ELSE 'DOWN' END AS up, count(*) AS samples FROM events GROUP BY ALL""",
    "slo_check": f"""SELECT stage, requests, failed_pct, p95_ms, failed_pct < 0.5 AND p95_ms < 200 AS met FROM (
        SELECT day(ts) // 8 AS stage, count(*) AS requests,
        round(count(*) FILTER (WHERE event_type = 'error' AND event_id % 50 = 0) * 100.0::DOUBLE / count(*), 6) AS failed_pct,
        {disc(0.95, 'value')} AS p95_ms FROM events GROUP BY ALL)""",
    "histogram_quantile_p50": quantile_oracle(0.5),
    "histogram_quantile_p95": quantile_oracle(0.95),
    "histogram_quantile_p99": quantile_oracle(0.99),
}

ROLLED = """count(*) AS n, round(sum({v}), 4) AS total, max({v}) AS most,
  quantile_disc({v}, 0.5) AS p50, quantile_disc({v}, 0.95) AS p95, quantile_disc({v}, 0.99) AS p99"""
ORACLE |= {
    "latency_rollup": f"SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, {ROLLED.format(v='value')} FROM events GROUP BY ALL",
    "latency_rollup_week": f"""WITH range AS (SELECT max(epoch_us(ts)) // {R.MINUTE} * {R.MINUTE} AS stop FROM events)
        SELECT event_type, {ROLLED.format(v='value')} FROM events, range
        WHERE epoch_us(ts) >= stop - {WEEK_US} AND epoch_us(ts) < stop GROUP BY ALL""",
    "span_rollup": with_tables("spans", f"SELECT service, name, start_us // 3600000000 AS hour, {ROLLED.format(v='duration_ms').replace(', 4)', ', 7)')} FROM spans GROUP BY ALL"),
}
