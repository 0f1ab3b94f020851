"""Rates of counters over a stream of samples that come late and out of order.

Two keyed states follow one another, both driven by event-time timers:

* Samples wait in the state of their (series, slice) until the watermark has passed the slice. Then they are put in order,
  restarts are corrected, the slice becomes one row (first, last, growth, count), and its samples leave the state. A series
  with a great many samples is spread over tasks by its slices; a shorter slice bounds what one task sorts.
* The slices of a series wait until the watermark has passed a grid point, where the slices of the range that ends there
  are put together. Slices that no later range reaches leave the state, and with the last one the series does.

So the state holds the samples of the delay and the slices of one range, however long the stream runs. Samples behind the
watermark are not counted; Spark reports how many there were (``late_rows``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MICRO = 1_000_000
SLICES = "series string, slice_end timestamp, first double, last double, grown double, n long"
RATES = "series string, eval_us long, rate double, n long"


def growth(values: np.ndarray) -> float:
    """Sum of the increases along samples in order; a lower value means that the counter started again at zero."""
    steps = np.diff(values)
    return float(np.where(steps < 0, values[1:], steps).sum())


class SliceSummaries(StatefulProcessor):
    """One row for each (series, slice), when the watermark has passed the slice. Equal times are ordered by value."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", "ts_us long, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end_ms = int(key[1]) // 1000
        if end_ms > timerValues.getCurrentWatermarkInMs():
            for part in rows:
                self.samples.appendList(list(zip(part["ts_us"].tolist(), part["value"].tolist())))
            self.handle.registerTimer(end_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = sorted((int(ts), float(value)) for ts, value in self.samples.get())
        self.samples.clear()
        if held:
            values = np.array([value for _, value in held])
            end = pd.Timestamp(int(key[1]), unit="us")
            yield pd.DataFrame({"series": [key[0]], "slice_end": [end], "first": [values[0]], "last": [values[-1]], "grown": [growth(values)], "n": [len(values)]})

    def close(self) -> None:
        pass


class RangeRates(StatefulProcessor):
    """Rates of a series at every grid point whose range holds two samples or more."""

    def __init__(self, range_us: int, step_us: int) -> None:
        self.range_us, self.step_us = range_us, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slices = handle.getMapState("slices", "slice_end long", "first double, last double, grown double, n long")
        self.due = handle.getValueState("due", "step long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due = int(self.due.get()[0]) if self.due.exists() else None
        for part in rows:
            for end, first, last, grown, n in zip(part["end_us"], part["first"], part["last"], part["grown"], part["n"]):
                self.slices.updateValue((int(end),), (float(first), float(last), float(grown), int(n)))
                step = -(-int(end) // self.step_us)
                due = step if due is None else min(due, step)
        if due is not None:
            self._wait(due)
        return iter(())

    def _wait(self, step: int) -> None:
        self.due.update((step,))
        self.handle.registerTimer(step * self.step_us // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.due.exists():
            return
        due, passed = int(self.due.get()[0]), timerValues.getCurrentWatermarkInMs() * 1000 // self.step_us
        held = sorted((int(end[0]), *row) for end, row in self.slices.iterator())
        found = self._evaluate(held, due, passed)
        reach = (passed + 1) * self.step_us - self.range_us
        for end, *_ in held:
            if end <= reach:
                self.slices.removeKey((end,))
        if held and held[-1][0] > reach:
            self._wait(max(passed + 1, due))
        else:
            self.due.clear()
        if found:
            yield pd.DataFrame({"series": key[0], "eval_us": [f[0] for f in found], "rate": [f[1] for f in found], "n": [f[2] for f in found]})

    def _evaluate(self, held: list[tuple], due: int, passed: int) -> list[tuple[int, float, int]]:
        if not held:
            return []
        ends = np.array([h[0] for h in held])
        first, last, grown, n = (np.array([h[k] for h in held]) for k in (1, 2, 3, 4))
        gaps = np.zeros(len(held))
        gaps[1:] = np.where(first[1:] < last[:-1], first[1:], first[1:] - last[:-1])
        total, counted = np.append(0.0, np.cumsum(grown + gaps)), np.append(0, np.cumsum(n))
        # No range beyond the last slice's reach holds a sample.
        points = np.arange(due, min(passed, (int(ends[-1]) + self.range_us) // self.step_us) + 1) * self.step_us
        low, high = np.searchsorted(ends, points - self.range_us, "right"), np.searchsorted(ends, points, "right")
        out = []
        for at, x, y in zip(points.tolist(), low.tolist(), high.tolist()):
            if counted[y] - counted[x] >= 2:
                out.append((at, float(total[y] - total[x] - gaps[x]) * MICRO / self.range_us, int(counted[y] - counted[x])))
        return out

    def close(self) -> None:
        pass


def counter_rates(samples: DataFrame, range_s: int, step_s: int, delay: str, slice_s: float | None = None) -> DataFrame:
    """Per-second increase of each series at every multiple of ``step_s``, over the range that ends there.

    ``samples``: a stream with ``series``, ``ts``, ``value``. Rows without a time or a value are no samples; a null series
    is a series. Only pairs of samples inside the range count. A grid point is written once, when the watermark (newest
    sample less ``delay``) has passed it. ``slice_s`` must divide both the step and the range. Start the stream inside
    ``run.state_on_disk`` where the session's state store is not RocksDB.
    """
    range_us, step_us = range_s * MICRO, step_s * MICRO
    slice_us = round((slice_s or step_s) * MICRO)
    if step_us % slice_us or range_us % slice_us or slice_us % 1000:
        raise ValueError("slices must divide the step and the range, in whole milliseconds")
    ts_us = F.unix_micros("ts")
    slice_end = F.ceil(ts_us / F.lit(slice_us)).cast("long") * F.lit(slice_us)
    known = samples.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).withWatermark("ts", delay)
    placed = known.select("series", slice_end.alias("end_us"), "ts", ts_us.alias("ts_us"), F.col("value").cast("double").alias("value"))
    slices = placed.groupBy("series", "end_us").transformWithStateInPandas(SliceSummaries(), SLICES, "append", "EventTime", eventTimeColumnName="slice_end")
    dated = slices.withColumn("end_us", F.unix_micros("slice_end"))
    return dated.groupBy("series").transformWithStateInPandas(RangeRates(range_us, step_us), RATES, "append", "EventTime")


def late_rows(query) -> int:
    """Samples of a stream that came behind the watermark, as far as the progress reports of the query reach."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
