"""Counter rates over sliding windows of a sample stream, from prefix sums kept per series."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from gatewright.functions.chunks import micros
from gatewright.operators.metrics import SECOND, extrapolated

FOUND = [("__end", T.LongType()), ("__raw", T.DoubleType()), ("__n", T.LongType()), ("__first", T.LongType()), ("__last", T.LongType()), ("__value", T.DoubleType())]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Increase of a counter from its first sample to each one; a smaller value than before is a restart from 0."""
    steps = np.diff(values)
    return np.concatenate([[0.0], np.cumsum(np.where(steps < 0, values[1:], steps))])[: len(values)]


class _Windows(StatefulProcessor):
    """Holds a series' samples until the watermark has passed them, then keeps those that windows still to come reach back to.

    ``kept`` is the last window end that was evaluated, and the times and values of the samples in order, packed. A
    sample is one entry whatever the window's length and step: a window's increase is the difference of two prefix sums.
    """

    def __init__(self, out: T.StructType, window: int, step: int):
        self.fields, self.width, self.window, self.step = out.names, len(out) - len(FOUND), window, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.row = handle, Row(*self.fields)
        self.held = handle.getListState("held", "t BIGINT, v DOUBLE")
        self.kept = handle.getValueState("kept", "upto BIGINT, times BINARY, samples BINARY")

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))

    def _grid(self, at: int) -> int:
        """The first window end at or after a time."""
        return -(-at // self.step) * self.step

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        # A window holds its end: a sample at ``t`` is late once the watermark has reached ``t - 1``.
        fresh = [(r[self.width], r[self.width + 1]) for r in rows]
        fresh = [x for x in fresh if x[0] > closed + 1 or not closed]
        if fresh:
            self.held.appendList(fresh)
            self._wake(self._grid(min(t for t, _ in fresh)))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, waiting = [], []
        for r in self.held.get():
            (ready if r[0] <= closed + 1 else waiting).append(tuple(r))
        last = closed // self.step * self.step  # the last window end that has passed
        upto, times, values = None, np.zeros(0, np.int64), np.zeros(0)
        if kept := self.kept.get():
            upto, times, values = kept[0], np.frombuffer(kept[1], np.int64), np.frombuffer(kept[2], np.float64)
        if not ready and (upto is None or upto >= last):
            return  # an earlier timer of this key did it
        ready.sort(key=lambda r: r[0])
        times = np.concatenate([times, np.array([t for t, _ in ready], np.int64)])
        values = np.concatenate([values, np.array([v for _, v in ready], np.float64)])
        if len(times):
            sums = prefix_sums(values)
            start = self._grid(int(times[0])) if upto is None else max(upto + self.step, self._grid(int(times[0])))
            ends = np.arange(start, min(last, int(times[-1]) + self.window) + 1, self.step)
            low, high = np.searchsorted(times, ends - self.window, "right"), np.searchsorted(times, ends, "right")
            for k in np.flatnonzero(high - low >= 2).tolist():
                a, b = low[k], high[k] - 1
                yield self.row(*key, int(ends[k]), float(sums[b] - sums[a]), int(b - a + 1), int(times[a]), int(times[b]), float(values[a]))
        live = times > last + self.step - self.window
        times, values = times[live], values[live]
        if waiting:
            self.held.put(waiting)
        else:
            self.held.clear()
        if len(times):
            self.kept.update((last, times.tobytes(), values.tobytes()))
            self._wake(max(last + self.step, self._grid(int(times[0]))))
        else:
            self.kept.clear()
        if waiting:
            self._wake(self._grid(min(t for t, _ in waiting)))

    def close(self) -> None:
        pass


def stream_rate_windows(
    samples: DataFrame,
    keys: Sequence[str],
    window_seconds: int = 300,
    step_seconds: int = 15,
    delay_seconds: int = 60,
    extrapolate: bool = True,
) -> DataFrame:
    """Increase and rate per series over ``(end - window, end]``, for every closed window of two samples or more.

    Windows end every ``step_seconds`` and appear, equal to those of
    ``counter_increase``, once the watermark has passed their end, also while a
    series is silent. What arrives behind the watermark is dropped, and so are
    samples without time or value. A series' samples of one micro-batch are one
    task's work. The state (Spark's RocksDB provider) has one entry per sample
    of the last window.
    """
    keys = list(keys)
    fields = {f.name: f for f in samples.schema.fields}
    rows = (
        # Windows include their end: the watermark has passed an end when it has passed the instant before it.
        samples.select(*keys, micros("ts").alias("__t"), F.col("value").cast("double").alias("__v"), (F.col("ts").cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")).alias("__at"))
        .filter("__t IS NOT NULL AND __v IS NOT NULL")
        .withWatermark("__at", f"{delay_seconds} seconds")
    )
    out = T.StructType([fields[k] for k in keys] + [T.StructField(name, kind) for name, kind in FOUND])
    windows = rows.groupBy(*keys).transformWithState(_Windows(out, window_seconds * SECOND, step_seconds * SECOND), out, "Append", "EventTime")
    value, end = F.col("__raw"), F.col("__end")
    if extrapolate:
        value = extrapolated(value, F.col("__n"), F.col("__first"), F.col("__last"), F.col("__value"), end - window_seconds * SECOND, end)
    return windows.select(*keys, F.timestamp_micros(end).alias("ts"), value.alias("increase"), (value / window_seconds).alias("rate"))
