"""Sustained alerts on a stream of evaluations, with one run per series kept in Spark's state store."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from gatewright.functions.chunks import micros
from gatewright.operators.metrics import SECOND
from gatewright.streaming.sinks import AVAILABLE_NOW, append, keyed_state

# Nested values are kept as JSON text in the state; times in them keep their microseconds.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
AT, ON, SINCE = "__at", "__on", "__since"


class _Runs(StatefulProcessor):
    """Holds the evaluations of a series until the watermark has passed them, then judges them in their own order.

    ``held`` lists the evaluations that wait, in order of arrival; ``run`` is the last judged one. A timer stands at the
    first evaluation of every arrival, and after it fired at the first one that still waits. Fields are the key,
    the other columns, the evaluation's time (microseconds) and truth, and, on arrival, the time that carries the watermark.
    """

    def __init__(self, held: T.StructType, out: T.StructType, for_micros: int, gap_micros: int | None):
        self.held_type, self.fields, self.width = held, out.names, len(out) - len(held)
        self.for_micros, self.gap_micros = for_micros, gap_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.row = handle, Row(*self.fields)
        self.held = handle.getListState("held", self.held_type)
        self.run = handle.getValueState("run", "at BIGINT, is_on BOOLEAN, since BIGINT")

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))  # timers count milliseconds

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        # Spark's own filter for late rows lags a batch behind; there is no watermark yet while it is 0.
        fresh = [r for r in (tuple(r)[self.width : -1] for r in rows) if r[-2] > closed or not closed]
        if fresh:
            self.held.appendList(fresh)
            self._wake(min(r[-2] for r in fresh))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, waiting = [], []
        for r in self.held.get():
            (ready if r[-2] <= closed else waiting).append(tuple(r))
        if not ready:
            return  # an earlier timer of this key took them
        if waiting:
            self.held.put(waiting)
            self._wake(min(r[-2] for r in waiting))
        else:
            self.held.clear()
        was_at, was_on, since = self.run.get() or (None, False, None)
        for r in sorted(ready, key=lambda r: r[-2]):
            at, is_on = r[-2:]
            silent = was_at is not None and self.gap_micros is not None and at - was_at > self.gap_micros
            if is_on and (not was_on or silent):
                since = at
            if is_on and at - since >= self.for_micros:
                yield self.row(*key, *r[:-2], at, since)
            was_at, was_on = at, is_on
        self.run.update((was_at, was_on, since if was_on else None))

    def close(self) -> None:
        pass


def firing_evaluations(
    stream: DataFrame, keys: Sequence[str], condition: Column, for_seconds: int, max_gap_seconds: int | None = None, delay_seconds: int = 60
) -> DataFrame:
    """The evaluations (``ts``) of an unbounded input that fire, with ``active_since``; columns are kept.

    Evaluations may arrive up to ``delay_seconds`` behind the newest one. Each is
    judged when the watermark has passed it, so files out of order give the
    alerts of the batch operator, ``delay_seconds`` later; what arrives behind
    the watermark is dropped, and so are evaluations without a time. Evaluations
    of one series at the same instant are taken in order of arrival. A series'
    evaluations of one micro-batch are one task's work: a rule gives one per
    series and evaluation interval. Nested columns wait as JSON text, so their
    maps need text keys. The state needs Spark's RocksDB provider.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("series need at least one key column")
    rest = [c for c in stream.columns if c not in (*keys, "ts")]
    fields = {f.name: f for f in stream.schema.fields}
    nested = [c for c in rest if isinstance(fields[c].dataType, (T.ArrayType, T.MapType, T.StructType))]
    kept = [T.StructField(c, T.StringType()) if c in nested else fields[c] for c in (*keys, *rest)]
    judged = [T.StructField(AT, T.LongType()), T.StructField(ON, T.BooleanType())]
    held = T.StructType(kept[len(keys) :] + judged)
    out = T.StructType(kept + [T.StructField(AT, T.LongType()), T.StructField(SINCE, T.LongType())])
    rows = (
        stream.filter("ts IS NOT NULL")
        .withWatermark("ts", f"{delay_seconds} seconds")
        .select(*keys, *[F.to_json(c, JSON).alias(c) if c in nested else c for c in rest], micros("ts").alias(AT), F.coalesce(condition, F.lit(False)).alias(ON), "ts")
    )
    gap = None if max_gap_seconds is None else max_gap_seconds * SECOND
    fired = rows.groupBy(*keys).transformWithState(_Runs(held, out, for_seconds * SECOND, gap), out, "Append", "EventTime")
    kind = fields["ts"].dataType
    times = {"ts": F.timestamp_micros(AT).cast(kind), "active_since": F.timestamp_micros(SINCE).cast(kind)}
    values = {c: F.from_json(c, fields[c].dataType, JSON) for c in nested}
    return fired.withColumns(times | values).select(*stream.columns, "active_since")


def stream_alerts(
    stream: DataFrame,
    keys: Sequence[str],
    condition: Column,
    for_seconds: int,
    root: str,
    checkpoint: str,
    max_gap_seconds: int | None = None,
    delay_seconds: int = 60,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """:func:`firing_evaluations` appended to ``<root>/alerts``, exactly once per checkpoint."""
    fired = firing_evaluations(stream, keys, condition, for_seconds, max_gap_seconds, delay_seconds)
    with keyed_state(stream.sparkSession):
        return append(fired, f"{root}/alerts", checkpoint, trigger)
