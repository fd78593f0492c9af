"""Keyed batches and panes on event time: several bounds and timers in one operator, on ``transformWithStateInPandas``.

Everything goes by event time, so what comes out does not depend on how the input falls into micro-batches: rows of a
micro-batch are taken in the order of their time, and a row that lies behind a due timer finds it as if it had fired.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle

from sluiceway.streaming.stateful import LONG_STATE, _grouped, _listed, _pages, _Processor, _run, _schema, _whole

ON_TIME, LATE, EXPIRED = "ON_TIME", "LATE", "EXPIRED"
_PAIR = T.StructType([T.StructField("count", T.LongType()), T.StructField("opened", T.LongType())])


def _micros(at: Any) -> int:
    return pd.Timestamp(at).value // 1000


class BoundedBatches(_Processor):
    """A batch is open from its first row to the earliest of its size, its wait and its window's end."""

    def __init__(self, schema, value: str, dtype: T.DataType, size: int, wait: int, windowed: bool) -> None:
        super().__init__(schema)
        self.value, self.dtype, self.size, self.wait, self.windowed = value, dtype, size, wait, windowed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getListState("values", T.StructType([T.StructField("value", self.dtype)]))
        self.open = handle.getValueState("open", _PAIR)
        self.armed = handle.getValueState("armed", LONG_STATE)

    def _due(self, key: tuple, opened: int) -> tuple[int, str]:
        due, end = opened + self.wait, _micros(key[-2]) if self.windowed else None
        return (due, "wait") if end is None or due < end else (end, "window")

    def _batch(self, key: tuple, values: list, at: int, by: str) -> pd.DataFrame:
        return self.frame(key, [(by, pd.Timestamp(at, unit="us"), values)])

    def handleInputRows(self, key, rows, timerValues):
        arrived = _whole(rows, "at_micros")
        times, values = arrived["at_micros"].to_numpy(np.int64), _listed(arrived, self.value, self.dtype)
        count, opened = self.open.get() if self.open.exists() else (0, 0)
        held: list | None = None if count else []  # of the open batch; none as long as it need not be read
        fresh: list = []
        i = 0
        while i < len(times):
            if not count:
                opened = int(times[i])
            due, by = self._due(key, opened)
            stop = min(i + self.size - count, int(np.searchsorted(times, due, "left")))
            fresh += values[i:stop]
            count += stop - i
            full = count == self.size
            if not full and stop == len(times):
                break
            if held is None:
                held = [v[0] for v in self.values.get()]
                self.values.clear()
            yield self._batch(key, held + fresh, int(times[stop - 1]) if full else due, "size" if full else by)
            held, fresh, count, i = [], [], 0, stop
        if fresh:
            self.values.appendList([(v,) for v in fresh])
        self._arm(key, count, opened)

    def _arm(self, key: tuple, count: int, opened: int) -> None:
        due = -(-self._due(key, opened)[0] // 1000) if count else None  # timers are in milliseconds
        armed = self.armed.get()[0] if self.armed.exists() else None
        if armed is not None and armed != due:
            self.handle.deleteTimer(armed)
            self.armed.clear()
        if count:
            self.open.update((count, opened))
            if armed != due:
                self.handle.registerTimer(due)
                self.armed.update((due,))
        else:
            self.open.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.open.exists():
            due, by = self._due(key, self.open.get()[1])
            yield self._batch(key, [v[0] for v in self.values.get()], due, by)
        self.values.clear()
        self.open.clear()
        self.armed.clear()


def _interval_micros(interval: str) -> int:
    return pd.Timedelta(interval).value // 1000


def stream_bounded_batches(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, size: int, wait: str, window: str | None = None, shards: int = 1
) -> DataFrame:
    """Batches per key that fire at ``size`` values, ``wait`` after the first value's event time, or at the window's end:
    ``(keys, window_start, window_end, shard, ended_by, fired_at, values)``, without ``window`` no window columns.

    ``df`` carries a watermark on ``ts``; timers fire when it has passed them. Rows are taken in the order of ``ts`` within
    a micro-batch. In windows a row is late when its window has closed, else when it is behind the watermark. A timer
    that finds nothing waiting gives nothing. ``operators.triggers.bounded_batches`` is the same over tables.
    """
    timed = df.where(F.col(ts).isNotNull()).withColumn("at_micros", F.unix_micros(ts))
    grouping = list(keys)
    if window:
        timed = timed.withColumn("window", F.window(ts, window))
        timed = timed.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop(ts)
        grouping += ["window_start", "window_end"]
    sharded, grouping = _grouped(timed, grouping, shards)
    dtype = df.schema[value].dataType
    fields = ("ended_by", T.StringType()), ("fired_at", T.TimestampType()), ("values", T.ArrayType(dtype))
    processor = BoundedBatches(_schema(sharded, grouping, *fields), value, dtype, size, _interval_micros(wait), bool(window))
    return _run(sharded, grouping, processor, "EventTime")


class LatePanes(_Processor):
    """An on-time pane when the watermark passes the window's end, a late one for what comes until the lateness is over,
    and then the end of the window's state."""

    def __init__(self, schema, value: str, dtype: T.DataType, lateness_ms: int, page_rows: int) -> None:
        super().__init__(schema)
        self.value, self.dtype, self.lateness_ms, self.page_rows = value, dtype, lateness_ms, page_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("value", self.dtype)]))
        self.panes = handle.getValueState("panes", LONG_STATE)
        self.seen = handle.getValueState("seen", LONG_STATE)

    def _end(self, key: tuple) -> int:
        return _micros(key[-2]) // 1000

    def _number(self, state) -> int:
        return state.get()[0] if state.exists() else 0

    def _on_time(self, key: tuple) -> Iterator[pd.DataFrame]:
        yield from self._pane(key, ON_TIME, (v[0] for v in self.waiting.get()))
        self.waiting.clear()

    def _pane(self, key: tuple, timing: str, values) -> Iterator[pd.DataFrame]:
        pane, seen, some = self._number(self.panes), self._number(self.seen), False
        for page, part in enumerate(_pages(values, self.page_rows)):
            seen, some = seen + len(part), True
            yield self.frame(key, [(pane, timing, page, part, seen)])
        if some:
            self.panes.update((pane + 1,))
            self.seen.update((seen,))

    def handleInputRows(self, key, rows, timerValues):
        mark, end = timerValues.getCurrentWatermarkInMs(), self._end(key)
        batches = [_listed(batch, self.value, self.dtype) for batch in rows]
        if mark >= end + self.lateness_ms:
            return  # too late even for a late pane
        if mark < end:
            for values in batches:
                self.waiting.appendList([(v,) for v in values])
            self.handle.registerTimer(end)
        else:  # the window has ended: its on-time pane comes first, if its timer has not fired yet
            yield from self._on_time(key)
            yield from self._pane(key, LATE, (v for values in batches for v in values))
            self.handle.registerTimer(end + self.lateness_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        over = self._end(key) + self.lateness_ms
        yield from self._on_time(key)
        if timerValues.getCurrentWatermarkInMs() < over:
            self.handle.registerTimer(over)
        elif self.seen.exists():  # else both timers were due at once
            yield self.frame(key, [(self._number(self.panes), EXPIRED, 0, [], self._number(self.seen))])
            self.panes.clear()
            self.seen.clear()


def stream_panes(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, lateness: str, value: str, page_rows: int = 100_000, shards: int = 1
) -> DataFrame:
    """Discarding panes per key and window: ``(keys, window_start, window_end, shard, pane, timing, page, values, seen)``.

    The watermark follows the newest row without delay, so a window's ``ON_TIME`` pane comes at once when it has ended;
    what comes in a micro-batch up to ``lateness`` later is a ``LATE`` pane of its own, and what comes after that is dropped.
    Panes are numbered from 0 per window, ``seen`` counts its values up to that page. When the lateness is over one
    ``EXPIRED`` row says how many panes and values there were, and the state is gone. A row is judged by the watermark
    that the micro-batches before its own have left.
    """
    marked = df.withWatermark(ts, "0 seconds").withColumn("window", F.window(ts, size))
    # Plain numbers carry no watermark, so that rows of windows that have ended still reach the operator.
    bounds = {f"window_{side}": F.timestamp_micros(F.unix_micros(F.col(f"window.{side}"))) for side in ("start", "end")}
    windowed = marked.withColumns(bounds).drop(ts, "window")
    sharded, grouping = _grouped(windowed, [*keys, "window_start", "window_end"], shards)
    dtype = df.schema[value].dataType
    fields = (
        ("pane", T.LongType()), ("timing", T.StringType()), ("page", T.IntegerType()), ("values", T.ArrayType(dtype)), ("seen", T.LongType()),
    )
    processor = LatePanes(_schema(sharded, grouping, *fields), value, dtype, _interval_micros(lateness) // 1000, page_rows)
    return _run(sharded, grouping, processor, "EventTime")
