"""Keyed state and timers on streams, on ``transformWithStateInPandas``.

Lists live in RocksDB and are read back in pages, so a long list is neither one state value nor one output
row. Each function takes ``shards``: above one, the rows of a key are spread over that many independent
states (the output has the column ``shard``), which is how a hot key is kept off a single task. Batches and
collections are then per key and shard; a running index or a map machine needs the whole key and has no shards.

Spark allows one time domain per operator. Event-time timers fire once the watermark has passed them,
processing-time timers in the first micro-batch after they are due.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import islice
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sluiceway.operators.skew import spread

LONG_STATE = T.StructType([T.StructField("value", T.LongType())])


class _Processor(StatefulProcessor):
    """Output rows start with the grouping key's columns."""

    def __init__(self, schema: T.StructType) -> None:
        self.schema = schema

    def frame(self, key: tuple, rows: Iterable[Sequence[Any]]) -> pd.DataFrame:
        return pd.DataFrame([(*key, *row) for row in rows], columns=self.schema.names)

    def close(self) -> None:
        pass


def _pages(values: Iterable[Any], size: int) -> Iterator[list[Any]]:
    values = iter(values)
    while page := list(islice(values, size)):
        yield page


def _grouped(df: DataFrame, keys: Sequence[str], shards: int) -> tuple[DataFrame, list[str]]:
    sharded = df.withColumn("shard", spread(df, shards))
    return sharded, [*keys, "shard"]


def _schema(df: DataFrame, keys: Sequence[str], *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys] + [T.StructField(n, t) for n, t in fields])


def _not_null(key: str, dtype: T.DataType) -> Column:
    fill = {"string": F.lit(""), "boolean": F.lit(False), "date": F.lit("1970-01-01"), "timestamp_ntz": F.lit("1970-01-01 00:00:00")}
    return F.coalesce(F.col(key), fill.get(dtype.typeName(), F.lit(0)).cast(dtype))


def _listed(batch: pd.DataFrame, column: str, dtype: T.DataType) -> list:
    """A column's values, whole numbers beside nulls as whole numbers again."""
    values = batch[column].tolist()
    if isinstance(dtype, T.IntegralType) and batch[column].dtype.kind == "f":
        return [None if v != v else int(v) for v in values]
    return values


def _run(df: DataFrame, keys: Sequence[str], processor: _Processor, time_mode: str) -> DataFrame:
    """Which keys are null is a key of its own, and the keys themselves are never null to Python: pandas would turn a
    column of whole numbers with a null into floats, which the state client then takes for nulls."""
    bits = F.lit(0)
    for i, key in enumerate(keys):
        bits = bits + F.col(key).isNull().cast("int") * (1 << i)
    schema = processor.schema
    processor.schema = T.StructType([T.StructField("null_keys", T.IntegerType()), *schema.fields])
    marked = df.withColumn("null_keys", bits).withColumns({k: _not_null(k, df.schema[k].dataType) for k in keys if df.schema[k].nullable})
    found = marked.groupBy("null_keys", *keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.schema, outputMode="Append", timeMode=time_mode
    )
    real = [F.when(F.col("null_keys").bitwiseAND(1 << i) == 0, F.col(key)).alias(key) for i, key in enumerate(keys)]
    return found.select(*real, *schema.names[len(keys) :])


def _windowed(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Rows with their window, which takes the place of ``ts`` as event time: a row is late when its window has
    closed, not when its own time is behind the watermark."""
    placed = df.withColumn("window", F.window(ts, size))
    return placed.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop(ts)


def _whole(rows: Iterator[pd.DataFrame], order: str) -> pd.DataFrame:
    """A key's rows of the micro-batch in order, which Arrow batches alone are not; the trigger's limit bounds them."""
    return pd.concat(list(rows), ignore_index=True).sort_values(order, kind="stable")


class CollectUntilWindowEnd(_Processor):
    """Keep values in a list; one event-time timer per window releases them in pages."""

    def __init__(self, schema, value: str, dtype: T.DataType, page_rows: int) -> None:
        super().__init__(schema)
        self.value, self.dtype, self.page_rows = value, dtype, page_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getListState("values", T.StructType([T.StructField("value", self.dtype)]))
        self.armed = handle.getValueState("armed", LONG_STATE)

    def handleInputRows(self, key, rows, timerValues):
        for batch in rows:
            self.values.appendList([(v,) for v in _listed(batch, self.value, self.dtype)])
            if not self.armed.exists():
                # The window's last instant: its end is the second last key column.
                at = int(pd.Timestamp(key[-2]).timestamp() * 1000) - 1
                self.handle.registerTimer(at)
                self.armed.update((at,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for number, page in enumerate(_pages((v[0] for v in self.values.get()), self.page_rows)):
            yield self.frame(key, [(number, page)])
        self.values.clear()
        self.armed.clear()


def stream_collect(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    value: str,
    page_rows: int = 100_000,
    shards: int = 1,
) -> DataFrame:
    """Values per key and window, released when the watermark passes the window's last instant.

    ``df`` carries a watermark on ``ts``; its delay is the lateness allowed. Output: ``(keys, window_start, window_end, shard, page, values)``.
    """
    windowed = _windowed(df, ts, size)
    sharded, grouping = _grouped(windowed, [*keys, "window_start", "window_end"], shards)
    dtype = df.schema[value].dataType
    schema = _schema(sharded, grouping, ("page", T.IntegerType()), ("values", T.ArrayType(dtype)))
    processor = CollectUntilWindowEnd(schema, value, dtype, page_rows)
    return _run(sharded, grouping, processor, "EventTime")


class BatchUp(_Processor):
    """Flush full batches at once; a timer from the first waiting element flushes a short one."""

    def __init__(self, schema, value: str, dtype: T.DataType, size: int, wait_ms: int, event_time: bool) -> None:
        super().__init__(schema)
        self.value, self.dtype, self.size, self.wait_ms, self.event_time = value, dtype, size, wait_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getListState("values", T.StructType([T.StructField("value", self.dtype)]))
        self.count = handle.getValueState("count", LONG_STATE)
        self.armed = handle.getValueState("armed", LONG_STATE)

    def _disarm(self) -> None:
        if self.armed.exists():
            self.handle.deleteTimer(self.armed.get()[0])
            self.armed.clear()

    def _due(self, key: tuple, now: int) -> int | None:
        if self.event_time:
            return int(pd.Timestamp(key[-2]).timestamp() * 1000) - 1
        return now + self.wait_ms if self.wait_ms > 0 else None

    def handleInputRows(self, key, rows, timerValues):
        waiting = self.count.get()[0] if self.count.exists() else 0
        before = waiting
        for batch in rows:
            values = _listed(batch, self.value, self.dtype)
            while waiting + len(values) >= self.size:
                take = self.size - waiting
                held = [v[0] for v in self.values.get()] if waiting else []
                yield self.frame(key, [(held + values[:take],)])
                values = values[take:]
                if waiting:
                    self.values.clear()
                self._disarm()
                waiting = before = 0
            if values:
                self.values.appendList([(v,) for v in values])
                waiting += len(values)
        if waiting:
            self.count.update((waiting,))
            due = self._due(key, timerValues.getCurrentProcessingTimeInMs())
            if before == 0 and due is not None and not self.armed.exists():
                self.handle.registerTimer(due)
                self.armed.update((due,))
        else:
            self.count.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = [v[0] for v in self.values.get()]
        self.values.clear()
        self.count.clear()
        self.armed.clear()
        if held:
            yield self.frame(key, [(held,)])


def stream_batches(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    size: int,
    max_wait_ms: int = 0,
    ts: str | None = None,
    window: str | None = None,
    shards: int = 1,
) -> DataFrame:
    """Batches of ``size`` values per key; short ones come out after a wait or at the window's end.

    With ``max_wait_ms`` the wait counts in processing time from a batch's first element, 0 means no limit.
    With ``window`` (on the watermarked ``ts``) batches do not cross windows and the last one comes out when
    the watermark passes the window's last instant. An empty flush emits nothing.
    """
    if window and max_wait_ms:
        raise ValueError("Spark has one time domain per operator: give window or max_wait_ms")
    grouping = list(keys)
    if window:
        df = _windowed(df, ts, window)
        grouping += ["window_start", "window_end"]
    sharded, grouping = _grouped(df, grouping, shards)
    dtype = df.schema[value].dataType
    schema = _schema(sharded, grouping, ("values", T.ArrayType(dtype)))
    processor = BatchUp(schema, value, dtype, size, max_wait_ms, bool(window))
    return _run(sharded, grouping, processor, "EventTime" if window else "ProcessingTime")


def trigger_any(df: DataFrame, keys: Sequence[str], value: str, count: int, wait_ms: int, shards: int = 1) -> DataFrame:
    """Fire, discarding, at ``count`` elements or ``wait_ms`` after a pane's first one, again and again."""
    return stream_batches(df, keys, value, count, wait_ms, shards=shards)


class IdleTimer(_Processor):
    """One processing-time timer, set anew by every element; when it fires it reports the backlog, which stays."""

    def __init__(self, schema, after_ms: int) -> None:
        super().__init__(schema)
        self.after_ms = after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", LONG_STATE)
        self.armed = handle.getValueState("armed", LONG_STATE)

    def handleInputRows(self, key, rows, timerValues):
        added = sum(len(batch) for batch in rows)
        held = self.count.get()[0] if self.count.exists() else 0
        self.count.update((held + added,))
        if self.armed.exists():
            self.handle.deleteTimer(self.armed.get()[0])
        due = timerValues.getCurrentProcessingTimeInMs() + self.after_ms
        self.handle.registerTimer(due)
        self.armed.update((due,))
        yield self.frame(key, [("element", n, n + 1) for n in range(held, held + added)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.count.get()[0] if self.count.exists() else 0
        self.armed.clear()
        yield self.frame(key, [("timer", held, held)])


def idle_timer(df: DataFrame, keys: Sequence[str], after_ms: int, shards: int = 1) -> DataFrame:
    """A row per element, and one when the key has been idle: ``(keys, shard, kind, before, backlog)``."""
    sharded, grouping = _grouped(df, keys, shards)
    schema = _schema(
        sharded, grouping, ("kind", T.StringType()), ("before", T.LongType()), ("backlog", T.LongType())
    )
    return _run(sharded, grouping, IdleTimer(schema, after_ms), "ProcessingTime")


class TimerFamily(_Processor):
    """An independent processing-time timer per element id, beside a multimap of what was put."""

    def __init__(self, schema, id_column: str, id_type: T.DataType, after_ms: int) -> None:
        super().__init__(schema)
        self.id_column, self.id_type, self.after_ms = id_column, id_type, after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        id_state = T.StructType([T.StructField("id", self.id_type)])
        due_state = T.StructType([T.StructField("ids", T.ArrayType(self.id_type))])
        self.due_of = handle.getMapState("due_of", id_state, LONG_STATE)
        self.ids_at = handle.getMapState("ids_at", LONG_STATE, due_state)
        self.entries = handle.getValueState("entries", LONG_STATE)

    def handleInputRows(self, key, rows, timerValues):
        due = timerValues.getCurrentProcessingTimeInMs() + self.after_ms
        held = self.entries.get()[0] if self.entries.exists() else 0
        ids = []
        for batch in rows:
            ids += batch[self.id_column].tolist()
        for one in ids:
            self.due_of.updateValue((one,), (due,))
        others = self.ids_at.getValue((due,))[0] if self.ids_at.containsKey((due,)) else []
        self.ids_at.updateValue((due,), (sorted({*others, *ids}),))
        self.handle.registerTimer(due)
        self.entries.update((held + len(ids),))
        yield self.frame(key, [("put", one, held + i) for i, one in enumerate(ids)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due = expiredTimerInfo.getExpiryTimeInMs()
        held = self.entries.get()[0] if self.entries.exists() else 0
        ids = self.ids_at.getValue((due,))[0] if self.ids_at.containsKey((due,)) else []
        fired = [one for one in ids if self.due_of.containsKey((one,)) and self.due_of.getValue((one,))[0] == due]
        for one in fired:
            self.due_of.removeKey((one,))
        self.ids_at.removeKey((due,))
        if fired:
            yield self.frame(key, [("timer", one, held) for one in fired])


def timer_family(df: DataFrame, keys: Sequence[str], id_column: str, after_ms: int, shards: int = 1) -> DataFrame:
    """Each element id has its own timer; the same id again moves it: ``(keys, shard, kind, id, entries)``.

    ``entries`` is how many values were put before (put) or by then (timer). Ids stay on one shard.
    """
    sharded = df.withColumn("shard", F.pmod(F.xxhash64(id_column), F.lit(shards)).cast("int"))
    grouping = [*keys, "shard"]
    id_type = df.schema[id_column].dataType
    schema = _schema(sharded, grouping, ("kind", T.StringType()), ("id", id_type), ("entries", T.LongType()))
    return _run(sharded, grouping, TimerFamily(schema, id_column, id_type, after_ms), "ProcessingTime")


class RunningIndex(_Processor):
    """A counter: read, emit for each row, write back once per micro-batch."""

    def __init__(self, schema, order: str, rest: Sequence[str]) -> None:
        super().__init__(schema)
        self.order, self.rest = order, list(rest)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", LONG_STATE)

    def handleInputRows(self, key, rows, timerValues):
        at = self.next.get()[0] if self.next.exists() else 0
        batch = _whole(rows, self.order)
        out = batch[self.rest].copy()
        for i, name in enumerate(self.schema.names[: len(key)]):
            out.insert(i, name, key[i])
        out["index"] = range(at, at + len(batch))
        yield out
        self.next.update((at + len(batch),))


def stream_running_index(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Number a key's rows from 0 by arrival, and by ``order`` in a micro-batch: ``(keys, other columns, index)``."""
    rest = [c for c in df.columns if c not in keys]
    schema = T.StructType(
        [df.schema[k] for k in keys] + [df.schema[c] for c in rest] + [T.StructField("index", T.LongType())]
    )
    return _run(df, keys, RunningIndex(schema, order, rest), "None")


class MapMachine(_Processor):
    """0 clears the map, another value below 3 is put, all else removes ``state-1``."""

    def __init__(self, schema, order: str, value: str) -> None:
        super().__init__(schema)
        self.order, self.value = order, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        name = T.StructType([T.StructField("name", T.StringType())])
        self.cells = handle.getMapState("cells", name, LONG_STATE)

    def handleInputRows(self, key, rows, timerValues):
        # The map is read once and only what the rows changed is written back.
        before = {k[0]: v[0] for k, v in self.cells.iterator()}
        cells, out = dict(before), []
        for at, value in _whole(rows, self.order)[[self.order, self.value]].itertuples(index=False):
            out.append((at, value, dict(cells)))
            if value == 0:
                cells.clear()
            elif value < 3:
                cells[f"state-{value}"] = int(value)
            else:
                cells.pop("state-1", None)
        for name in before.keys() - cells.keys():
            self.cells.removeKey((name,))
        for name, value in cells.items():
            if before.get(name) != value:
                self.cells.updateValue((name,), (value,))
        yield self.frame(key, out)


def stream_map_state(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """The map's entries before each row: ``(keys, order, value, entries)``; the rules are ``MapMachine``'s."""
    entries = T.MapType(T.StringType(), T.LongType())
    schema = T.StructType(
        [df.schema[k] for k in keys] + [df.schema[order], df.schema[value], T.StructField("entries", entries)]
    )
    return _run(df, keys, MapMachine(schema, order, value), "None")


class GrowingOutput(_Processor):
    """A stored pane number decides how many rows the pane emits."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.index = handle.getValueState("index", LONG_STATE)

    def handleInputRows(self, key, rows, timerValues):
        for _ in rows:
            pass
        index = self.index.get()[0] if self.index.exists() else 0
        self.index.update((index + 1,))
        yield self.frame(key, [(index, copy) for copy in range(1, index + 2)])


def stream_growing_output(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A key's i-th micro-batch emits i rows: ``(keys, index, copy)``."""
    slim = df.select(*keys)
    schema = _schema(slim, keys, ("index", T.LongType()), ("copy", T.LongType()))
    return _run(slim, keys, GrowingOutput(schema), "None")
