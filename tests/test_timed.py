"""Batches with several bounds and panes with lateness, over tables and on streams."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import triggers
from sluiceway.operators.skew import Skew
from sluiceway.plans import stream_queries
from sluiceway.plans.inputs import table
from sluiceway.session import fresh_dir, stream_session, subfolders
from sluiceway.streaming import panes, replay, timed


@pytest.fixture(scope="module")
def session(spark):
    sibling = stream_session(spark)
    sibling.conf.set("spark.sql.shuffle.partitions", "2")
    return sibling


def run(session, chunks, job, drain=None):
    out = fresh_dir(session, "out")
    replay.replay(session, chunks, lambda s, checkpoint: panes.stream_append(job(s), out, checkpoint, every=None), drain=drain)
    return session.read.parquet(out)


def machine(rows, count, wait, window=None):
    """Batches (key, ended_by, fired_at, values) of (key, ts, value) rows one after the other."""
    out, waiting = [], {}

    def due(opened, place):
        end = place and place[1]
        return (opened + wait, "wait") if not end or opened + wait < end else (end, "window")

    for key, ts, value in rows:
        start = window and datetime.datetime.fromtimestamp(ts.timestamp() // window.total_seconds() * window.total_seconds())
        place = (key, start and start + window)
        for other in [p for p in waiting if p[0] == key]:
            at, by = due(waiting[other][0], other)
            if ts >= at:
                out.append((key, by, at, [v for _, v in waiting.pop(other)[1]]))
        opened, held = waiting.setdefault(place, (ts, []))
        held.append((ts, value))
        if len(held) == count:
            out.append((key, "size", ts, [v for _, v in waiting.pop(place)[1]]))
    for place, (opened, held) in waiting.items():
        at, by = due(opened, place)
        out.append((place[0], by, at, [v for _, v in held]))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def events(spark, sf):
    """A null key with a third of the rows; times with ties."""
    rows = table(spark, sf, "events").where("event_id < 600")
    key = F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("user_id") % 3)
    return rows.select(key.cast("bigint").alias("k"), F.date_trunc("hour", "ts").cast("timestamp").alias("ts"), "event_id").cache()


def in_order(events):
    return [tuple(r) for r in events.orderBy("ts", "event_id").collect()]


@pytest.mark.parametrize("count, hours", [(1, 5), (3, 6), (1000, 24)])
@pytest.mark.parametrize("skew", [Skew(), Skew(hot_rows=20)])
def test_any_of_count_and_wait(events, count, hours, skew):
    got = triggers.bounded_batches(events, ["k"], "ts", ["event_id"], "event_id", count, f"{hours} HOURS", skew=skew)
    want = machine(in_order(events), count, datetime.timedelta(hours=hours))
    assert sorted((tuple(r) for r in got.select("k", "ended_by", "fired_at", "values").collect()), key=repr) == want
    numbers = got.groupBy("k").agg(F.max("pane") + 1 == F.count("*"), F.countDistinct("pane") == F.count("*")).collect()
    assert all(r[1] and r[2] for r in numbers)


def test_nothing_that_grows_with_the_rows_is_broadcast(events, monkeypatch):
    """Packed positions make a small file, however many they are."""
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label)

    written = triggers.written
    monkeypatch.setattr(triggers, "written", seen)
    triggers.any_of(events, ["k"], "ts", ["event_id"], 3, "6 HOURS")
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("count, hours", [(3, 6), (1000, 3)])
def test_window_end_is_the_third_bound(events, count, hours):
    placed = events.withColumn("s", F.window("ts", "1 day")["start"]).withColumn("e", F.window("ts", "1 day")["end"])
    got = triggers.bounded_batches(placed, ["k", "s", "e"], "ts", ["event_id"], "event_id", count, f"{hours} HOURS", "e")
    want = machine(in_order(events), count, datetime.timedelta(hours=hours), datetime.timedelta(days=1))
    assert sorted((tuple(r) for r in got.select("k", "ended_by", "fired_at", "values").collect()), key=repr) == want


def test_odd_tables(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", "2024-01-01 00:00:00", 2), (None, None, 3)], "k string, t string, v int")
    rows = rows.withColumn("ts", F.to_timestamp("t"))
    got = triggers.bounded_batches(rows, ["k"], "ts", ["v"], "v", 5, "1 HOUR").select("k", "ended_by", "values").collect()
    assert [tuple(r) for r in got] == [("a", "wait", [2])]
    assert triggers.bounded_batches(rows.limit(0), ["k"], "ts", ["v"], "v", 5, "1 HOUR").count() == 0


@pytest.mark.parametrize("count, hours, window", [(4, 6, None), (1000, 5, "1 day")])
def test_a_stream_gives_the_batches_of_the_table(session, events, count, hours, window):
    """However the rows fall into micro-batches."""
    rows = session.createDataFrame([tuple(r) for r in events.collect()], "k bigint, ts timestamp, event_id bigint")
    chunks = [rows.where(F.floor(F.col("event_id") / 170) == i) for i in range(4)]
    got = run(
        session, chunks,
        lambda s: timed.stream_bounded_batches(s.withWatermark("ts", "1 second"), ["k"], "ts", "event_id", count, f"{hours} hours", window),
        drain="ts",
    )
    show = lambda r: (r[0], r[1], r[2], sorted(r[3]))  # noqa: E731 - rows of one instant have no order
    want = machine(in_order(events), count, datetime.timedelta(hours=hours), window and datetime.timedelta(days=1))
    have = got.select("k", "ended_by", "fired_at", "values").collect()
    assert [x[:3] for x in sorted(map(show, have), key=repr)] == [x[:3] for x in sorted(map(show, want), key=repr)]
    assert sorted(v for r in have for v in r["values"]) == sorted(r[2] for r in in_order(events))


def at(session, *rows):
    made = session.createDataFrame([("k", t, v) for t, v in rows], "key string, t string, v bigint")
    return made.select("key", F.to_timestamp("t").alias("ts"), "v").coalesce(1)


def test_panes_on_time_late_and_expired(session):
    chunks = [
        at(session, ("2024-01-01 10:10", 1), ("2024-01-01 10:50", 2)),
        at(session, ("2024-01-01 10:20", 3), ("2024-01-01 11:10", 4)),  # behind the watermark, in an open window
        at(session, ("2024-01-01 10:30", 5), ("2024-01-01 10:31", 6)),  # its window has ended, the lateness has not
        at(session, ("2024-01-01 12:05", 7), ("2024-01-01 10:32", 8)),  # again
        at(session, ("2024-01-01 10:59", 9), ("2024-01-01 11:59", 10)),  # too late, and late
        at(session, ("2024-01-01 09:00", 11)),
    ]
    got = run(session, chunks, lambda s: timed.stream_panes(s, ["key"], "ts", "1 hour", "1 hour", "v"), drain="ts")
    rows = got.select(F.hour("window_start").alias("h"), "pane", "timing", F.array_sort("values").alias("values"), "seen").where("h > 0")
    assert sorted((r[0], r[1], r[2], r[3], r[4]) for r in rows.collect()) == [
        (10, 0, "ON_TIME", [1, 2, 3], 3), (10, 1, "LATE", [5, 6], 5), (10, 2, "LATE", [8], 6), (10, 3, "EXPIRED", [], 6),
        (11, 0, "ON_TIME", [4], 1), (11, 1, "LATE", [10], 2), (11, 2, "EXPIRED", [], 2),
        (12, 0, "ON_TIME", [7], 1), (12, 1, "EXPIRED", [], 1),
    ]


def test_a_window_that_only_has_late_rows_and_no_lateness(session):
    chunks = [at(session, ("2024-01-01 10:10", 1)), at(session, ("2024-01-01 09:30", 2)), at(session, ("2024-01-01 08:30", 3))]
    late = run(session, chunks, lambda s: timed.stream_panes(s, ["key"], "ts", "1 hour", "1 hour", "v"), drain="ts")
    rows = late.where("size(values) > 0").select("pane", "timing", "values").collect()
    assert sorted((r[0], r[1], r[2]) for r in rows) == [(0, "LATE", [2]), (0, "ON_TIME", [1])]
    strict = run(session, chunks, lambda s: timed.stream_panes(s, ["key"], "ts", "1 hour", "0 seconds", "v"), drain="ts")
    assert [r["values"] for r in strict.where("size(values) > 0").collect()] == [[1]]


def test_words_are_counted_in_one_run_of_the_stream(spark, sf, monkeypatch):
    """A second run would load the whole state again, and counting the state's rows takes a lookup before every write."""
    started = []

    def seen(df, *args, **how):
        started.append(df.sparkSession.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"))
        return append(df, *args, **how)

    append = panes.stream_append
    monkeypatch.setattr(panes, "stream_append", seen)
    stream_queries.stream_word_count(spark, sf)
    assert started == ["false"]


def test_windows_close_while_words_land(spark, sf, monkeypatch):
    """The state holds the windows of a part of the text and not of the table; what was counted is removed."""
    whole = {tuple(r) for r in stream_queries.stream_word_count(spark, sf).collect()}
    runs, folders = [], []
    append, watch = panes.stream_append, replay.watch_files
    monkeypatch.setattr(replay, "CORE_BYTES", (64 << 10) // spark.sparkContext.defaultParallelism)
    monkeypatch.setattr(replay, "LEAST_BYTES", 0)
    monkeypatch.setattr(panes, "stream_append", lambda *args, **how: runs.append(append(*args, **how)) or runs[-1])
    monkeypatch.setattr(replay, "watch_files", lambda s, folder, *args: folders.append(folder) or watch(s, folder, *args))
    assert {tuple(r) for r in stream_queries.stream_word_count(spark, sf).collect()} == whole
    (query,) = runs
    added = [s.numRowsUpdated for p in query.recentProgress for s in p.stateOperators]
    assert len(added) > 5 and max(added) < sum(added) / 3
    (folder,) = folders
    assert subfolders(spark, folder.removesuffix("/*")) == []


def test_parts_follow_the_order(spark):
    rows = spark.range(2_000).select(F.pmod(F.xxhash64("id"), F.lit(500)).alias("at"), F.repeat(F.lit("x"), 1_000).alias("text"))
    parts, last = replay.in_order(rows, "at", 200_000)
    found = parts.groupBy("part").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n")).orderBy("part").collect()
    assert [r["part"] for r in found] == list(range(last + 1)) and last > 4
    assert sum(r["n"] for r in found) == 2_000
    assert all(a["last"] < b["first"] for a, b in zip(found, found[1:]))


def test_parts_that_come_too_late_are_an_error(session, tmp_path):
    rows = session.createDataFrame([(0, "1000"), (1, "2000"), (2, "1")], "part int, value string")

    def job(lines, checkpoint, then):
        timed = lines.select(F.timestamp_seconds(F.col("line").cast("bigint")).alias("ts"))
        counts = panes.window_agg(timed, "ts", "10 seconds", "10 seconds", [], {"n": F.count(F.lit(1))})
        return panes.stream_append(panes.window_start(counts), str(tmp_path / "out"), checkpoint, "0 seconds", "batches", then)

    with pytest.raises(ValueError, match="1 rows of part 2 came after"):
        replay.run_in_order(session, rows, job)
