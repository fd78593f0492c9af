"""Keyed state and timers on real streams."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from sluiceway.functions import sharding
from sluiceway.operators import state
from sluiceway.plans.inputs import table
from sluiceway.session import fresh_dir, stream_session
from sluiceway.sources.stream import table_stream
from sluiceway.streaming import panes, replay, stateful


@pytest.fixture(scope="module")
def session(spark):
    sibling = stream_session(spark)
    sibling.conf.set("spark.sql.shuffle.partitions", "2")
    return sibling


def run(session, chunks, job):
    """Replay chunks through the job and return what it appended."""
    out = fresh_dir(session, "out")
    replay.replay(session, chunks, lambda s, checkpoint: panes.stream_append(job(s), out, checkpoint, every=None))
    return session.read.parquet(out)


def run_live(session, chunks, job, seconds: float, deadline: float = 45):
    """Keep the job running: feed the chunks one by one, then leave it ``seconds`` for its timers.

    A job on processing time never runs dry, so it is stopped by hand.
    """
    out, landing = fresh_dir(session, "out"), fresh_dir(session, "landing")
    chunks[0].write.parquet(landing)
    rows = job(table_stream(session, landing, chunks[0].schema))
    query = panes.stream_append(rows, out, fresh_dir(session, "cp"), "200 milliseconds")
    expected, last = 0, time.time() + deadline
    try:
        for i, chunk in enumerate(chunks):
            expected += chunk.count()
            if i:
                chunk.write.mode("append").parquet(landing)
            while sum(p["numInputRows"] for p in query.recentProgress) < expected:
                assert query.exception() is None and time.time() < last
                time.sleep(0.2)
        time.sleep(seconds)
    finally:
        query.stop()
    return session.read.parquet(out)


def timed(session, sf):
    events = table(session, sf, "events").select("event_id", "ts", "user_id")
    return panes.event_time(events, "ts")


def test_collect_equals_batch_for_closed_windows(session, sf):
    events = timed(session, sf)
    chunks = [events.filter(F.floor(F.col("event_id") / 400) == i) for i in range(3)]
    got = run(
        session,
        chunks,
        lambda s: stateful.stream_collect(
            s.withWatermark("ts", "1 hour"), ["user_id"], "ts", "1 day", "event_id", page_rows=7, shards=2
        ),
    )
    mark = events.agg((F.max("ts") - F.expr("INTERVAL 1 HOUR")).alias("m")).first()["m"]
    want = state.collect_until_window_end(events, ["user_id"], "ts", "1 day", "event_id")
    want = want.filter(F.col("window_end") <= F.lit(mark))
    flat = got.select("user_id", "window_start", F.explode("values").alias("v"))
    assert sorted(map(tuple, flat.collect())) == sorted(
        map(tuple, want.select("user_id", "window_start", F.explode("values").alias("v")).collect())
    )
    assert got.agg(F.max(F.size("values"))).first()[0] <= 7


def test_batches_are_full_until_the_timer(session, sf):
    events = timed(session, sf)
    chunks = [events.filter("event_id < 500"), events.filter("event_id >= 500")]
    got = run_live(
        session, chunks, lambda s: stateful.stream_batches(s, ["user_id"], "event_id", 10, max_wait_ms=15_000), seconds=18
    )
    rows = got.collect()
    assert sorted(v for r in rows for v in r["values"]) == list(range(events.count()))
    short: dict[int, int] = {}
    for r in rows:
        assert len(r["values"]) <= 10
        short[r["user_id"]] = short.get(r["user_id"], 0) + (len(r["values"]) < 10)
    assert max(short.values()) <= 1


def test_batches_do_not_cross_windows(session, sf):
    events = timed(session, sf)
    chunks = [events.filter(F.floor(F.col("event_id") / 400) == i) for i in range(3)]
    got = run(
        session,
        chunks,
        lambda s: stateful.stream_batches(
            s.withWatermark("ts", "1 hour"), ["user_id"], "event_id", 3, ts="ts", window="1 day"
        ),
    )
    mark = events.agg((F.max("ts") - F.expr("INTERVAL 1 HOUR")).alias("m")).first()["m"]
    per_window = (
        got.filter(F.col("window_end") <= F.lit(mark))
        .groupBy("user_id", "window_start")
        .agg(F.sum(F.size("values")).alias("n"), F.count(F.when(F.size("values") < 3, 1)).alias("short"))
    )
    want = (
        events.groupBy("user_id", F.window("ts", "1 day").alias("w")).count()
        .filter(F.col("w.end") <= F.lit(mark))
        .select("user_id", "w.start", "count", (F.col("count") % 3 != 0).cast("bigint"))
    )
    assert sorted(map(tuple, per_window.collect())) == sorted(map(tuple, want.collect()))


def test_window_and_wait_need_one_time_domain(session, sf):
    with pytest.raises(ValueError):
        stateful.stream_batches(timed(session, sf), ["user_id"], "event_id", 3, 10, "ts", "1 day")


def test_trigger_any_fires_on_count_and_on_wait(session):
    rows = session.range(0, 7).select(F.lit("k").alias("key"), F.col("id").alias("v"))
    got = run_live(session, [rows], lambda s: stateful.trigger_any(s, ["key"], "v", 5, 1000), seconds=4)
    assert sorted(len(r["values"]) for r in got.collect()) == [2, 5]


def test_idle_timer_is_moved_by_later_elements(session):
    rows = session.range(0, 4).select(F.lit("k").alias("key"), F.col("id").alias("v"))
    got = run_live(session, [rows, rows], lambda s: stateful.idle_timer(s, ["key"], 12_000), seconds=16)
    assert sorted(map(tuple, got.select("kind", "before", "backlog").collect())) == [
        *[("element", n, n + 1) for n in range(8)], ("timer", 8, 8)
    ]


def test_timer_family_fires_once_per_id(session):
    rows = session.createDataFrame([("k", 1), ("k", 2), ("k", 1), ("k", 5)], "key string, id bigint").coalesce(1)
    got = run_live(session, [rows], lambda s: stateful.timer_family(s, ["key"], "id", 1000), seconds=4)
    assert sorted(r["id"] for r in got.filter("kind = 'timer'").collect()) == [1, 2, 5]
    assert sorted(r["entries"] for r in got.filter("kind = 'put'").collect()) == [0, 1, 2, 3]
    assert {r["entries"] for r in got.filter("kind = 'timer'").collect()} == {4}


def test_running_index_and_map_state_equal_batch(session, sf):
    events = table(session, sf, "events").select(
        "user_id", "event_id", (sharding.shard_key(F.col("event_id"), 7) - 1).alias("v")
    )
    chunks = [events.filter(F.floor(F.col("event_id") / 400) == i).coalesce(1) for i in range(3)]
    index = run(session, chunks, lambda s: stateful.stream_running_index(s, ["user_id"], "event_id"))
    want = state.running_index(events, ["user_id"], ["event_id"])
    cols = ["user_id", "event_id", "index"]
    assert sorted(map(tuple, index.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))

    cells = run(session, chunks, lambda s: stateful.stream_map_state(s, ["user_id"], "event_id", "v"))
    want = state.map_state_fold(events, ["user_id"], "event_id", "v", tracked=(-1, 1, 2))
    show = lambda rows: sorted((r["user_id"], r["event_id"], tuple(sorted(r["entries"].items()))) for r in rows.collect())
    assert show(cells) == show(want)


def test_growing_output(session, sf):
    events = table(session, sf, "events").select("user_id", "event_id")
    chunks = [events.filter(F.floor(F.col("event_id") / 400) == i) for i in range(3)]
    got = run(session, chunks, lambda s: stateful.stream_growing_output(s, ["user_id"]))
    counts = {tuple(r) for r in got.groupBy("index").agg((F.count("*") / F.countDistinct("user_id")).cast("int")).collect()}
    assert counts == {(0, 1), (1, 2), (2, 3)}


def arrivals(session):
    """A day's window, an hour of lateness: 05:00 comes after 12:30 but its window is open; the day before is closed."""
    rows = [[("k", "2024-01-02 12:00", 1)], [("k", "2024-01-02 12:30", 2)], [("k", "2024-01-02 05:00", 3)], [("k", "2024-01-01 23:00", 4)], [("k", "2024-01-05 00:00", 5)]]
    return [session.createDataFrame(r, "key string, t string, v bigint").select("key", F.to_timestamp("t").alias("ts"), "v") for r in rows]


def test_a_row_is_late_when_its_window_has_closed(session):
    collected = run(session, arrivals(session), lambda s: stateful.stream_collect(s.withWatermark("ts", "1 hour"), ["key"], "ts", "1 day", "v"))
    assert [sorted(r["values"]) for r in collected.collect()] == [[1, 2, 3]]
    batched = run(session, arrivals(session), lambda s: stateful.stream_batches(s.withWatermark("ts", "1 hour"), ["key"], "v", 10, ts="ts", window="1 day"))
    assert [sorted(r["values"]) for r in batched.collect()] == [[1, 2, 3]]


def test_order_holds_over_a_whole_micro_batch(session):
    rows = session.range(25_000).select(F.lit("k").alias("key"), F.col("id").alias("o")).orderBy(F.desc("o")).coalesce(1)
    got = run(session, [rows], lambda s: stateful.stream_running_index(s, ["key"], "o"))
    assert got.where("index <> o").count() == 0 and got.count() == 25_000
