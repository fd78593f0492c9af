"""Named streaming queries: a table goes through a streaming job and the job's output table comes back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions import sharding
from sluiceway.operators import branch, elements, group, shuffle, side
from sluiceway.plans import inputs
from sluiceway.plans.inputs import cents, dollars, table
from sluiceway.session import fresh_dir, stream_session
from sluiceway.sinks import streams, tables
from sluiceway.sources import batch as sources
from sluiceway.sources import stream
from sluiceway.streaming import panes, replay, timed

HOUR = "1 hour"
LATENESS = "2 hours"


def _hours(events: DataFrame) -> DataFrame:
    """Sum and count per hour and key of an event stream."""
    keyed = panes.event_time(events, "ts").withColumn("key", sharding.shard_key(F.col("event_id"), 10))
    return panes.window_agg(
        keyed.withColumn("cents", cents("value")),
        "ts",
        HOUR,
        LATENESS,
        ["key"],
        {"sum_cents": F.sum("cents"), "n": F.count(F.lit(1))},
    )


def _hourly(events: DataFrame) -> DataFrame:
    return panes.window_start(_hours(events))


def _report(sums: DataFrame) -> DataFrame:
    return sums.select("key", "window_start", dollars("sum_cents").alias("sum_value"), "n")


def _thirds(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """Events with their arrival third (0, 1, 2)."""
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    size = events.agg(F.max("event_id").alias("last")).first()["last"] + 1
    third = F.floor(F.col("event_id") * 3 / size)
    return events.withColumn("third", third), size


def _chunks(arrivals: DataFrame) -> list[DataFrame]:
    return [arrivals.filter(F.col("third") == i) for i in range(3)]


def _late_chunks(spark: SparkSession, sf: str) -> list[DataFrame]:
    """After the first third, even elements keep the last event time of that third."""
    arrivals, _ = _thirds(spark, sf)
    frozen = arrivals.filter(F.col("third") == 0).agg(F.max("ts")).scalar()
    late = (F.col("third") > 0) & (F.col("event_id") % 2 == 0)
    return _chunks(stream.late_replay(arrivals, "ts", late, frozen))


def stream_window_complete(spark: SparkSession, sf: str) -> DataFrame:
    session, out = stream_session(spark), fresh_dir(spark, "out")
    replay.run_table(
        session, f"{sf}/events.parquet", lambda s, cp: panes.stream_snapshot(_hourly(s), out, cp)
    )
    return _report(panes.newest(spark.read.parquet(out)))


def stream_window_append(spark: SparkSession, sf: str) -> DataFrame:
    session, out = stream_session(spark), fresh_dir(spark, "out")
    replay.run_table(
        session, f"{sf}/events.parquet", lambda s, cp: panes.stream_append(_hourly(s), out, cp, every=None), drain="ts"
    )
    return _report(spark.read.parquet(out))


def stream_multi_window(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of one to four hours side by side, over events that come in three chunks."""
    session, out = stream_session(spark), fresh_dir(spark, "out")

    def job(events: DataFrame, checkpoint: str):
        sizes = {"count": F.count(F.lit(1)), "total_bytes": F.sum(F.octet_length("props").cast("bigint"))}
        found = panes.multi_window_agg(panes.event_time(events, "ts"), "ts", [60, 120, 180, 240], LATENESS, [], sizes)
        return panes.stream_append(panes.window_start(found), out, checkpoint, every=None)

    events = table(session, sf, "events").select("event_id", "ts", "props")
    size = events.agg(F.max("event_id").alias("last")).first()["last"] + 1
    third = F.floor(F.col("event_id") * 3 / size)
    replay.replay(session, [events.filter(third == i) for i in range(3)], job, drain="ts")
    return spark.read.parquet(out)


def stream_rolled_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Hours that are finished go on into windows of six hours."""
    session, out = stream_session(spark), fresh_dir(spark, "out")

    def job(events: DataFrame, checkpoint: str):
        rolled = panes.rewindow(_hours(events), "6 hours", ["key"], {"sum_cents": F.sum("sum_cents"), "n": F.sum("n")})
        return panes.stream_append(panes.window_start(rolled), out, checkpoint, every=None)

    arrivals, _ = _thirds(session, sf)
    replay.replay(session, _chunks(arrivals), job, drain="ts")
    return _report(spark.read.parquet(out))


def stream_late_dropped(spark: SparkSession, sf: str) -> DataFrame:
    session, out = stream_session(spark), fresh_dir(spark, "out")
    replay.replay(
        session, _late_chunks(session, sf), lambda s, cp: panes.stream_append(_hourly(s), out, cp, every=None), drain="ts"
    )
    return _report(spark.read.parquet(out))


def stream_stateless_late(spark: SparkSession, sf: str) -> DataFrame:
    session, out = stream_session(spark), fresh_dir(spark, "out")

    def job(events: DataFrame, checkpoint: str):
        marked = panes.event_time(events, "ts").withWatermark("ts", LATENESS)
        rows = marked.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
        return panes.stream_append(rows, out, checkpoint, every=None)

    replay.replay(session, _late_chunks(session, sf), job)
    return spark.read.parquet(out)


def stream_trigger_update(spark: SparkSession, sf: str) -> DataFrame:
    session, out = stream_session(spark), fresh_dir(spark, "out")
    arrivals, _ = _thirds(session, sf)
    replay.replay(session, _chunks(arrivals), lambda s, cp: panes.stream_changes(_hourly(s), out, cp))
    changes = spark.read.parquet(out)
    return _report(panes.latest(changes, ["key", "window_start"]))


def stream_discarding(spark: SparkSession, sf: str) -> DataFrame:
    """Per-batch panes of each key; together they count every row once."""
    session, out = stream_session(spark), fresh_dir(spark, "out")
    arrivals, _ = _thirds(session, sf)

    def pane(batch: DataFrame) -> DataFrame:
        keyed = batch.withColumn("key", sharding.shard_key(F.col("event_id"), 10))
        return group.combine_per_key(
            keyed, ["key"], {"n": F.count(F.lit(1)), "first": F.min("event_id"), "last": F.max("event_id")}
        )

    replay.replay(session, _chunks(arrivals), lambda s, cp: panes.stream_discarding(s, pane, out, cp))
    return spark.read.parquet(out).select("key", "n", "first", "last")


def stream_static_side(spark: SparkSession, sf: str) -> DataFrame:
    session, out = stream_session(spark), fresh_dir(spark, "out")
    newest = table(session, sf, "orders").agg(F.max("o_orderkey").alias("side"))

    def job(events: DataFrame, checkpoint: str):
        values = events.select(F.col("event_id").cast("string").alias("value"))
        both = branch.branch_union(values, inputs.prefixed("Left-"), inputs.prefixed("Right-"))
        return panes.stream_append(side.with_singleton(both, newest, "side"), out, checkpoint, every=None)

    replay.run_table(session, f"{sf}/events.parquet", job)
    return spark.read.parquet(out)


def stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Documents land as text files in a watched folder, every line with the second its document stands for; words are
    counted per ten seconds as they come, and a window's counts leave the state when it closes."""
    cores = spark.sparkContext.defaultParallelism
    # A micro-batch has so much text for each core, however large the table: more state partitions would only be smaller.
    session = stream_session(spark, min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(12, 2 * cores)))
    out = fresh_dir(spark, "out")
    docs = table(session, sf, "documents").where("text <> ''").select("doc_id", "text")
    # Documents land in the order of their seconds, so that windows close as others come.
    placed, last = replay.in_order(docs, "doc_id", max(replay.LEAST_BYTES, replay.CORE_BYTES * cores))
    body = F.regexp_replace(F.regexp_replace("text", "\r\n?", "\n"), "\n\\z", "")
    lines = placed.select(replay.PART, "doc_id", F.explode(F.split(body, "\n")).alias("line"))
    said = lines.select(replay.PART, F.concat(F.col("doc_id").cast("string"), F.lit("\t"), "line").alias("value"))
    # The end of time comes with the last documents: no restart, which would load the state.
    end = session.range(1).select(F.lit(last).alias(replay.PART), F.lit(f"{1 << 36}\tend").alias("value"))

    def job(landed: DataFrame, checkpoint: str, then: Callable[[], None]):
        parts = landed.select(F.split("line", "\t", 2).alias("part"))
        timed = parts.select(F.timestamp_seconds(F.col("part")[0].cast("bigint")).alias("ts"), F.col("part")[1].alias("line"))
        words = elements.tokenize_lines(timed, "line", "ts")
        counts = panes.window_start(panes.window_agg(words, "ts", "10 seconds", "10 seconds", ["word"], {"count": F.count(F.lit(1))}))
        return panes.stream_append(counts, out, checkpoint, every="0 seconds", method="batches", then=then)

    replay.run_in_order(session, said.unionByName(end), job)
    return spark.read.parquet(out).drop(panes.BATCH)


def stream_collect_windows(spark: SparkSession, sf: str) -> DataFrame:
    session, out = stream_session(spark), fresh_dir(spark, "out")

    def job(events: DataFrame, checkpoint: str):
        timed = panes.event_time(events, "ts")
        lists = panes.collect_windows(timed, "ts", "1 day", LATENESS, ["user_id"], "event_id", F.col("event_id") % 4)
        return panes.stream_append(panes.window_start(lists), out, checkpoint, every=None)

    replay.run_table(session, f"{sf}/events.parquet", job, drain="ts")
    rows = spark.read.parquet(out)
    return rows.select("user_id", "window_start", "shard", inputs.joined("values").alias("event_ids"))


def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages are keyed by id modulo shards, redistributed, and appended with their ``ts`` attribute."""
    session, out = stream_session(spark), fresh_dir(spark, "out")
    landing = fresh_dir(spark, "landing")
    sources.synthetic_messages(table(session, sf, "events"), "event_id", "ts", 32).write.parquet(landing)
    messages = stream.message_stream(session, landing)
    keyed = messages.withColumn("shard", sharding.shard_key(F.col("message_id"), 100))
    rows = shuffle.reshuffle_by(keyed, "shard").select(
        "message_id",
        "shard",
        F.col("attributes")["ts"].alias("sent"),
        F.octet_length("payload").cast("bigint").alias("size"),
    )
    panes.stream_append(rows, out, fresh_dir(spark, "checkpoint"), every=None).awaitTermination()
    return spark.read.parquet(out)


def _delayed(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Events in the order of their time in four chunks, but every fifth comes a chunk later."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    size = events.agg(F.max("event_id").alias("last")).first()["last"] + 1
    chunk = F.floor(F.col("event_id") * 4 / size) + (F.col("event_id") % 5 == 0).cast("int")
    return [events.filter(F.least(chunk, F.lit(3)) == i) for i in range(4)]


def stream_late_panes(spark: SparkSession, sf: str) -> DataFrame:
    """On-time and late panes of each event type's half days, with six days of lateness, and where their state ends."""
    session, out = stream_session(spark), fresh_dir(spark, "out")

    def job(events: DataFrame, checkpoint: str):
        found = timed.stream_panes(panes.event_time(events, "ts"), ["event_type"], "ts", "12 hours", "6 days", "event_id")
        rows = found.select(
            "event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "pane", "timing",
            inputs.joined("values", ordered=True).alias("event_ids"), "seen",
        )
        return panes.stream_append(rows, out, checkpoint, every=None)

    replay.replay(session, _delayed(session, sf), job, drain="ts")
    return spark.read.parquet(out)


def stream_bounded_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The batches of ``bounded_batches``, on a stream that brings the events in three chunks."""
    session, out = stream_session(spark), fresh_dir(spark, "out")

    def job(events: DataFrame, checkpoint: str):
        marked = panes.event_time(events, "ts").withWatermark("ts", "1 hour")
        made = timed.stream_bounded_batches(marked, ["event_type"], "ts", "event_id", 20, "3 hours", "1 day")
        rows = made.select(
            "event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "ended_by",
            F.col("fired_at").cast("timestamp_ntz").alias("fired_at"), inputs.joined("values").alias("event_ids"),
        )
        return panes.stream_append(rows, out, checkpoint, every=None)

    events = table(session, sf, "events").select("event_id", "ts", "event_type")
    size = events.agg(F.max("event_id").alias("last")).first()["last"] + 1
    third = F.floor(F.col("event_id") * 3 / size)
    replay.replay(session, [events.filter(third == i) for i in range(3)], job, drain="ts")
    return spark.read.parquet(out)


def stream_validated_append(spark: SparkSession, sf: str) -> DataFrame:
    """Documents judged by size and by a nested field as they come, both halves of a micro-batch committed at once."""
    session = stream_session(spark)
    target, rejects, commits = (fresh_dir(spark, name) for name in ("target", "rejects", "commits"))
    rules = {
        "row too large": F.octet_length("text") > 10_000,
        "bad nested field": F.col("sub.c").isNull() | (F.col("sub.c") < 100),
    }

    def job(docs: DataFrame, checkpoint: str):
        rows = docs.select("doc_id", "text", F.struct("lang", F.col("n_chars").alias("c")).alias("sub"))
        return streams.stream_validated(rows, rules, target, rejects, commits, checkpoint, every=None)

    replay.run_table(session, f"{sf}/documents.parquet", job)
    good = streams.committed(spark, target, commits).select("doc_id", F.lit("ok").alias("status"))
    return good.unionByName(streams.committed(spark, rejects, commits).select("doc_id", F.col("reject_reason").alias("status")))


def stream_routed_append(spark: SparkSession, sf: str) -> DataFrame:
    """Orders routed to their priority's table as they come; two priorities have none, null values break one's rule."""
    session = stream_session(spark)
    path, rejects, commits, landing = (fresh_dir(spark, name) for name in ("routed", "rejects", "commits", "landing"))
    routes = {"table1": tables.Route(required=True), "table2": tables.Route(default=2), "table3": tables.Route(required=True, default=3)}
    rows = inputs.routed_orders(session, sf)
    rows.write.parquet(landing)
    replay.run_table(
        session, landing, lambda s, cp: streams.stream_routed(s, path, rejects, commits, "dest", "value", routes, cp, every=None)
    )
    columns = ["dest", "key", F.coalesce(F.col("value").cast("string"), F.lit("null")).alias("value")]
    good = streams.committed(spark, path, commits).select(*columns, F.lit("ok").alias("status"))
    return good.unionByName(streams.committed(spark, rejects, commits).select(*columns, F.col("reject_reason").alias("status")))


STREAM_QUERIES = {
    fn.__name__: fn
    for fn in (
        stream_window_complete, stream_window_append, stream_rolled_windows, stream_late_dropped, stream_stateless_late,
        stream_trigger_update, stream_discarding, stream_static_side, stream_word_count, stream_messages,
        stream_collect_windows, stream_late_panes, stream_bounded_batches,
        stream_validated_append, stream_routed_append, stream_multi_window,
    )
}
