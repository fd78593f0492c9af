"""Windows, triggers and panes on streams.

Every sink here is safe to retry: a batch that runs again overwrites its own folder, and the file sink keeps
a log of committed files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BATCH = "batch_id"


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Streams need zoned timestamps; the session is in UTC, so this keeps the wall clock."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def window_agg(
    df: DataFrame, ts: str, size: str, lateness: str, keys: Sequence[str], aggs: Mapping[str, Column]
) -> DataFrame:
    """Aggregate per window and key; rows later than ``lateness`` behind the newest are dropped."""
    grouped = df.withWatermark(ts, lateness).groupBy(F.window(ts, size), *keys)
    return grouped.agg(*[a.alias(n) for n, a in aggs.items()])


def multi_window_agg(
    df: DataFrame, ts: str, minutes: Sequence[int], lateness: str, keys: Sequence[str], aggs: Mapping[str, Column]
) -> DataFrame:
    """Windows of several sizes side by side, under one watermark and in one state: ``(keys, minutes, window, aggs)``.

    A row is read once and then put into its window of every size. Exploding loses the mark of the event time, which is
    what lets windows close, so it is taken over from the watermarked column.
    """
    marked = df.withWatermark(ts, lateness)
    mark = marked.schema[ts].metadata
    for size in minutes:
        marked = marked.withColumn(f"__window_{size}", F.window(ts, f"{size} minutes"))
    sized = F.array(*[F.struct(F.lit(size).alias("minutes"), F.col(f"__window_{size}").alias("window")) for size in minutes])
    rows = marked.withColumn("__sized", F.explode(sized)).select(
        *df.columns, F.col("__sized.minutes").alias("minutes"), F.col("__sized.window").alias("window", metadata=mark)
    )
    return rows.drop(ts).groupBy(*keys, "minutes", "window").agg(*[a.alias(n) for n, a in aggs.items()])


def collect_windows(
    df: DataFrame, ts: str, size: str, lateness: str, keys: Sequence[str], value: str, shard: Column
) -> DataFrame:
    """Values per window, key and shard as a sorted list that comes out when the window closes, in append mode.

    The list is an aggregate of Spark's own; shards keep a hot key's window from being one row.
    """
    return window_agg(df.withColumn("shard", shard), ts, size, lateness, [*keys, "shard"], {"values": F.sort_array(F.collect_list(value))})


def rewindow(windowed: DataFrame, size: str, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Put finished windows into larger ones: each goes by its last instant."""
    grouped = windowed.groupBy(F.window(F.window_time("window"), size), *keys)
    return grouped.agg(*[a.alias(n) for n, a in aggs.items()])


def window_start(windowed: DataFrame) -> DataFrame:
    """Replace the window by its start."""
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), *rest)


def _triggered(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Run on a fixed processing-time grid, or once over what is there."""
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def stream_append(
    df: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds", method: str = "files",
    then: Callable[[], None] | None = None,
) -> StreamingQuery:
    """Append finished rows to a Parquet table.

    ``files`` commits through the sink's own log, exactly once. ``batches`` writes a folder per micro-batch
    (column ``batch_id``), which any reader sees as soon as it is there and a retry replaces; ``then`` is called after each.
    """
    if then and method != "batches":
        raise ValueError("only the method batches has a call after each micro-batch")
    if method == "files":
        writer = df.writeStream.format("parquet").option("path", path)
    elif method == "batches":
        writer = df.writeStream.foreachBatch(batch_writer(path, then=then))
    else:
        raise ValueError(f"unknown write method {method}")
    return _triggered(writer.outputMode("append").option("checkpointLocation", checkpoint), every)


def stream_snapshot(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the whole current result after each micro-batch (complete mode); ``newest`` reads the last one."""
    writer = df.writeStream.outputMode("complete").foreachBatch(batch_writer(path))
    return _triggered(writer.option("checkpointLocation", checkpoint), every)


def stream_changes(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the groups each micro-batch changed (update mode); a micro-batch is the finest trigger."""
    writer = df.writeStream.outputMode("update").foreachBatch(batch_writer(path))
    return _triggered(writer.option("checkpointLocation", checkpoint), every)


def stream_discarding(
    df: DataFrame,
    aggregate: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Aggregate each micro-batch by itself: a pane holds only what arrived since the last one."""
    writer = df.writeStream.foreachBatch(batch_writer(path, aggregate))
    return _triggered(writer.option("checkpointLocation", checkpoint), every)


def batch_writer(
    path: str, aggregate: Callable[[DataFrame], DataFrame] | None = None, then: Callable[[], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """Write a micro-batch to its own folder; a retried batch replaces it."""

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = aggregate(batch) if aggregate else batch
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if then:
            then()

    return save


def newest(snapshots: DataFrame) -> DataFrame:
    """The last snapshot; the others are pruned as partitions."""
    last = snapshots.agg(F.max(BATCH)).scalar()
    return snapshots.filter(F.col(BATCH) == last).drop(BATCH)


def latest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each group among written changes."""
    rest = [c for c in changes.columns if c not in (*keys, BATCH)]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("__row"))
    return newest.select(*keys, "__row.*")
