"""Feeding a table to a stream in arrival chunks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.skew import Skew, hot_cuts, with_piece
from sluiceway.session import fresh_dir, move_folder, remove_folder, subfolders
from sluiceway.sources.stream import table_stream, watch_files


# Bytes of text in a part of ``run_in_order``: for each core, and at least.
CORE_BYTES = 4 << 20
LEAST_BYTES = 24 << 20
# The part of a row's text in ``run_in_order``.
PART = "part"

# Old state is only of use to a job that goes back by many micro-batches, old shuffles to none.
LITTLE_KEPT = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Later than any event, and within what pandas can hold: the time at which a bounded stream has ended.
END_OF_TIME = "2200-01-01 00:00:00"


def end_row(session: SparkSession, schema, ts: str) -> DataFrame:
    """A row that only says that time has come to its end; everything else in it is null."""
    return session.range(1).select(
        *[(F.lit(END_OF_TIME) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def replay(
    session: SparkSession,
    chunks: Sequence[DataFrame],
    start: Callable[[DataFrame, str], StreamingQuery],
    drain: str | None = None,
) -> None:
    """Land one chunk after the other in a folder and run the streaming job over each until it has caught up.

    ``start`` takes the stream and a checkpoint folder. The job is restarted from its checkpoint for every
    chunk, so the watermark a chunk meets is settled by all chunks before it. With ``drain``, the name of the event
    time, the end of the input moves the watermark to the end of time, so that the last windows close too. The row
    that does it lies in a window that never closes: in append mode with windows it does not come out.
    """
    if drain:  # the last chunk is judged by those before it, so its end can come with it
        chunks = [*chunks[:-1], chunks[-1].unionByName(end_row(session, chunks[0].schema, drain))]
    landing = fresh_dir(session, "landing")
    checkpoint = fresh_dir(session, "checkpoint")
    for chunk in chunks:
        chunk.write.mode("append").parquet(landing)
        start(table_stream(session, landing, chunk.schema), checkpoint).awaitTermination()


def run_table(
    session: SparkSession,
    path: str,
    start: Callable[[DataFrame, str], StreamingQuery],
    bytes_per_trigger: int | None = None,
    drain: str | None = None,
) -> None:
    """Run the streaming job straight over a stored table, without a copy.

    With ``drain`` the end of the input comes with it, see ``replay``: rows are late against earlier micro-batches only, so
    where the table is one micro-batch its end can be in the same one, and the job need not start again.
    """
    schema = session.read.parquet(path).schema
    checkpoint = fresh_dir(session, "checkpoint")
    rows = table_stream(session, path, schema, bytes_per_trigger=bytes_per_trigger)
    if not drain:
        start(rows, checkpoint).awaitTermination()
        return
    ends = fresh_dir(session, "end")
    last = end_row(session, schema, drain)
    (last.where("false") if bytes_per_trigger else last).write.parquet(ends)
    both = rows.unionByName(table_stream(session, ends, schema))
    start(both, checkpoint).awaitTermination()
    if bytes_per_trigger:
        last.write.mode("append").parquet(ends)
        start(both, checkpoint).awaitTermination()


def in_order(df: DataFrame, order: str, part_bytes: int) -> tuple[DataFrame, int]:
    """Rows with ``PART``, a number from 0 on that never falls with ``order``, and the last number. A part has about
    ``part_bytes`` of text, and the rows of one value are in one part."""
    cuts = hot_cuts(df, [], order, Skew(hot_bytes=2 * part_bytes))
    if cuts is None:
        return df.withColumn(PART, F.lit(0)), 0
    most = cuts.agg(F.max(F.size("__cuts"))).first()[0]
    # One row, whose cuts are bounded.
    both = df.crossJoin(F.broadcast(cuts.select("__cuts")))
    placed = with_piece(both, F.col(order), "__cuts", most).select(*df.columns, F.col("__piece").alias(PART))
    # Else every task that reads would write a file of each part.
    return placed.hint("rebalance", most + 1, PART), most


def run_in_order(
    session: SparkSession, parts: DataFrame, start: Callable[[DataFrame, str, Callable[[], None]], StreamingQuery]
) -> None:
    """Land text in a watched folder part by part, and run one streaming job that has closed a part's windows before the next
    one lands.

    ``parts`` has the columns ``PART`` and ``value``, the lines. Its event time must not fall from part to part: then no line is
    late, however many windows have closed, and the state holds the windows of a part and not of the table. ``start`` gets the
    stream, a checkpoint folder, and what its sink must call at the end of every micro-batch: that removes the part which has
    been counted, while nobody lists the watched folder. Its trigger goes by processing time. A part's folder is moved into the
    watched one, which shows it as a whole, so that it is one micro-batch.
    """
    staged, landing, checkpoint = (fresh_dir(session, name) for name in ("staged", "landing", "checkpoint"))
    for name, value in LITTLE_KEPT.items():
        session.conf.set(name, value)
    parts.select(PART, "value").write.partitionBy(PART).text(staged)
    landed: list[int] = []

    def counted() -> None:
        while landed:
            remove_folder(session, f"{landing}/{landed.pop()}")

    query, seen = start(watch_files(session, f"{landing}/*", "*.txt"), checkpoint, counted), -1
    try:
        for part in sorted(int(name.partition("=")[2]) for name in subfolders(session, staged) if name.startswith(f"{PART}=")):
            landed.append(part)
            move_folder(session, f"{staged}/{PART}={part}", f"{landing}/{part}")
            query.processAllAvailable()
            done = [p for p in query.recentProgress if p["batchId"] > seen]
            if late := sum(s["numRowsDroppedByWatermark"] for p in done for s in p["stateOperators"]):
                raise ValueError(f"{late} rows of part {part} came after their window had closed")
            seen = max((p["batchId"] for p in done), default=seen)
    finally:
        query.stop()
