"""Unbounded sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.sources.batch import MESSAGE_SCHEMA


def table_stream(
    spark: SparkSession, path: str, schema, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet table, one file or a folder, read as a stream. The braces make the path a glob, so both fit.

    Without a limit, what is there becomes one micro-batch; files are taken by age, so a limit also decides
    which rows later ones are late against.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(f"{folder}/{{{name}}}")


def unbounded_sequence(
    spark: SparkSession, start: int = 0, rows_per_batch: int = 1, advance_ms: int = 1000, start_ms: int = 0
) -> DataFrame:
    """Whole numbers from ``start`` on with an event time that moves by ``advance_ms`` per batch.

    The offset is kept in the checkpoint: a restarted job goes on with the next number.
    """
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
        .option("advanceMillisPerBatch", advance_ms)
        .load()
    )
    return ticks.select(F.col("timestamp").alias("ts"), (F.col("value") + start).alias("value"))


def late_replay(df: DataFrame, ts: str, late: Column, frozen: Column) -> DataFrame:
    """Late elements keep the event time ``frozen`` although the stream around them moves on."""
    return df.withColumn(ts, F.when(late, frozen).otherwise(F.col(ts)))


def watch_files(spark: SparkSession, folder: str, pattern: str = "*", files_per_trigger: int | None = None) -> DataFrame:
    """Lines of every file that matches, including files that appear later; ``path`` names the file.

    The trigger interval of the query is the polling interval.
    """
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with id, attributes and payload, as they land in a folder."""
    return spark.readStream.schema(MESSAGE_SCHEMA).parquet(folder)


def kafka_options(servers: str, topics: list[str], starting: str = "earliest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting}


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest") -> DataFrame:
    """Log topics in the message layout. Needs Spark's Kafka connector on the class path."""
    records = spark.readStream.format("kafka").options(**kafka_options(servers, topics, starting))
    records = records.option("includeHeaders", "true").load()
    headers = F.map_from_entries(
        F.transform(F.coalesce("headers", F.array()), lambda h: F.struct(h["key"], h["value"].cast("string")))
    )
    return records.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("value").alias("payload"),
        headers.alias("attributes"),
        F.col("timestamp").alias("publish_ts"),
    )
