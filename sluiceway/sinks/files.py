"""Text and Parquet files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.render import row_json
from sluiceway.functions.sharding import destination_name
from sluiceway.operators.skew import spread

# Codecs that text files can be written with; zstd text needs a native library.
TEXT_CODECS = ("none", "gzip", "bzip2", "deflate", "snappy", "lz4")


def write_text(df: DataFrame, path: str, shards: int = 0, mode: str = "errorifexists") -> None:
    """Write a one-column frame as text. 0 shards keeps the partitioning; one shard makes one task write all."""
    out = df.repartition(shards) if shards else df
    out.write.mode(mode).text(path)


def write_compressed(df: DataFrame, path: str, codec: str = "zstd", text: bool = False) -> None:
    """Write with a compression codec: Parquet, or plain text for the codecs text supports."""
    if not text:
        df.write.option("compression", codec).parquet(path)
        return
    if codec not in TEXT_CODECS:
        raise ValueError(f"text files cannot be written with {codec}; use one of {TEXT_CODECS} or Parquet")
    df.write.option("compression", codec).text(path)


def write_dynamic(
    df: DataFrame, path: str, value: Column, destination: Column, destinations: int, shards: int = 0
) -> None:
    """Write text lines to the folder of each row's destination.

    With ``shards`` a destination has at most that many files and is written by as many tasks. With 0,
    Spark joins small destinations and splits large ones by size. Either way a destination with most of the
    rows is not one task.
    """
    routed = df.select(
        destination_name(destination, destinations).alias("destination"), value.cast("string").alias("value")
    )
    if shards:
        placed = routed.withColumn("__shard", spread(routed, shards))
        routed = placed.repartition("destination", "__shard").drop("__shard")
    else:
        routed = routed.hint("rebalance", "destination")
    routed.write.partitionBy("destination").text(path)


def export_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row and line, written by all tasks."""
    df.select(row_json(df).alias("value")).write.text(path)


def publish_strings(df: DataFrame, path: str, checkpoint: str, value: str = "value"):
    """Stream strings to a folder of text files; returns the writer, so the caller sets its trigger."""
    return (
        df.select(F.col(value).cast("string").alias("value"))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
