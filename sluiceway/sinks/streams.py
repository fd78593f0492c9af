"""Appending the rows of a stream to several tables at once: good rows, routed rows and dead letters.

A micro-batch is judged once, its parts are written to folders named by the batch, and last of all a commit says that it
is whole. A batch that failed in between is written again over the same folders, so nothing is doubled, and readers by
``committed`` see a batch in all tables or in none.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.session import fresh_dir
from sluiceway.sinks.tables import Route, exists, route, split_valid, validate
from sluiceway.streaming.panes import BATCH, _triggered


def batch_publisher(
    judge: Callable[[DataFrame], DataFrame], path: str, rejects: str, commits: str, partition_by: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Publish a micro-batch: ``judge`` adds the reject reason."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = fresh_dir(spark, "judged")
        checked = judge(batch)
        checked.write.parquet(staged)
        good, rejected = split_valid(spark.read.schema(checked.schema).parquet(staged))
        writer = good.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{path}/{BATCH}={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{rejects}/{BATCH}={batch_id}")
        done = spark.range(1).select(F.lit(batch_id).cast("long").alias("committed"))
        done.coalesce(1).write.mode("overwrite").parquet(f"{commits}/{BATCH}={batch_id}")

    return publish


def committed(spark: SparkSession, path: str, commits: str) -> DataFrame:
    """The rows of all batches that are whole. Spark prunes the other batches' folders."""
    if not exists(spark, commits):
        return spark.read.parquet(path).where("false").drop(BATCH)
    whole = spark.read.parquet(commits).select(F.col("committed").alias(BATCH)).distinct()
    rows = spark.read.parquet(path)
    return rows.withColumn(BATCH, F.col(BATCH).cast("long")).join(whole, BATCH, "left_semi").drop(BATCH)


def stream_validated(
    df: DataFrame, rules: Mapping[str, Column], path: str, rejects: str, commits: str, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """Good rows to one table, the others with the first rule they break to another."""
    publish = batch_publisher(lambda batch: validate(batch, rules), path, rejects, commits)
    return _triggered(df.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint), every)


def stream_routed(
    df: DataFrame, path: str, rejects: str, commits: str, dest: str, value: str, routes: Mapping[str, Route], checkpoint: str,
    missing: str = "unspecified", every: str | None = "10 seconds",
) -> StreamingQuery:
    """Each accepted row under its destination's folder, by ``tables.route``; rejected rows to another table."""
    publish = batch_publisher(lambda batch: route(batch, dest, value, routes, missing), path, rejects, commits, dest)
    return _triggered(df.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint), every)
