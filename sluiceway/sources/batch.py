"""Bounded sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The message layout used by every message source and sink.
MESSAGE_SCHEMA = "message_id string, payload binary, attributes map<string,string>, publish_ts timestamp"


#: Numbers that one row of the first level of ``fan_out`` stands for.
FAN_OUT_BLOCK = 4_096


def literal_rows(spark: SparkSession, rows: Sequence[Any], schema: str) -> DataFrame:
    """A handful of rows written in the program; an explicit schema also covers the empty case."""
    return spark.createDataFrame(rows, schema)


def sequence(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    """Whole numbers in ``[start, end)`` as ``value``; one partition stands for an unsplittable source."""
    numbers = spark.range(start, end, 1, partitions) if partitions else spark.range(start, end)
    return numbers.withColumnRenamed("id", "value")


def fan_out(df: DataFrame, seed: str, per_row: int, payload_bytes: int = 0) -> DataFrame:
    """Each seed i gives the numbers ``[i*per_row, (i+1)*per_row)``, if asked with a payload of fixed size."""
    first = F.col(seed).cast("bigint") * per_row
    blocks = df.select(seed, F.explode(F.sequence(first, first + (per_row - 1), F.lit(FAN_OUT_BLOCK).cast("bigint"))).alias("low"))
    # Two levels with a redistribution between: one seed's numbers are neither one array nor one task's work.
    high = F.least(F.col("low") + (FAN_OUT_BLOCK - 1), first + (per_row - 1))
    rows = blocks.hint("rebalance").select(seed, F.explode(F.sequence(F.col("low"), high)).alias("value"))
    return rows.withColumn("payload", F.repeat(F.lit("\0"), payload_bytes).cast("binary")) if payload_bytes else rows


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """A whole Parquet table; filters and columns used later are pushed into the scan."""
    return spark.read.parquet(path)


def sql_source(
    spark: SparkSession, tables: Mapping[str, DataFrame], query: str, args: Mapping[str, Any] | None = None
) -> DataFrame:
    """Run SQL text given at run time. Tables go in as ``{name}``, values as ``:name``."""
    return spark.sql(query, args=dict(args or {}), **tables)


def jdbc_options(
    url: str,
    table_or_query: str,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; a partition column with bounds splits the read into parallel range queries."""
    is_query = " " in table_or_query.strip()
    options = {"url": url, "fetchsize": str(fetch_size)}
    options["dbtable"] = f"({table_or_query}) source" if is_query else table_or_query
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def jdbc_read(spark: SparkSession, url: str, table_or_query: str, **how: Any) -> DataFrame:
    """A relational table or query as rows; see ``jdbc_options`` for ``how``."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table_or_query, **how)).load()


def synthetic_messages(df: DataFrame, message_id: str, ts: str, payload_bytes: int = 1024) -> DataFrame:
    """One message per row: zero bytes of a fixed size and the row's time as ISO text attribute ``ts``."""
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return df.select(
        F.col(message_id).cast("string").alias("message_id"),
        F.repeat(F.lit("\0"), payload_bytes).cast("binary").alias("payload"),
        F.create_map(F.lit("ts"), iso).alias("attributes"),
        F.col(ts).cast("timestamp").alias("publish_ts"),
    )
