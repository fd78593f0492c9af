"""Appending to tables: existing targets, dead letters, routed rows, cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.skew import lookup
from sluiceway.session import fresh_dir

REASON = "reject_reason"


class TargetMissing(ValueError):
    """The table to append to does not exist."""


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a Parquet table."""
    try:
        spark.read.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def append_existing(df: DataFrame, path: str) -> None:
    """Append to a Parquet table that must exist and have the same columns and types."""
    try:
        target = df.sparkSession.read.parquet(path).schema
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        raise TargetMissing(path) from failure
    want = {f.name: f.dataType for f in target.fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    if want != have:
        raise ValueError(f"schema of {path} is {target.simpleString()}, rows are {df.schema.simpleString()}")
    df.select(*target.names).write.mode("append").parquet(path)


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first rule a row breaks, null for a good row. A rule is true when broken."""
    reason = F.lit(None).cast("string")
    for text, broken in reversed(rules.items()):
        reason = F.when(broken, F.lit(text)).otherwise(reason)
    return df.withColumn(REASON, reason)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reason."""
    good = checked.filter(F.col(REASON).isNull()).drop(REASON)
    return good, checked.filter(F.col(REASON).isNotNull())


def _judged_once(checked: DataFrame) -> DataFrame:
    """The rows with their verdicts, written once: whatever fails in reading or judging fails before anything is
    published, and both halves are then copied from here."""
    staged = fresh_dir(checked.sparkSession, "judged")
    checked.write.parquet(staged)
    return checked.sparkSession.read.schema(checked.schema).parquet(staged)


def append_validated(df: DataFrame, rules: Mapping[str, Column], path: str, rejects: str) -> None:
    """Append good rows to an existing table and the others, with the reason, to a dead-letter table."""
    checked = validate(df, rules)
    if not exists(df.sparkSession, path):
        raise TargetMissing(path)
    good, rejected = split_valid(_judged_once(checked))
    append_existing(good, path)
    rejected.write.mode("append").parquet(rejects)


@dataclass(frozen=True)
class Route:
    """How one destination treats the routed value."""

    required: bool = False
    default: Any = None


def route(
    df: DataFrame, dest: str, value: str, routes: Mapping[str, Route], missing: str = "unspecified"
) -> DataFrame:
    """Apply each destination's rules to ``value`` and add ``reject_reason``.

    ``missing`` is unspecified, null_value or default_value. Only default_value fills a null with the
    destination's default; otherwise a null stays and is rejected where the value is required.
    """
    if missing not in ("unspecified", "null_value", "default_value"):
        raise ValueError(f"unknown missing-value policy {missing}")
    filled = F.col(value)
    dtype = df.schema[value].dataType
    if missing == "default_value":
        for name, rule in routes.items():
            if rule.default is not None:
                here = (F.col(dest) == name) & F.col(value).isNull()
                filled = F.when(here, F.lit(rule.default).cast(dtype)).otherwise(filled)
    required = [name for name, rule in routes.items() if rule.required]
    known = F.coalesce(F.col(dest).isin(*routes), F.lit(False))
    return validate(
        df.withColumn(value, filled),
        {
            "unknown destination": ~known,
            "missing required value": F.col(value).isNull() & F.col(dest).isin(*required),
        },
    )


def route_append(
    df: DataFrame, path: str, rejects: str, dest: str, value: str, routes: Mapping[str, Route], missing: str = "unspecified"
) -> None:
    """Append each accepted row under its destination's folder, rejected rows to a dead-letter table."""
    good, rejected = split_valid(_judged_once(route(df, dest, value, routes, missing)))
    good.write.mode("append").partitionBy(dest).parquet(path)
    rejected.write.mode("append").parquet(rejects)


def insert_verdicts(
    df: DataFrame, target: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """Insert-only check: add ``reject_reason``, null for rows that may be inserted.

    A row is rejected if a key column is null, if the target has the key, or if an earlier row (by the
    unique ``order``) brings the same key.
    """
    existing = target.select(*keys).distinct().withColumn("__exists", F.lit(True))
    first = df.groupBy(*keys).agg(F.min(order).alias("__first")).join(existing, list(keys), "left")
    null_key = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    judged = lookup(df, first, keys, "left")
    return validate(
        judged,
        {
            "null key": null_key,
            "key exists": F.coalesce("__exists", F.lit(False)),
            "duplicate in input": F.col(order) > F.col("__first"),
        },
    ).select(*df.columns, REASON)


def insert_or_reject(
    df: DataFrame, target: DataFrame, keys: Sequence[str], order: str
) -> tuple[DataFrame, DataFrame]:
    """Rows to insert, and error rows with the reason. Existing rows are never overwritten."""
    return split_valid(insert_verdicts(df, target, keys, order))


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a target for insert-only appends: bucketed and sorted by its keys, as the catalog's table ``name`` at ``path``.

    ``insert_verdicts`` against it shuffles the incoming keys alone, to the target's buckets; the target is read where it is.
    """
    spread_rows = df.repartition(buckets, *keys)
    spread_rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def append_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Append accepted rows to such a target; a bucket gets one more file."""
    columns = df.sparkSession.table(name).columns
    rows = df.select(*columns).repartition(buckets, *keys)
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).mode("append").saveAsTable(name)


def jdbc_append(
    df: DataFrame, url: str, table: str, driver: str | None = None, batch_size: int = 1_000, writers: int = 8
) -> None:
    """Insert rows by prepared statements, in batches, over a bounded number of connections."""
    writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", batch_size).option("numPartitions", writers)
    (writer.option("driver", driver) if driver else writer).save()


def to_cells(df: DataFrame, key: str, family: str, columns: Sequence[str]) -> DataFrame:
    """One ``(row_key, family, qualifier, value)`` cell per row and column, all as bytes but the names."""

    def as_bytes(column: str) -> Column:
        return F.col(column).cast("string").cast("binary")

    cells = F.array(*[F.struct(F.lit(c).alias("qualifier"), as_bytes(c).alias("value")) for c in columns])
    rows = df.select(as_bytes(key).alias("row_key"), F.lit(family).alias("family"), F.inline(cells))
    return rows.filter(F.col("value").isNotNull())
