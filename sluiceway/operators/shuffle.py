"""Redistribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.sharding import spread_key


def reshuffle(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly, whatever their content."""
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def reshuffle_by(df: DataFrame, *keys: str, partitions: int | None = None, colocate: bool = False) -> DataFrame:
    """Bring rows of a key together.

    By default an oversized key is split at run time. ``colocate`` keeps every key whole, for callers whose
    next step needs it and whose keys are known to be small.
    """
    columns = [F.col(k) for k in keys]
    if colocate:
        return df.repartition(partitions, *columns) if partitions else df.repartition(*columns)
    return df.hint("rebalance", partitions, *columns) if partitions else df.hint("rebalance", *columns)


def reshuffle_spread(df: DataFrame, partitions: int, *values: str, seed: int = 0) -> DataFrame:
    """Spread rows by a well-mixed key, then drop the key."""
    mixed = spread_key(*[F.col(v) for v in values], seed=seed)
    return df.withColumn("__spread", mixed).repartition(partitions, "__spread").drop("__spread")
