"""Shard keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shard_key(value: Column, shards: int) -> Column:
    """Floor modulus: never negative."""
    return F.pmod(value.cast("bigint"), F.lit(shards).cast("bigint"))


def remainder_key(value: Column, shards: int) -> Column:
    """Truncating remainder: takes the sign of the value."""
    return value.cast("bigint") % F.lit(shards).cast("bigint")


def sha_shard(value: Column, shards: int) -> Column:
    """Floor modulus of the first eight bytes of SHA-256 over the big-endian long, read as a signed long."""
    eight_bytes = F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))
    head = F.conv(F.substring(F.sha2(eight_bytes, 256), 1, 16), 16, -10).cast("bigint")
    return F.pmod(head, F.lit(shards).cast("bigint"))


def destination_name(destination: Column, shards: int) -> Column:
    """Zero-padded ``destination-of-shards``."""
    return F.format_string("%08d-of-%08d", destination, F.lit(shards).cast("bigint"))


def spread_key(*values: Column, seed: int = 0) -> Column:
    """A well-mixed key from the row's own values, so that a recomputed task assigns the same one."""
    return F.xxhash64(F.lit(seed).cast("bigint"), *values)
