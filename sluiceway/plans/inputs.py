"""Inputs the named queries derive from the supplied tables."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.accumulate import Accumulator
from sluiceway.sources import batch as sources

# A dictionary with no, one and two answers per source.
DICTIONARY = [
    ("BUILDING", "construction"),
    ("MACHINERY", "machines"),
    ("AUTOMOBILE", "cars"),
    ("AUTOMOBILE", "vehicles"),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return sources.scan_table(spark, f"{sf}/{name}.parquet")


def cents(amount: str) -> Column:
    """Amounts have two decimals; whole cents add up the same in any order."""
    return F.round(F.col(amount) * 100).cast("bigint")


def dollars(amount: str) -> Column:
    return F.col(amount).cast("double") / F.lit(100.0)


def joined(values: str, ordered: bool = False) -> Column:
    listed = F.sort_array(values) if ordered else F.col(values)
    return F.array_join(F.transform(listed, lambda v: v.cast("string")), ",")


def prefixed(prefix: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("value", F.concat(F.lit(prefix), F.col("value")))


def dictionary(spark: SparkSession) -> DataFrame:
    return sources.literal_rows(spark, DICTIONARY, "source string, target string")


def lineitem_messages(spark: SparkSession, sf: str) -> DataFrame:
    """``flag:linenumber status:quantity [bad] p:partkey`` per line item; returned ones have the bad word."""
    lines = table(spark, sf, "lineitem")
    bad = F.when(F.col("l_returnflag") == "R", F.lit("bad ")).otherwise(F.lit(""))
    return lines.select(
        F.concat(
            "l_returnflag", F.lit(":"), F.col("l_linenumber").cast("string"), F.lit(" "),
            "l_linestatus", F.lit(":"), F.col("l_quantity").cast("int").cast("string"), F.lit(" "),
            bad, F.lit("p:"), (F.col("l_partkey") % 50).cast("string"), F.lit(" "),
        ).alias("text")
    )


def event_messages(spark: SparkSession, sf: str) -> DataFrame:
    """``type:user [oops] v:n`` per event; error events have the malformed word."""
    events = table(spark, sf, "events")
    oops = F.when(F.col("event_type") == "error", F.lit("oops ")).otherwise(F.lit(""))
    return events.select(
        "ts",
        F.concat(
            "event_type", F.lit(":"), F.col("user_id").cast("string"), F.lit(" "),
            oops, F.lit("v:"), (F.col("event_id") % 7).cast("string"),
        ).alias("text"),
    )


def routed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders routed by priority; two priorities have no table, pending orders have a null value."""
    priority = F.col("o_orderpriority")
    dest = F.concat(F.lit("table"), F.substring(priority, 1, 1))
    return table(spark, sf, "orders").select(
        dest.alias("dest"),
        F.col("o_orderkey").cast("string").alias("key"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("value"),
    )


def json_decoder() -> json.JSONDecoder:
    return json.JSONDecoder()


def decode_props(decoder: json.JSONDecoder, batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"event_id": batch["event_id"], "k": [decoder.decode(p)["k"] for p in batch["props"]]})


def _add_values(state: dict, values: pa.Array) -> dict:
    whole = values.drop_null()
    if not len(whole):
        return state
    seen = {"n": len(whole), "sum": pc.sum(whole).as_py(), "squares": pc.sum(pc.multiply(whole, whole)).as_py()}
    return _merge_values(state, seen)


def _merge_values(a: dict, b: dict) -> dict:
    return {name: a[name] + b[name] for name in a}


#: n times the sum of squares less the squared sum of whole numbers.
SPREAD = Accumulator(
    create=lambda: {"n": 0, "sum": 0, "squares": 0},
    add=_add_values,
    merge=_merge_values,
    extract=lambda s: float(s["n"] * s["squares"] - s["sum"] ** 2),
    state=T.StructType([T.StructField(n, T.LongType()) for n in ("n", "sum", "squares")]),
    result=T.DoubleType(),
)
