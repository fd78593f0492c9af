"""Element-wise operators: nothing here shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluiceway.functions import render, text


def explode_with(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One output row per item of an array; rows with an empty array give none."""
    return df.withColumn(name, F.explode(items))


def discard(df: DataFrame) -> DataFrame:
    """Consume the input and emit nothing."""
    return df.filter(F.lit(False))


def with_key(df: DataFrame, key: Any, name: str = "key", dtype: str = "string") -> DataFrame:
    """The same key, possibly null, on every row."""
    return df.withColumn(name, F.lit(key).cast(dtype))


def multi_output(df: DataFrame, outputs: Mapping[str, Column], value: str = "value") -> DataFrame:
    """Several tagged outputs per row in one pass. All outputs share a type."""
    branches = [F.struct(F.lit(tag).alias("tag"), expr.alias(value)) for tag, expr in outputs.items()]
    return df.select(F.inline(F.array(*branches)))


def parse_kv_words(df: DataFrame, message: str, *keep: str) -> DataFrame:
    """``key``/``value`` rows of the ``key:value`` words before a message's first malformed word."""
    return df.select(*keep, F.inline(text.kv_words(F.col(message))))


def tokenize(df: DataFrame, body: str, *keep: str, name: str = "word") -> DataFrame:
    """One row per letter token of every line of a text."""
    return df.select(*keep, F.explode(text.text_tokens(F.col(body))).alias(name))


def tokenize_lines(df: DataFrame, line: str, *keep: str, name: str = "word") -> DataFrame:
    """One row per letter token where each row is a line already."""
    return df.select(*keep, F.explode(text.line_tokens(F.col(line))).alias(name))


def restamp(df: DataFrame, ts: str, stamp: Column) -> DataFrame:
    """Give every row a new event time. On a stream this must come before the watermark."""
    return df.withColumn(ts, stamp)


def tagged(df: DataFrame, value: str, name: str = "tag", fmt: str = "TODAY:{v}") -> DataFrame:
    """Tag rows with a parameter derived from another one at run time."""
    return df.withColumn(name, F.lit(fmt.format(v=value)))


def process_values(df: DataFrame, value: str = "value", name: str = "processed") -> DataFrame:
    """Mark each value as processed; partitions run side by side."""
    return df.withColumn(name, F.concat(F.lit("processed-"), F.col(value)))


def trace(
    df: DataFrame,
    tag: str,
    element: Column,
    ts: Column | None = None,
    window: Column | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Pass rows through with a ``trace`` text column; row counts go to the observation if one is given."""
    traced = df.withColumn("trace", render.trace_line(tag, element, ts, window))
    return traced.observe(observation, F.count(F.lit(1)).alias("rows")) if observation else traced


def with_setup(
    df: DataFrame,
    setup: Callable[[], Any],
    process: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: str,
    teardown: Callable[[Any], None] | None = None,
) -> DataFrame:
    """Process Arrow batches with a resource that is made once per partition and released at its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield process(resource, batch)
        finally:
            if teardown:
                teardown(resource)

    return df.mapInPandas(run, schema)
