"""Grouping, combining and batching.

A group that somebody wants as a list is delivered in pages of bounded size, so a key with a third of all
rows is never one row or one task. Everything that can be an aggregate is one: Spark combines before the
shuffle, and then a hot key costs one small row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.render import xml_escape
from sluiceway.operators.skew import DEFAULT_SKEW, Skew, positions, running


def _ordered_list(order: Sequence[str], value: str) -> Column:
    """Collect values, nulls too, in the given order."""
    rows = F.sort_array(F.collect_list(F.struct(*dict.fromkeys([*order, value]))))
    return F.transform(rows, lambda r: r[value])


def group_values(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] | None = None,
    page_rows: int = 100_000,
    page_bytes: int | None = None,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Values per key in order, as ``(keys, page, values)``.

    A page holds at most ``page_rows`` values; with ``page_bytes`` a new page starts once that many bytes
    are in it instead, an empty value counting as one. A key with fewer values has the single page 0.
    """
    order = list(order or [value])
    needed = df.select(*dict.fromkeys([*keys, *order, value]))
    if page_bytes:
        size = F.greatest(F.octet_length(F.col(value)), F.lit(1)).cast("bigint")
        paged = running(needed, keys, order, {"__end": ("sum", size)}, skew=skew)
        paged = paged.withColumn("__at", F.col("__end") - size)
        page = F.expr(f"__at div {int(page_bytes)}")
    else:
        paged = positions(needed, keys, order, "__at", skew)
        page = F.expr(f"__at div {int(page_rows)}")
    return (
        paged.withColumn("page", page)
        .groupBy(*keys, "page")
        .agg(_ordered_list(order, value).alias("values"))
    )


def ungroup(grouped: DataFrame, keys: Sequence[str], name: str = "value") -> DataFrame:
    """Emit every value of every page again."""
    return grouped.select(*keys, F.explode("values").alias(name))


def key_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, smallest and largest value per key."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("count"), F.min(value).alias("min"), F.max(value).alias("max")
    )


def key_bytes(df: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """Count and total payload bytes per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.coalesce(F.sum(F.octet_length(payload).cast("bigint")), F.lit(0)).alias("total_bytes"),
    )


def combine_globally(df: DataFrame, aggs: Mapping[str, Column], window: str | None = None) -> DataFrame:
    """Combine everything, per window if one is named; no input means no output row."""
    outputs = [a.alias(n) for n, a in aggs.items()]
    if window:
        return df.groupBy(window).agg(*outputs)
    counted = df.agg(*outputs, F.count(F.lit(1)).alias("__rows"))
    return counted.filter(F.col("__rows") > 0).drop("__rows")


def combine_per_key(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Combine values per key; Spark combines on the map side first."""
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])


def combine_grouped(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    create: Column,
    add: Callable[[Column, Column], Column],
    merge: Callable[[Column, Column], Column],
    name: str,
    extract: Callable[[Column], Column] = lambda acc: acc,
    order: Sequence[str] | None = None,
    page_rows: int = 100_000,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Group first, then fold: every page of the list from ``create`` by ``add``, the pages in order by ``merge``, and
    ``extract`` of the last accumulator.

    For folds that are no Spark aggregate; ``combine_per_key`` is cheaper where it applies. A page starts from
    ``create``, so it must be neutral (``merge`` with it changes nothing), which is checked on itself; then the answer
    does not depend on ``page_rows``.
    """
    itself = df.sparkSession.range(1).select(merge(create, create).eqNullSafe(create).alias("same")).first()
    if not itself["same"]:
        raise ValueError("create must be neutral: merged with itself it has to stay the same")
    pages = group_values(df, keys, value, order, page_rows, skew=skew)
    folded = pages.select(*keys, "page", F.aggregate("values", create, add).alias("__acc"))
    listed = folded.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("page", "__acc"))).alias("__pages"))
    whole = F.aggregate(F.transform("__pages", lambda p: p["__acc"]), create, merge, extract)
    return listed.select(*keys, whole.alias(name))


def count_per_element(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def group_fields(df: DataFrame, fields: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Group by named fields and aggregate into named outputs."""
    return combine_per_key(df, fields, aggs)


def salted_agg(
    df: DataFrame,
    keys: Sequence[str],
    partial: Mapping[str, Column],
    final: Mapping[str, Column],
    salt: Sequence[str],
    salts: int,
) -> DataFrame:
    """Aggregate by key and salt, then by key.

    For hot keys whose partial state is large, or where map-side combining is switched off.
    """
    first = df.groupBy(*keys, F.pmod(F.xxhash64(*salt), F.lit(salts)).alias("__salt")).agg(
        *[a.alias(n) for n, a in partial.items()]
    )
    return first.groupBy(*keys).agg(*[a.alias(n) for n, a in final.items()])


def group_into_batches(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    size: int,
    order: Sequence[str] | None = None,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Batches of exactly ``size`` values per key, the last one possibly short: ``(keys, batch, values)``."""
    return group_values(df, keys, value, order, page_rows=size, skew=skew).withColumnRenamed("page", "batch")


def global_batches(
    df: DataFrame, value: str, size: int, order: Sequence[str] | None = None, skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    """Batches over the whole table as one sequence, ranked in parallel ranges."""
    return group_into_batches(df, [], value, size, order, skew)


def multi_bag_batches(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    size: int,
    order: Sequence[str] | None = None,
    bags: int = 4,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Batches whose values lie in turn in several bags and come out bag by bag; the first goes to bag 1."""
    batches = group_into_batches(df, keys, value, size, order, skew)
    numbered = F.transform(
        "values", lambda v, i: F.struct(((i + 1) % bags).alias("bag"), i.alias("at"), v.alias("value"))
    )
    return batches.withColumn("values", F.transform(F.sort_array(numbered), lambda r: r["value"]))


def bundle_documents(
    df: DataFrame,
    keys: Sequence[str],
    element: str,
    order: Sequence[str],
    rows_per_document: int = 10_000,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """One XML document per bundle: ``(keys, page, xml)``. A bundle of many rows spans several documents."""
    body = F.coalesce(xml_escape(F.col(element).cast("string")), F.lit(""))
    lines = df.withColumn(element, F.concat(F.lit("  <element>"), body, F.lit("</element>")))
    pages = group_values(lines, keys, element, order, rows_per_document, skew=skew)
    xml = F.concat(F.lit("<root>\n"), F.array_join("values", "\n"), F.lit("\n</root>\n"))
    return pages.select(*keys, "page", xml.alias("xml"))
