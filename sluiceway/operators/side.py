"""Side inputs: a second, usually small, collection seen by every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.group import group_values
from sluiceway.operators.skew import DEFAULT_SKEW, Skew, lookup


def with_singleton(df: DataFrame, side: DataFrame, name: str) -> DataFrame:
    """The single value of a one-row, one-column side on every row.

    It runs as a scalar subquery: Spark itself fails on a second row, an empty side fails here.
    """
    value = side.columns[0]
    checked = side.select(F.col(value), F.lit(1).alias("rows")).agg(
        F.count("rows").alias("rows"), F.min(F.struct(value))[value].alias(value)
    )
    wrong = F.concat(F.lit("a singleton side input needs exactly one row, found "), F.col("rows").cast("string"))
    dtype = side.schema[value].dataType
    one = checked.select(F.when(F.col("rows") == 1, F.col(value)).otherwise(F.raise_error(wrong).cast(dtype)))
    return df.withColumn(name, one.scalar())


def with_list(
    df: DataFrame, side: DataFrame, value: str | Column, name: str, page_rows: int = 100_000, skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    """The whole side, sorted, on every row, in pages: one output row per input row and page (column ``page``).

    One form for sides of any size: a page is one array of at most ``page_rows`` values, and rows meet pages by an
    equi join on the page number, of which Spark broadcasts the pages if they are small. An empty side has no page.
    """
    items = side.select((F.col(value) if isinstance(value, str) else value).alias(name))
    pages = group_values(items, [], name, page_rows=page_rows, skew=skew).withColumnRenamed("values", name)
    count = F.ceil(side.agg(F.count(F.lit(1))).scalar() / F.lit(page_rows))
    wanted = F.when(count > 0, F.sequence(F.lit(0).cast("bigint"), count - 1)).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn("page", F.explode(wanted)).join(pages, "page")


def with_self_list(df: DataFrame, value: str, name: str, page_rows: int = 100_000, skew: Skew = DEFAULT_SKEW) -> DataFrame:
    """Every row beside the list of all values of the same input, in pages."""
    return with_list(df, df, value, name, page_rows, skew)


def _estimate(df: DataFrame) -> int:
    """The optimizer's estimate of a table's bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def with_map(
    df: DataFrame, side: DataFrame, on: str, key: str, value: str, name: str | None = None
) -> DataFrame:
    """Look ``df[on]`` up in a map; a missing key gives null. Fails if a key that is looked up is in the map twice.

    A map that Spark takes for larger than the rows is first reduced to the keys that they ask for, so only those are
    grouped and checked; a smaller one is grouped as it is. A streamed ``df`` can't be asked twice, so its map is not reduced.
    """
    name = name or value
    entries = side.filter(F.col(key).isNotNull()).select(F.col(key).alias(on), F.col(value).alias(name))
    if not df.isStreaming and _estimate(entries) > _estimate(df.select(on)):
        asked = df.select(on).filter(F.col(on).isNotNull()).distinct()
        entries = entries.join(asked, on, "left_semi")
    answers = entries.groupBy(on).agg(F.any_value(name).alias(name), F.count(F.lit(1)).alias("__times"))
    found = lookup(df, answers, [on], "left")
    twice = F.raise_error(F.concat(F.lit("duplicate key in side map: "), F.col(on).cast("string"))).cast(side.schema[value].dataType)
    return found.withColumn(name, F.when(F.col("__times") > 1, twice).otherwise(F.col(name))).drop("__times")


def enrich(
    df: DataFrame,
    dictionary: DataFrame,
    on: str,
    source: str,
    target: str,
    strict: bool = True,
) -> DataFrame:
    """Translate ``df[on]`` by a dictionary with zero or more answers per source.

    Strict: keep a row only if there is exactly one answer. Lenient: keep every row, with the smallest
    answer or null.
    """
    answers = dictionary.groupBy(F.col(source).alias(on)).agg(
        F.min(target).alias(target), F.count(target).alias("__answers")
    )
    if strict:
        return lookup(df, answers.filter(F.col("__answers") == 1).drop("__answers"), [on], "inner")
    return lookup(df, answers.drop("__answers"), [on], "left")
