"""Primitives that stay balanced when one key holds a large share of the rows.

* ``running``: running count, sum, minimum or maximum per key in a given order. A key with more rows than one task
  should have is cut into ranges of the order column, every range is scanned by its own task, and the totals of the
  earlier ranges (one small row per key and range) are added back. A whole table without a key is range partitioned
  by Spark and scanned partition by partition in the same way.
* ``lookup``: an equi join against a side with few rows per key.

How many rows and bytes of text a task should have are absolute numbers, so the layout holds at any table size and any
width of rows. Which keys exceed them is estimated from a sample, and where a key's cuts lie from a quantile sketch of bounded size, a random sample of its
values that the aggregation merges. That only changes how work is spread, never the answer. Cuts and range numbers are
written once to the shared folder and joined by Spark, so a recomputed task sees the same layout and nothing that grows
with the rows comes to the driver or stands beside a row. All rows go through the plan itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.session import fresh_dir

# Sampled rows for each task's worth of rows.
SAMPLED = 200
# Cuts of one key at most, and values in its sketch.
MOST_CUTS = 1 << 14
SKETCH = 1 << 16

_PIECE = "__piece"
_HASH = "__hash"
_CUTS = "__cuts"
_KEY = "__key"


@dataclass(frozen=True)
class Skew:
    """A key with more than ``hot_rows`` rows, or ``hot_bytes`` in their strings and binaries, is split into ranges of
    about half as many."""

    hot_rows: int = 500_000
    hot_bytes: int = 64 << 20


DEFAULT_SKEW = Skew()


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("bigint")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder, and read from there."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _weight(df: DataFrame, skew: Skew) -> Column | None:
    """As how many rows a row counts: one, or what its bytes make of ``hot_bytes``. None if no column is of any length."""
    wide = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("double") for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if not wide:
        return None
    size = wide[0]
    for more in wide[1:]:
        size = size + more
    return F.greatest(F.lit(1.0), size * (skew.hot_rows / skew.hot_bytes))


def hot_cuts(df: DataFrame, keys: Sequence[str], order: str, skew: Skew = DEFAULT_SKEW) -> DataFrame | None:
    """``(__hash, __cuts)`` of every hot key: its sorted cut points on the order column. None if no key is hot.

    One job reads the rows and writes a sample, in which a wide row stands as often as its bytes are worth. A hot key's sketch is a random sample of at most about ``SKETCH`` of
    its sampled values, however many they are; its cuts are evenly spaced values of it, as many as its rows need and
    at most ``MOST_CUTS``, and whole values, however long their common beginning. The table of cuts is written, not
    collected. A hash collision only splits one more key.
    """
    share = min(1.0, SAMPLED / skew.hot_rows)
    weight = _weight(df, skew)
    if weight is None:
        rows = df.select(key_hash(keys).alias(_HASH), F.col(order).alias("at")).where(F.col("at").isNotNull())
        seen = written(rows.sample(share, seed=7) if share < 1 else rows, "sample")
    else:
        rows = df.select(key_hash(keys).alias(_HASH), F.col(order).alias("at"), weight.alias("weight")).where(F.col("at").isNotNull())
        copies = rows.select(_HASH, "at", F.floor(F.col("weight") * share + F.rand(7)).cast("int").alias("copies")).where("copies > 0")
        seen = written(copies.select(_HASH, F.explode(F.array_repeat("at", F.col("copies"))).alias("at")), "sample")
    counts = seen.groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > skew.hot_rows * share)
    if counts.isEmpty():
        return None
    step = max(1, int(skew.hot_rows * share) // 2)
    kept = seen.join(counts, _HASH).where((F.col("n") <= SKETCH) | (F.rand(11) * F.col("n") < SKETCH))
    sketch = kept.groupBy(_HASH).agg(F.array_sort(F.collect_list("at")).alias("values"), F.max("n").alias("n"))
    cuts = F.least(F.expr(f"n div {step}"), F.size("values").cast("bigint"), F.lit(MOST_CUTS).cast("bigint"))
    sketch = sketch.withColumn("__number", cuts)
    at = lambda i: F.get("values", (F.floor(i * F.size("values") / F.col("__number")) - 1).cast("int"))
    points = F.array_distinct(F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("__number")), at))
    return written(sketch.select(_HASH, points.alias(_CUTS)), "cuts")


def heavy_keys(df: DataFrame, keys: Sequence[str], order: str, skew: Skew = DEFAULT_SKEW) -> list[int]:
    """Hashes of the hot keys, to look at; no operator needs them."""
    cuts = hot_cuts(df, keys, order, skew)
    return [] if cuts is None else [r[_HASH] for r in cuts.select(_HASH).collect()]


def with_piece(df: DataFrame, value: Column, cuts: str, most: int) -> DataFrame:
    """Add how many of the row's cut points (at most ``most``) are at or below the value; 0 without cuts or value.

    A binary search in generated code: each step is its own column, since it is used twice by the next one.
    """
    found = df.withColumn(_PIECE, F.lit(0))
    for bit in reversed(range(most.bit_length())):
        half = 1 << bit
        reached = F.get(F.col(cuts), F.col(_PIECE) + (half - 1)) <= value
        found = found.withColumn(_PIECE, F.col(_PIECE) + F.when(reached, F.lit(half)).otherwise(F.lit(0)))
    return found


def _exceeds(df: DataFrame, skew: Skew) -> bool:
    """Whether the table has more rows or bytes than one task should have, by a sample of the rows."""
    share = min(1.0, SAMPLED / skew.hot_rows)
    weight = _weight(df, skew)
    rows = df.sample(share, seed=7) if share < 1 else df
    much = rows.agg(F.sum(F.lit(1.0) if weight is None else weight)).first()[0] or 0
    return much > skew.hot_rows * share


def _aggregate(how: str, value: Column) -> Column:
    return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[how](value)


def _add_back(how: str, local: Column, before: Column) -> Column:
    if how == "count":
        return local + F.coalesce(before, F.lit(0))
    if how == "sum":
        return F.coalesce(local + before, local, before)
    return F.greatest(local, before) if how == "max" else F.least(local, before)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, tuple[str, Column]],
    inclusive: bool = True,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Add running aggregates per key. ``measures`` maps an output name to ``(how, value)``.

    ``how`` is count, sum, min or max. Without ``inclusive`` a row sees only the rows before it. The order
    columns together must be unique per key; the first one should be close to unique, it carries the cuts.
    With no keys the whole table is one sequence, and if it is split its columns must fit into Parquet. Types are those
    of the plain window, split or not; sums of doubles are rounded in an order that depends on the cuts, so use exact
    types where that matters. ``df`` is evaluated once for the sample and, with keys, twice in the plan; checkpoint it
    first if it is costly or not deterministic.
    """
    if df.isStreaming:
        raise ValueError("a stream has no end to order by; see sluiceway.streaming.stateful")
    keys, order = list(keys), list(order)
    last = Window.currentRow if inclusive else -1
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    plain = df.withColumns({n: _aggregate(how, v).over(frame) for n, (how, v) in measures.items()})
    if keys:
        cuts = hot_cuts(df, keys, order[0], skew)
        if cuts is None:
            return plain
        most = cuts.agg(F.max(F.size(_CUTS))).first()[0]
        cut = with_piece(df.withColumn(_HASH, key_hash(keys)).join(cuts, _HASH, "left"), F.col(order[0]), _CUTS, most)
        split = F.col(_CUTS).isNotNull()
    else:
        if not _exceeds(df, skew):
            return plain
        ranged = df.repartitionByRange(*order)
        cut, split = written(ranged.withColumn(_PIECE, F.spark_partition_id()), "ranges"), F.lit(True)
    # As one column, keys with nulls equal each other, and rows that were dealt out by key and range are where the join wants them.
    by = [_KEY] if keys else []
    if keys:
        cut = cut.withColumn(_KEY, F.struct(*keys))
    side = [f"__side{name}" for name in by]
    totals = (
        cut.filter(split)
        .groupBy(*[F.col(k).alias(s) for k, s in zip(by, side)], F.col(_PIECE).alias("__side_piece"))
        .agg(*[_aggregate(how, v).alias(f"__total_{n}") for n, (how, v) in measures.items()])
    )
    earlier = Window.partitionBy(*side).orderBy("__side_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *side,
        "__side_piece",
        *[
            _aggregate("sum" if how == "count" else how, F.col(f"__total_{n}")).over(earlier).alias(f"__before_{n}")
            for n, (how, _) in measures.items()
        ],
    )
    frame = Window.partitionBy(*by, _PIECE).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    local = cut.withColumns({n: _aggregate(how, v).over(frame) for n, (how, v) in measures.items()})
    match = F.col(_PIECE) == F.col("__side_piece")
    for key, name in zip(by, side):
        match = (F.col(key) == F.col(name)) & match
    # One row per range of a hot key: Spark broadcasts them if they are few, and else the rows stay where they are.
    joined = local.join(before, match, "left")
    types = {f.name: f.dataType for f in plain.schema.fields}
    return joined.select(
        *df.columns,
        *[_add_back(how, F.col(n), F.col(f"__before_{n}")).cast(types[n]).alias(n) for n, (how, _) in measures.items()],
    )


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position", skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    """Add the 0-based position of each row within its key."""
    counted = running(df, keys, order, {name: ("count", F.lit(1))}, skew=skew)
    return counted.withColumn(name, F.col(name) - 1)


def spread(df: DataFrame, parts: int) -> Column:
    """A number in ``[0, parts)`` that spreads rows evenly, copies of one row as well.

    It depends on the row's content and on the input partition, both the same when a task is run again.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by_content = F.pmod(F.xxhash64(*plain), F.lit(parts).cast("bigint"))
    return F.pmod(by_content + F.spark_partition_id(), F.lit(parts).cast("bigint")).cast("int")


def lookup(df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``df`` to a side that has few rows per key.

    Spark picks a broadcast or a shuffle by the side's size; where it shuffles, adaptive execution splits the
    partition of a hot key and repeats its few side rows. Nothing runs while the plan is built.
    """
    return df.join(side, list(on), how)
