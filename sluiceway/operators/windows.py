"""Event-time windows and, over bounded tables, panes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.skew import DEFAULT_SKEW, Skew, running


def fixed_window(df: DataFrame, ts: str, size: str, name: str = "window") -> DataFrame:
    """Tumbling, half-open windows aligned to the epoch; works on tables and streams."""
    return df.withColumn(name, F.window(ts, size))


def global_window(df: DataFrame, *windows: str) -> DataFrame:
    """Put rows back into the one window of everything: the named window columns go."""
    return df.drop(*(windows or ("window",)))


def window_meta(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace the window by its start, its end and its last instant."""
    last = F.col(window)["end"] - F.expr("INTERVAL 1 MICROSECOND")
    return df.withColumns(
        {"window_start": F.col(window)["start"], "window_end": F.col(window)["end"], "window_time": last}
    ).drop(window)


def multi_window(
    df: DataFrame,
    ts: str,
    minutes: Sequence[int],
    partial: Mapping[str, Column],
    final: Mapping[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """The same rows in windows of several sizes side by side: ``(keys, minutes, window_start, finals)``.

    The table is read and combined once, at the largest step that divides every size; the sizes are rolled
    up from those small results.
    """
    step = reduce(gcd, minutes)
    base = df.groupBy(*keys, F.window(ts, f"{step} minutes")["start"].alias("__base")).agg(
        *[a.alias(n) for n, a in partial.items()]
    )
    local = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") if local else F.timestamp_seconds(F.lit(0))
    since_epoch = F.col("__base") - epoch
    number = F.extract(F.lit("DAY"), since_epoch) * 1440 + F.extract(F.lit("HOUR"), since_epoch) * 60
    number = number + F.extract(F.lit("MINUTE"), since_epoch)
    sized = base.withColumn("minutes", F.explode(F.array(*[F.lit(m) for m in minutes])))
    into = F.pmod(number, F.col("minutes")).cast("int")
    return (
        sized.withColumn("window_start", F.col("__base") - F.make_dt_interval(mins=into))
        .groupBy(*keys, "minutes", "window_start")
        .agg(*[a.alias(n) for n, a in final.items()])
    )


def panes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    every: int,
    value: str,
    discarding: bool = True,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Fire once per ``every`` rows of a key in arrival order: ``(keys, pane, count, sum)``.

    A discarding pane covers what came since the last one, an accumulating pane everything so far.
    """
    pane = F.expr(f"(__n - 1) div {int(every)}").alias("pane")
    if discarding:
        placed = running(df, keys, order, {"__n": ("count", F.lit(1))}, skew=skew)
        return placed.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias("count"), F.sum(value).alias("sum"))
    so_far = {"__n": ("count", F.lit(1)), "__sum": ("sum", F.col(value))}
    placed = running(df, keys, order, so_far, skew=skew)
    # What a pane's last row has seen is what it accumulates.
    return placed.groupBy(*keys, pane).agg(F.max("__n").alias("count"), F.max_by("__sum", "__n").alias("sum"))
