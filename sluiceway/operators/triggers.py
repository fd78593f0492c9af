"""Panes that end at a number of elements or after a wait, whichever comes first, over bounded tables.

Where a pane begins depends on where the one before ended, so panes can't be read off row by row. But every row has one
successor, the row that would open the next pane if this row opened one, and the pane starts are what the first row
reaches. Successors are followed by pointer doubling: a round joins every pointer with the one it leads to, so a key of
n panes needs log2(n) rounds of equi joins on key and position, and a hot key is spread over all tasks like any other.

Both sides of these joins grow with the rows. Positions pack so well in the files they are read from that Spark would take
millions of them for a small table and send them through the driver, hence the hints.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.skew import DEFAULT_SKEW, Skew, positions, running, written


def _same(keys: Sequence[str], names: Sequence[str]) -> Column:
    match = F.lit(True)
    for key, name in zip(keys, names):
        match = match & F.col(key).eqNullSafe(F.col(name))
    return match


def _successors(placed: DataFrame, keys: Sequence[str], ts: str, count: int, wait: str, skew: Skew) -> DataFrame:
    """``(keys, __at, __to)``: the position of the first row that is not in the pane which the row at ``__at`` opens.

    How many rows come before a wait is over is a running count over the rows and their deadlines, sorted together; a
    deadline comes before the rows of its own instant.
    """
    rows = placed.select(*keys, F.col(ts).alias("__time"), F.lit(1).alias("__row"), "__at")
    due = placed.select(*keys, (F.col(ts) + F.expr(f"INTERVAL {wait}")).alias("__time"), F.lit(0).alias("__row"), "__at")
    counted = running(rows.unionByName(due), keys, ["__time", "__row", "__at"], {"__before": ("sum", F.col("__row"))}, skew=skew)
    return counted.where("__row = 0").select(*keys, "__at", F.least(F.col("__at") + count, F.col("__before")).alias("__to"))


def _starts(successors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, __at)`` of the rows that open panes: those that position 0 reaches."""
    names = [f"__key{i}" for i in range(len(keys))]
    reached = written(successors.where("__at = 0").select(*keys, "__at"), "starts")
    jumps = successors
    while True:
        ahead = jumps.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("__at").alias("__from"), F.col("__to").alias("__next"))
        ahead = ahead.hint("merge")
        match = _same(keys, names)
        more = reached.join(ahead, match & (F.col("__at") == F.col("__from"))).select(*keys, F.col("__next").alias("__at"))
        reached = written(reached.unionByName(more), "starts")
        jumps = written(jumps.join(ahead, match & (F.col("__to") == F.col("__from"))).select(*keys, "__at", F.col("__next").alias("__to")), "jumps")
        if jumps.isEmpty():
            return reached


def any_of(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], count: int, wait: str, skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    """Add ``pane`` (from 0), ``opened`` (the time of its first row) and ``at``, the row's place in it.

    Rows arrive by ``ts`` and then by ``order``, unique per key. A pane takes ``count`` rows, or what comes less than ``wait``
    (an interval, longer than none) after its first row. Rows without a time take no part. With a window's start among
    the keys panes end with their window too.
    """
    keys, order = list(keys), list(order)
    timed = df.where(F.col(ts).isNotNull())
    placed = written(positions(timed, keys, [ts, *order], "__at", skew), "placed")
    following = written(_successors(placed, keys, ts, count, wait, skew), "successors")
    sizes = placed.groupBy(*keys).agg(F.count("*").alias("__size"))
    names = [f"__key{i}" for i in range(len(keys))]
    ends = sizes.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__size")
    inside = following.join(ends.hint("merge"), _same(keys, names)).where(F.col("__to") < F.col("__size")).select(*keys, "__at", "__to")
    first = placed.where("__at = 0").select(*keys, "__at")
    # A key of one pane has no pointer; its first row opens it all the same.
    starts = _starts(inside, keys).unionByName(first).distinct()
    marks = starts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("__at").alias("__start"))
    marked = written(placed.join(marks.hint("merge"), _same(keys, names) & (F.col("__at") == F.col("__start")), "left").drop(*names), "marked")
    opens = F.col("__start").isNotNull()
    measures = {
        "__panes": ("sum", opens.cast("bigint")), "__first": ("max", F.col("__start")), "opened": ("max", F.when(opens, F.col(ts))),
    }
    seen = running(marked, keys, ["__at"], measures, skew=skew)
    return seen.select(*df.columns, (F.col("__panes") - 1).alias("pane"), "opened", (F.col("__at") - F.col("__first")).alias("at"))


def bounded_batches(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], value: str, count: int, wait: str,
    window_end: str | None = None, skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Batches per key: ``(keys, pane, ended_by, fired_at, values)``, values in order of arrival.

    A batch fires when it has ``count`` values, ``wait`` after its first, or at the end of the window (a key column; the
    window's start is among the keys as well), and says which of them it was: size, wait or window.
    """
    keys = list(keys)
    placed = any_of(df, keys, ts, order, count, wait, skew)
    last = F.max_by(ts, "at")
    made = placed.groupBy(*keys, "pane", "opened").agg(
        F.count("*").alias("__n"), last.alias("__last"),
        F.transform(F.sort_array(F.collect_list(F.struct("at", value))), lambda r: r[value]).alias("values"),
    )
    due = F.col("opened") + F.expr(f"INTERVAL {wait}")
    full = F.col("__n") == count
    by, at = F.lit("wait"), due
    if window_end:
        inside = due < F.col(window_end)
        by, at = F.when(inside, by).otherwise(F.lit("window")), F.when(inside, due).otherwise(F.col(window_end))
    return made.select(
        *keys, "pane", F.when(full, F.lit("size")).otherwise(by).alias("ended_by"), F.when(full, F.col("__last")).otherwise(at).alias("fired_at"), "values"
    )
