"""What keyed state computes, over bounded tables and without state.

Each operator is a closed form of the sequential program, built on running aggregates, so a hot key's history is
scanned by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.group import group_values
from sluiceway.operators.skew import DEFAULT_SKEW, Skew, positions, running, written
from sluiceway.operators.windows import fixed_window, window_meta


def running_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "index", skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    """A counter per key: read, emit, then add one."""
    return positions(df, keys, order, name, skew)


def unsaved_counter(df: DataFrame, name: str = "count") -> DataFrame:
    """A counter that is read and raised but never stored, so every row reports 1.

    ``running_index`` plus one is the counter that keeps its value.
    """
    return df.withColumn(name, F.lit(1).cast("bigint"))


def backlog(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    order: Sequence[str],
    name: str = "backlog",
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """How many rows of the same key and window came before each row."""
    placed = window_meta(fixed_window(df, ts, size)).drop("window_end", "window_time")
    return positions(placed, [*keys, "window_start"], order, name, skew)


def collect_until_window_end(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    value: str,
    order: Sequence[str] | None = None,
    page_rows: int = 100_000,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """All values per key and window, released at the window's last instant, in pages."""
    placed = window_meta(fixed_window(df, ts, size))
    grouped = [*keys, "window_start", "window_end", "window_time"]
    return group_values(placed, grouped, value, order, page_rows, skew=skew)


def map_state_fold(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    tracked: Sequence[int] = (1, 2),
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """The entries of a map state before each row, as a map column ``entries``.

    The machine: 0 clears the map, any other value below 3 puts ``state-<value>``, all else removes
    ``state-1``. An entry is there if its last put is later than the last clear and, for ``state-1``, than
    the last remove. ``tracked`` names the values that may be put; another one is an error.
    """
    v = F.col(value)
    puts = (v < 3) & (v != 0)
    at = F.col(order)
    measures: dict[str, tuple[str, Column]] = {
        "__clear": ("max", F.when(v == 0, at)),
        "__remove": ("max", F.when(v >= 3, at)),
        "__unknown": ("max", F.when(puts & ~v.isin(*tracked), at)),
    }
    for t in tracked:
        measures[f"__put_{t}"] = ("max", F.when(v == t, at))
    seen = running(df, keys, [order], measures, inclusive=False, skew=skew)

    def alive(t: int) -> Column:
        put = F.col(f"__put_{t}")
        kept = put.isNotNull() & (F.col("__clear").isNull() | (put > F.col("__clear")))
        if t == 1:
            kept = kept & (F.col("__remove").isNull() | (put > F.col("__remove")))
        return kept

    entry = [
        F.when(alive(t), F.struct(F.lit(f"state-{t}").alias("key"), F.lit(t).cast("bigint").alias("value")))
        for t in tracked
    ]
    entries = F.map_from_entries(F.filter(F.array(*entry), lambda e: e.isNotNull()))
    unknown = F.raise_error(F.lit("a put value is missing from tracked")).cast("map<string,bigint>")
    return seen.withColumn("entries", F.when(F.col("__unknown").isNotNull(), unknown).otherwise(entries)).select(
        *df.columns, "entries"
    )


def multimap_entries(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    order: Sequence[str],
    value: str,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Before each put of ``state-<value>``: how many entries the window's multimap already holds."""
    counted = backlog(df, keys, ts, size, order, "entries", skew)
    return counted.withColumn("state_key", F.concat(F.lit("state-"), F.col(value).cast("string")))


def multimap_contents(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    order: Sequence[str],
    value: str,
    after: str,
    page_rows: int = 100_000,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """The entries of each window's multimap whenever somebody looks: ``(keys, window_start, kind, at, state_key, seen,
    page, entries)``.

    Every row puts its value under ``state-<value>``. A ``put`` sees what was there before it, a ``timer``, set anew by
    every put of its state key and due ``after`` later, what is there when it goes off, if the window is still open, and
    ``expiry`` all of it at the window's end. ``seen`` is how many entries that is. They come in the order of arrival
    (``ts``, then ``order``, unique per key) as arrays of (state_key, value), in pages of ``page_rows``: whoever looks meets the
    window's pages by an equi join on the page number and cuts the last, so no array grows with the window. An empty
    multimap is one empty page. Rows without a time take no part.
    """
    keys, order = list(keys), list(order)
    placed = window_meta(fixed_window(df, ts, size)).drop("window_time")
    grouped = [*keys, "window_start"]
    state_key = F.concat(F.lit("state-"), F.col(value).cast("string"))
    put = positions(placed, grouped, [ts, *order], "__at", skew)
    put = written(put.select(*grouped, "window_end", ts, *order, F.col(value), state_key.alias("state_key"), "__at"), "puts")

    page = F.floor(F.col("__at") / page_rows)
    entry = F.struct("__at", "state_key", F.col(value).alias("value"))
    pages = put.groupBy(*grouped, page.alias("page")).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    pages = pages.withColumn("entries", F.transform("entries", lambda e: F.struct(e["state_key"], e["value"])))

    fires = idle_fires(put.drop("__at"), [*grouped, "state_key"], ts, order, after, skew).where("fired_at < window_end")
    marks = written(fires.select(*grouped, "state_key", F.col("fired_at").alias("__time"), F.lit(0).alias("__row")), "fires")
    rows = put.select(*grouped, "state_key", F.col(ts).alias("__time"), F.lit(1).alias("__row"))
    looks = running(rows.unionByName(marks), grouped, ["__time", "__row", "state_key"], {"seen": ("sum", F.col("__row"))}, skew=skew)
    timers = looks.where("__row = 0").select(*grouped, F.lit("timer").alias("kind"), F.col("__time").alias("at"), "state_key", "seen")
    puts = put.select(*grouped, F.lit("put").alias("kind"), F.col(ts).alias("at"), "state_key", F.col("__at").alias("seen"))
    ends = put.groupBy(*grouped, "window_end").agg(F.count("*").alias("seen"))
    expiry = ends.select(*grouped, F.lit("expiry").alias("kind"), F.col("window_end").alias("at"), F.lit(None).cast("string").alias("state_key"), "seen")
    lookers = puts.unionByName(timers).unionByName(expiry)

    last = F.greatest(F.lit(0).cast("bigint"), F.floor((F.col("seen") - 1) / page_rows))
    wanted = lookers.withColumn("page", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    names = [f"__key{i}" for i in range(len(grouped))]
    side = pages.select(*[F.col(k).alias(n) for k, n in zip(grouped, names)], F.col("page").alias("__page"), "entries")
    match = F.col("page") == F.col("__page")
    for key, name in zip(grouped, names):
        match = match & F.col(key).eqNullSafe(F.col(name))
    cut = F.slice("entries", F.lit(1), F.least(F.lit(page_rows).cast("bigint"), F.col("seen") - F.col("page") * page_rows).cast("int"))
    return wanted.join(side, match).select(*grouped, "kind", "at", "state_key", "seen", "page", cut.alias("entries"))


def multimap_at_expiry(df: DataFrame, keys: Sequence[str], ts: str, size: str, value: str) -> DataFrame:
    """What the multimap holds when its window expires: per state key the number of its values."""
    placed = window_meta(fixed_window(df, ts, size)).drop("window_end", "window_time")
    return placed.groupBy(
        *keys, "window_start", F.concat(F.lit("state-"), F.col(value).cast("string")).alias("state_key")
    ).agg(F.count(F.lit(1)).alias("values"))


def idle_fires(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], after: str, skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    """When a timer that every row of its key sets anew goes off: the last row before each pause longer than ``after``,
    with ``fired_at`` and ``backlog``, the rows of the key so far.

    ``order`` is the unique order of arrival, in which ``ts`` does not fall. A row that comes just when the timer is
    due moves it. With an element id among the keys this is a family of independent timers. Each row meets the next
    one of its key by an equi join on its position, so a hot key is no single task.
    """
    placed = positions(df, keys, order, "__at", skew)
    names = [f"__key{i}" for i in range(len(keys))]
    following = placed.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("__at").alias("__next"), F.col(ts).alias("__next_ts"))
    match = F.col("__at") + 1 == F.col("__next")
    for key, name in zip(keys, names):
        match = match & F.col(key).eqNullSafe(F.col(name))
    due = F.col(ts) + F.expr(f"INTERVAL {after}")
    alone = placed.join(following, match, "left").where(F.col("__next_ts").isNull() | (F.col("__next_ts") > due))
    return alone.select(*df.columns, due.alias("fired_at"), (F.col("__at") + 1).alias("backlog"))


def growing_output(
    df: DataFrame, keys: Sequence[str], pane: str, name: str = "copy", skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    """The i-th pane of a key emits i rows, numbered from 1. Rows are first combined to panes."""
    fired = df.select(*keys, pane).distinct()
    placed = positions(fired, keys, [pane], "__at", skew)
    numbered = placed.withColumn(name, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__at") + 1)))
    return numbered.withColumnRenamed("__at", "index")
