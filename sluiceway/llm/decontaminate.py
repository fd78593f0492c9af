"""Benchmark passages in training documents, by winnowed word fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import wordhash
from sluiceway.llm.arrow import released, saved, slices, utf8

WINDOW = 13
GRAM = 8
#: Fingerprints of the benchmark mark one of so many bits; the bitmap has this size whatever the benchmark's.
FILTER_BITS = 23
_ROW = "array<struct<fp:long,size:int,at:int,before:array<string>,same:string,after:array<string>>>"


def _selected(hashes: np.ndarray, first: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Winnowing: of the gram hashes in every run of ``window`` words the least (the last of equal ones)."""
    run = window - gram + 1
    grams = wordhash.gram_hashes(hashes, gram)
    if len(grams) < run:
        return np.zeros(0, np.int64)
    whole = np.flatnonzero(wordhash.inside_text(first, len(grams) - run + 1, window))
    if not len(whole):
        return whole
    views = np.lib.stride_tricks.sliding_window_view(grams, run)[whole, ::-1]
    return np.unique(whole + run - 1 - views.argmin(axis=1))


def _found(column: pa.Array, window: int, gram: int, shorter: list[int], marks: np.ndarray | None, own_size: bool) -> Iterator[tuple[int, list[dict]]]:
    """Per text its number of words and its fingerprints with the words around them.

    shorter: sizes below the window that count as windows too. marks: keep only fingerprints whose bit is set.
    own_size: of a text below the window take the one gram of all its words.
    """
    for lo, hi in slices(column):
        part = column.slice(lo, hi - lo)
        data, offsets = utf8(part)
        data = wordhash.LOWERED[data]
        starts, ends, first = wordhash.words(data, offsets)
        hashes = wordhash.word_hashes(data, starts, ends)
        counts = np.diff(first)
        picked: list[tuple[np.ndarray, np.ndarray, int]] = []
        at = _selected(hashes, first, window, gram)
        picked.append((at, wordhash.gram_hashes(hashes, gram)[at] if len(at) else np.zeros(0, np.uint64), gram))
        for size in np.unique(counts[(counts > 0) & (counts < window)]).tolist() if own_size else shorter:
            grams = wordhash.gram_hashes(hashes, size)
            at = np.flatnonzero(wordhash.inside_text(first, len(grams), size)) if len(grams) else np.zeros(0, np.int64)
            if own_size:
                at = at[counts[np.searchsorted(first, at, "right") - 1] == size]
            picked.append((at, wordhash.mixed(grams[at] ^ np.uint64(size << 8)), -size))
        out: list[list[dict]] = [[] for _ in range(len(part))]
        for at, fps, size in picked:
            if marks is not None and len(at):
                bit = (fps >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                keep = (marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                at, fps = at[keep], fps[keep]
            docs = np.searchsorted(first, at, "right") - 1
            reach = window - gram if size > 0 else 0
            for p, h, d in zip(at.tolist(), fps.view(np.int64).tolist(), docs.tolist()):
                lo_w, hi_w = max(int(first[d]), p - reach), min(int(first[d + 1]), p + abs(size) + reach)
                said = [data[starts[i] : ends[i]].tobytes().decode() for i in range(lo_w, hi_w)]
                a, b = p - lo_w, p - lo_w + abs(size)
                out[d].append({"fp": h, "size": size, "at": p - int(first[d]), "before": said[:a][::-1], "same": " ".join(said[a:b]), "after": said[b:]})
        yield from zip(counts.tolist(), out)


def fingerprints(text: Column, window: int, gram: int, shorter: list[int], marks: np.ndarray | None, own_size: bool = False) -> Column:
    kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("fp", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("before", pa.list_(pa.string())), ("same", pa.string()), ("after", pa.list_(pa.string()))])))])

    def each(column: pa.Array) -> pa.Array:
        found = [{"n_words": n, "hits": hits} for n, hits in _found(column, window, gram, shorter, marks, own_size)]
        released()
        return pa.array(found, kind)

    each.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(each, f"struct<n_words:long,hits:{_ROW}>").asNondeterministic()(text)


def _marks(items: DataFrame) -> np.ndarray:
    """One bit for every fingerprint of the benchmark: 2**FILTER_BITS bits, 1 MB, however large the benchmark is."""
    bits = items.select(F.shiftrightunsigned("fp", 64 - FILTER_BITS).alias("bit"))
    words = bits.select(F.expr("bit >> 5").alias("word"), F.expr("shiftleft(1L, int(bit & 31))").alias("mask"))
    rows = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 5), "<u4")
    out[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64)
    return out.view(np.uint8)


def _extend(window: int):
    """Joined fingerprints to the document's words that lie in a common window: ``[start, stop)`` per item."""

    def along(a, b) -> int:
        n = 0
        for x, y in zip(a, b):
            if x != y:
                break
            n += 1
        return n

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            kept = []
            for r in rows.itertuples(index=False):
                if r.same != r.item_same:
                    continue
                left, right = along(r.before, r.item_before), along(r.after, r.item_after)
                length = left + abs(r.size) + right
                if r.size < 0 or length >= window:
                    kept.append((r.id, r.text_key, r.at - left, r.at + abs(r.size) + right, r.item_id))
            yield pd.DataFrame(kept, columns=["id", "text_key", "start", "stop", "item_id"])

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", window: int = WINDOW, gram: int = GRAM, share: int = 20,
) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    Words are runs of digits, letters a-z (after lower-casing A-Z) and characters beyond ASCII. ``window`` successive
    words of an item are a window, an item with fewer is one as a whole. A word of a document is hit if it lies in an
    occurrence of a window; contaminated means some hits, and at least one word in ``share``.

    Method: both sides keep the least ``gram``-word hash of every ``window`` words, so a common window always has a
    common fingerprint. A bitmap of fixed size drops most others where they arise, the rest is joined and extended
    word by word, which decides. Null texts have no words, an item without words has no window, an item with a null
    id makes hits but is not listed, items that share an id are one. Rows are told apart by id and text; repeated
    rows stay repeated. Other columns are not read. Empty tables give no rows, or no hits.
    """
    parts = benchmark.select(F.col(item_col).cast("string").alias("item_id"), fingerprints(F.col(item_text), window, gram, [], None, own_size=True).alias("f"))
    items = saved(parts.select("item_id", F.inline("f.hits")).distinct(), "benchmark")
    shorter = [-r[0] for r in items.where("size < 0").select("size").distinct().collect()]  # below the window each
    looked = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col, F.length(text_col)).alias("text_key"),
        fingerprints(F.col(text_col), window, gram, sorted(shorter), _marks(items)).alias("f"),
    )
    looked = saved(looked.select("id", "text_key", "f.*"), "hits")
    sides = items.select("fp", "size", "item_id", F.col("before").alias("item_before"), F.col("same").alias("item_same"), F.col("after").alias("item_after"))
    pairs = looked.select("id", "text_key", F.inline("hits")).join(sides, ["fp", "size"])
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in looked.schema if f.name in ("id", "text_key"))
    spans = pairs.drop("fp").mapInPandas(_extend(window), f"{kind}, start int, stop int, item_id string")
    hits = spans.groupBy("id", "text_key").agg(
        F.size(F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("start", "stop")), lambda s: F.sequence(s["start"], s["stop"] - 1))))).cast("long").alias("n_hit"),
        F.collect_set("item_id").alias("items"),
    )
    same = looked["id"].eqNullSafe(hits["id"]) & (looked["text_key"] == hits["text_key"])
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return looked.join(hits, same, "left").select(
        looked["id"].alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items_of), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
