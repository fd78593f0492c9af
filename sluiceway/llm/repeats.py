"""Removal of long byte strings that occur more than once in a corpus, by run-length indexes."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import rindex
from sluiceway.llm.arrow import saved, slices, utf8
from sluiceway.llm.wordhash import mixed

LENGTH = 400
#: Bytes of an anchor.
GRAM = 16
#: Bytes of one index; a shard takes whole groups of contexts up to it. Sorting is cheapest while they fit a core's cache.
SHARD_BYTES = 256 << 10
#: Contexts of one anchor that share an index; more are cut into blocks of windows.
GROUP_LIMIT = 1_024
BLOCK = 16
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_MARK = "array<struct<anchor:long,ctx:long,spans:array<int>>>"


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from every position on."""
    h = data.astype(np.uint64) + np.uint64(1)
    for i, step in enumerate(_STEPS):
        h = h[: -(1 << i)] * step + h[1 << i :] if len(h) > 1 << i else h[:0]
        h ^= h >> np.uint64(29)
    return mixed(h)


def windows(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """All windows of ``length`` bytes, in runs that share their anchor: the first least 16-byte hash in the window.

    Text, first and last start of each run, the anchor's hash and its place. Equal windows have equal anchors.
    """
    span = length - GRAM + 1
    grams = _grams(data)
    n = len(grams) - span + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.astype(np.uint64), none
    bits = np.uint64(32)  # of places; the same in every slice, or equal windows might choose otherwise
    low = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    whole = np.zeros(n + 1, np.int64)
    begin = np.minimum(offsets[:-1], n)
    stop = np.minimum(np.maximum(offsets[1:] - length + 1, offsets[:-1]), n)
    np.add.at(whole, begin, 1)
    np.add.at(whole, stop, -1)
    starts = np.flatnonzero(np.cumsum(whole[:-1]) > 0)
    if not len(starts):
        return none, none, none, none.astype(np.uint64), none
    at = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(new)
    first, last = starts[heads], starts[np.append(heads[1:], len(starts)) - 1]
    return np.searchsorted(offsets, first, "right") - 1, first, last, grams[at[heads]], at[heads]


def _runs(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, list[tuple[int, int, int, int]]]]:
    """Per text: its bytes, and its runs as (anchor, context hash, first start, number of starts)."""
    for lo, hi in slices(column):
        data, offsets = utf8(column.slice(lo, hi - lo))
        text, first, last, anchors, _ = windows(data, offsets, length)
        view, digest = memoryview(np.ascontiguousarray(data)), xxhash.xxh3_64_intdigest
        hashes = np.fromiter((digest(view[a : b + length]) for a, b in zip(first.tolist(), last.tolist())), np.uint64, len(first)).view(np.int64).tolist()
        anchors = anchors.view(np.int64).tolist()
        bounds = np.searchsorted(text, np.arange(hi - lo + 1))
        firsts, counts = (first - offsets[text]).tolist() if len(text) else [], (last - first + 1).tolist()
        for i in range(hi - lo):
            a, b = bounds[i], bounds[i + 1]
            yield lo + i, data[offsets[i] : offsets[i + 1]], list(zip(anchors[a:b], hashes[a:b], firsts[a:b], counts[a:b]))


def _signatures(length: int):
    schema = pa.schema([(n, pa.int64()) for n in ("row", "anchor", "ctx", "n")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = batch.column(0).to_pylist(), []
            for i, _, runs in _runs(batch.column(1), length):
                out += [(rows[i], anchor, ctx, n) for (anchor, ctx), n in Counter((a, c) for a, c, _, _ in runs).items()]
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return run


def _contexts(length: int):
    """Documents with the contexts asked of them to those contexts' bytes: all windows of a run."""
    schema = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("weight", pa.int64()), ("kinds", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1)
            out = []
            for i, data, runs in _runs(batch.column(0), length):
                asked = {(w["anchor"], w["ctx"]): w for w in wanted[i].as_py()}
                for anchor, ctx, first, n in runs:
                    if w := asked.pop((anchor, ctx), None):
                        out.append({**w, "bytes": data[first : first + n - 1 + length].tobytes()})
                if len(out) > 5_000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _spans(marked: np.ndarray) -> list[int]:
    """First and last of every run of marks, flat."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    edges[1::2] -= 1
    return edges.tolist()


def shard_marks(contexts: list[bytes], weights: list[int], length: int) -> list[list[int]]:
    """Per context the spans of window starts whose window occurs again, in the shard or by the context's own weight."""
    index, begin = rindex.build(contexts, length)
    reach = index.matching_statistics()
    out = []
    for at, data, weight in zip(begin.tolist(), contexts, weights):
        n = len(data) - length + 1
        out.append([0, n - 1] if weight > 1 else _spans(reach[at : at + n] >= length))
    return out


def _index(length: int, shard_bytes: int):
    schema = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("spans", pa.list_(pa.int32()))])

    def marks(rows: list[tuple]) -> pa.RecordBatch:
        spans = shard_marks([r[3] for r in rows], [r[2] for r in rows], length)
        kept = [(r[0], r[1], s) for r, s in zip(rows, spans) if s]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), schema.types)] if kept else [pa.array([], t) for t in schema.types], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held >= shard_bytes and row[0] != rows[-1][0]:
                    yield marks(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3])
        if rows:
            yield marks(rows)

    return run


def _blocks(length: int):
    """Contexts to blocks of up to ``BLOCK`` window starts, cut at fixed distances from the anchor. All windows of a
    block contain its probe, so equal windows have equal probes."""
    schema = pa.schema([(n, pa.int64()) for n in ("anchor", "ctx", "at", "n", "probe", "block", "weight")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, ctx, weight, data in zip(*(c.to_pylist() for c in batch.columns)):
                flat = np.frombuffer(data, np.uint8)
                place = int(windows(flat, np.array([0, len(flat)]), length)[4][0])
                starts = len(data) - length + 1
                at = 0
                while at < starts:
                    n = min(starts - at, BLOCK - (at - place) % BLOCK)
                    # The probe of a whole block: one that is cut off at an end of the context has the same.
                    last = at + BLOCK - 1 - (at - place) % BLOCK
                    probe = data[last : last - BLOCK + 1 + length]
                    out.append((anchor, ctx, at, n, _hash64(probe), _hash64(data[at : at + n - 1 + length]), weight))
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 7, schema=schema)

    return run


def _hash64(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _windows_of_blocks(length: int):
    schema = pa.schema([(n, pa.int64()) for n in ("probe", "block", "off", "said", "weight")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                for w in wanted:
                    out += [(w["probe"], w["block"], i, _hash64(data[w["at"] + i : w["at"] + i + length]), w["weight"]) for i in range(w["n"])]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5, schema=schema)

    return run


def crowded_marks(contexts: DataFrame, length: int) -> DataFrame:
    """``(anchor, ctx, spans)`` for anchors with too many contexts for one index: ``contexts`` has their bytes.

    The same idea once more, on blocks: a probe that one block has alone has no partner, equal blocks are repeats as
    they are, and only of different blocks with one probe each window is counted by its hash.
    """
    blocks = saved(contexts.mapInArrow(_blocks(length), "anchor long, ctx long, at long, n long, probe long, block long, weight long"), "blocks")
    rep = F.min(F.struct("anchor", "ctx", "at", "n")).alias("rep")
    kinds = saved(blocks.groupBy("probe", "block").agg(F.sum("weight").alias("weight"), rep), "kinds")
    sizes = saved(kinds.groupBy("probe").agg(F.count("*").alias("kinds")).where("kinds > 1").drop("kinds"), "probes")
    asked = kinds.join(sizes, "probe").select("probe", "block", "weight", "rep.*")
    asked = asked.groupBy("anchor", "ctx").agg(F.collect_list(F.struct("probe", "block", "weight", "at", "n")).alias("wanted"))
    each = contexts.join(asked, ["anchor", "ctx"]).select("bytes", "wanted")
    each = saved(each.mapInArrow(_windows_of_blocks(length), "probe long, block long, off long, said long, weight long"), "windows")
    again = saved(each.groupBy("probe", "said").agg(F.sum("weight").alias("w")).where("w > 1").drop("w"), "again")
    found = each.join(again, ["probe", "said"]).groupBy("probe", "block").agg(F.collect_set("off").alias("off"))
    whole = kinds.where("weight > 1").select("probe", "block", F.lit(True).alias("whole"))
    marks = saved(whole.join(found, ["probe", "block"], "full"), "block marks")
    starts = F.when(F.col("whole"), F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).otherwise(F.col("off"))
    rows = blocks.join(marks, ["probe", "block"]).select("anchor", "ctx", F.transform(starts, lambda s: (s + F.col("at")).cast("int")).alias("starts"))
    pairs = F.flatten(F.transform(F.array_sort(F.flatten(F.collect_list("starts"))), lambda s: F.array(s, s)))
    return rows.groupBy("anchor", "ctx").agg(pairs.alias("spans"))


def _removed(length: int):
    def each(texts: pa.Array, marks: pa.Array) -> pa.Array:
        out = [None] * len(texts)
        plain = marks.is_null().to_pylist()
        there = [i for i, none in enumerate(plain) if not none]
        for i, none in enumerate(plain):
            if none:
                data = (texts[i].as_py() or "").encode()
                out[i] = {"n_bytes": len(data), "n_removed": 0, "n_spans": 0, "kept_sha256": hashlib.sha256(data).hexdigest(), "spans": []}
        for j, data, runs in _runs(texts.take(pa.array(there, pa.int64())), length):
            spans = {(m["anchor"], m["ctx"]): m["spans"] for m in marks[there[j]].as_py()}
            edges = np.zeros(len(data) + 1, np.int64)
            for anchor, ctx, first, n in runs:
                if (anchor, ctx) in spans:
                    mine = spans[anchor, ctx] or [0, n - 1]
                    for a, b in zip(mine[::2], mine[1::2]):
                        edges[first + a] += 1
                        edges[first + b + length] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            runs_gone = _spans(gone)
            out[there[j]] = {
                "n_bytes": len(data), "n_removed": int(gone.sum()), "n_spans": len(runs_gone) // 2,
                "kept_sha256": hashlib.sha256(data[~gone].tobytes()).hexdigest(), "spans": runs_gone,
            }
        kind = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int32()))]
        return pa.array(out, pa.struct(kind))

    each.__annotations__ = {"texts": pa.Array, "marks": pa.Array, "return": pa.Array}
    return F.arrow_udf(each, "struct<n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string,spans:array<int>>")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_bytes: int = SHARD_BYTES, group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and ``spans``: first and last byte of every
    removed run, flat.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else in the table, the same text included;
    matches lie within texts, overlap, and are judged on the input.

    Method: windows with one anchor form a run, whose bytes are its context. Contexts whose anchor is unique have no
    partner; equal contexts are counted before they are shuffled. Where an anchor has several contexts, each distinct
    one goes once, with its count, to a shard with a run-length index, whose matching statistics mark the windows.
    An anchor with over ``group_limit`` contexts does not fit a shard: see ``crowded_marks``.
    Null and short texts lose nothing; repeated rows are each other's repeats; null ids are kept; other columns are
    not read; an empty table gives no rows.
    """
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), row.alias("row"), F.col(text_col).alias("text"))
    signatures = saved(rows.select("row", "text").mapInArrow(_signatures(length), "row long, anchor long, ctx long, n long"), "signatures")
    shared = signatures.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi"))
    shared = saved(shared.where("n > 1").select("anchor", (F.col("lo") == F.col("hi")).alias("one")), "anchors")
    # Kept anchors only; a frequent one is split by the join.
    seen = saved(signatures.join(shared, "anchor"), "candidates")
    kinds = seen.where("not one").groupBy("anchor", "ctx").agg(F.sum("n").alias("weight"), F.min("row").alias("row"))
    kinds = saved(kinds, "contexts")
    sizes = saved(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")), "sizes")
    asked = kinds.join(sizes, "anchor").groupBy("row").agg(F.collect_list(F.struct("anchor", "ctx", "weight", "kinds")).alias("wanted"))
    contexts = rows.join(asked, "row").select("text", "wanted").mapInArrow(_contexts(length), "anchor long, ctx long, weight long, kinds long, bytes binary")
    contexts = saved(contexts, "bytes")
    fits = contexts.where(F.col("kinds") <= group_limit).select("anchor", "ctx", "weight", "bytes")
    indexed = fits.repartition("anchor").sortWithinPartitions("anchor", "ctx").mapInArrow(_index(length, shard_bytes), "anchor long, ctx long, spans array<int>")
    counted = crowded_marks(contexts.where(F.col("kinds") > group_limit).select("anchor", "ctx", "weight", "bytes"), length)
    marks = saved(indexed.unionByName(counted), "marks")
    whole = seen.where("one").select("row", "anchor", "ctx", F.array().cast("array<int>").alias("spans"))
    partly = seen.where("not one").join(marks, ["anchor", "ctx"]).select("row", "anchor", "ctx", "spans")
    of_row = whole.unionByName(partly).groupBy("row").agg(F.collect_set(F.struct("anchor", "ctx", "spans")).alias("marks"))
    found = rows.join(of_row, "row", "left").select("id", _removed(length)("text", "marks").alias("r"))
    return found.select(F.col("id").alias(id_col), "r.*")
