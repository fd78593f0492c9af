"""Near-duplicate documents by SimHash fingerprints and BK-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.arrow import saved
from sluiceway.llm.components import components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BITS = 64
#: Fingerprints in one tree; a group with more is cut finer.
TREE_LIMIT = 2048
#: After six cuts 53 of 64 bits are fixed in a group, so it can't have more than 2**11 fingerprints.
MOST_CUTS = 6
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority of every bit over the XXH64 (seed 42) of all word shingles, unsigned. No words: 0."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return 0
    size = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    joined = b" ".join(words)
    starts = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(starts))
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BYTE_BITS).ravel()  # of bits 0 to 63
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long; null texts count as empty."""

    def each(column: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(t.as_py(), shingle) for t in column), np.uint64, len(column))
        return pa.array(found.view(np.int64))

    each.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(each, "long").asNondeterministic()(text)  # evaluated once where it stands


class BKTree:
    """Children hang on their parent by their integer Hamming distance to it."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.edges: list[dict[int, int]] = []

    def within(self, key: int, radius: int) -> list[int]:
        """Positions of the keys at most ``radius`` bits away: only edges that the triangle inequality allows are followed."""
        if not self.keys:
            return []
        found, stack = [], [0]
        keys, edges = self.keys, self.edges
        while stack:
            at = stack.pop()
            d = (keys[at] ^ key).bit_count()
            if d <= radius:
                found.append(at)
            children = edges[at]
            if len(children) <= 2 * radius + 1:
                stack += [child for edge, child in children.items() if d - radius <= edge <= d + radius]
            else:
                stack += [children[e] for e in range(max(1, d - radius), d + radius + 1) if e in children]
        return found

    def insert(self, key: int) -> None:
        """Keys must differ."""
        self.keys.append(key)
        self.edges.append({})
        new, at = len(self.keys) - 1, 0
        while new:
            d = (self.keys[at] ^ key).bit_count()
            if d not in self.edges[at]:
                self.edges[at][d] = new
                return
            at = self.edges[at][d]


def shard_links(keys: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between the keys: ``(key, smallest key it reaches inside the shard)``."""
    tree, parent = BKTree(), list(range(len(keys)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, key in enumerate(sorted(keys)):
        for j in tree.within(key, radius):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
        tree.insert(key)
    for i, key in enumerate(tree.keys):
        if (r := root(i)) != i:
            yield key, tree.keys[r]


def _cut(radius: int):
    """Rows ``(shard, fixed, fp)`` to ``radius + 1`` rows each: the free bits fall into that many blocks, of which two
    fingerprints within the radius share one, so they meet in the shard of that block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, fixed, fp = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            for mask in np.unique(fixed):
                rows = fixed == mask
                free = [b for b in range(BITS) if not int(mask) >> b & 1]
                for block in np.array_split(free, radius + 1):
                    bits = np.uint64(sum(1 << int(b) for b in block))
                    key = (shard[rows] ^ bits) * np.uint64(0x9E3779B97F4A7C15)
                    key = (key ^ (key >> np.uint64(29)) ^ (fp[rows] & bits)) * np.uint64(0xBF58476D1CE4E5B9)
                    key ^= key >> np.uint64(32)
                    masks = np.full(len(key), mask | bits, np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key, masks, fp[rows])], names=["shard", "fixed", "fp"])

    return run


def _trees(radius: int):
    """Sorted rows ``(shard, fp)`` to links ``(a, b)``, one tree per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys = None, []
        out: list[tuple[int, int]] = []
        for batch in batches:
            shards, fps = batch.column(0).to_pylist(), batch.column(1).to_numpy().view(np.uint64).tolist()
            for shard, fp in zip(shards, fps):
                if shard != now:
                    if len(keys) > 1:
                        out += shard_links(keys, radius)
                    now, keys = shard, []
                keys.append(fp)
            if out:
                yield _links(out)
                out = []
        if len(keys) > 1:
            out += shard_links(keys, radius)
        yield _links(out)

    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.uint64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, i]).view(np.int64)) for i in (0, 1)], names=["a", "b"])


def fingerprint_links(fingerprints: DataFrame, max_bits: int, tree_limit: int = TREE_LIMIT) -> DataFrame:
    """Links ``(a, b)`` that join all distinct ``fp`` at most ``max_bits`` apart, as a spanning forest of every shard.

    A shard holds the fingerprints that agree on one block of bits; a shard over ``tree_limit`` is cut again on its
    other bits, which loses no pair, until the bits left free bound it. Copies share a fingerprint and count once.
    """
    rows = fingerprints.select(F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("fixed"), "fp")
    links = None
    for cut in range(MOST_CUTS):
        rows = rows.mapInArrow(_cut(max_bits), "shard long, fixed long, fp long")
        if cut:
            rows = rows.distinct()
        rows = saved(rows, "shards")
        sizes = rows.groupBy("shard").agg(F.count("*").alias("n"))
        last = cut == MOST_CUTS - 1
        ready = rows.join(sizes.where(F.lit(last) | (F.col("n") <= tree_limit)).where("n > 1"), "shard")
        found = (
            ready.select("shard", "fp").repartition("shard").sortWithinPartitions("shard", "fp")
            .mapInArrow(_trees(max_bits), "a long, b long").distinct()
        )
        links = found if links is None else links.unionByName(found)
        if last:
            break
        large = sizes.where(F.col("n") > tree_limit)
        if large.isEmpty():
            break
        rows = rows.join(large.select("shard"), "shard", "left_semi")
    return links


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3,
    tree_limit: int = TREE_LIMIT,
) -> DataFrame:
    """Per row of ``docs``: the id column, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id that links of at most ``max_bits`` bits reach, the row's own included. Words
    are separated by ASCII white space and lower-cased A-Z; shingles repeat as often as they occur; a text of fewer
    words is one shingle, one without words (null and empty too) has fingerprint zero and links like any other.
    Null ids are never the smallest; a component of null ids only has a null. Repeated rows stay repeated rows. Of
    other columns none is read, whatever their names. An empty table gives an empty result.

    Method: equal fingerprints are one node; BK-trees over shards of nodes that agree on a block of bits are walked
    along the edges that the triangle inequality allows. A tree travels to the task of its shard by a shuffle, not
    through the driver, since all fingerprints must not meet there.
    """
    signed = saved(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")), "fingerprints"
    )
    nodes = signed.groupBy("fp").agg(F.min("id").alias("low"))
    roots = components(fingerprint_links(nodes.select("fp"), max_bits, tree_limit)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    label = rooted.join(lowest, "root").select("fp", "component_id")
    return signed.join(label, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
