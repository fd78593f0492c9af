"""Hard negatives by threshold joins over an inverted index (after L2AP).

Of a chunk of rows, only the leading dimensions of a vector are in the index: those after them are left out once the
norm of the rest, times the largest such norm of any anchor, cannot reach the least threshold. Scores accumulate
dimension by dimension; a pair goes when what it has and the product of the remaining norms stay below its anchor's
threshold. Thresholds start high and are lowered for the anchors whose windows are not full yet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.arrow import saved

#: Anchors of one pass over the table, all that a pass broadcasts.
ANCHOR_BLOCK = 8_192
#: Rows that are indexed at a time, and anchors that probe them at a time.
CHUNK = 4_096
PROBES = 256
#: Dimensions of one step of accumulation.
STEP = 8
#: A pair list takes over from the accumulators once so small a share of the pairs is left.
SPARSE = 0.05
#: How far down its window a threshold starts, and where it goes then.
LEVELS = (0.25, 0.5, 1.0)
_EXACT = 1 << 53
#: Bounds are wider by this, so that rounding loses no pair.
_SLACK = 1e-9


def _norms(values: np.ndarray) -> np.ndarray:
    """Norms of what is left after each step of dimensions: column j of what follows the first j steps."""
    steps = -(-values.shape[1] // STEP)
    out = np.zeros((len(values), steps + 1))
    for j in reversed(range(steps)):
        out[:, j] = np.sqrt(out[:, j + 1] ** 2 + (values[:, j * STEP : (j + 1) * STEP] ** 2).sum(axis=1))
    return out


class Index:
    """Inverted index over a chunk: per step of dimensions the rows that have it, longest lists first."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray, probe_norms: np.ndarray, least: float):
        values = vectors[:, order].astype(np.float64)
        norms = _norms(values)
        reach = norms * probe_norms.max(axis=0, initial=0.0)[None, :]
        steps = norms.shape[1] - 1
        # A row keeps its dimensions up to the first step after which the rest cannot reach the least threshold.
        covered = reach * (1 + _SLACK) < least
        depth = np.where(covered.any(axis=1), covered.argmax(axis=1), steps)
        self.rows = np.argsort(-depth, kind="stable")
        depth = depth[self.rows]
        self.norms = norms[self.rows]
        self.exact = vectors[self.rows]
        self.lists = []
        for j in range(steps):
            n = int(np.searchsorted(-depth, -j, "left"))  # rows deeper than j
            self.lists.append(np.ascontiguousarray(values[self.rows[:n], j * STEP : (j + 1) * STEP].T))

    def probe(self, anchors: np.ndarray, order: np.ndarray, norms: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (anchor, row, score) whose score reaches the anchor's threshold."""
        values = anchors[:, order].astype(np.float64)
        live = np.arange(len(anchors))  # anchors that still have a row in play
        partial = np.zeros((len(anchors), len(self.rows)))
        need = thresholds[:, None] - _SLACK
        norms = norms * (1 + _SLACK)
        alive = norms[:, :1] * self.norms[None, :, 0] >= need
        for j, listed in enumerate(self.lists):
            if not len(live):
                break
            n = listed.shape[1]
            if not n:
                break
            partial[:, :n] += values[live, j * STEP : (j + 1) * STEP] @ listed
            # A row that has left the lists keeps what was decided with all of its rest.
            alive[:, :n] &= partial[:, :n] + norms[live, j + 1 : j + 2] * self.norms[None, :n, j + 1] >= need[live]
            some = alive.any(axis=1)
            if not some.all():
                live, partial, alive = live[some], partial[some], alive[some]
            if np.count_nonzero(alive) <= SPARSE * alive.size:
                break
        a, row = np.nonzero(alive)
        a = live[a]
        score = np.empty(len(a), np.int64)
        for lo in range(0, len(a), 1 << 16):
            hi = lo + (1 << 16)
            score[lo:hi] = (anchors[a[lo:hi]] * self.exact[row[lo:hi]]).sum(axis=1)
        enough = score >= thresholds[a]
        return a[enough], self.rows[row[enough]], score[enough]


class Windows:
    """Per anchor, windows of scores ``low`` to ``high``; each keeps its first ``k`` rows, by score and then by id."""

    def __init__(self, anchors: np.ndarray, own: np.ndarray, labels: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.anchors, self.own, self.labels, self.k, self.same = anchors, own, labels, k, same
        self.at, self.low, self.high = at, low.astype(np.float64), high.astype(np.float64)
        self.best: list[list[tuple[int, int]]] = [[] for _ in at]  # (-score, id), ascending
        self.order = np.argsort(-(anchors.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.norms = _norms(anchors[:, self.order].astype(np.float64))

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Rows of the chunk that are wholly equal count once."""
        key = np.lexsort((ids, labels, *vectors.T[::-1]))
        ids, labels, vectors = ids[key], labels[key], vectors[key]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
        ids, labels, vectors = ids[new], labels[new], vectors[new]
        top = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)))
        bound = self.norms[self.at, 0] * top + 1
        for w, best in enumerate(self.best):  # what later rows must reach
            if len(best) == self.k:
                self.low[w] = max(self.low[w], -best[-1][0])
        floor = np.maximum(self.low, -bound)
        ceiling = np.minimum(self.high, bound)
        open_ = floor <= ceiling
        for level in LEVELS:
            w = np.flatnonzero(open_)
            if not len(w):
                break
            threshold = np.floor(ceiling[w] - level * (ceiling[w] - floor[w])) if level < 1 else floor[w]
            per_anchor = np.full(len(self.anchors), np.inf)
            np.minimum.at(per_anchor, self.at[w], threshold)
            asked = np.flatnonzero(np.isfinite(per_anchor))
            index = Index(vectors, self.order, self.norms[asked], float(per_anchor[asked].min()))
            for lo in range(0, len(asked), PROBES):
                some = asked[lo : lo + PROBES]
                a, row, score = index.probe(self.anchors[some], self.order, self.norms[some], per_anchor[some])
                a = some[a]
                fits = ((labels[row] == self.labels[a]) == self.same) & (ids[row] != self.own[a])
                self._offer(w, a[fits], ids[row[fits]], score[fits])
            for i, t in zip(w.tolist(), threshold.tolist()):
                best = self.best[i]
                if len(best) == self.k and -best[-1][0] >= t:  # nothing below the threshold can come before these
                    open_[i] = False

    def _offer(self, windows: np.ndarray, a: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        by = np.lexsort((ids, -score, a))
        a, ids, score = a[by], ids[by], score[by]
        starts, stops = np.searchsorted(a, self.at[windows], "left"), np.searchsorted(a, self.at[windows], "right")
        for w, lo, hi in zip(windows.tolist(), starts.tolist(), stops.tolist()):
            if lo == hi:
                continue
            inside = -score[lo:hi]  # ascending
            first = lo + int(np.searchsorted(inside, -self.high[w], "left"))
            last = lo + int(np.searchsorted(inside, -self.low[w], "right"))
            got = set(self.best[w])
            for s, i in zip(score[first:last].tolist(), ids[first:last].tolist()):
                if len(got) >= self.k and (-s, i) > max(got):
                    break
                got.add((-s, i))
                if len(got) > self.k:
                    got.discard(max(got))
            self.best[w] = sorted(got)


def _matcher(blocks: dict[int, dict[str, np.ndarray]], k: int, same: bool):
    """Search windows of the broadcast anchors (by dimension) among all rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {
            dim: Windows(b["vectors"], b["ids"], b["labels"], b["at"], b["low"], b["high"], k, same) for dim, b in blocks.items()
        }
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo in range(0, len(batch), CHUNK):
                part = batch.column(2).slice(lo, CHUNK)
                length = part.value_lengths().to_numpy(zero_copy_only=False)
                flat, ends = part.flatten().to_numpy(zero_copy_only=False), np.cumsum(length)
                for dim, windows in found.items():
                    mine = np.flatnonzero(length == dim)
                    if len(mine):
                        vectors = flat[(ends[mine] - dim)[:, None] + np.arange(dim)[None, :]]
                        windows.add(ids[lo + mine], labels[lo + mine], vectors.astype(np.int64))
        for dim, windows in found.items():
            names = blocks[dim]["window"]
            rows = [(int(names[w]), i, -s) for w, best in enumerate(windows.best) for s, i in best]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["window", "row_id", "score"])

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("window").orderBy(F.desc("score"), "row_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _blocks(windows, ids, labels, vectors, at, low, high) -> dict[int, dict[str, np.ndarray]]:
    """Anchors and windows by dimension."""
    out = {}
    length = np.array([len(v) for v in vectors])
    for dim in np.unique(length):
        mine = np.flatnonzero(length == dim)
        new = np.full(len(ids), -1)
        new[mine] = np.arange(len(mine))
        of = np.flatnonzero(new[at] >= 0)
        if len(of):
            out[int(dim)] = {
                "vectors": np.stack([np.asarray(vectors[i], np.int64) for i in mine]), "ids": ids[mine], "labels": labels[mine],
                "window": windows[of], "at": new[at[of]], "low": low[of], "high": high[of],
            }
    return out


def mine(
    vectors: DataFrame, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 5, share: int = 80, every: int = 100, scale: int = 256, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``, the score is the integer inner product, ties go to the smaller id. Anchors
    are the rows whose id ``every`` divides; an anchor's positives are its first other rows of the same label, and the
    negatives of a positive the first rows of another label that score at least ``share`` percent of the positive and
    at most as much. ``label`` replaces the label column where given.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part; rows of
    different dimensions have no score. Rows of the anchor's id are never its results; wholly equal rows count once.
    A positive with a negative score has no window, one with score 0 takes negatives of score 0. Other columns are not
    read. Scores are exact while squared norms stay below 2**53; larger vectors are refused. No anchor, no rows.

    A pass over the table serves ``anchor_block`` anchors, first for their positives and then for the negatives.
    """
    spark = vectors.sparkSession
    whole = F.transform(vector_col, lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")))
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    named = (F.col(label_col) if label is None else label).cast("long")
    usable = vectors.where(F.col(id_col).isNotNull() & named.isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    length = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    sized = F.when(length < float(_EXACT), F.col("v")).otherwise(F.raise_error(F.lit("a vector is too long for exact scores")).cast("array<bigint>"))
    cells = usable.select(F.col(id_col).cast("long").alias("id"), named.alias("label"), whole.alias("v")).withColumn("v", sized)
    anchors = saved(cells.where(F.col("id") % every == 0).distinct(), "anchors")
    parts = -(-anchors.count() // anchor_block)
    out = None
    for part in range(parts):
        some = anchors.where(F.pmod(F.xxhash64("id", "label", "v"), F.lit(parts)) == part).toPandas()
        some = some.sort_values(["id", "label"], kind="stable")
        if not len(some):
            continue
        ids, labels, rows = some["id"].to_numpy(), some["label"].to_numpy(), list(some["v"])
        n = len(ids)
        free = np.full(n, -np.inf), np.full(n, np.inf)
        blocks = _blocks(np.arange(n), ids, labels, rows, np.arange(n), *free)
        near = cells.mapInArrow(_matcher(blocks, positives, True), "window long, row_id long, score long")
        near = _first(near, positives).toPandas().sort_values(["window", "rank"])  # at most ``positives`` per anchor of the block
        near = near[near["score"] >= 0]
        if not len(near):
            continue
        at, score = near["window"].to_numpy(), near["score"].to_numpy()
        low = -((-share * score) // 100)  # the least whole number of at least that share
        blocks = _blocks(np.arange(len(at)), ids, labels, rows, at, low, score)
        hard = _first(cells.mapInArrow(_matcher(blocks, negatives, False), "window long, row_id long, score long"), negatives)
        told = spark.createDataFrame(
            [(int(w), int(ids[a]), int(p), int(s)) for w, (a, p, s) in enumerate(zip(at, near["row_id"], score))],
            "window long, anchor_id long, positive_id long, positive_score long",
        )
        pairs = hard.join(told, "window").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
        pairs = saved(pairs, "negatives") if parts > 1 else pairs
        out = pairs if out is None else out.unionByName(pairs)
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame([], empty) if out is None else out
