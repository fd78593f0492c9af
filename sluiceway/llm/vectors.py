"""Exact top-k search by inner product with a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.arrow import saved

#: A cell is so many bits of a component wide: the approximation keeps the bits above.
CELL_BITS = 4
#: Queries of one pass over the table; they, and k results each per task, are what a pass broadcasts and holds.
QUERY_BLOCK = 16_384
#: Vectors whose bounds are computed at a time.
CHUNK = 4_096


class Nearest:
    """The best k so far of every query of a block: scores, and ids (smaller ids first among equal scores)."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), ascending
        self.positive = np.maximum(queries, 0).sum(axis=1)
        self.negative = np.minimum(queries, 0).sum(axis=1)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Equal vectors of the chunk are one cell entry with its k + 1 smallest ids (one may be the query's own)."""
        order = np.lexsort((ids, *vectors.T[::-1]))
        vectors, ids = vectors[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        once = new.copy()
        once[1:] |= ids[1:] != ids[:-1]
        vectors, ids, new = vectors[once], ids[once], new[once]
        at = np.flatnonzero(new)
        stops = np.append(at[1:], len(ids))
        distinct = vectors[at]
        cells = (distinct >> CELL_BITS) << CELL_BITS  # the low corner of each cell
        width = (1 << CELL_BITS) - 1
        step = max(1, (1 << 21) // max(1, len(at)))
        for lo in range(0, len(self.ids), step):
            hi = min(len(self.ids), lo + step)
            base = self.queries[lo:hi].astype(np.float64) @ cells.T.astype(np.float64)  # whole numbers far below 2**53
            upper = base + (width * self.positive[lo:hi])[:, None]
            lower = base + (width * self.negative[lo:hi])[:, None]
            for q in range(lo, hi):
                self._one(q, upper[q - lo], lower[q - lo], distinct, ids, at, stops)

    def _one(self, q, upper, lower, distinct, ids, at, stops) -> None:
        best, k, own = self.best[q], self.k, int(self.ids[q])
        enough = k + 1  # the query's own vector may be one of them
        sure = np.partition(lower, len(lower) - enough)[len(lower) - enough] if len(lower) >= enough else -np.inf
        if len(best) == k:
            sure = max(sure, -best[-1][0])
        near = np.flatnonzero(upper >= sure)
        near = near[np.argsort(-upper[near], kind="stable")]
        query = self.queries[q]
        for lo in range(0, len(near), 32):
            if len(best) == k and upper[near[lo]] < -best[-1][0]:
                break  # the kth result is certain
            some = near[lo : lo + 32]
            scores = distinct[some] @ query
            for v, score in zip(some.tolist(), scores.tolist()):
                if len(best) == k and score < -best[-1][0]:
                    continue
                same = ids[at[v] : min(stops[v], at[v] + enough)].tolist()
                best += [x for i in same if i != own and (x := (-score, i)) not in best]
                best.sort()
                del best[k:]


def _search(ids: np.ndarray, queries: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(ids, queries, k)
        for batch in batches:
            for lo in range(0, len(batch), CHUNK):
                part = batch.slice(lo, CHUNK)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
                nearest.add(part.column(0).to_numpy(), flat.reshape(len(part), -1).astype(np.int64))
        rows = [(int(q), v, -s) for q, best in zip(ids, nearest.best) for s, v in best]
        columns = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, every: int = 100,
    scale: int = 1024, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by ``every`` its ``k`` best other rows.

    Components become ``floor(scale * x)``; the score is the integer inner product, ties go to the smaller id. Rows
    with a null id, a null or empty vector, or a null or non-finite component take no part; nor does a row with
    another dimension than the query's get a score with it. Rows of one id are its own rows and never its results;
    repeated rows count once. Other columns are not read. No query rows give no rows.

    Method: a task computes for all its cells the bounds of the score from the approximation, and reads exact vectors
    from the best bound down until the kth result cannot change. Queries come in blocks of ``query_block``, each with
    a pass over the table.
    """
    whole = F.transform(vector_col, lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")))
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    usable = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    cells = usable.select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    asked = saved(cells.where(F.col("id") % every == 0).distinct(), "queries")
    blocks = asked.groupBy(F.size("v").alias("dim")).count().collect()  # dimensions, of which a table has few
    found = []
    for dim, n in blocks:
        of_dim = cells.where(F.size("v") == dim)
        parts = -(-n // query_block)
        for part in range(parts):
            mine = asked.where((F.size("v") == dim) & (F.pmod(F.xxhash64("id"), F.lit(parts)) == part)).toPandas()
            if len(mine):
                found.append(of_dim.mapInArrow(_search(mine["id"].to_numpy(), np.stack(mine["v"].to_numpy()).astype(np.int64), k), "query_id long, vec_id long, score long"))
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = rows.distinct().withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
