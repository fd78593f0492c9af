"""Document quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import wordhash
from sluiceway.llm.arrow import released, slices, utf8

#: Labelled documents that vote: at most so many, those with the least hash of their id. All others are only scored.
LABELLED = 8_192
DIMENSIONS = 48
NEIGHBOURS = 25
#: A neighbour's vote weighs its similarity to this power.
POWER = 8
ACCEPT = 0.3
_BLOCK = 512
#: Documents of a block whose neighbours are picked at a time.
_PICKED = 64

# Kinds of bytes, of which every three in a row are a term.
_KINDS = {" ": 0, "\n": 1, ".": 6, ",": 7, "!?": 8, "'\"-:;()": 9, "*#$%&@^~+=<>|/\\_[]{}`": 10}
_KIND = np.full(256, 11, np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 2, 3, 4, 5
for _chars, _kind in _KINDS.items():
    _KIND[list(_chars.encode())] = _kind
_BASE = 12
#: Widths of the groups of terms: hashed words, hashed runs of four bytes, hashed pairs of words (all with A-Z lowered),
#: runs of three kinds of bytes, and three counts of repeated words: equal to the one before, equal to one of the two
#: before that, and as long as the one before. Whatever the vocabulary, a document has so many terms.
WORDS, RUNS, PAIRS = 2_048, 2_048, 1_024
WIDTHS = (WORDS, RUNS, PAIRS, _BASE**3 + 3)
#: What each group may contribute to a vector's squared length.
SHARES = (1.0, 1.0, 0.25, 2.0)
_STARTS = np.concatenate([[0], np.cumsum(WIDTHS)])
TERMS = int(_STARTS[-1])
_TEXT = np.ones(256, bool)
_TEXT[[9, 10, 11, 12, 13, 32]] = False


def _tally(out: np.ndarray, group: int, first: np.ndarray, terms: np.ndarray, span: int = 1) -> None:
    """Counts of a group's terms, for texts whose terms begin at ``first`` and take ``span`` places each."""
    start, width = int(_STARTS[group]), WIDTHS[group]
    for i in range(len(out)):
        a, b = first[i], max(first[i], first[i + 1] - span + 1)
        out[i, start : start + width] += np.bincount(terms[a:b], minlength=width)


def _hashed(values: np.ndarray, width: int) -> np.ndarray:
    return (wordhash.mixed(values) % np.uint64(width)).astype(np.int64)


def term_counts(column: pa.Array) -> np.ndarray:
    """A row of term counts per text, over all of it; null texts have none."""
    out = np.zeros((len(column), TERMS), np.float32)
    for lo, hi in slices(column):
        data, offsets = utf8(column.slice(lo, hi - lo))
        if not len(data):
            continue
        rows = out[lo:hi]
        lowered = wordhash.LOWERED[data]
        starts, ends, first = wordhash.words(lowered, offsets)
        hashes = wordhash.word_hashes(lowered, starts, ends)
        _tally(rows, 0, first, _hashed(hashes, WORDS))
        wide = lowered.astype(np.uint64)
        _tally(rows, 1, offsets, _hashed(wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:], RUNS), 4)
        _tally(rows, 2, first, _hashed(wordhash.gram_hashes(hashes, 2), PAIRS), 2)
        kind = _KIND[data]
        _tally(rows, 3, offsets, kind[:-2] * _BASE * _BASE + kind[1:-1] * _BASE + kind[2:], 3)
        starts, ends, first = wordhash.words(data, offsets, _TEXT)
        hashes = wordhash.word_hashes(data, starts, ends)
        same = np.zeros((3, len(hashes)), np.int64)
        same[0, 1:] = hashes[1:] == hashes[:-1]
        for gap in (2, 3):
            same[1, gap:] |= hashes[gap:] == hashes[:-gap]
        same[2, 1:] = (ends - starts)[1:] == (ends - starts)[:-1]
        for i in range(hi - lo):
            x, y = first[i], first[i + 1]
            for row, gap in ((0, 1), (1, 3), (2, 1)):
                rows[i, TERMS - 3 + row] = same[row, x + gap : y].sum()
    return out


@dataclass
class Model:
    """Term weights, the latent basis, and the labelled documents' unit vectors with their labels.

    ``usual``: how much of a labelled document's length the latent dimensions explain, in the median.
    """

    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    usual: float = 1.0

    def project(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit vectors in the latent dimensions, and what part of each document's length these explain."""
        whole = _weighted(counts, self.weight)
        vectors = whole @ self.basis
        length, all_of_it = np.linalg.norm(vectors, axis=1), np.linalg.norm(whole, axis=1)
        unit = vectors / np.where(length > 0, length, 1)[:, None]
        return unit.astype(np.float32), length / np.where(all_of_it > 0, all_of_it, 1)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled documents; without any similar one, the labels' mean.

        A document of which the latent dimensions explain less than usual, because its terms are not those of the labelled
        ones, has that much less similarity to them. Its score lies as much nearer ``ACCEPT``, on the side its votes say.
        """
        out = np.full(len(counts), float(self.labels.mean()) if len(self.labels) else 0.5)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return out
        for lo in range(0, len(counts), _BLOCK):
            unit, explained = self.project(counts[lo : lo + _BLOCK])
            cosine = unit @ self.vectors.T  # of every document with every label
            near = np.concatenate([np.argpartition(-cosine[i : i + _PICKED], k - 1, axis=1)[:, :k] for i in range(0, len(cosine), _PICKED)])
            weight = np.clip(np.take_along_axis(cosine, near, 1), 0, 1).astype(np.float64) ** POWER
            votes = weight.sum(axis=1)
            some = votes > 0
            share = (weight * self.labels[near]).sum(axis=1)[some] / votes[some]
            known = np.clip(explained[some].astype(np.float64) / self.usual, 0, 1) ** POWER
            out[lo : lo + _BLOCK][some] = (known * share + (1 - known) * ACCEPT).clip(0, 1)
        return out


def _weighted(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Roots of the terms' shares in their group, times their weights; each group is then brought to its length."""
    out = np.sqrt(counts)
    out *= weight
    for lo, hi, share in zip(_STARTS[:-1], _STARTS[1:], SHARES):
        part = out[:, lo:hi]
        length = np.linalg.norm(part, axis=1, keepdims=True)
        part *= np.sqrt(share, dtype=np.float32) / np.where(length > 0, length, 1)
    return out


def pack(counts: np.ndarray) -> bytes:
    """A document's term counts in under three bytes per term, since the whole sample lies in the driver's memory."""
    at = np.flatnonzero(counts)
    return zlib.compress(at.astype("<u2").tobytes() + counts[at].astype("<u4").tobytes(), 1)


def unpack(data: bytes, counts: np.ndarray) -> None:
    """Sets the counts of a document in a row of zeros."""
    data = zlib.decompress(data)
    n = len(data) // 6
    counts[np.frombuffer(data, "<u2", n)] = np.frombuffer(data, "<u4", n, 2 * n)


def latent(sample: list[bytes], labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """Latent-semantic analysis of documents given as packed counts of their terms: inverse document frequencies and
    a truncated singular value decomposition. The matrix is never whole in memory, only blocks of its rows."""

    def blocks():
        for lo in range(0, len(sample), _BLOCK):
            counts = np.zeros((min(_BLOCK, len(sample) - lo), TERMS), np.float32)
            for row, data in zip(counts, sample[lo : lo + _BLOCK]):
                unpack(data, row)
            yield counts

    seen = np.zeros(TERMS, np.int64)
    for counts in blocks():
        seen += (counts > 0).sum(axis=0)
    weight = (np.log((1 + len(sample)) / (1 + seen)) + 1).astype(np.float32)
    rank = min(dimensions, len(sample))
    draw = np.random.default_rng(7).standard_normal((TERMS, rank + 10)).astype(np.float32)
    for _ in range(4):  # subspace iteration
        moved = np.zeros_like(draw)
        for counts in blocks():
            rows = _weighted(counts, weight)
            moved += rows.T @ (rows @ draw)
        draw = np.linalg.qr(moved)[0]
    inner = np.zeros((draw.shape[1], draw.shape[1]))
    for counts in blocks():
        rows = (_weighted(counts, weight) @ draw).astype(np.float64)
        inner += rows.T @ rows
    values, turned = np.linalg.eigh(inner)
    basis = (draw @ turned[:, np.argsort(-values)[:rank]]).astype(np.float32)
    model = Model(weight, basis, np.zeros((0, rank), np.float32), labels.astype(np.float64))
    parts = [model.project(counts) for counts in blocks()]
    if parts:
        model.vectors = np.concatenate([p[0] for p in parts])
        model.usual = float(np.median(np.concatenate([p[1] for p in parts]))) or 1.0
    return model


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows whose labels are never learned from; a null id has no label to hold out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % folds == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = LABELLED
) -> Model:
    """Learns from at most ``most`` labelled documents outside the held-out fold; of several labels of one id the mean.

    The sample's term counts come to the driver: their size is bounded by ``most`` and the number of terms.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.avg(F.col(label_col).cast("double")).alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(most)

    def packed(column: pa.Array) -> pa.Array:
        rows = [pack(counts) for lo in range(0, len(column), _BLOCK) for counts in term_counts(column.slice(lo, _BLOCK))]
        return pa.array(rows, pa.binary())

    packed.__annotations__ = {"column": pa.Array, "return": pa.Array}
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    found = chosen.select("_id", "_label", F.arrow_udf(packed, "binary")("_text").alias("t"))
    rows = found.orderBy("_id", F.hash("t")).limit(2 * most).toPandas()
    return latent(rows["t"].tolist(), rows["_label"].to_numpy(np.float64))


def score_column(docs: DataFrame, text: Column, model: Model) -> Column:
    """Probability-like score of label 1; the model is broadcast (its size does not grow with the documents)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(column: pa.Array) -> pa.Array:
        parts = [shared.value.score(term_counts(column.slice(lo, _BLOCK))) for lo in range(0, len(column), _BLOCK)]
        released()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    each.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(each, "double").asNondeterministic()(text)  # evaluated once where it stands


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per row: id, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 if ``score >= ACCEPT``).

    Terms are hashed words, pairs of words and runs of bytes of the whole text, beside its runs of kinds of bytes and
    repetitions of words; inverse document frequencies and a singular value decomposition of the labelled sample make
    latent vectors; each document's cosine with all labelled vectors is computed in blocks, and its nearest vote by
    similarity, less where its terms are not those of labelled documents. Only the text makes the score. Null,
    empty and very short texts have no terms and get the labels' mean, as all do if no label is left (then 0.5).
    Repeated rows stay repeated rows; other columns are not read; an empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    scored = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score_column(docs, F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
