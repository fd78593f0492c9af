"""Scoring documents by a language model, beside a unigram base of their words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm import attention
from sluiceway.llm.arrow import saved, slices
from sluiceway.llm.tokens import Encoder, taken

FOLDS, HELD = 7, 2
#: The documents that are learned from come in turns, each in one of them: so many sixteenths up to the end of each turn.
TURNS = (1, 4, 16)
#: A word with more than one in so many of all tokens is looked up in the tasks; there can't be more such words.
FREQUENT = 200_000
#: Words whose ids a worker remembers.
REMEMBERED = 200_000
_SLICE = 2 << 20
#: Keys that are counted at a time.
_COUNTED = 2 << 20
#: What tasks learned is added up in blocks of so many weights, and of the embeddings of so many tokens.
_BLOCK, _ROWS = 1_024, 256
_BLOCKS = pa.schema([("block", pa.int64()), ("tokens", pa.binary()), ("sums", pa.binary())])


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from; a row without an id is learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % FOLDS == HELD, F.lit(False))


def words(column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Distinct words of the texts, which of them stands where, and how many each text has. Null texts have none."""
    at, distinct, sizes = _cut(column)
    return at, distinct.to_pylist(), sizes


def _cut(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The same, the distinct words left to Arrow."""
    text = pc.ascii_lower(pc.fill_null(column, ""))
    split = pc.ascii_split_whitespace(text)
    flat, owner = split.flatten(), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(real).dictionary_encode()
    sizes = np.bincount(owner.filter(real).to_numpy(), minlength=len(column))
    return coded.indices.to_numpy(), coded.dictionary.cast(pa.string()), sizes


class Subwords(Encoder):
    """Ids of words, each with a blank before it; the library is asked once for each word of a worker's recent texts."""

    def __init__(self, path: str):
        super().__init__(path, REMEMBERED)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.end = self.tokenizer.token_to_id("<|endoftext|>")

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, pa.Array, np.ndarray]]:
        """All texts' ids, the end after each, where each text begins in them, and its words."""
        at, distinct, sizes = found = _cut(column)
        flat, begin = self.ids_of(pc.binary_join_element_wise("", distinct, " "))
        flat, begin = np.append(flat, flat.dtype.type(self.end)), np.append(begin, len(flat) + 1)
        ends = np.cumsum(sizes)
        tokens, after = taken(flat, begin, np.insert(at, ends, len(distinct)))
        return tokens, after[np.concatenate([[0], ends + np.arange(len(ends)) + 1])], found


@lru_cache(maxsize=2)
def subwords(path: str) -> Subwords:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    return Subwords(path)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, every, seen): occurrences in all texts, and in those that are learned from."""
    for batch in batches:
        for lo, hi in slices(batch.column(0), _SLICE):
            at, distinct, sizes = _cut(batch.column(0).slice(lo, hi - lo))
            learned = np.repeat(~batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False), sizes)
            every = np.bincount(at, minlength=len(distinct))
            seen = np.bincount(at, learned, minlength=len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([distinct, pa.array(every), pa.array(seen)], names=["word", "every", "seen"])


def _prepare(path: str, frequent: pa.Array, seen: np.ndarray, whole: int, distinct_words: int, end_seen: int, id_type: pa.DataType):
    """A row per document: its ids, what its frequent words add to the base, and its other words."""
    floor, count = np.log10(whole + distinct_words + 1), np.append(seen, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, row = subwords(path), TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, hi in slices(batch.column(1), _SLICE):
                n = hi - lo
                tokens, offsets, (at, distinct, sizes) = to.ids(batch.column(1).slice(lo, n))
                of = count[pc.fill_null(pc.index_in(distinct, frequent), -1).to_numpy()][at]
                doc, here = np.repeat(np.arange(n), sizes), of >= 0
                base = np.bincount(doc[here], np.log10(of[here] + 1) - floor, minlength=n) + np.log10(end_seen + 1) - floor
                known = np.bincount(doc[here], of[here] > 0, minlength=n).astype(np.int64) + (end_seen > 0)
                others = np.concatenate([[0], np.cumsum(np.bincount(doc[~here], minlength=n))]).astype(np.int32)
                raw = memoryview(np.ascontiguousarray(tokens)).cast("B")
                width = tokens.itemsize
                columns = [
                    pa.array(row + np.arange(n)),
                    batch.column(0).slice(lo, n).cast(id_type),
                    batch.column(2).slice(lo, n),
                    pa.array(sizes + 1),
                    pa.array(known),
                    pa.array(base),
                    pa.array([bytes(raw[offsets[i] * width : offsets[i + 1] * width]) for i in range(n)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(others), distinct.take(pa.array(at[~here]))),
                ]
                row += n
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "held_out", "n_tokens", "known", "base", "ids", "words"])

    return run


def _texts(column: pa.Array, code: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of several documents, and where each begins."""
    parts = [np.frombuffer(x, code) for x in column.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, code), offsets


def _token_counts(code: str, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for lo, hi in slices(batch.column(0), _SLICE):
                total += np.bincount(_texts(batch.column(0).slice(lo, hi - lo), code)[0], minlength=vocabulary)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["token", "n"])

    return run


def _pair_counts(code: str, start: int, keys):
    """How often each key occurs that ``keys`` makes of the tokens and those before them, counted piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            there, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(there), pa.array(n)], names=["key", "n"])

        waiting, size = [], 0
        for batch in batches:
            for lo, hi in slices(batch.column(0), _SLICE):
                waiting.append(keys(*attention.pairs(*_texts(batch.column(0).slice(lo, hi - lo), code), start)).astype(np.int32))
                size += len(waiting[-1])
                if size > _COUNTED:
                    yield counted()
                    waiting, size = [], 0
        if waiting:
            yield counted()

    return run


def _beside(mark: np.ndarray):
    """A token and the place of a frequent one before it, and a token and the place of a frequent one after it."""
    width = 2 * attention.BESIDE

    def keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        left, right = mark[before], mark[tokens]
        return np.concatenate([tokens[left >= 0] * width + left[left >= 0], before[right >= 0] * width + attention.BESIDE + right[right >= 0]])

    return keys


def _after(of: np.ndarray, kind: np.ndarray):
    """A token and the class of the one after it, and behind these a kind of context and the token after it."""
    vocabulary = len(of)

    def keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        return np.concatenate([before * attention.CLASSES + of[tokens], (attention.CLASSES + kind[before]) * vocabulary + tokens])

    return keys


def _summed(learned: DataFrame, run, size: int) -> np.ndarray:
    """The counts of all tasks, keys from 0 to ``size``."""
    sums = learned.select("ids").mapInArrow(run, "key int, n long").groupBy("key").agg(F.sum("n").cast("float").alias("n")).toArrow()
    out = np.zeros(size, np.float32)
    out[sums["key"].to_numpy()] = sums["n"].to_numpy()
    return out


def _learn(code: str, weights: attention.Weights, squares: list[np.ndarray], of: np.ndarray, start: int, again: int):
    """What a task's documents make of the weights, all their windows once or ``again``, in blocks that can be added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = attention.Learner(weights, squares)
        for batch in batches:
            for lo, hi in slices(batch.column(0), _SLICE):
                tokens, offsets = _texts(batch.column(0).slice(lo, hi - lo), code)
                for _ in range(again):
                    for inputs, targets, counts, _ in attention.windows(tokens, offsets, start, attention.WINDOW):
                        learner.step(inputs, of[targets], counts)
        if not learner.seen:
            return
        flat = np.append(learner.flat(), 1.0) * learner.seen
        rows = [(-1 - i, b"", flat[lo : lo + _BLOCK].tobytes()) for i, lo in enumerate(range(0, len(flat), _BLOCK))]
        met = np.flatnonzero(learner.met)
        for tokens in np.split(met, np.flatnonzero(np.diff(met // _ROWS)) + 1):
            times = learner.met[tokens, None].astype(np.float32)
            sums = np.concatenate([learner.w.embedding[tokens] * times, times], axis=1)
            rows.append((int(tokens[0]) // _ROWS, tokens.astype(np.int32).tobytes(), sums.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], schema=_BLOCKS)

    return run


def _added(blocks: pa.Table) -> pa.Table:
    """The sum of one block of weights over all tasks, or of the embeddings of one run of tokens that they met."""
    block = blocks["block"][0].as_py()
    if block < 0:
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in blocks["sums"])
        return pa.table([pa.array([block]), pa.array([b""]), pa.array([total.tobytes()])], schema=_BLOCKS)
    total = np.zeros((_ROWS, attention.DIM + 1))
    for tokens, sums in zip(blocks["tokens"], blocks["sums"]):
        total[np.frombuffer(tokens.as_py(), np.int32) - block * _ROWS] += np.frombuffer(sums.as_py(), np.float32).reshape(-1, attention.DIM + 1)
    there = np.flatnonzero(total[:, -1])
    mean = (total[there, :-1] / total[there, -1:]).astype(np.float32)
    return pa.table([pa.array([block]), pa.array([(there + block * _ROWS).astype(np.int32).tobytes()]), pa.array([mean.tobytes()])], schema=_BLOCKS)


def _score(code: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            found = [model.log10(*_texts(ids.slice(lo, hi - lo), code)) for lo, hi in slices(ids, _SLICE)]
            rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "ids"]
            names = [name for name in batch.schema.names if name != "ids"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(np.concatenate(found) if found else np.zeros(0))], names=[*names, "score"])

    return run


def fit(prepared: DataFrame, path: str, steps: int = attention.STEPS) -> attention.Model:
    """Learns from all tokens of all documents that are not held out: counts, what stands beside what, and the weights.

    The weights are learned in turns of growing size. In a turn every task goes through its documents from the same
    weights, and the average of what the tasks came to, by their tokens, begins the next. What comes to the driver is
    bounded by the vocabulary and the model's size.
    """
    to = subwords(path)
    learned = prepared.where("not held_out")
    counts = np.zeros(to.vocabulary, np.int64)
    for token, n in learned.select("ids").mapInArrow(_token_counts(to.code, to.vocabulary), "token long, n long").groupBy("token").agg(F.sum("n")).collect():
        counts[token] = n
    single = attention.frequent(counts, attention.BESIDE)
    mark = np.full(to.vocabulary, -1)
    mark[single] = np.arange(len(single))
    width = 2 * attention.BESIDE
    beside = _summed(learned, _pair_counts(to.code, to.end, _beside(mark)), to.vocabulary * width).reshape(-1, width)
    of, kind = attention.classes(counts, beside), attention.classes(counts, beside, attention.CONTEXTS, attention.SHARED_CONTEXTS)
    del beside
    follows = _summed(learned, _pair_counts(to.code, to.end, _after(of, kind)), to.vocabulary * (attention.CLASSES + attention.CONTEXTS))
    next_class, after = np.split(follows, [to.vocabulary * attention.CLASSES])
    weights = attention.begin(attention.fresh(to.vocabulary, attention.CLASSES), next_class.reshape(to.vocabulary, -1))
    again = max(1, min(attention.AGAIN, -(-steps * attention.BATCH * attention.WINDOW // max(1, int(counts.sum())))))
    squares, turn, begin = attention.no_squares(weights), F.pmod(F.xxhash64("row"), F.lit(TURNS[-1])), 0
    for end in TURNS:
        some = learned.where((turn >= begin) & (turn < end)).select("ids")
        run = _learn(to.code, weights, squares, of, to.end, again)
        kinds = "block long, tokens binary, sums binary"
        sums = some.mapInArrow(run, kinds).groupBy("block").applyInArrow(_added, kinds).collect()
        if sums:
            flat = np.frombuffer(b"".join(bytes(r.sums) for r in sorted(sums, key=lambda r: -r.block) if r.block < 0))
            weights, squares = attention.unflat(weights, flat[:-1] / flat[-1])
            weights.embedding = weights.embedding.copy()
            for r in sums:
                if r.block >= 0:
                    weights.embedding[np.frombuffer(r.tokens, np.int32)] = np.frombuffer(r.sums, np.float32).reshape(-1, attention.DIM)
        begin = end
    return attention.Model(weights, of, kind, attention.inside_log(after.reshape(attention.CONTEXTS, -1), of), to.end)


def score(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", steps: int = attention.STEPS, frequent: int = FREQUENT,
) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    A text is its words in lower case (A-Z) and an end. The base is a unigram model of whole words with one added to
    every count, ``score`` the log10 probability of the words and the end under a causal self-attention model on their
    subword ids, every token scored once in overlapping windows. Neither learns from rows that are held out.

    Null, empty and blank texts are an end alone. Rows without an id are learned from; repeated rows are rows of their
    own and are learned from as often as they stand. Texts are scored whole, whatever their length. Without a row to
    learn from the base of every text is 0 and the model is as it began. Other columns are not read; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    counted = rows.select("text", "held_out").mapInArrow(_count_words, "word string, every long, seen long")
    counted = saved(counted.groupBy("word").agg(F.sum("every").alias("every"), F.sum("seen").alias("seen")), "words")
    total = counted.agg(F.sum("every"), F.sum("seen"), F.count(F.when(F.col("seen") > 0, 1))).first()
    ends = rows.agg(F.count("*"), F.count(F.when(~F.col("held_out"), 1))).first()
    whole, distinct_words = (total[1] or 0) + ends[1], total[2] + (ends[1] > 0)
    common = counted.where(F.col("every") * frequent > (total[0] or 0)).select("word", "seen").toArrow()  # fewer than ``frequent``
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", id_type)]).simpleString()[len("struct<") : -1].replace(":", " ")
    schema += ", held_out boolean, n_tokens long, known long, base double, ids binary, words array<string>"
    from pyspark.sql.pandas.types import to_arrow_type

    known = common["word"].combine_chunks().cast(pa.string()), common["seen"].to_numpy()
    prepare = _prepare(vocabulary_path, *known, whole, distinct_words, ends[1], to_arrow_type(id_type))
    both = saved(rows.mapInArrow(prepare, schema), "ids")
    texts, others = both.drop("words"), both.select("row", F.explode("words").alias("word"))

    floor = float(np.log10(whole + distinct_words + 1))
    rare = others.join(counted.where(F.col("every") * frequent <= (total[0] or 0)).select("word", "seen"), "word")
    added = rare.groupBy("row").agg(
        F.sum(F.log10(F.col("seen") + 1) - floor).alias("more"), F.count(F.when(F.col("seen") > 0, 1)).alias("also")
    )
    shared = spark.sparkContext.broadcast(fit(texts, vocabulary_path, steps))
    out_schema = schema.split(", ids")[0] + ", score double"
    scored = texts.mapInArrow(_score(subwords(vocabulary_path).code, shared), out_schema)
    return scored.join(added, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(whole).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )
