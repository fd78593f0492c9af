"""Token ids of documents in files coded by a range asymmetric numeral system (rANS).

A file has one table of symbol frequencies that its blocks share, each coded by itself with ``LANES`` interleaved
states. Every ``SECTION`` steps a checkpoint keeps the states and the place in the words, and a checksum of the ids up
to the next, so sections decode in parallel. The footer has the table, the sections and the documents.
"""

from __future__ import annotations

import io
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm.arrow import released, saved, slices
from sluiceway.llm.files import Output, opened
from sluiceway.session import fresh_dir

END_ID = 0
SCALE = 20
LANES = 1024
SECTION = 256
BLOCK = 4 * SECTION * LANES
#: Tokens of a file at most (but for one longer document), which its writer holds to count them.
FILE = 16 << 20
#: Tokens of a reading task.
PART = 4 << 20
#: Words whose ids a worker remembers.
REMEMBERED = 500_000
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_PARTS = np.uint64(1 << SCALE)
_MASK = np.uint64((1 << SCALE) - 1)
_SHIFT = np.uint64(SCALE)
MAGIC = b"RANSTOK1"
#: What the fast way of cutting does not expect: white space but blank and newline, NUL, and two of white space together.
_UNUSUAL = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"] + ["\0", "  ", "\n\n", " \n", "\n "]
_OPAQUE = re.compile(r"[\0\x1c-\x1f]")  # here Python and the tokenizer disagree on what is white space
_PIECES = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# Letters, and punctuation after them: two words of the tokenizer's pattern.
_LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_PLAIN = f"\\A ?[{_LETTERS}]+\\z"
#: Bytes of the texts that are cut at once.
_SLICE = 4 << 20


class _Remembered(dict):
    """What ``made`` gives of a key; of the keys before the last ``most`` / 2 new ones, those that were not asked for again go."""

    def __init__(self, made: Callable[[str], bytes], most: int):
        super().__init__()
        self.made, self.half, self.before = made, most // 2, {}

    def __missing__(self, key: str) -> bytes:
        if (value := self.before.get(key)) is None:
            value = self.made(key)
        if len(self) >= self.half:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


def _found(strings: list[str]) -> str:
    """A pattern of Arrow's for texts that hold one of these, or begin or end with a blank or newline."""
    return "|".join("".join(f"\\x{{{ord(c):x}}}" for c in s) for s in strings) + r"|\A[ \n]|[ \n]\z"


class Encoder:
    """Ids by the tokenizers library, which is asked once for each word of a worker's recent texts.

    A byte-level BPE of this pattern never joins white space to what stands before it, so the pieces of a text between
    white space have the ids that they have in the text. Arrow cuts the texts and finds the distinct pieces.
    """

    def __init__(self, path: str, remembered: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unusual = _found([*_UNUSUAL, *self.special])
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.code = "H" if self.vocabulary <= 1 << 16 else "I"
        self.chars = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in " " + _LETTERS}
        most = remembered or REMEMBERED
        self.words, self.others = _Remembered(self._word, most), _Remembered(self._whole, most // 8)

    def _word(self, word: str) -> bytes:
        """One word of the tokenizer's pattern, of letters or of marks, by the library's model."""
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(word.translate(self.chars))]).tobytes() if word else b""

    def _whole(self, piece: str) -> bytes:
        return array(self.code, self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _rarely(self, text: str) -> list[str]:
        """The pieces of a text that Arrow can't cut."""
        if any(s in text for s in self.special):  # cut before everything else
            return [text]
        return [text] if _OPAQUE.search(text) else _PIECES.findall(text)

    def _pieces(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces of the texts, and where those of each text begin."""
        rare = pc.match_substring_regex(column, self.unusual).to_numpy(zero_copy_only=False).astype(bool)
        cut = pc.replace_substring(pc.replace_substring(column, " ", "\0 "), "\n", "\0\n\0")
        cut = pc.split_pattern(cut, "\0")
        if rare.any():
            at = np.where(rare, len(column) + np.cumsum(rare) - 1, np.arange(len(column)))
            own = [self._rarely(t) for t in column.filter(pa.array(rare)).to_pylist()]
            cut = pa.concat_arrays([cut, pa.array(own, cut.type)]).take(pa.array(at))
        return cut.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))])

    def ids_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, and where each begins: letters with marks word by word, all else as a whole."""
        heads, tails = pc.utf8_rtrim(pieces, _MARKS), pc.utf8_ltrim(pieces, " " + _LETTERS)
        plain = pc.match_substring_regex(heads, _PLAIN)
        heads, tails = pc.if_else(plain, heads, pieces).dictionary_encode(), pc.if_else(plain, tails, "").dictionary_encode()
        words, others = self.words.__getitem__, self.others.__getitem__
        of = np.full(len(heads.dictionary), False)
        of[heads.indices.to_numpy()] = plain.to_numpy(zero_copy_only=False)  # a head of letters is no other piece
        held = [words(w) if easy else others(w) for w, easy in zip(heads.dictionary.to_pylist(), of.tolist())]
        parts = np.stack([heads.indices.to_numpy(), len(held) + tails.indices.to_numpy()], axis=1)
        flat, begin = self._flat([*held, *map(words, tails.dictionary.to_pylist())])
        flat, ends = taken(flat, begin, parts.ravel())
        return flat, ends[::2]

    def _flat(self, held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.frombuffer(b"".join(held), self.code)
        return flat, np.concatenate([[0], np.cumsum(np.fromiter(map(len, held), np.int64, len(held)))]) // flat.itemsize

    def column(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``end`` after each, and where each text begins in them; null texts are empty."""
        pieces, begin = self._pieces(pc.fill_null(column, "") if column.null_count else column)
        coded = pieces.dictionary_encode()
        flat, at = self.ids_of(coded.dictionary)
        order = coded.indices.to_numpy()
        if end is not None:  # one more piece
            flat, at = np.append(flat, flat.dtype.type(end)), np.append(at, len(flat) + 1)
            order, begin = np.insert(order, begin[1:], len(coded.dictionary)), begin + np.arange(len(begin))
        flat, at = taken(flat, at, order)
        return flat, at[begin]

    def encode(self, texts: list[str]) -> list[bytes]:
        flat, at = self.column(pa.array(texts, pa.string()))
        return [flat[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def taken(flat: np.ndarray, begin: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of ``flat`` that ``order`` names, one behind the other, and where each begins; ``begin`` has the last end."""
    much = np.diff(begin)[order]
    ends = np.concatenate([[0], np.cumsum(much)])
    return flat[np.arange(ends[-1]) + np.repeat(begin[order] - ends[:-1], much)], ends


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    return Encoder(path)


def encoded(column: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, ids, and where each text begins in them, of successive ranges of rows; the end id comes after every
    document, null texts are empty."""
    for lo, hi in slices(column, _SLICE):
        yield lo, *encoder(path).column(column.slice(lo, hi - lo), END_ID)
    released()


class Table:
    """Frequencies that add up to 2**SCALE; every id that occurs has at least one part."""

    def __init__(self, counts: np.ndarray | None = None, freq: np.ndarray | None = None):
        parts = freq.astype(np.int64) if freq is not None else self._parts(counts)
        self.freq = parts.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(parts)[:-1]]).astype(np.uint64)

    @staticmethod
    def _parts(counts: np.ndarray) -> np.ndarray:
        there = np.flatnonzero(counts)
        parts = np.zeros(len(counts), np.int64)
        if len(there):
            free = (1 << SCALE) - len(there)
            if free < 0:
                raise ValueError("more ids than parts")
            share = counts[there].astype(np.float64) / counts.sum()
            parts[there] = 1 + np.floor(share * free).astype(np.int64)
            parts[there[np.argmax(parts[there])]] += (1 << SCALE) - parts.sum()
        return parts

    @property
    def symbols(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.freq)), self.freq.astype(np.int64)).astype(np.uint32)


def encode_block(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, and per section the states and the place in the words from which it decodes."""
    states = np.full(LANES, _LOW, np.uint64)
    out, kept, left = [], [], []
    total, size = 0, SECTION * LANES
    for begin in range((len(ids) - 1) // size * size, -1, -size):
        of = ids[begin : begin + size]
        freq, cum = table.freq[of], table.cum[of]
        limit = freq << np.uint64(43)
        for at in range((len(of) - 1) // LANES * LANES, -1, -LANES):
            f = freq[at : at + LANES]
            x = states[: len(f)]
            over = np.flatnonzero(x >= limit[at : at + LANES])
            if len(over):
                full = x[over]
                out.append(full.astype(np.uint32))
                total += len(full)
                x[over] = full >> _WORD
            q = x // f
            x += q * (_PARTS - f) + cum[at : at + LANES]  # (q << SCALE) + x - q * f + cum
        kept.append(states.copy())
        left.append(total)
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    return words.astype("<u4"), np.array(kept[::-1]).reshape(-1, LANES).astype("<u8"), len(words) - np.array(left[::-1], np.int64)


def decode_section(words: np.ndarray, states: np.ndarray, n: int, table: Table, symbols: np.ndarray) -> np.ndarray:
    """The ``n`` ids of a section; ``words`` begin at its place."""
    states, out, at = states.astype(np.uint64), np.empty(n, np.uint32), 0
    freq, cum = table.freq, table.cum
    for lo in range(0, n, LANES):
        x = states[: min(LANES, n - lo)]
        slot = x & _MASK
        s = symbols[slot]
        out[lo : lo + LANES] = s
        x = freq[s] * (x >> _SHIFT) + slot - cum[s]
        low = x < _LOW
        k = int(np.count_nonzero(low))
        if k:
            if at + k > len(words):
                raise ValueError("a damaged section: its words end before its ids")
            x[low] = (x[low] << _WORD) | words[at : at + k]
            at += k
        states[: len(x)] = x
    return out


def _arrays(**named: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **named)
    return out.getvalue()


class _File:
    """Holds the ids of one file, and writes it when all are there: the table they make, their blocks, the footer."""

    def __init__(self, folder: str, name: str, vocabulary: int):
        self.out, self.name, self.vocabulary = Output(folder, name), name, vocabulary
        self.waiting: list[np.ndarray] = []
        self.tokens = 0
        self.docs: list[int] = []
        self.named: list[bool] = []
        self.sections: list[tuple[int, int, int, int]] = []  # of the file: byte of its words, number of words, ids, their crc
        self.states: list[np.ndarray] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.named.append(doc_id is not None)
        self.waiting.append(ids)
        self.tokens += len(ids)

    def _block(self, ids: np.ndarray, table: Table) -> None:
        words, states, places = encode_block(ids, table)
        ends = [*places[1:].tolist(), len(words)]
        begin = self.out.size
        for i, (a, b) in enumerate(zip(places.tolist(), ends)):
            part = ids[i * SECTION * LANES : (i + 1) * SECTION * LANES]
            self.sections.append((begin + 4 * a, b - a, len(part), zlib.crc32(part.astype("<u4"))))
        self.states.append(states)
        self.out.write(words.tobytes())

    def close(self) -> dict:
        lengths, ids = np.array([len(x) for x in self.waiting], "<i8"), np.concatenate(self.waiting)
        self.waiting = []
        counts = np.zeros(self.vocabulary, np.int64)
        for lo in range(0, len(ids), BLOCK):  # bincount widens what it counts
            counts += np.bincount(ids[lo : lo + BLOCK], minlength=self.vocabulary)
        table = Table(counts)
        for lo in range(0, len(ids), BLOCK):
            self._block(ids[lo : lo + BLOCK], table)
        footer = _arrays(
            freq=table.freq.astype("<u4"), docs=np.array(self.docs, "<i8"), named=np.array(self.named, bool), lengths=lengths,
            sections=np.array(self.sections, "<i8").reshape(-1, 4), states=np.concatenate([*self.states, np.zeros((0, LANES), "<u8")]),
        )
        at = self.out.size
        self.out.write(footer + zlib.crc32(footer).to_bytes(4, "little") + MAGIC)
        self.out.close()
        return {"file": self.name, "tokens": self.tokens, "footer_at": at, "bytes": self.out.size}


def write(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", most: int = FILE) -> DataFrame:
    """Writes all documents in ascending id order (null first, equal ids by their text) and returns the manifest.

    A partition is a file, or several of about ``most`` tokens; names are in the order of the documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, n = None, 0
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for lo, coded, at in encoded(batch.column(1), path):
                for doc_id, a, b in zip(ids_of[lo:], at[:-1].tolist(), at[1:].tolist()):
                    if file and file.tokens >= most:
                        yield pa.RecordBatch.from_pylist([file.close()])
                        file = None
                    if not file:
                        file, n = _File(folder, f"part-{TaskContext.get().partitionId():06d}-{n:06d}", encoder(path).vocabulary), n + 1
                    file.add(doc_id, coded[a:b])
        if file:
            yield pa.RecordBatch.from_pylist([file.close()])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    return saved(ordered.mapInArrow(run, "file string, tokens long, footer_at long, bytes long"), "manifest")


def documents(folder: str, name: str, footer_at: int, size: int, first: int, stop: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, start in the file, ids)`` of the documents that begin in the ``[first, stop)``-th tokens of a file."""
    fs, base = opened(folder)
    with fs.open_input_file(f"{base}/{name}") as f:
        f.seek(footer_at)
        tail = f.read(size - footer_at)
        body, crc, magic = tail[:-12], int.from_bytes(tail[-12:-8], "little"), tail[-8:]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError(f"{name}: the footer is damaged")
        with np.load(io.BytesIO(body)) as packed:
            footer = dict(packed)  # each array is unpacked once
        lengths, sections, states = footer["lengths"], footer["sections"], footer["states"]
        table = Table(freq=footer["freq"])
        symbols = table.symbols
        starts = np.cumsum(lengths) - lengths
        mine = np.flatnonzero((starts >= first) & (starts < stop))
        section_at = np.cumsum(sections[:, 2]) - sections[:, 2]
        have, ids = -1, np.zeros(0, np.uint32)  # decoded ids from token ``have`` on
        done = 0
        for d in mine.tolist():
            begin, end = int(starts[d]), int(starts[d] + lengths[d])
            if have < 0:
                done = int(np.searchsorted(section_at, begin, "right")) - 1
                have = int(section_at[done])
            parts = [ids[begin - have :]]
            have, more = begin, len(parts[0])
            while have + more < end:
                at, n_words, n, crc = (int(x) for x in sections[done])
                f.seek(at)
                got = decode_section(np.frombuffer(f.read(4 * n_words), "<u4"), states[done], n, table, symbols)
                if zlib.crc32(got.astype("<u4", copy=False)) != crc:
                    raise ValueError(f"{name}: section {done} is damaged")
                skip = max(0, begin - int(section_at[done]))
                parts.append(got[skip:])
                more += len(got) - skip
                done += 1
            ids = np.concatenate(parts) if len(parts) > 1 else parts[0]
            yield (int(footer["docs"][d]) if footer["named"][d] else None), begin, ids[: end - begin]


def read(spark: SparkSession, folder: str, manifest: DataFrame, part: int = PART) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents; a task decodes about ``part`` tokens."""
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(order), F.lit(0)).cast("long"))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tokens") - 1, F.lit(part).cast("long")))
    tasks = files.select("file", "footer_at", "bytes", "base", at.alias("first"))
    # A number given is kept; by the size of these few small rows all of them would become one task.
    tasks = tasks.repartition(max(1, tasks.count()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.to_pylist():
                rows = []
                for doc_id, start, ids in documents(folder, t["file"], t["footer_at"], t["bytes"], t["first"], t["first"] + part):
                    crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
                    rows.append({"doc_id": doc_id, "start": t["base"] + start, "n_tokens": len(ids), "ids_crc32": crc})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return tasks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its id, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32``, from files
    written and read back.

    Null texts are empty, so their ids are the end id alone; a null id comes first; equal ids are in the order of
    their texts; other columns are not read; an empty table writes no block and gives no rows.
    """
    spark = docs.sparkSession
    folder = fresh_dir(spark, "tokens")
    return read(spark, folder, write(docs, folder, path, id_col, text_col)).withColumnRenamed("doc_id", id_col)
