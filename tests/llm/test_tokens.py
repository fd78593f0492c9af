from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sluiceway.llm import queries, tokens
from sluiceway.llm.arrow import table
from sluiceway.llm.files import opened
from sluiceway.llm.vocabularies import vocabulary
from sluiceway.session import fresh_dir

PATH = vocabulary("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "a\n\nb", " lead", "trail ", "tab\tx", "a  b   c", "don't I'll", "x\x1cy z", "nul\0z a", "\xa0 b\xa0c", "日本 語　x", "a \n b",
    "<|endoftext|> x", "hello <|endoftext|> there", "a  <|endoftext|>\n\nb<|endoftext|>", "\r\n\r\n a", "1234 5.6\n\n", "naïve*** Öl,, ªb µm straße!? it's (so) x_y ×÷ ÀÖØöøÿ", "é́   b",
]


def want(texts):
    coder = Tokenizer.from_file(PATH)
    out, start = [], 0
    for i, t in texts:
        ids = np.array(coder.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_query_against_the_library(spark, sf):
    rows = table(spark, sf, "documents").orderBy("doc_id").select("doc_id", "text").collect()
    assert got(queries.QUERIES["op2_rans_tokens"](spark, sf)) == want(rows)


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, "word " * 30_000), (51, "same"), (51, "same")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in [(None, None), *rows[::-1]]], "doc_id long, text string, ids string")
    assert got(tokens.token_digests(docs, PATH)) == want([(None, None), *rows])
    assert tokens.token_digests(docs.limit(0), PATH).count() == 0


def test_words_have_the_ids_they_have_in_texts():
    coder = tokens.encoder(PATH)
    for text in ODD:
        assert coder.encode([text])[0] == np.array(coder.tokenizer.encode(text, add_special_tokens=False).ids, "H").tobytes(), repr(text)


def test_sections_decode_by_themselves():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 2 * tokens.SECTION * tokens.LANES + 12_345) % 5000
    table_ = tokens.Table(np.bincount(ids, minlength=5001))
    assert table_.freq.sum() == 1 << tokens.SCALE
    words, states, places = tokens.encode_block(ids, table_)
    size = tokens.SECTION * tokens.LANES
    for i in (2, 0, 1):
        part = ids[i * size : (i + 1) * size]
        assert (tokens.decode_section(words[places[i] :], states[i], len(part), table_, table_.symbols) == part).all()


def test_reading_in_parts_and_damage(spark, sf):
    docs = table(spark, sf, "documents")
    folder = fresh_dir(spark, "tokens")
    manifest = tokens.write(docs, folder, PATH, most=20_000)
    assert manifest.count() > 4
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    assert got(tokens.read(spark, folder, manifest, part=5000)) == want(rows)
    fs, base = opened(folder)
    name = manifest.first().file
    with fs.open_input_file(f"{base}/{name}") as f:
        data = bytearray(f.read())
    data[10] ^= 1  # of the first words
    with fs.open_output_stream(f"{base}/{name}") as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        tokens.read(spark, folder, manifest).collect()


def test_mixed_pieces_against_the_library():
    rng, coder = np.random.default_rng(5), tokens.Encoder(PATH)
    parts = ["a", "b ", "'s", "\n", " ", "  ", "é", "ª", "日", "!", "--", "23", "\t", "\0", "\x1c", "　", "Ġ", "<|endoftext|>", "It's", "(x)", "_", "ß", "÷", "\x85"]
    texts = ["".join(rng.choice(parts, n)) for n in rng.integers(0, 12, 3_000)]
    flat, at = coder.column(pa.array([None, *texts]), 0)
    want_ids = [coder.tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in ["", *texts]]
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == want_ids


def test_words_in_use_are_not_forgotten(monkeypatch):
    """The library is asked once for a word that stays in use, however many others come; those are forgotten."""
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    coder, asked = tokens.Encoder(PATH), []
    made = coder.words.made
    coder.words.made = lambda word: asked.append(word) or made(word)
    letters = "abcdefghij"
    for i in range(100):
        text = "frequent " + " ".join(letters[i // 10] + letters[i % 10] + x for x in letters)
        assert coder.encode([text])[0] == np.array(coder.tokenizer.encode(text, add_special_tokens=False).ids, "H").tobytes()
    assert asked.count("frequent") == 1 and len(coder.words) + len(coder.words.before) <= 101
