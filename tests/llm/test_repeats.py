from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from sluiceway.llm import queries, repeats, rindex
from sluiceway.llm.arrow import table
from tests.llm import brute

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_matching_statistics_against_all_suffixes():
    rng = random.Random(1)
    for _ in range(30):
        base = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(4)]
        strings = [rng.choice(base)[rng.randint(0, 5) :] + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 10))) for _ in range(rng.randint(1, 7))]
        index, begin = rindex.build(strings)
        got = index.matching_statistics()
        suffixes = [(i, j, s[j:]) for i, s in enumerate(strings) for j in range(len(s))]
        for i, j, s in suffixes:
            common = [next((n for n, (a, b) in enumerate(zip(s, t)) if a != b), min(len(s), len(t))) for x, y, t in suffixes if (x, y) != (i, j)]
            assert got[begin[i] + j] == max(common, default=0)


def test_query_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    got = queries.QUERIES["op1_run_length_index"](spark, sf).select(COLUMNS).collect()
    assert key(got) == key(brute.repeats(docs, 400))


@pytest.mark.parametrize("group_limit", [2048, 1])
def test_small_lengths_and_odd_rows(spark, group_limit):
    rng = random.Random(3)
    phrase = "".join(rng.choice("abcdef ") for _ in range(70))
    rows = [(i, "".join(rng.choice("xyz é") for _ in range(rng.randint(0, 60))) + phrase[rng.randint(0, 9) : rng.randint(40, 70)] * rng.randint(0, 2)) for i in range(60)]
    rows += [(100, "an " * 60), (101, None), (102, ""), (None, phrase), (103, phrase), (103, phrase), (104, "ab" * 3000)]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, row string, n int")
    got = repeats.remove_repeats(docs, length=32, shard_bytes=2000, group_limit=group_limit)
    assert key(got.select(COLUMNS).collect()) == key(brute.repeats(rows, 32))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(docs).count() == 0


def test_equal_windows_have_equal_anchors_in_slices_of_all_lengths(monkeypatch):
    def grams(data):
        out = np.full(len(data) - 15, 1 << 63, np.uint64)
        out[[10, 20]] = (1 << 20) + (1 << 12), 1 << 20  # they differ in a bit that a long slice has for places
        return out

    monkeypatch.setattr(repeats, "_grams", grams)
    short, long = (repeats.windows(np.zeros(n, np.uint8), np.array([0, 400, n][: 2 + (n > 400)]), 400) for n in (400, 100_000))
    assert short[4][0] == long[4][0]


def test_an_index_stays_in_the_cache(monkeypatch):
    sizes = []
    monkeypatch.setattr(repeats, "shard_marks", lambda contexts, weights, length: sizes.append(sum(map(len, contexts))) or [[] for _ in contexts])
    rows = [{"anchor": i // 2, "ctx": i, "weight": 1, "bytes": b"a" * 10_000} for i in range(200)]
    list(repeats._index(400, repeats.SHARD_BYTES)(iter([pa.RecordBatch.from_pylist(rows)])))
    assert sum(sizes) == 2_000_000 and max(sizes) <= 300_000
