from __future__ import annotations

import random

import pytest

from sluiceway.llm import queries, simhash
from sluiceway.llm.arrow import table
from sluiceway.llm.components import components
from tests.llm import brute


def expected(rows, shingle=3, radius=3):
    prints = [brute.fingerprint(t, shingle) for _, t in rows]
    labels = brute.components([i for i, _ in rows], prints, radius)
    return sorted([(i, format(p, "016x"), c) for (i, _), p, c in zip(rows, prints, labels)], key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert got(queries.QUERIES["op10_bk_simhash"](spark, sf)) == expected(rows)


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (None, " \t"), (9, "One"), (8, "one "), (7, "a B"), (7, "a B"), (6, "x\ty\nz w"), (4, "é " * 3000), (None, "lonely words here")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, low int")
    assert got(simhash.near_duplicates(docs)) == expected(rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [2048, 3])
def test_links_of_dense_fingerprints(spark, limit):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for _ in range(400):
        p = rng.choice(sorted(prints))
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"), 3, limit)
    root = {r.node: r.root for r in components(links).collect()}
    want = brute.components(signed, prints)
    assert [root.get(p, p) for p in signed] == want


def test_tree_follows_only_what_it_must():
    rng = random.Random(4)
    keys = [rng.getrandbits(64) for _ in range(300)]
    keys = list(dict.fromkeys(keys + [k ^ 1 << rng.randrange(64) for k in keys[:50]]))
    tree = simhash.BKTree()
    for k in keys:
        tree.insert(k)
    for k in keys[:60]:
        assert sorted(tree.within(k, 3)) == [i for i, x in enumerate(keys) if (x ^ k).bit_count() <= 3]


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    root = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert root == {**{i: 0 for i in range(1, 61)}, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
