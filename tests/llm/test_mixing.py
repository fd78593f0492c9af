from __future__ import annotations

import re

import pytest

from sluiceway.llm import mixing, queries
from sluiceway.llm.arrow import table
from tests.compare import mismatch, reference


def check(given, got, exact=True):
    """Sizes, targets by filling up, and what each source is taken."""
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, size(t)) for i, t, _ in given)
    total: dict = {}
    for _, t, s in given:
        total[s] = total.get(s, 0) + size(t)
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    everything, capped = sum(total.values()), set()
    while True:
        rest = everything - sum(3 * total[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * total[s] if s in capped else rest * weight[s] / free for s in names}
        more = {s for s in names if s not in capped and target[s] > 3 * total[s]}
        if not more:
            break
        capped |= more
    source = {i: s for i, _, s in given}
    taken: dict = {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s in names:
        assert taken[s] == pytest.approx(target[s], abs=1.01)


def test_query(spark, sf):
    docs = table(spark, sf, "documents")
    given = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = queries.QUERIES["op7_source_schedule"](spark, sf).collect()
    check(given, got)
    assert mismatch(docs.sparkSession.createDataFrame(got).toPandas(), reference(queries.ORACLES["op7_source_schedule"], sf)) is None
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


@pytest.mark.parametrize("block", [512, 7])
def test_odd_rows(spark, block):
    given = [(i, "word " * (i % 23), f"s{i % 7}") for i in range(300)]
    given += [(1000, None, "s1"), (1001, "", "s1"), (1002, " \t\n", "blank"), (1003, "a b", None), (1004, "x " * 20_000, "big"), (1005, "tiny", "\U0001f600"), (1006, "tiny", "￿")]
    docs = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in given], "doc_id long, text string, source string, size int, s int")
    check(given, mixing.mix(docs, block_words=block).collect())
    assert mixing.mix(docs.limit(0)).count() == 0
    nothing = docs.where("doc_id in (1000, 1001)")
    assert [(r.size, r.taken) for r in mixing.mix(nothing).collect()] == [(0, 0)] * 2


def test_repeated_and_nameless_rows(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", "s"), (None, "d e", "s"), (None, "f", "t")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sum(r.size for r in got) == 11 and len(got) == 5 and sum(r.taken for r in got) in (10, 11)


def test_applied_mix_has_the_taken_words(spark, sf):
    docs = table(spark, sf, "documents")
    mixed = mixing.mix(docs).cache()
    out = mixing.applied(docs, mixed)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall("[^\x20\x09-\x0d]+", r.text))
    assert words == {r.doc_id: r.taken for r in mixed.collect() if r.taken}
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(whole[r.doc_id].startswith(r.text) and len(r.text) == r.n_chars for r in out.collect())
