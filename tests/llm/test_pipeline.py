from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluiceway.llm import mixing, stages
from sluiceway.llm.arrow import saved, table
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_after_another(spark, sf):
    docs = table(spark, sf, "documents")
    by_stage = []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, sf), name)
        by_stage.append(docs)
    assert [d.columns for d in by_stage[:-1]] == [COLUMNS] * 4
    quality, groups, clean, mixed, tokens = by_stage
    kept = quality.select("doc_id", "text").collect()
    label = brute.components([r.doc_id for r in kept], [brute.fingerprint(r.text) for r in kept])
    assert sorted(r.doc_id for r in groups.collect()) == sorted(r.doc_id for r, c in zip(kept, label) if r.doc_id == c)
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    judged = brute.contamination([(r.doc_id, r.text) for r in groups.collect()], items)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(j[0] for j in judged if not j[5])
    assert tokens.count() == mixed.count() > 0
    assert tokens.agg(F.countDistinct("start")).first()[0] == mixed.count()


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0


def test_stages_on_odd_rows(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "one two three four", "en", None, 18), (2, "one two three four", "en", None, 18), (None, "nameless text of words", "en", "b", 22)]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    once = stages.one_of_each_group(spark, docs, sf)
    assert sorted(map(str, (r.doc_id for r in once.collect()))) == ["1", "2", "None"]  # no text is a near copy of an empty one
    for stage in (stages.keep_quality, stages.one_of_each_group, stages.without_benchmarks, stages.mixed):
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert stages.token_files(spark, docs, sf).count() == 5 and stages.token_files(spark, docs.limit(0), sf).count() == 0


def made(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")


ONE = "an entirely different text about the weather in the mountains and the sea " * 3
TWO = "numbers and figures of quite another kind fill these lines from end to end " * 3


@pytest.mark.parametrize("nameless", [[], [(None, "a third text that has no id at all but says something of its own here", "x")]])
def test_no_row_goes_for_its_id(spark, sf, nameless):
    rows = [(1, ONE, "a"), (1, TWO, "a"), *nameless]
    got = stages.one_of_each_group(spark, made(spark, rows), sf).collect()
    assert sorted(r.text for r in got) == sorted(t for _, t, _ in rows)


def test_near_copies_without_ids_go(spark, sf):
    rows = [(None, ONE, "a"), (None, ONE.upper(), "b"), (None, TWO, "a"), (5, TWO, "c"), (3, TWO, "c"), (3, TWO, "d")]
    got = stages.one_of_each_group(spark, made(spark, rows), sf).collect()
    assert len(got) == 2 and {(r.doc_id, r.text) for r in got if r.doc_id} == {(3, TWO)}


@pytest.mark.parametrize("doc_id", [7, None])
def test_no_contaminated_row_stays_for_a_clean_one_of_its_id(spark, sf, doc_id):
    passage = table(spark, sf, "benchmark").where("length(text) > 200").first().text
    got = stages.without_benchmarks(spark, made(spark, [(doc_id, passage, "a"), (doc_id, ONE, "a")]), sf).collect()
    assert [r.text for r in got] == [ONE]


def test_rows_of_one_id_are_mixed_by_themselves(spark, sf):
    rows = [(1, "a b c", "s"), (1, "d " * 50, "t"), (None, "e " * 20, "s"), (None, "f " * 9, "u"), (1, "a b c", "s")]
    docs = made(spark, rows)
    got = stages.mixed(spark, docs, sf).collect()
    taken: dict = {}
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.size, r.source_size] = taken.get((r.doc_id, r.size, r.source_size), 0) + r.taken
    assert sum(len(r.text.split()) for r in got) == sum(taken.values())
    assert all(any(r.doc_id == i and t.startswith(r.text) for i, t, _ in rows) for r in got)


@pytest.mark.parametrize("name, _", corpus_pipeline.STAGES)
def test_names(name, _):
    assert 0 < len(name) <= 40
