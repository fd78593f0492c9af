from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluiceway.llm import attention, language, queries
from sluiceway.llm.arrow import table
from sluiceway.llm.vocabularies import vocabulary
from tests.llm.brute import lowered

PATH = vocabulary("byte_bpe_50k.json")
WORD = re.compile("[^\x20\x09-\x0d]+")
END = object()


def held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base(rows):
    """(held_out, n_tokens, n_known, train_tokens, base_score) per row of (id, text)."""
    said = [[*WORD.findall(lowered(t or "")), END] for _, t in rows]
    seen = Counter(w for (i, _), words in zip(rows, said) if not held(i) for w in words)
    n, v = sum(seen.values()), len(seen)
    return [
        (held(i), len(words), sum(w in seen for w in words), n, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in words))
        for (i, _), words in zip(rows, said)
    ]


def plain(model: attention.Model, tokens: list[int]) -> float:
    """One position after the other, without batches or masks."""
    w, total = model.weights, 0.0
    inputs = [model.start, *tokens[:-1]]
    for at, token in enumerate(tokens):
        first = 0 if at < attention.WINDOW else -(-(at + 1 - attention.WINDOW) // attention.STRIDE) * attention.STRIDE
        h = np.array([w.embedding[t] + w.place[i] for i, t in enumerate(inputs[first : at + 1])], np.float64)
        q, k, v = np.split(h @ w.mix, 3, axis=1)
        a = np.exp(k @ q[-1] / math.sqrt(attention.DIM))
        z = (h[-1] + (a / a.sum()) @ v @ w.back) @ w.out + w.bias
        log = z - np.log(np.exp(z).sum())
        total += log[model.of[token]] + model.inside[model.kind[inputs[at]], token]
    return total / math.log(10)


def small_model(seed=0) -> attention.Model:
    rng = np.random.default_rng(seed)
    of = rng.integers(0, attention.CLASSES, 300)
    of[: attention.CLASSES] = np.arange(attention.CLASSES)
    kind = rng.integers(0, attention.CONTEXTS, 300)
    after = rng.poisson(0.3, (attention.CONTEXTS, 300)).astype(np.float32)
    return attention.Model(attention.fresh(300, attention.CLASSES, seed), of, kind, attention.inside_log(after, of), 7)


def test_batches_against_one_position_at_a_time():
    model, rng = small_model(), np.random.default_rng(1)
    texts = [rng.integers(0, 300, n).tolist() for n in (1, 2, 47, 48, 49, 84, 85, 1, 400, 5)] + [[3] * 200]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = model.log10(np.concatenate(texts), offsets)
    assert np.allclose(got, [plain(model, t) for t in texts], rtol=1e-5)


def test_probabilities_add_up_to_one():
    model = small_model(2)
    inputs = np.random.default_rng(3).integers(0, 300, (1, attention.WINDOW))
    f = attention.features(model.weights, inputs)
    p = np.exp(attention.class_log(model.weights, f))[0][:, model.of] * np.exp(model.inside[model.kind[inputs[0]]])
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_gradient_against_differences():
    rng, w = np.random.default_rng(4), attention.fresh(30, attention.CLASSES, 5)
    inputs, wanted = rng.integers(0, 30, (2, attention.WINDOW)), rng.integers(0, attention.CLASSES, (2, attention.WINDOW))
    counts = rng.random((2, attention.WINDOW)) < 0.8

    def loss() -> float:
        log = attention.class_log(w, attention.features(w, inputs))
        return -float(np.take_along_axis(log, wanted[:, :, None], 2)[:, :, 0][counts].mean(dtype=np.float64))

    for part, slope in zip(w.parts(), attention.gradient(w, inputs, wanted, counts)):
        flat = part.reshape(-1)
        for i in np.argsort(-np.abs(slope.reshape(-1)))[:4]:
            value = flat[i]
            flat[i] = value + 0.01
            up = loss()
            flat[i] = value - 0.01
            down = loss()
            flat[i] = value
            assert (up - down) / 0.02 == pytest.approx(slope.reshape(-1)[i], rel=0.05, abs=2e-5)


def test_every_token_counts_once():
    sizes = [0, 1, 35, 36, 37, 48, 49, 120, 1000]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    tokens, hits = np.arange(offsets[-1]), []
    for _, targets, counts, _ in attention.windows(tokens, offsets, 0):
        hits += targets[counts].tolist()
    assert sorted(hits) == tokens.tolist()


def test_words_are_those_of_the_pattern():
    texts = ["", None, " a\tB\x0bc\x0cd\re\n", "É x　y\x1cz", "\x85 \x00 A", "one  two"]
    at, distinct, sizes = language.words(pa.array(texts))
    want = [WORD.findall(lowered(t or "")) for t in texts]
    assert [distinct[i] for i in at] == [w for ws in want for w in ws] and sizes.tolist() == [len(w) for w in want]


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op12_attention_scores"](spark, sf).collect()}
    assert len(got) == len(rows)
    for (doc_id, _), want in zip(rows, base(rows)):
        r = got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4] and r.base_score == pytest.approx(want[4], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got.values())


def test_better_than_the_base_on_texts_it_has_not_seen(spark):
    out = queries.QUERIES["op12_attention_scores"](spark, "/root/testdata/sf0.1").where("held_out")
    score, base_score = out.selectExpr("sum(score)", "sum(base_score)").first()
    assert score > base_score


@pytest.mark.parametrize("frequent", [language.FREQUENT, 20])
def test_odd_rows_and_what_is_held_out(spark, frequent):
    rng = np.random.default_rng(9)
    some = [i for i in range(60) if held(i)][:3]
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.5, 30) if x < 500)) for i in range(60)]
    rows += [(None, None), (100, ""), (101, " \t"), (102, "W1 w1 É <|endoftext|> x y"), (103, "the " * 30_000), (4, "w1 w2"), (4, "w1 w2"), (None, "w1 rare")]

    def run(rows):
        df = spark.createDataFrame([(i, t, 1.0, "c") for i, t in rows], "doc_id long, text string, score double, word string").repartition(3, "doc_id")
        return [tuple(r) for r in language.score(df, PATH, steps=20, frequent=frequent).collect()]

    got = run(rows)
    want = sorted(((i, *b) for (i, _), b in zip(rows, base(rows))), key=repr)
    assert [g[:5] for g in sorted(got, key=repr)] == [w[:5] for w in want]
    assert np.allclose(sorted(g[5] for g in got), sorted(w[5] for w in want))
    changed = run([(i, "quite another text" if i in some else t) for i, t in rows])
    same = lambda found: sorted((g for g in found if g[0] not in some), key=repr)
    assert [g[:5] for g in same(changed)] == [g[:5] for g in same(got)] and np.allclose([g[6] for g in same(changed)], [g[6] for g in same(got)])
    assert run([]) == []
    alone = run([(some[0], "w1 w2")])
    assert alone[0][:6] == (some[0], True, 3, 0, 0, 0.0) and alone[0][6] < 0


def learned_by(texts, of, code="H"):
    """What one task hands on for these texts: tokens met in the embeddings' blocks, how often, and tokens seen."""
    weights = attention.fresh(len(of), attention.CLASSES)
    run = language._learn(code, weights, attention.no_squares(weights), of, 7, 1)
    rows = [r for b in run(pa.RecordBatch.from_arrays([pa.array([np.array(t, code).tobytes()])], names=["ids"]) for t in texts) for r in b.to_pylist()]
    met = Counter()
    for r in rows:
        if r["block"] >= 0:
            n = np.frombuffer(r["sums"], np.float32).reshape(-1, attention.DIM + 1)[:, -1]
            met.update(dict(zip(np.frombuffer(r["tokens"], np.int32).tolist(), n.astype(int).tolist())))
    flat = np.frombuffer(b"".join(r["sums"] for r in sorted(rows, key=lambda r: -r["block"]) if r["block"] < 0))
    return met, flat[-1], rows


def test_the_weights_learn_from_every_token():
    """Attention layer and embeddings are no sample's: a task goes through every token of every text."""
    rng = np.random.default_rng(12)
    texts = [rng.integers(0, 600, n).tolist() for n in (1, 48, 49, 500, 5_000)]
    met, seen, rows = learned_by(texts, rng.integers(0, attention.CLASSES, 600))
    assert seen == sum(map(len, texts))
    assert set(met) >= {7, *(t for text in texts for t in text[:-1])}
    again = pa.Table.from_pylist([r for r in rows if r["block"] == 1] * 2, schema=language._BLOCKS)
    once = language._added(again.slice(0, 1)).to_pylist()
    assert np.allclose(*(np.frombuffer(x["sums"], np.float32) for x in (once[0], language._added(again).to_pylist()[0])))


def test_a_document_is_one_row_whatever_words_it_has(spark):
    """All that reads the ids, turn after turn, goes through the documents and not through their rare words as well."""
    texts = ["a rare1 rare2 A", "", None, "rare1 a", " rare3 rare3\t"]
    run = language._prepare(PATH, pa.array(["a"]), np.array([3]), 9, 4, 5, pa.int64())
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").selectExpr("id", "text", "false as held_out").coalesce(1)
    schema = "row long, id long, held_out boolean, n_tokens long, known long, base double, ids binary, words array<string>"
    got = sorted(df.mapInArrow(run, schema).collect(), key=lambda r: r.id)
    assert [r.words for r in got] == [["rare1", "rare2"], [], [], ["rare1"], ["rare3", "rare3"]]
    assert [(r.n_tokens, r.known) for r in got] == [(5, 3), (1, 1), (1, 1), (3, 2), (3, 1)]
    floor = math.log10(9 + 4 + 1)
    assert [r.base for r in got] == pytest.approx([(n + 1) * -floor + n * math.log10(4) + math.log10(6) for n in (2, 0, 0, 1, 0)])


def test_classes_and_tokens_after_are_counted_in_one_pass(spark):
    rng = np.random.default_rng(15)
    of, kind = rng.integers(0, attention.CLASSES, 400), rng.integers(0, attention.CONTEXTS, 400)
    texts = [rng.integers(0, 400, n).tolist() for n in (0, 1, 2, 300, 700)]
    df = spark.createDataFrame([(bytearray(np.array(t, "H").tobytes()),) for t in texts], "ids binary").repartition(3)
    got = language._summed(df, language._pair_counts("H", 7, language._after(of, kind)), 400 * (attention.CLASSES + attention.CONTEXTS))
    classes, tokens = np.zeros((400, attention.CLASSES)), np.zeros((attention.CONTEXTS, 400))
    for text in texts:
        for a, b in zip([7, *text], text):
            classes[a, of[b]] += 1
            tokens[kind[a], b] += 1
    assert np.array_equal(got, np.concatenate([classes.ravel(), tokens.ravel()]))


def test_positions_that_score_nothing_are_not_worked_out():
    """Windows after a text's first give features of the positions they score, the same as with all of them."""
    model, inputs = small_model(5), np.random.default_rng(6).integers(0, 300, (3, attention.WINDOW))
    begin = attention.WINDOW - attention.STRIDE
    some = attention.features(model.weights, inputs, begin)
    assert some.shape[1] == attention.STRIDE and np.allclose(some, attention.features(model.weights, inputs)[:, begin:], atol=1e-5)


def test_counts_of_neighbours_are_of_every_token(spark):
    """Classes and kinds of context come from the pairs of all texts."""
    rng = np.random.default_rng(14)
    texts = [rng.integers(0, 400, n).tolist() for n in (0, 1, 2, 300, 700)]
    mark = np.full(400, -1)
    mark[:200] = rng.permutation(200)
    df = spark.createDataFrame([(bytearray(np.array(t, "H").tobytes()),) for t in texts], "ids binary").repartition(3)
    width = 2 * attention.BESIDE
    got = language._summed(df, language._pair_counts("H", 7, language._beside(mark)), 400 * width).reshape(-1, width)
    want = np.zeros_like(got)
    for text in texts:
        for a, b in zip([7, *text], text):
            want[b, mark[a]] += mark[a] >= 0
            want[a, attention.BESIDE + mark[b]] += mark[b] >= 0
    assert np.array_equal(got, want)


def test_subwords_are_the_library_s_and_words_in_use_stay(monkeypatch):
    monkeypatch.setattr(language, "REMEMBERED", 100)
    coder, asked = language.Subwords(PATH), []
    made = coder.words.made
    coder.words.made = lambda word: asked.append(word) or made(word)
    for i in range(40):
        text = f"frequent it's É日!? <|endoftext|>x {i} " + " ".join(chr(97 + i % 26) + chr(97 + i // 26) + x for x in "abcdefghij")
        tokens, offsets, _ = coder.ids(pa.array([text, None]))
        want = [x for w in WORD.findall(lowered(text)) for x in coder.tokenizer.encode(" " + w, add_special_tokens=False).ids] + [coder.end]
        assert tokens.tolist() == [*want, coder.end] and offsets.tolist() == [0, len(want), len(want) + 1]
    assert asked.count(" frequent") == 1 and len(coder.words) + len(coder.words.before) <= 101
