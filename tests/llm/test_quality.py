from __future__ import annotations

import random
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa

from sluiceway.llm import quality, queries, wordhash
from sluiceway.llm.arrow import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op4_neighbour_votes"](spark, sf).toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    judged = got[got["held_out"]].merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    right = judged["predicted"] == judged["quality"]
    assert right.mean() >= 0.95
    assert right[judged["quality"] == 1].mean() >= 0.97


def test_only_the_text_makes_the_score(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit(docs, labels)
    flipped = labels.withColumn("quality", quality.held_out(labels["doc_id"]).cast("int"))
    mixed = labels.where(~quality.held_out(labels["doc_id"])).unionByName(flipped.where(quality.held_out(flipped["doc_id"])))
    assert (quality.fit(docs, mixed).vectors == model.vectors).all()
    text = docs.select("text").first().text
    rows = spark.createDataFrame([(1, text, "en"), (2, text, "xx"), (None, text, None)], "doc_id long, text string, lang string")
    scores = {r.s for r in rows.select(quality.score_column(rows, rows["text"], model).alias("s")).collect()}
    assert len(scores) == 1


def test_odd_rows(spark, sf):
    labels = table(spark, sf, "labels")
    known = table(spark, sf, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (None, "a"), (9003, "b " * 30_000), (9004, "twice"), (9004, "twice")], known.schema)
    docs = known.unionByName(odd).selectExpr("doc_id", "text", "'c' as score", "1 as _label")
    got = quality.score_documents(docs, labels).where("doc_id is null or doc_id > 9000").collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (9001, 9002)}) == 1
    assert {r.score for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def sample_model(sf: str) -> tuple[quality.Model, pd.DataFrame]:
    rows = pd.read_parquet(f"{sf}/documents.parquet").merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    counts = quality.term_counts(pa.array(rows["text"]))
    return quality.latent([quality.pack(c) for c in counts], rows["quality"].to_numpy(float)), rows


def test_every_term_of_the_whole_text_is_counted():
    texts = ["The cat saw the dog. " * 500 + "end", "dog the saw cat THE", "né", "abc", "", None, "a"]
    counts = quality.term_counts(pa.array(texts))
    edges = np.concatenate([[0], np.cumsum(quality.WIDTHS)])
    sums = [[counts[i, lo:hi].sum() for lo, hi in zip(edges[:-1], edges[1:])] for i in range(len(texts))]
    for text, (words, runs, pairs, kinds) in zip(texts, sums):
        size = len((text or "").encode())
        n = len(re.findall(r"\w+", text or ""))
        assert (words, runs, pairs) == (n, max(0, size - 3), max(0, n - 1))
        assert kinds >= max(0, size - 2)
    one = quality.term_counts(pa.array(["the cat saw the dog"]))[0]
    assert (one[: quality.WORDS] == counts[1, : quality.WORDS]).all() and (one != counts[1]).any()  # other order, same words
    alone = np.concatenate([quality.term_counts(pa.array([t], pa.string())) for t in texts])
    assert (alone == counts).all()


def test_votes_are_those_of_all_cosines():
    model, rows = sample_model("/root/testdata/sf0.01")
    texts = list(rows["text"][:150]) + ["Win big at our casino. " * 20, "x", ""]
    got = model.score(quality.term_counts(pa.array(texts)))
    for text, score in zip(texts, got):
        counts = quality.term_counts(pa.array([text]))[0].astype(float)
        whole = np.sqrt(counts) * model.weight.astype(float)
        at = 0
        for width, share in zip(quality.WIDTHS, quality.SHARES):
            part = whole[at : at + width]
            if part.any():
                part *= np.sqrt(share) / np.sqrt((part * part).sum())
            at += width
        if not whole.any():
            assert score == model.labels.mean()
            continue
        inner = whole @ model.basis.astype(float)
        explained = min(1.0, np.linalg.norm(inner) / np.linalg.norm(whole) / model.usual)
        cosines = [float(inner @ v.astype(float)) / np.linalg.norm(inner) for v in model.vectors]
        nearest = sorted(range(len(cosines)), key=lambda j: -cosines[j])[: quality.NEIGHBOURS]
        weights = [min(1.0, max(0.0, cosines[j])) ** quality.POWER for j in nearest]
        share = sum(w * model.labels[j] for w, j in zip(weights, nearest)) / sum(weights)
        known = explained**quality.POWER
        assert abs(known * share + (1 - known) * quality.ACCEPT - score) < 2e-3


def test_words_count():
    model, rows = sample_model("/root/testdata/sf0.1")
    good = list(rows["text"][rows["quality"] == 1][:80])
    draw = random.Random(3)

    def letters(text: str) -> str:
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") if c.islower() else c for c in text)

    def shuffled(text: str) -> str:
        words = text.split(" ")
        draw.shuffle(words)
        return " ".join(words)

    def scores(texts: list[str]) -> float:
        return model.score(quality.term_counts(pa.array(texts))).mean()

    clean = scores(good)
    assert scores([letters(t) for t in good]) < clean - 0.12
    assert scores([shuffled(t) for t in good]) < clean - 0.02
    assert scores(["Win big at our casino today and buy cheap pills online. Click here now. " * 8]) < clean - 0.3


def test_work_arrays_stay_small():
    words = np.random.default_rng(3).integers(0, 50_000, (512, 1_400))
    column = pa.array([" ".join(f"w{x}" for x in row) for row in words.tolist()])  # 5 MB
    wordhash._powers.cache_clear()
    tracemalloc.start()
    quality.term_counts(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6  # the counts have 14 MB
