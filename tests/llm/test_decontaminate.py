from __future__ import annotations

import random

from sluiceway.llm import decontaminate, queries
from sluiceway.llm.arrow import table
from tests.compare import mismatch, reference
from tests.llm import brute


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_sql_and_brute_force(spark, sf):
    rows = queries.QUERIES["op9_winnowed_contamination"](spark, sf)
    assert mismatch(rows.toPandas(), reference(queries.ORACLES["op9_winnowed_contamination"], sf)) is None
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    assert got(rows) == sorted(brute.contamination(docs, items), key=repr)


def test_odd_rows(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(6)]
    passage = [f"p{i}" for i in range(40)]
    items = [(1, " ".join(passage)), (2, " ".join(passage[20:]) + " tail"), (3, "only four words here"), (4, None), (5, ""), (None, "nameless " * 14), (6, "w1 w2 w1 w2 " * 5), (6, "x y"), (7, "é ü")]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    for i in range(40, 60):
        a = rng.randint(0, 30)
        docs.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 300))) + ", " + "-".join(passage[a : a + rng.randint(5, 20)]).upper() + " Only four WORDS here"))
    docs += [(100, None), (101, ""), (102, "..."), (None, " ".join(passage)), (103, "x y"), (103, "x y"), (104, "nameless " * 9000), (105, "é Ü é ü")]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in docs], "doc_id long, text string, n_hit int, hits string")
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, fp string")
    want = sorted(brute.contamination(docs, items), key=repr)
    assert got(decontaminate.contamination(df, bench)) == want
    assert got(decontaminate.contamination(df, bench.limit(0))) == sorted(brute.contamination(docs, []), key=repr)
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
