from __future__ import annotations

import numpy as np
import pytest

from sluiceway.llm import queries, vectors
from tests.compare import mismatch, reference


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op5_va_top_k"](spark, sf).toPandas()
    assert mismatch(got, reference(queries.ORACLES["op5_va_top_k"], sf)) is None


def brute(rows, k=10, every=100):
    whole = sorted({(i, tuple(int(np.floor(1024 * float(x))) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)})
    out = []
    for q, a in whole:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [16_384, 2])
def test_ties_copies_and_odd_rows(spark, block):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 6)]) for i in rng.permutation(700)]
    rows += [(i, rows[5][1]) for i in range(1000, 1400)]  # a very common vector
    rows += [(2000, None), (2001, []), (2100, [None] * 6), (2200, [float("nan")] * 6), (2300, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(2400, [0.5, 0.5]), (2401, [0.1, 0.1]), rows[0], rows[0], (-100, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(7)
    got = sorted(tuple(r) for r in vectors.top_k(df, query_block=block).collect())
    assert got == brute(rows)


def test_no_queries_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert vectors.top_k(df).count() == 0 and vectors.top_k(df.limit(0)).count() == 0
