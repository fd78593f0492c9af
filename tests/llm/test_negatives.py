from __future__ import annotations

import numpy as np
import pytest

from sluiceway.llm import negatives, queries
from tests.compare import mismatch, reference


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op11_l2ap_negatives"](spark, sf).toPandas()
    assert len(got) and mismatch(got, reference(queries.ORACLES["op11_l2ap_negatives"], sf)) is None


def brute(rows, every=100):
    """Rows are (id, vector, label)."""
    whole = sorted({
        (i, tuple(int(np.floor(256 * float(x))) for x in v), l)
        for i, v, l in rows if i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v)
    })
    out = []
    for i, a, l in whole:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, m) for j, b, m in whole if j != i and len(a) == len(b))
        for s, p, _ in [x for x in scored if x[2] == l][:5]:
            near = [(j, -t) for t, j, m in scored if m != l and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, p, n + 1, j, -s, t) for n, (j, t) in enumerate(near)]
    return sorted(out)


def got(df, **more):
    return sorted(tuple(r) for r in negatives.mine(df, **more).collect())


@pytest.mark.parametrize("block", [8_192, 2])
@pytest.mark.parametrize("kind", ["clustered", "flat", "steep"])
def test_ties_copies_and_odd_rows(spark, kind, block):
    rng = np.random.default_rng(5)
    if kind == "clustered":  # near neighbours of both labels
        centres = rng.normal(0, 0.3, (6, 20))
        made = centres[rng.integers(0, 6, 900)] + rng.normal(0, 0.05, (900, 20))
    elif kind == "flat":
        made = rng.normal(0, 0.2, (900, 20))
    else:  # most of the norm in few dimensions, so that the index leaves many out
        made = rng.normal(0, 1, (900, 20)) * 0.6 ** np.arange(20)
    rows = [(int(i), [float(x) for x in v], int(l)) for i, v, l in zip(rng.permutation(900), made, rng.integers(0, 4, 900))]
    rows += [(i, rows[5][1], i % 3) for i in range(1000, 1500)]  # a very common vector
    rows += [(2000, None, 1), (2001, [], 1), (2100, [None] * 20, 1), (2200, [float("nan")] * 20, 2), (2300, [float("-inf")] + [0.0] * 19, 2)]
    rows += [(None, [1.0] * 20, 1), (2400, [0.5, 0.5], 1), (2401, [0.5, 0.5], 1), (2402, [0.45, 0.5], 2), (2500, rows[9][1], None), rows[0], rows[0]]
    rows += [(2600, [0.0] * 20, 3), (-100, [-x for x in rows[7][1]], 1)]
    df = spark.createDataFrame([(i, v, l, 1) for i, v, l in rows], "vec_id long, embedding array<double>, label int, rank int").repartition(7)
    assert got(df, anchor_block=block) == brute(rows)


def test_small_chunks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 9)], int(rng.integers(0, 2))) for i in range(300)]
    windows = negatives.Windows(
        np.array([[int(np.floor(256 * x)) for x in rows[0][1]]]), np.array([0]), np.array([rows[0][2]]), np.zeros(1, int),
        np.array([-np.inf]), np.array([np.inf]), 5, True,
    )
    for lo in range(0, 300, 7):  # a threshold that rises from chunk to chunk
        part = rows[lo : lo + 7]
        windows.add(np.array([r[0] for r in part]), np.array([r[2] for r in part]), np.array([[int(np.floor(256 * x)) for x in r[1]] for r in part]))
    anchor = windows.anchors[0]
    want = sorted((-int(sum(int(np.floor(256 * x)) * y for x, y in zip(v, anchor))), i) for i, v, l in rows if i and l == rows[0][2])
    assert windows.best[0] == want[:5]


def test_no_anchors_no_positives_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], "vec_id long, embedding array<double>, label int")
    assert got(df) == [] and got(df.limit(0)) == []
    assert got(spark.createDataFrame([(0, [1.0], 1), (2, [1.0], 2)], df.schema)) == []
    with pytest.raises(Exception, match="too long"):
        got(spark.createDataFrame([(0, [1e12], 1), (2, [1.0], 2)], df.schema))
