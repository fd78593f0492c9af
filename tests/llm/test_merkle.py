from __future__ import annotations

import hashlib
import zlib

import pytest

from sluiceway.llm import merkle, queries
from tests.compare import mismatch, reference
from tests.llm.brute import lowered


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def tree(digests):
    """The root, and per leaf the siblings left and right on each level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for leaf, i in enumerate(at):
            lo = i // 8 * 8
            paths[leaf].append(("".join(digests[lo:i]), "".join(digests[i + 1 : lo + 8])))
        at = [i // 8 for i in at]
        digests = [sha("".join(digests[lo : lo + 8])) for lo in range(0, len(digests), 8)]
    return digests[0], paths


def brute(rows):
    """Rows are (doc_id, text, lang, source, n_chars)."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[name] = tree([leaf_of(r, r[1]) for r in groups[name]])
    root, over = tree([trees[n][0] for n in names]) if names else (None, [])
    out = []
    for name, upper in zip(names, over):
        for row, path in zip(groups[name], trees[name][1]):
            leaf = given = leaf_of(row, row[1])
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
                given = leaf_of(row, lowered(row[1]))
            proof = sha("".join(a + b for a, b in path + upper))
            for a, b in path + upper:
                given = sha(a + given + b)
            out.append((row[0], leaf, trees[name][0], root, proof, given, given == root))
    return sorted(out, key=repr)


def got(spark, rows):
    wide = [(*r, "c", 1) for r in rows]
    df = spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, digest string, grp int").repartition(5)
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=repr)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op13_interval_manifest"](spark, sf).toPandas()
    assert mismatch(rows, reference(queries.ORACLES["op13_interval_manifest"], sf)) is None
    assert 0 < (~rows["verified"]).sum() < len(rows) / 2


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8}, {"a": 9, None: 1}, {"a": 64, "b": 65, "é": 513, "": 7, None: 130}, {f"g{i}": 1 + i % 3 for i in range(70)}])
def test_sizes_of_groups(spark, sizes):
    rows = [(1000 * g + i, f"Text {i}", name, "s", i) for g, (name, n) in enumerate(sizes.items()) for i in range(n)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "en", "a", 0), (None, "A", "en", "a", None), (2, "-", "en", None, 18), (2, "-", "en", None, 18)]
    rows += [(2, "Other", "en", "b", 1), (7, "LONG É " * 200_000, "de", "", -5), (11, "AbC", "de", "-", 3), (-4, "x", "", "1:a", 1)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
