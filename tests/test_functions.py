from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.functions import render, sharding, text


def test_sha_shard_equals_hashlib(spark):
    ids = [0, 1, 2, 3, 4, 1 << 40, -1, -(1 << 63), (1 << 63) - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint").select("id", sharding.sha_shard(F.col("id"), 10).alias("d"))
    for r in rows.collect():
        digest = hashlib.sha256(r["id"].to_bytes(8, "big", signed=True)).digest()
        assert r["d"] == int.from_bytes(digest[:8], "big", signed=True) % 10


def test_floor_and_truncating_modulus(spark):
    row = spark.range(1).select(
        sharding.shard_key(F.lit(-7), 3).alias("floor"),
        sharding.remainder_key(F.lit(-7), 3).alias("cut"),
        sharding.destination_name(F.lit(7).cast("bigint"), 10).alias("name"),
    ).first()
    assert (row["floor"], row["cut"], row["name"]) == (2, -1, "00000007-of-00000010")


def split_model(line: str) -> list[str]:
    """Split on non-letters, a leading empty piece kept, trailing ones dropped, no match keeps the line."""
    pieces = re.split(r"[^a-zéß]+", line)
    if len(pieces) == 1:
        return pieces
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


CASES = ["", "a", ",a b,", ",,", "é1ß", " a", "a\n\nb", "a\n", "\n", "a\r\nb\rc", "1\n2a"]


def test_tokens(spark):
    rows = spark.createDataFrame([(c,) for c in CASES], "t string").select(
        "t", text.text_tokens(F.col("t")).alias("w")
    )
    for r in rows.collect():
        body = re.split(r"\r\n|\r|\n", r["t"])
        if body[-1] == "":
            body.pop()
        assert sorted(r["w"]) == sorted(w for line in body for w in split_model(line)), repr(r["t"])


def test_line_tokens(spark):
    single = [c for c in CASES if not set(c) & set("\r\n")]
    rows = spark.createDataFrame([(c,) for c in single], "t string").select("t", text.line_tokens(F.col("t")).alias("w"))
    assert {r["t"]: r["w"] for r in rows.collect()} == {c: split_model(c) for c in single}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abé ,1\n\r", max_size=12), min_size=1, max_size=20))
def test_tokens_random(spark, bodies):
    rows = spark.createDataFrame([(c,) for c in bodies], "t string").select(
        "t", text.text_tokens(F.col("t")).alias("w")
    )
    for r in rows.collect():
        body = re.split(r"\r\n|\r|\n", r["t"])
        if body[-1] == "":
            body.pop()
        assert sorted(r["w"]) == sorted(w for line in body for w in split_model(line)), repr(r["t"])


@pytest.mark.parametrize(
    "message, want",
    [
        ("a:1 b:2 bad c:3", [("a", "1"), ("b", "2")]),
        (" a:1", []),
        ("", []),
        ("k:v:w x:", [("k", "v:w"), ("x", "")]),
        ("bad", []),
        ("a:1\t\tb:2  ", [("a", "1"), ("b", "2")]),
        (":v", [("", "v")]),
    ],
)
def test_kv_words(spark, message, want):
    row = spark.createDataFrame([(message,)], "t string").select(text.kv_words(F.col("t")).alias("kv")).first()
    assert [tuple(p) for p in row["kv"]] == want


def test_render(spark):
    rows = spark.createDataFrame([(1, "a<b>&\"c\"")], "id bigint, t string")
    assert rows.select(render.row_json(rows)).first()[0] == '{"id":1,"t":"a<b>&\\"c\\""}'
    assert rows.select(render.xml_escape(F.col("t"))).first()[0] == 'a&lt;b&gt;&amp;"c"'
    assert rows.select(render.trace_line("x", F.col("id"))).first()[0] == "[x] element:1, timestamp:-, window:-"
