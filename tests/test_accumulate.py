"""Accumulators of the user's own, streamed dead letters, and map lookups that ask for few keys."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators import accumulate, side
from sluiceway.plans import inputs
from sluiceway.session import fresh_dir
from sluiceway.sinks import streams

LONGEST = accumulate.Accumulator(
    create=lambda: None,
    add=lambda best, values: max([best or "", *values.drop_null().to_pylist()], key=lambda v: (len(v), v)),
    merge=lambda a, b: max((x for x in (a, b) if x is not None), key=lambda v: (len(v), v), default=None),
    extract=lambda best: best,
    state=T.StringType(),
    result=T.StringType(),
)


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).cast("bigint")
    name = F.when(F.col("id") % 7 != 0, F.repeat(F.lit("x"), (F.col("id") % 11).cast("int")))
    return spark.range(0, 5000, 1, 6).select(key.alias("k"), (F.col("id") % 2 == 0).alias("even"), name.alias("v"), "id")


@pytest.mark.parametrize("keys", [["k"], ["k", "even"], []])
@pytest.mark.parametrize("most", [3, 100_000])
def test_accumulators_against_one_fold(rows, keys, most):
    got = accumulate.combine_accumulated(rows, keys, "v", LONGEST, "longest", most)
    want: dict = {}
    for r in rows.collect():
        key = tuple(r[k] for k in keys)
        want[key] = max([want.get(key, ""), r["v"] or ""], key=len)
    assert {tuple(r)[:-1]: r["longest"] for r in got.collect()} == want and got.count() == len(want)
    spread = accumulate.combine_accumulated(rows, keys, "id", inputs.SPREAD, "s", most)
    sums: dict = {}
    for r in rows.collect():
        n, s, q = sums.get(tuple(r[k] for k in keys), (0, 0, 0))
        sums[tuple(r[k] for k in keys)] = (n + 1, s + r["id"], q + r["id"] ** 2)
    assert {tuple(r)[:-1]: r["s"] for r in spread.collect()} == {k: float(n * q - s * s) for k, (n, s, q) in sums.items()}


def test_one_row_per_key_and_task_is_shuffled(spark, rows):
    partial = rows.select("k", "v").mapInArrow(
        accumulate._partial(LONGEST, ["k"], "v", pa.schema([("k", pa.int64()), ("__state", pa.string())]), 100_000), "k long, __state string"
    )
    per_task = partial.groupBy("k", F.spark_partition_id()).count()
    assert per_task.where("count > 1").isEmpty() and partial.count() == 6 * 51


def test_no_rows_no_output(rows):
    assert accumulate.combine_accumulated(rows.limit(0), ["k"], "v", LONGEST, "longest").count() == 0
    assert accumulate.combine_accumulated(rows.limit(0), [], "v", LONGEST, "longest").count() == 0


def test_a_batch_that_failed_half_way_is_not_doubled(spark, rows, monkeypatch):
    path, rejects, commits = (fresh_dir(spark, n) for n in ("good", "bad", "commits"))
    judge = lambda df: streams.validate(df, {"odd": ~F.col("even")})
    publish = streams.batch_publisher(judge, path, rejects, commits)
    publish(rows.where("id < 1000"), 0)
    blocked = streams.batch_publisher(judge, path, "file:/dev/null/no-folder", commits)
    with pytest.raises(Exception):
        blocked(rows.where("id >= 1000"), 1)  # the good half is there by now
    count = lambda where: streams.committed(spark, where, commits).count()
    assert spark.read.parquet(path).count() == 2500 and count(path) == 500 and count(rejects) == 500
    publish(rows.where("id >= 1000"), 1)
    assert count(path) == count(rejects) == 2500
    publish(rows.where("id >= 1000"), 1)  # a retry after the commit
    assert count(path) == count(rejects) == 2500
    assert streams.committed(spark, path, fresh_dir(spark, "none")).count() == 0


def test_a_large_map_is_reduced_to_the_keys_asked_for(spark, capsys):
    path = fresh_dir(spark, "map")
    spark.range(200_000).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("value")).write.parquet(path)
    spark.range(500_000, 500_002).select(F.lit(150_000).cast("long").alias("key"), F.lit("twice").alias("value")).write.mode("append").parquet(path)
    entries = spark.read.parquet(path)

    def stored(*keys):
        where = fresh_dir(spark, "probes")
        spark.createDataFrame([(k,) for k in keys], "x bigint").write.parquet(where)
        return spark.read.parquet(where)

    probes = stored(5, 5, None, 199_999, -1)
    got = side.with_map(probes, entries, "x", "key", "value")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(5, "v5"), (5, "v5"), (None, None), (199_999, "v199999"), (-1, None)]))
    got.explain()
    assert "LeftSemi" in capsys.readouterr().out
    with pytest.raises(Exception, match="duplicate key"):
        side.with_map(stored(150_000), entries, "x", "key", "value").collect()
    side.with_map(entries.withColumnRenamed("key", "x").drop("value"), probes.select(F.col("x").alias("key"), F.lit(1).alias("value")).distinct(), "x", "key", "value").explain()
    assert "LeftSemi" not in capsys.readouterr().out
