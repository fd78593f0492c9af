"""Sources, sinks and side inputs at their edges."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sluiceway.functions import sharding
from sluiceway.operators import elements, group, side
from sluiceway.operators.skew import spread
from sluiceway.plans.inputs import table
from sluiceway.session import fresh_dir, stream_session
from sluiceway.sinks import files, tables
from sluiceway.sources import batch, stream
from sluiceway.streaming import panes


def test_literal_rows_and_sequence(spark):
    assert batch.literal_rows(spark, [], "a int").count() == 0
    assert [r["value"] for r in batch.sequence(spark, 3, 6, 1).collect()] == [3, 4, 5]
    assert batch.sequence(spark, 1, 101).agg(F.sum("value")).first()[0] == 5050


def test_jdbc_and_kafka_options():
    plain = batch.jdbc_options("jdbc:x", "t")
    assert plain["dbtable"] == "t" and "partitionColumn" not in plain
    split = batch.jdbc_options("jdbc:x", "select a from t", partition_column="a", bounds=(0, 10), partitions=4)
    assert split["dbtable"] == "(select a from t) source" and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        batch.jdbc_options("jdbc:x", "t", partition_column="a")
    assert stream.kafka_options("h:1", ["a", "b"])["subscribe"] == "a,b"


def test_unbounded_sequence_goes_on_after_a_restart(spark):
    session = stream_session(spark)
    out, checkpoint = fresh_dir(spark, "out"), fresh_dir(spark, "cp")
    for _ in range(2):
        numbers = stream.unbounded_sequence(session, start=100, rows_per_batch=5)
        query = panes.stream_append(numbers, out, checkpoint, every="100 milliseconds")
        query.awaitTermination(4)
        query.stop()
    values = sorted(r["value"] for r in spark.read.parquet(out).collect())
    assert values == list(range(100, 100 + len(values))) and len(values) >= 10


def test_singleton_needs_exactly_one_row(spark):
    df = spark.range(3)
    assert side.with_singleton(df, spark.range(7, 8), "s").filter("s = 7").count() == 3
    for wrong in (spark.range(0), spark.range(2)):
        with pytest.raises(Exception, match="exactly one row"):
            side.with_singleton(df, wrong, "s").collect()


def test_list_limits_and_nulls(spark):
    df = spark.range(2)
    values = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    assert side.with_list(df, values, "v", "l").first()["l"] == [None, "a", "b"]
    assert side.with_list(df, values.limit(0), "v", "l").count() == 0
    pages = side.with_list(df, values, "v", "l", page_rows=2)
    assert sorted((r["id"], r["page"], len(r["l"])) for r in pages.collect()) == [(0, 0, 2), (0, 1, 1), (1, 0, 2), (1, 1, 1)]


def test_map_with_a_key_twice_fails(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k bigint, v string")
    with pytest.raises(Exception, match="duplicate key"):
        side.with_map(spark.range(3).withColumnRenamed("id", "x"), twice, "x", "k", "v").collect()


def test_empty_input_combines_to_nothing(spark):
    assert group.combine_globally(spark.range(0), {"s": F.sum("id")}).count() == 0


def test_trace_counts_through_an_observation(spark):
    seen = Observation()
    elements.trace(spark.range(5), "t", F.col("id"), observation=seen).count()
    assert seen.get == {"rows": 5}


def test_setup_runs_per_partition_and_is_released(spark):
    log = fresh_dir(spark, "log").replace("file:", "")

    def setup():
        import os

        os.makedirs(log, exist_ok=True)
        return log

    def process(folder, frame):
        return frame

    def teardown(folder):
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()

    import os

    assert elements.with_setup(spark.range(0, 10, 1, 3), setup, process, "id bigint", teardown).count() == 10
    assert len(os.listdir(log)) == 3


def test_append_needs_an_existing_table_of_the_same_schema(spark):
    path = fresh_dir(spark, "table")
    with pytest.raises(tables.TargetMissing):
        tables.append_existing(spark.range(2), path)
    spark.range(2).write.parquet(path)
    with pytest.raises(ValueError):
        tables.append_existing(spark.range(2).withColumn("x", F.lit(1)), path)
    tables.append_existing(spark.range(2), path)
    assert spark.read.parquet(path).count() == 4


def test_text_codecs(spark):
    rows = spark.range(5).select(F.col("id").cast("string").alias("value"))
    with pytest.raises(ValueError, match="zstd"):
        files.write_compressed(rows, fresh_dir(spark, "t"), "zstd", text=True)
    for codec in ("gzip", "bzip2"):
        path = fresh_dir(spark, codec)
        files.write_compressed(rows, path, codec, text=True)
        assert spark.read.text(path).count() == 5


def test_a_hot_destination_is_written_by_many_tasks(spark):
    rows = spark.range(0, 5000, 1, 4)
    path = fresh_dir(spark, "hot")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # would join these tiny shards again
    spark.conf.set(merge, "false")
    try:
        files.write_dynamic(rows, path, F.col("id"), F.lit(3).cast("bigint"), destinations=10, shards=8)
    finally:
        spark.conf.unset(merge)
    back = spark.read.text(path)
    assert back.select("destination").distinct().first()[0] == "00000003-of-00000010"
    assert 2 <= back.select(F.input_file_name()).distinct().count() <= 8
    assert back.count() == 5000


def test_shards_of_a_text_write(spark):
    path = fresh_dir(spark, "text")
    files.write_text(spark.range(100).select(F.col("id").cast("string").alias("value")), path, 3)
    assert spark.read.text(path).select(F.input_file_name()).distinct().count() == 3


def test_routes(spark):
    rows = spark.createDataFrame([("t1", None), ("t2", None), ("t3", None), ("t9", 1), (None, 1)], "dest string, value bigint")
    routes = {"t1": tables.Route(True), "t2": tables.Route(default=2), "t3": tables.Route(True, 3)}
    show = lambda missing: sorted(
        (r["dest"] or "", r["value"], r["reject_reason"]) for r in tables.route(rows, "dest", "value", routes, missing).collect()
    )
    missing, unknown = "missing required value", "unknown destination"
    assert show("unspecified") == [("", 1, unknown), ("t1", None, missing), ("t2", None, None), ("t3", None, missing), ("t9", 1, unknown)]
    assert show("default_value") == [("", 1, unknown), ("t1", None, missing), ("t2", 2, None), ("t3", 3, None), ("t9", 1, unknown)]
    with pytest.raises(ValueError):
        show("other")


def test_cells_and_messages(spark, sf):
    cells = tables.to_cells(spark.createDataFrame([("first", "hello")], "k string, value string"), "k", "f", ["value"])
    assert tuple(cells.first()) == (b"first", "f", "value", b"hello")
    message = batch.synthetic_messages(table(spark, sf, "events"), "event_id", "ts", 8).first()
    assert message["payload"] == bytes(8) and message["attributes"]["ts"].endswith("Z")


def test_publish_strings(spark):
    session = stream_session(spark)
    landing, out = fresh_dir(spark, "in"), fresh_dir(spark, "out")
    session.range(10).select(F.col("id").alias("value")).write.parquet(landing)
    rows = stream.table_stream(session, landing, "value bigint")
    files.publish_strings(rows, out, fresh_dir(spark, "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(int(r["value"]) for r in spark.read.text(out).collect()) == list(range(10))


def test_a_stream_beside_a_static_map(spark, sf):
    session = stream_session(spark)
    out, landing = fresh_dir(spark, "out"), fresh_dir(spark, "in")
    table(session, sf, "orders").select("o_orderkey", "o_custkey").write.parquet(landing)
    names = table(session, sf, "customer").filter("c_custkey % 2 = 0")
    orders = stream.table_stream(session, landing, "o_orderkey bigint, o_custkey bigint")
    rows = side.with_map(orders, names, "o_custkey", "c_custkey", "c_name")
    panes.stream_append(rows, out, fresh_dir(spark, "cp"), every=None, method="batches").awaitTermination()
    got = spark.read.parquet(out)
    want = table(spark, sf, "orders").count()
    assert got.count() == want
    assert got.filter("(o_custkey % 2 = 0) != (c_name is not null)").count() == 0
    with pytest.raises(ValueError):
        group.group_values(orders, ["o_custkey"], "o_orderkey")
    with pytest.raises(ValueError):
        panes.stream_append(rows, out, out, method="other")


def test_a_byte_limit_makes_several_batches_and_one_snapshot(spark):
    session = stream_session(spark)
    out, landing = fresh_dir(spark, "out"), fresh_dir(spark, "in")
    session.range(0, 1000, 1, 4).withColumn("k", F.col("id") % 3).write.parquet(landing)
    rows = stream.table_stream(session, landing, "id bigint, k bigint", bytes_per_trigger=1024)
    query = panes.stream_snapshot(rows.groupBy("k").count(), out, fresh_dir(spark, "cp"))
    query.awaitTermination()
    snapshots = spark.read.parquet(out)
    assert snapshots.select("batch_id").distinct().count() > 1
    assert panes.newest(snapshots).agg(F.sum("count")).first()[0] == 1000


def test_copies_of_one_row_are_spread(spark):
    copies = spark.range(0, 4000, 1, 40).select(F.lit("same").alias("v"))
    counts = [r["count"] for r in copies.withColumn("s", spread(copies, 8)).groupBy("s").count().collect()]
    assert len(counts) == 8 and max(counts) == 500


def test_spread_key_is_stable_and_even(spark):
    keyed = spark.range(1000).select(F.pmod(sharding.spread_key(F.col("id"), seed=3), F.lit(10)).alias("k"))
    counts = [r["count"] for r in keyed.groupBy("k").count().collect()]
    assert len(counts) == 10 and min(counts) > 60
