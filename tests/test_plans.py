"""What the physical plans look like."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from sluiceway.operators.skew import Skew
from sluiceway.operators import skew
from sluiceway.plans.queries import BATCH_QUERIES
from sluiceway.plans.stream_queries import STREAM_QUERIES
from sluiceway.plans.inputs import table
from sluiceway.session import fresh_dir
from sluiceway.sinks import tables


def queries():
    return {**BATCH_QUERIES, **STREAM_QUERIES}


@pytest.fixture
def plan(spark, sf, capsys):
    def show(name: str) -> str:
        queries()[name](spark, sf).explain()
        return capsys.readouterr().out

    return show


STORED = {
    "dynamic_write", "json_lines", "sharded_text", "compressed_text", "compressed_table",
    "validated_append", "routed_append", "routed_append_defaults",
}


@pytest.mark.parametrize("name", [n for n in queries() if not n.startswith("stream_") and n not in STORED])
def test_no_pairs_and_no_row_python(plan, name):
    text = plan(name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


@pytest.mark.parametrize("name", ["window_sum_per_key", "key_stats", "hot_key_stats", "key_bytes", "word_count"])
def test_aggregates_combine_before_the_shuffle(plan, name):
    text = plan(name)
    assert "partial_" in text and "collect_list" not in text


@pytest.mark.parametrize("name", ["batches", "group_values", "running_index", "map_state_fold", "ungroup_roundtrip"])
def test_keyed_order_needs_one_shuffle(plan, name):
    assert plan(name).count("Exchange hashpartitioning") == 1


def test_multi_window_reads_once(plan):
    assert plan("multi_window").count("FileScan") == 1


def test_filters_and_columns_reach_the_scan(plan):
    text = plan("conditional_emit")
    assert "GreaterThan(value,100.0)" in text and "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_window_over_everything_never_lands_in_one_task(plan):
    text = plan("global_batches_split")
    assert "Window" in text.split("SinglePartition")[0]
    assert text.count("SinglePartition") <= 1  # of the few totals of ranges


@pytest.mark.parametrize("name", ["batches_split", "group_values_split", "map_state_fold_split", "backlog_split", "panes_accumulating_split"])
def test_split_queries_scan_ranges(plan, name):
    assert "__piece" in plan(name)


def test_jobs_while_a_plan_is_built(spark, sf):
    tracker = spark.sparkContext.statusTracker()

    def jobs(build) -> int:
        spark.sparkContext.setJobGroup("built", "built")
        before = len(tracker.getJobIdsForGroup("built"))
        build()
        spark.sparkContext.setJobGroup("other", "other")
        return len(tracker.getJobIdsForGroup("built")) - before

    events = table(spark, sf, "events")
    assert jobs(lambda: skew.lookup(events, events.select("user_id").distinct(), ["user_id"])) == 0


def test_a_bucketed_target_is_not_shuffled(spark, sf, capsys):
    path = fresh_dir(spark, "bucketed")
    target = tables.write_bucketed(table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey"), "plan_target", path, ["k"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("v"))
        tables.insert_verdicts(rows, target, ["k"], "v").explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE plan_target")
    plan = capsys.readouterr().out
    scan = next(i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
    above = plan.splitlines()[: scan + 1]
    depth = [len(line) - len(line.lstrip(" :|+-*")) for line in above]
    path_up, at = [], depth[-1]
    for line, d in zip(reversed(above), reversed(depth)):
        if d < at or line is above[-1]:
            path_up.append(line)
            at = d
    before_join = "\n".join(path_up).split("Join")[0]
    assert "Exchange" not in before_join
