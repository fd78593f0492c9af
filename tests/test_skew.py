"""Hot keys: one key holds a third of the rows or more, and answers do not change."""

from __future__ import annotations

from itertools import groupby

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import group, side, skew, state, windows
from sluiceway.operators.skew import Skew
from sluiceway.plans.inputs import table
from sluiceway.sinks import tables

EAGER = Skew(hot_rows=50)


@pytest.fixture(scope="module")
def hot(spark, sf):
    """Events where a null key has a third of the rows, key 1 a fifth, and the rest are spread."""
    i = F.col("event_id")
    key = F.when(i % 3 == 0, F.lit(None)).when(i % 5 == 0, F.lit(1)).otherwise(F.col("user_id") + 10).cast("bigint")
    events = table(spark, sf, "events").withColumn("k", key).withColumn("name", F.format_string("n%07d", i))
    return events.select("event_id", "ts", "k", "value", "name", "event_type", F.pmod(i, F.lit(7)).alias("v")).cache()


def test_hot_keys_are_found(hot):
    found = skew.heavy_keys(hot, ["k"], "event_id", EAGER)
    want = {hot.filter(c).select(skew.key_hash(["k"])).first()[0] for c in ("k is null", "k = 1")}
    assert set(found) == want
    assert skew.heavy_keys(hot, ["k"], "event_id") == []


@pytest.mark.parametrize("order", ["event_id", "ts", "name", "long_name"])
def test_no_task_gets_a_whole_hot_key(hot, order):
    """Names with a long common beginning are cut as well as numbers."""
    named = hot.withColumn("long_name", F.format_string("Customer#000000000%07d", F.col("event_id")))
    cuts = skew.hot_cuts(named, ["k"], order, EAGER)
    known = named.withColumn("__hash", skew.key_hash(["k"])).join(cuts, "__hash")
    sizes = skew.with_piece(known, F.col(order), "__cuts", 64).groupBy("k", "__piece").count().agg(F.max("count")).first()[0]
    assert sizes <= EAGER.hot_rows


def test_a_key_has_as_many_cuts_as_its_rows_need(spark):
    rows = spark.range(0, 200_000, 1, 8).select("id", F.lit(1).alias("k"))
    cuts = skew.hot_cuts(rows, ["k"], "id", Skew(hot_rows=40)).first()
    assert len(cuts["__cuts"]) == 10_000


@pytest.mark.parametrize("skew_", [Skew(hot_bytes=40_000), Skew(hot_rows=1000, hot_bytes=40_000)])
def test_a_key_of_few_wide_rows_is_split(spark, skew_):
    """Later rows are wider; no range has more bytes than a task should have, and pages are those of one task."""
    rows = spark.range(400).select("id", F.lit(1).alias("k"), F.repeat(F.lit("x"), (F.col("id") * 4).cast("int")).alias("text"))
    cuts = skew.hot_cuts(rows, ["k"], "id", skew_)
    known = rows.withColumn("__hash", skew.key_hash(["k"])).join(cuts, "__hash")
    pieces = skew.with_piece(known, F.col("id"), "__cuts", 64).groupBy("__piece").agg(F.sum(F.octet_length("text")).alias("n"))
    assert pieces.agg(F.max("n")).first()[0] <= 40_000
    pages = [group.group_values(rows, ["k"], "text", ["id"], page_bytes=5_000, skew=s).orderBy("page").collect() for s in (skew_, Skew())]
    assert pages[0] == pages[1]
    assert skew.positions(rows, [], ["id"], skew=skew_).where("position <> id").isEmpty()


def test_sums_have_one_type(hot):
    amount = F.col("v").cast("decimal(12,2)")
    kinds = [skew.running(hot, ["k"], ["event_id"], {"s": ("sum", amount)}, skew=s).schema["s"].dataType for s in (EAGER, skew.DEFAULT_SKEW)]
    assert kinds[0] == kinds[1]


@pytest.mark.parametrize("cuts", [0, 1, 2, 3, 7, 8, 100])
def test_pieces_count_the_cuts_at_or_below(spark, cuts):
    points = [10 * i for i in range(1, cuts + 1)]
    rows = spark.range(-5, 1100).union(spark.createDataFrame([(None,)], "id bigint"))
    rows = rows.withColumn("cuts", F.lit(points).cast("array<bigint>"))
    got = skew.with_piece(rows, F.col("id"), "cuts", cuts).collect()
    assert all(r["__piece"] == (0 if r["id"] is None else max(0, min(cuts, r["id"] // 10))) for r in got)


def test_sampled_estimates(spark):
    rows = spark.range(0, 400_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    sampled = Skew(hot_rows=40_000)
    cuts = skew.hot_cuts(rows, ["k"], "id", sampled).collect()
    assert len(cuts) == 1 and 5 <= len(cuts[0]["__cuts"]) <= 8
    placed = skew.positions(rows, ["k"], ["id"], skew=sampled)
    wrong = placed.filter("position != if(k = 0, id div 3, 0)").count()
    assert wrong == 0 and placed.count() == 400_000


@pytest.mark.parametrize("order", ["event_id", "ts", "name"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_equals_a_plain_scan(hot, order, inclusive):
    measures = {
        "n": ("count", F.lit(1)),
        "s": ("sum", F.col("v")),
        "lo": ("min", F.when(F.col("v") > 2, F.col("v"))),
        "hi": ("max", F.when(F.col("v") < 3, F.col("event_id"))),
    }
    got = skew.running(hot, ["k"], [order], measures, inclusive, EAGER)
    rows = sorted(hot.collect(), key=lambda r: (r["k"] is not None, r["k"] or 0, r[order]))
    want = {}
    for _, members in groupby(rows, key=lambda r: r["k"]):
        seen: list = []
        for r in members:
            if inclusive:
                seen.append(r)
            v = [x["v"] for x in seen]
            above, below = [x for x in v if x > 2], [x["event_id"] for x in seen if x["v"] < 3]
            want[r["event_id"]] = (len(v), sum(v) if v else None, min(above, default=None), max(below, default=None))
            if not inclusive:
                seen.append(r)
    assert {r["event_id"]: (r["n"], r["s"], r["lo"], r["hi"]) for r in got.collect()} == want


def test_whole_table_positions_without_keys(hot):
    rows = skew.positions(hot.repartition(5), [], ["event_id"], skew=EAGER).collect()
    assert all(r["position"] == r["event_id"] for r in rows) and len(rows) == hot.count()


def test_ties_and_short_inputs(spark):
    same = spark.range(200).select(F.lit(1).alias("k"), F.lit(5).alias("o"), F.col("id"))
    rows = skew.positions(same, ["k"], ["o", "id"], skew=EAGER).collect()
    assert all(r["position"] == r["id"] for r in rows)
    assert skew.positions(same.limit(0), [], ["id"], skew=EAGER).count() == 0


def test_pages_are_bounded_and_whole(hot):
    pages = group.group_values(hot, ["k"], "event_id", page_rows=9, skew=EAGER)
    plain = group.group_values(hot, ["k"], "event_id", page_rows=9)
    show = lambda p: sorted((r["k"] or -1, r["page"], r["values"]) for r in p.collect())
    assert show(pages) == show(plain)
    assert pages.agg(F.max(F.size("values"))).first()[0] == 9
    short = pages.filter(F.size("values") < 9).groupBy("k").count().agg(F.max("count")).first()[0]
    assert short == 1
    by_bytes = group.group_values(hot, ["k"], "name", ["event_id"], page_bytes=40, skew=EAGER)
    assert by_bytes.agg(F.max(F.size("values"))).first()[0] == 5
    assert by_bytes.select(F.explode("values")).count() == hot.count()


def test_state_operators_do_not_change_with_skew(hot):
    for job in (
        lambda s: state.map_state_fold(hot, ["k"], "event_id", "v", skew=s).withColumn("entries", F.to_json("entries")),
        lambda s: state.backlog(hot, ["k"], "ts", "30 days", ["event_id"], skew=s),
        lambda s: windows.panes(hot, ["k"], ["event_id"], 4, "v", discarding=False, skew=s),
        lambda s: state.growing_output(hot.withColumn("p", F.col("event_id") % 40), ["k"], "p", skew=s),
    ):
        assert sorted(map(repr, job(EAGER).collect())) == sorted(map(repr, job(skew.DEFAULT_SKEW).collect()))


def test_map_state_fold_against_the_machine(hot):
    shifted = hot.withColumn("v", F.col("v") - 1)
    got = state.map_state_fold(shifted, ["k"], "event_id", "v", tracked=(-1, 1, 2), skew=EAGER)
    have = {r["event_id"]: r["entries"] for r in got.collect()}
    cells: dict = {}
    for r in sorted(shifted.collect(), key=lambda r: r["event_id"]):
        mine = cells.setdefault(r["k"], {})
        assert have[r["event_id"]] == mine
        if r["v"] == 0:
            mine.clear()
        elif r["v"] < 3:
            mine[f"state-{r['v']}"] = r["v"]
        else:
            mine.pop("state-1", None)


def test_untracked_put_is_an_error(hot):
    with pytest.raises(Exception, match="tracked"):
        state.map_state_fold(hot, ["k"], "event_id", "v", tracked=(1,)).collect()


def test_salted_lookup_equals_plain_join(spark, hot):
    names = spark.range(0, 2000).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("name2")).filter("key % 2 = 1")
    got = side.with_map(hot, names, "k", "key", "name2")
    want = hot.join(names.withColumnRenamed("key", "k"), "k", "left")
    cols = ["event_id", "k", "name2"]
    assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))


def test_insert_verdicts_with_a_hot_key(spark, hot):
    target = spark.createDataFrame([(1,), (12,)], "k bigint")
    good, bad = tables.insert_or_reject(hot, target, ["k"], "event_id")
    keys = {r["k"] for r in hot.select("k").distinct().collect()} - {None, 1, 12}
    assert sorted(r["k"] for r in good.collect()) == sorted(keys)
    assert good.count() + bad.count() == hot.count()
    reasons = {(r["k"], r["reject_reason"]) for r in bad.filter("k is null or k in (1, 12)").collect()}
    assert reasons == {(None, "null key"), (1, "key exists"), (12, "key exists")}


def test_combines_agree(hot):
    lifted = group.combine_per_key(hot, ["k"], {"s": F.sum("v")})
    folded = group.combine_grouped(
        hot, ["k"], "v", F.lit(0).cast("bigint"), lambda a, v: a + v, lambda a, b: a + b, "s", order=["event_id"], page_rows=10, skew=EAGER
    )
    salted = group.salted_agg(hot, ["k"], {"p": F.sum("v")}, {"s": F.sum("p")}, ["event_id"], 4)
    rows = [sorted(map(repr, d.collect())) for d in (lifted, folded, salted)]
    assert rows[0] == rows[1] == rows[2]


@pytest.mark.parametrize("page_rows", [7, 100, 100_000])
def test_a_fold_does_not_depend_on_its_pages(spark, page_rows):
    """The mean by sum and count, and an accumulator that is not neutral."""
    rows = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    zero = F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("n"))
    add = lambda a, v: F.struct((a["s"] + v).alias("s"), (a["n"] + 1).alias("n"))
    merge = lambda a, b: F.struct((a["s"] + b["s"]).alias("s"), (a["n"] + b["n"]).alias("n"))
    mean = group.combine_grouped(rows, ["k"], "v", zero, add, merge, "m", lambda a: a["s"] / a["n"], page_rows=page_rows)
    assert mean.collect() == [(1, 499.5)]
    with pytest.raises(ValueError, match="neutral"):
        group.combine_grouped(rows, ["k"], "v", F.lit(5).cast("bigint"), lambda a, v: a + v, lambda a, b: a + b, "s", page_rows=page_rows)


def test_the_sketch_and_the_cuts_of_a_key_are_bounded(spark, monkeypatch):
    """However many rows a key has: few values are kept of it, and the ranges still have about the same size."""
    monkeypatch.setattr(skew, "SKETCH", 800)
    monkeypatch.setattr(skew, "MOST_CUTS", 40)
    rows = spark.range(0, 20_000, 1, 8).select("id", F.lit(1).alias("k"), F.lit("x").alias("name"))
    cuts = skew.hot_cuts(rows, ["k"], "id", EAGER)
    points = cuts.first()["__cuts"]
    assert len(points) == 40 and max(b - a for a, b in zip([0, *points], [*points, 20_000])) < 3 * 500
    placed = skew.positions(rows, ["k"], ["id"], skew=EAGER)
    assert placed.where("position <> id").isEmpty() and placed.count() == 20_000


def test_cuts_are_read_from_a_written_table(spark, hot, capsys):
    skew.hot_cuts(hot, ["k"], "event_id", EAGER).explain()
    text = capsys.readouterr().out
    assert "FileScan" in text and "Window" not in text and "LocalTableScan" not in text
    skew.positions(hot, ["k"], ["event_id"], skew=EAGER).explain("extended")
    text = capsys.readouterr().out
    assert "LocalRelation" not in text and "Window [row_number" not in text.split("Physical Plan")[0]


def test_a_whole_table_is_cut_by_range_partitions(spark, hot, capsys):
    named = hot.select("event_id", "name", F.when(F.col("event_id") % 4 == 0, F.col("ts")).alias("at"))
    rows = skew.running(named, [], ["at", "event_id"], {"n": ("count", F.lit(1)), "hi": ("max", F.col("name"))}, skew=EAGER)
    got = [tuple(r) for r in rows.orderBy("n").select("event_id", "n", "hi").collect()]
    want, top = [], ""
    for i, r in enumerate(sorted(named.collect(), key=lambda r: (r["at"] is not None, r["at"] or 0, r["event_id"]))):
        top = max(top, r["name"])
        want.append((r["event_id"], i + 1, top))
    assert got == want
    rows.explain()
    assert capsys.readouterr().out.count("SinglePartition") <= 1


def test_totals_of_many_ranges_go_to_the_rows(spark, hot, capsys):
    """There is a total for each range, as many as the rows ask for: where they are too large to broadcast, they are dealt out
    like the rows, and the rows are neither sorted nor shuffled for them."""
    measures = {"n": ("count", F.lit(1)), "hi": ("max", F.col("name"))}
    rows = skew.running(hot, ["k", "v"], ["event_id"], measures, skew=Skew(hot_rows=6))
    plain = skew.running(hot, ["k", "v"], ["event_id"], measures)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows.explain()
        text = capsys.readouterr().out
        assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and "__piece" in text
    joined = text[text.index("Join [__key") :].splitlines()
    assert "Window" in joined[1] and "Sort" in joined[2] and "Exchange hashpartitioning(__key" in joined[3]
