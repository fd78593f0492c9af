"""Named batch queries. Each takes a session and a folder of tables and runs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions import render, sharding
from sluiceway.operators import accumulate, branch, elements, group, shuffle, side, state, triggers, windows
from sluiceway.operators.skew import DEFAULT_SKEW, Skew, written
from sluiceway.plans import inputs
from sluiceway.plans.inputs import cents, dollars, joined, table
from sluiceway.session import fresh_dir
from sluiceway.sinks import files, tables
from sluiceway.sources import batch as sources

HOUR = "1 hour"
DAY = "1 day"


def _keyed_hours(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    keyed = events.withColumn("key", sharding.shard_key(F.col("event_id"), 10)).withColumn("cents", cents("value"))
    return windows.window_meta(windows.fixed_window(keyed, "ts", HOUR))


# Grouping and combining


def window_sum_per_key(spark: SparkSession, sf: str) -> DataFrame:
    sums = group.combine_per_key(
        _keyed_hours(spark, sf), ["key", "window_start"], {"sum_cents": F.sum("cents"), "n": F.count(F.lit(1))}
    )
    return sums.select("key", "window_start", dollars("sum_cents").alias("sum_value"), "n")


def window_sum_grouped(spark: SparkSession, sf: str) -> DataFrame:
    sums = group.combine_grouped(
        _keyed_hours(spark, sf),
        ["key", "window_start"],
        "cents",
        create=F.lit(0).cast("bigint"),
        add=lambda acc, v: acc + v,
        merge=lambda a, b: a + b,
        name="sum_cents",
        order=["event_id"],
    )
    return sums.select("key", "window_start", dollars("sum_cents").alias("sum_value"))


def window_sum_global(spark: SparkSession, sf: str) -> DataFrame:
    sums = group.combine_globally(_keyed_hours(spark, sf), {"sum_cents": F.sum("cents")}, window="window_start")
    return sums.select("window_start", dollars("sum_cents").alias("sum_value"))


def global_sum(spark: SparkSession, sf: str) -> DataFrame:
    total = group.combine_globally(table(spark, sf, "orders"), {"sum_cents": F.sum(cents("o_totalprice"))})
    return total.select(dollars("sum_cents").alias("total"))


def window_spread_accumulated(spark: SparkSession, sf: str) -> DataFrame:
    """n times the sum of squares less the squared sum, by accumulators of count, sum and squares."""
    spread = accumulate.combine_accumulated(_keyed_hours(spark, sf), ["key", "window_start"], "cents", inputs.SPREAD, "spread")
    return spread.select("key", "window_start", "spread")


def global_spread_accumulated(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("bigint").alias("quantity"))
    return accumulate.combine_accumulated(lines, [], "quantity", inputs.SPREAD, "spread")


def group_fields_count(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("t", sharding.shard_key(F.col("user_id"), 3))
    timed = windows.window_meta(windows.fixed_window(events, "ts", "6 hours"))
    return group.group_fields(timed, ["window_start", "event_type", "t"], {"count": F.count(F.lit(1))})


def key_stats(spark: SparkSession, sf: str) -> DataFrame:
    keyed = table(spark, sf, "lineitem").withColumn("key", sharding.shard_key(F.col("l_orderkey"), 10))
    return group.key_stats(keyed, ["key"], "l_partkey")


def hot_key_stats(spark: SparkSession, sf: str) -> DataFrame:
    one_key = elements.with_key(table(spark, sf, "lineitem"), "all")
    return group.salted_agg(
        one_key,
        ["key"],
        partial={"n": F.count("l_partkey"), "lo": F.min("l_partkey"), "hi": F.max("l_partkey")},
        final={"count": F.sum("n"), "min": F.min("lo"), "max": F.max("hi")},
        salt=["l_orderkey"],
        salts=64,
    )


def key_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return group.key_bytes(table(spark, sf, "documents"), ["lang"], "text")


def group_values(spark: SparkSession, sf: str) -> DataFrame:
    pages = group.group_values(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", page_rows=16)
    return pages.select("o_custkey", "page", joined("values").alias("order_keys"))


def group_values_by_bytes(spark: SparkSession, sf: str) -> DataFrame:
    pages = group.group_values(
        table(spark, sf, "documents"), ["lang"], "text", order=["doc_id"], page_bytes=1 << 16
    )
    sizes = F.aggregate("values", F.lit(0).cast("bigint"), lambda acc, v: acc + F.octet_length(v))
    return pages.select("lang", "page", F.size("values").cast("bigint").alias("n"), sizes.alias("bytes"))


def ungroup_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    pages = group.group_values(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey")
    return group.ungroup(pages, ["o_custkey"], "o_orderkey")


def _batch_report(batches: DataFrame, *keys: str) -> DataFrame:
    return batches.select(
        *keys,
        "batch",
        F.size("values").cast("bigint").alias("size"),
        F.get("values", F.lit(0)).alias("first"),
        F.get("values", F.size("values") - 1).alias("last"),
    )


def batches(spark: SparkSession, sf: str) -> DataFrame:
    made = group.group_into_batches(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", 10)
    return _batch_report(made, "o_custkey")


def global_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _batch_report(group.global_batches(table(spark, sf, "orders"), "o_orderkey", 1000))


def multi_bag_batches(spark: SparkSession, sf: str) -> DataFrame:
    made = group.multi_bag_batches(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", 10)
    return made.select("o_custkey", "batch", joined("values").alias("order_keys"))


def xml_documents(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name")
    return group.bundle_documents(customers, ["c_nationkey"], "c_name", ["c_custkey"], rows_per_document=50)


# Text and elements


def exploded_props(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of each event's JSON text between quotes, one row each."""
    rows = table(spark, sf, "events").select("event_id", "props")
    parts = elements.explode_with(rows, F.split("props", '"'), "part")
    return group.count_per_element(parts, "part")


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "documents").select("text")
    return group.count_per_element(elements.tokenize(texts, "text"), "word")


def parse_kv(spark: SparkSession, sf: str) -> DataFrame:
    pairs = elements.parse_kv_words(inputs.lineitem_messages(spark, sf), "text")
    return group.count_per_element(pairs, "key", "value")


def kv_processed(spark: SparkSession, sf: str) -> DataFrame:
    pairs = elements.parse_kv_words(inputs.event_messages(spark, sf), "text", "ts")
    timed = windows.window_meta(windows.fixed_window(pairs, "ts", "6 hours"))
    return group.count_per_element(elements.process_values(timed), "window_start", "key", "processed")


def conditional_emit(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter(F.col("value") > 100).select("event_id", "value")


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    return elements.tagged(table(spark, sf, "events").select("event_id"), "2024-01-31")


def restamped(spark: SparkSession, sf: str) -> DataFrame:
    shifted = F.col("ts") + F.make_dt_interval(mins=sharding.shard_key(F.col("event_id"), 60).cast("int"))
    moved = elements.restamp(table(spark, sf, "events"), "ts", shifted)
    timed = windows.window_meta(windows.fixed_window(moved, "ts", HOUR))
    return group.count_per_element(timed, "window_start")


def traced(spark: SparkSession, sf: str) -> DataFrame:
    timed = windows.fixed_window(table(spark, sf, "events"), "ts", HOUR)
    rows = elements.trace(timed, "events", F.col("event_id"), F.col("ts"), F.col("window"))
    return rows.select("event_id", "trace")


def with_setup(spark: SparkSession, sf: str) -> DataFrame:
    return elements.with_setup(
        table(spark, sf, "events").select("event_id", "props"),
        inputs.json_decoder,
        inputs.decode_props,
        "event_id bigint, k bigint",
    )


def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    rows = sources.fan_out(table(spark, sf, "customer"), "c_custkey", 5, payload_bytes=16)
    return rows.select("c_custkey", "value", F.octet_length("payload").cast("bigint").alias("payload_bytes"))


def synthetic_messages(spark: SparkSession, sf: str) -> DataFrame:
    messages = sources.synthetic_messages(table(spark, sf, "events"), "event_id", "ts")
    return messages.select(
        "message_id",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.col("attributes")["ts"].alias("ts_attribute"),
    )


def sequence_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of a sequence as long as the largest part key that no line item uses."""
    used = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("value")).distinct()
    last = table(spark, sf, "part").agg(F.max("p_partkey").alias("last")).first()["last"]
    return sources.sequence(spark, 0, last + 10).join(used, "value", "left_anti")


def sql_source(spark: SparkSession, sf: str) -> DataFrame:
    query = """
        SELECT o_orderpriority, count(*) AS n FROM {orders}
        WHERE o_orderstatus = :status GROUP BY o_orderpriority
    """
    return sources.sql_source(spark, {"orders": table(spark, sf, "orders")}, query, {"status": "O"})


def sha_destinations(spark: SparkSession, sf: str) -> DataFrame:
    keyed = table(spark, sf, "orders").select(sharding.sha_shard(F.col("o_orderkey"), 10).alias("destination"))
    return group.count_per_element(keyed, "destination")


def multi_output(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return elements.multi_output(orders, {"a": F.col("o_orderkey"), "b": F.col("o_orderkey")})


def union_to_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources flattened, both outputs turned into named rows."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("v"))
    both = branch.union_all(orders, table(spark, sf, "customer").select(F.col("c_custkey").alias("v")))
    row = {name: F.struct(F.concat(F.lit(f"{name}-"), F.col("v").cast("string")).alias("k"), "v") for name in ("w1", "w2")}
    return elements.multi_output(both, row, "row").select("tag", "row.k", "row.v")


def union_branches(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("value"))
    both = branch.branch_union(orders, inputs.prefixed("Left-"), inputs.prefixed("Right-"))
    newest = table(spark, sf, "orders").agg(F.max("o_orderkey").alias("side"))
    return side.with_singleton(both, newest, "side")


def left_only_union(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("value"))
    return branch.branch_union(orders, inputs.prefixed("Left-"), elements.discard)


# Side inputs


def side_singleton(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    largest = orders.agg(F.max("o_totalprice").alias("largest"))
    return side.with_singleton(orders.select("o_orderkey", "o_totalprice"), largest, "largest")


def side_list(spark: SparkSession, sf: str) -> DataFrame:
    segments = table(spark, sf, "customer").select("c_mktsegment").distinct()
    rows = side.with_list(table(spark, sf, "orders").select("o_orderkey"), segments, "c_mktsegment", "segments")
    return rows.select("o_orderkey", "page", joined("segments").alias("segments"))


def side_list_pages(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "supplier").select("s_suppkey")
    brands = table(spark, sf, "part").select("p_brand").distinct()
    rows = side.with_list(brands, names, "s_suppkey", "suppliers", page_rows=20)
    return rows.select("p_brand", "page", joined("suppliers").alias("suppliers"))


def side_map(spark: SparkSession, sf: str) -> DataFrame:
    """Labels beside documents; not every document has one, so lookups also miss."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    rows = side.with_map(docs, table(spark, sf, "labels"), "doc_id", "doc_id", "quality")
    return rows.withColumn("quality", F.col("quality").cast("string"))


def self_list(spark: SparkSession, sf: str) -> DataFrame:
    """Every brand beside all brands, then every brand beside all of those pairs."""
    brands = table(spark, sf, "part").select("p_brand").distinct()
    pairs = side.with_self_list(brands, "p_brand", "brands")
    again = side.with_list(brands, pairs, F.struct("p_brand", "page", "brands"), "pairs")
    return again.select(
        "p_brand",
        "page",
        F.array_join(F.transform("pairs", lambda p: p["p_brand"]), ",").alias("seen"),
        F.aggregate("pairs", F.lit(0).cast("bigint"), lambda acc, p: acc + F.size(p["brands"])).alias("entries"),
    )


def enrich_strict(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return side.enrich(customers, inputs.dictionary(spark), "c_mktsegment", "source", "target")


def enrich_lenient(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return side.enrich(customers, inputs.dictionary(spark), "c_mktsegment", "source", "target", strict=False)


# Redistribution


def reshuffled(spark: SparkSession, sf: str) -> DataFrame:
    return shuffle.reshuffle(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 16)


def reshuffled_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return shuffle.reshuffle_by(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


def reshuffled_spread(spark: SparkSession, sf: str) -> DataFrame:
    return shuffle.reshuffle_spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 16, "o_orderkey")


# Windows and state over tables


def rewindowed_globally(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts, brought back into one window: the busiest and the quietest hour per type."""
    timed = windows.fixed_window(table(spark, sf, "events"), "ts", HOUR)
    hourly = group.count_per_element(timed, "window", "event_type")
    return group.key_stats(windows.global_window(hourly), ["event_type"], "count")


def multi_window(spark: SparkSession, sf: str) -> DataFrame:
    return windows.multi_window(
        table(spark, sf, "events"),
        "ts",
        [60, 120, 180, 240],
        partial={"n": F.count(F.lit(1)), "size": F.sum(F.octet_length("props").cast("bigint"))},
        final={"count": F.sum("n"), "total_bytes": F.sum("size")},
    )


def window_meta(spark: SparkSession, sf: str) -> DataFrame:
    timed = windows.fixed_window(table(spark, sf, "events").select("event_id", "ts"), "ts", "15 minutes")
    return windows.window_meta(timed)


def panes_discarding(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("cents", cents("value"))
    return windows.panes(events, ["user_id"], ["event_id"], 5, "cents")


def panes_accumulating(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("cents", cents("value"))
    return windows.panes(events, ["user_id"], ["event_id"], 5, "cents", discarding=False)


def running_index(spark: SparkSession, sf: str) -> DataFrame:
    return state.running_index(table(spark, sf, "events").select("event_id", "user_id"), ["user_id"], ["event_id"])


def unsaved_counter(spark: SparkSession, sf: str) -> DataFrame:
    return state.unsaved_counter(table(spark, sf, "events").select("event_id", "user_id"))


def backlog(spark: SparkSession, sf: str) -> DataFrame:
    rows = state.backlog(table(spark, sf, "events"), ["user_id"], "ts", DAY, ["event_id"])
    return rows.select("user_id", "event_id", "window_start", "backlog")


def collect_until_window_end(spark: SparkSession, sf: str) -> DataFrame:
    rows = state.collect_until_window_end(table(spark, sf, "events"), ["user_id"], "ts", DAY, "event_id")
    return rows.select("user_id", "window_start", "window_time", "page", joined("values").alias("event_ids"))


def map_state_fold(spark: SparkSession, sf: str) -> DataFrame:
    return _map_state(spark, sf, DEFAULT_SKEW)


def _map_state(spark: SparkSession, sf: str, skew: Skew) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", sharding.shard_key(F.col("event_id"), 7).alias("v"))
    rows = state.map_state_fold(events, ["user_id"], "event_id", "v", skew=skew)
    shown = F.transform(F.map_entries("entries"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return rows.select("user_id", "event_id", "v", F.array_join(shown, ",").alias("entries"))


def _small_values(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("v", sharding.shard_key(F.col("event_id"), 7))


def multimap_entries(spark: SparkSession, sf: str) -> DataFrame:
    rows = state.multimap_entries(_small_values(spark, sf), ["user_id"], "ts", DAY, ["event_id"], "v")
    return rows.select("user_id", "event_id", "window_start", "state_key", "entries")


def multimap_at_expiry(spark: SparkSession, sf: str) -> DataFrame:
    return state.multimap_at_expiry(_small_values(spark, sf), ["user_id"], "ts", DAY, "v")


def _contents(spark: SparkSession, sf: str, skew: Skew) -> DataFrame:
    rows = state.multimap_contents(
        _small_values(spark, sf).select("user_id", "event_id", "ts", "v"), ["user_id"], "ts", "6 days", ["event_id"], "v", "1 DAY",
        page_rows=5, skew=skew,
    )
    shown = F.transform("entries", lambda e: F.concat(e["state_key"], F.lit("="), e["value"].cast("string")))
    return rows.withColumn("entries", F.array_join(shown, ","))


def multimap_contents(spark: SparkSession, sf: str) -> DataFrame:
    return _contents(spark, sf, DEFAULT_SKEW)


def multimap_contents_split(spark: SparkSession, sf: str) -> DataFrame:
    return _contents(spark, sf, Skew(hot_rows=6))


def growing_output(spark: SparkSession, sf: str) -> DataFrame:
    timed = windows.window_meta(windows.fixed_window(table(spark, sf, "events"), "ts", DAY))
    return state.growing_output(timed, ["user_id"], "window_start")


# Sinks, read back


def dynamic_write(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "dynamic")
    orders = table(spark, sf, "orders").select("o_orderkey")
    key = F.col("o_orderkey")
    files.write_dynamic(orders, path, key, sharding.sha_shard(key, 10), destinations=10, shards=4)
    back = spark.read.schema("value string, destination string").text(path)
    return back.groupBy("destination").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("bigint")).alias("key_sum")
    )


def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "json")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    files.export_json_lines(rows, path)
    return spark.read.text(path).withColumnRenamed("value", "json")


def row_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return rows.select("o_orderkey", render.row_json(rows).alias("json"))


def sharded_text(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "text")
    files.write_text(table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("value")), path, 4)
    return spark.read.text(path)


def compressed_text(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "gzip")
    files.write_compressed(table(spark, sf, "customer").select(F.col("c_name").alias("value")), path, "gzip", text=True)
    return spark.read.text(path)


def compressed_table(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "zstd")
    files.write_compressed(table(spark, sf, "customer"), path)
    return spark.read.parquet(path)


def validated_append(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(
        "doc_id", "text", F.struct("lang", F.col("n_chars").alias("c")).alias("sub")
    )
    target, rejects = fresh_dir(spark, "target"), fresh_dir(spark, "rejects")
    elements.discard(rows).write.parquet(target)
    rules = {
        "row too large": F.octet_length("text") > 10_000,
        "bad nested field": F.col("sub.c").isNull() | (F.col("sub.c") < 100),
    }
    tables.append_validated(rows, rules, target, rejects)
    good = spark.read.parquet(target).select("doc_id", F.lit("ok").alias("status"))
    return branch.union_all(good, spark.read.parquet(rejects).select("doc_id", F.col("reject_reason").alias("status")))


def _routed(spark: SparkSession, sf: str, missing: str) -> DataFrame:
    routes = {
        "table1": tables.Route(required=True),
        "table2": tables.Route(default=2),
        "table3": tables.Route(required=True, default=3),
    }
    path, rejects = fresh_dir(spark, "routed"), fresh_dir(spark, "rejects")
    tables.route_append(inputs.routed_orders(spark, sf), path, rejects, "dest", "value", routes, missing)
    good = spark.read.schema("key string, value bigint, dest string").parquet(path)
    columns = ["dest", "key", F.coalesce(F.col("value").cast("string"), F.lit("null")).alias("value")]
    return branch.union_all(
        good.select(*columns, F.lit("ok").alias("status")),
        spark.read.parquet(rejects).select(*columns, F.col("reject_reason").alias("status")),
    )


def routed_append(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf, "unspecified")


def routed_append_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf, "default_value")


def insert_or_reject(spark: SparkSession, sf: str) -> DataFrame:
    """Three orders bring each key; the keys of labelled documents exist already."""
    wanted = table(spark, sf, "orders").select(F.expr("o_orderkey div 3").alias("k"), F.col("o_orderkey").alias("v"))
    existing = table(spark, sf, "labels").select(F.col("doc_id").alias("k"))
    judged = tables.insert_verdicts(wanted, existing, ["k"], "v")
    return judged.select("k", "v", F.coalesce("reject_reason", F.lit("inserted")).alias("status"))


def insert_or_reject_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same against a target that is stored by its key, and once more after the first accepted half is in it."""
    orders = table(spark, sf, "orders").select(F.expr("o_orderkey div 3").alias("k"), F.col("o_orderkey").alias("v"))
    path = fresh_dir(spark, "bucketed")
    name = "target_" + path.rsplit("-", 1)[1]
    tables.write_bucketed(table(spark, sf, "labels").select(F.col("doc_id").alias("k")), name, path, ["k"], 16)
    early, late = orders.where("v % 2 = 0"), orders.where("v % 2 = 1")
    first = written(tables.insert_verdicts(early, spark.table(name), ["k"], "v"), "judged")
    tables.append_bucketed(first.where("reject_reason is null"), name, ["k"], 16)
    judged = first.unionByName(tables.insert_verdicts(late, spark.table(name), ["k"], "v"))
    return judged.select("k", "v", F.coalesce("reject_reason", F.lit("inserted")).alias("status"))


def to_cells(spark: SparkSession, sf: str) -> DataFrame:
    cells = tables.to_cells(table(spark, sf, "customer"), "c_custkey", "info", ["c_name", "c_nationkey", "c_mktsegment"])
    return cells.select(
        F.col("row_key").cast("string").alias("row_key"), "family", "qualifier", F.col("value").cast("string").alias("value")
    )


def window_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of three that do not cross a day's window."""
    placed = windows.window_meta(windows.fixed_window(table(spark, sf, "events"), "ts", DAY))
    return _batch_report(group.group_into_batches(placed, ["user_id", "window_start"], "event_id", 3), "user_id", "window_start")


def idle_timer_fires(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return state.idle_fires(events, ["user_id"], "ts", ["event_id"], "6 HOURS")


def timer_family_fires(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return state.idle_fires(events, ["user_id", "event_type"], "ts", ["event_id"], "1 DAY", Skew(hot_rows=20))


def _triggered(spark: SparkSession, sf: str, skew: Skew) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    made = triggers.bounded_batches(events, ["user_id"], "ts", ["event_id"], "event_id", 5, "36 HOURS", skew=skew)
    return made.select("user_id", "pane", "ended_by", "fired_at", joined("values").alias("event_ids"))


def trigger_any(spark: SparkSession, sf: str) -> DataFrame:
    """Panes of five events, or of what comes within 36 hours of the first."""
    return _triggered(spark, sf, DEFAULT_SKEW)


def bounded_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of an event type's day: twenty events, three hours after the first, or the day's end."""
    placed = windows.window_meta(windows.fixed_window(table(spark, sf, "events"), "ts", DAY))
    made = triggers.bounded_batches(
        placed, ["event_type", "window_start", "window_end"], "ts", ["event_id"], "event_id", 20, "3 HOURS", "window_end"
    )
    return made.select("event_type", "window_start", "pane", "ended_by", "fired_at", joined("values").alias("event_ids"))


# The same with every key split: so few rows for a task that the keys of small tables are hot.
SPLIT = Skew(hot_rows=4)


def batches_split(spark: SparkSession, sf: str) -> DataFrame:
    made = group.group_into_batches(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", 10, skew=SPLIT)
    return _batch_report(made, "o_custkey")


def global_batches_split(spark: SparkSession, sf: str) -> DataFrame:
    return _batch_report(group.global_batches(table(spark, sf, "orders"), "o_orderkey", 1000, skew=Skew(hot_rows=500)))


def group_values_split(spark: SparkSession, sf: str) -> DataFrame:
    pages = group.group_values(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", page_rows=16, skew=SPLIT)
    return pages.select("o_custkey", "page", joined("values").alias("order_keys"))


def map_state_fold_split(spark: SparkSession, sf: str) -> DataFrame:
    return _map_state(spark, sf, SPLIT)


def backlog_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = state.backlog(table(spark, sf, "events"), ["user_id"], "ts", DAY, ["event_id"], skew=Skew(hot_rows=2))
    return rows.select("user_id", "event_id", "window_start", "backlog")


def panes_accumulating_split(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("cents", cents("value"))
    return windows.panes(events, ["user_id"], ["event_id"], 5, "cents", discarding=False, skew=SPLIT)


def trigger_any_split(spark: SparkSession, sf: str) -> DataFrame:
    return _triggered(spark, sf, Skew(hot_rows=20))


BATCH_QUERIES = {
    fn.__name__: fn
    for fn in (
        window_sum_per_key, window_sum_grouped, window_sum_global, global_sum, group_fields_count,
        window_spread_accumulated, global_spread_accumulated,
        key_stats, hot_key_stats, key_bytes, group_values, group_values_by_bytes, ungroup_roundtrip,
        batches, global_batches, multi_bag_batches, xml_documents,
        exploded_props, word_count, parse_kv, kv_processed, conditional_emit, tagged, restamped, traced, with_setup,
        fan_out, synthetic_messages, sequence_gaps, sql_source, sha_destinations,
        multi_output, union_to_rows, union_branches, left_only_union,
        side_singleton, side_list, side_list_pages, side_map, self_list, enrich_strict, enrich_lenient,
        reshuffled, reshuffled_by_key, reshuffled_spread,
        rewindowed_globally, multi_window, window_meta, panes_discarding, panes_accumulating,
        running_index, unsaved_counter, backlog, collect_until_window_end, map_state_fold,
        multimap_entries, multimap_at_expiry, multimap_contents, growing_output,
        dynamic_write, json_lines, row_json, sharded_text, compressed_text, compressed_table,
        validated_append, routed_append, routed_append_defaults, insert_or_reject, insert_or_reject_bucketed, to_cells,
        window_batches, idle_timer_fires, timer_family_fires, trigger_any, bounded_batches,
        batches_split, global_batches_split, group_values_split, map_state_fold_split, backlog_split, panes_accumulating_split,
        trigger_any_split, multimap_contents_split,
    )
}
