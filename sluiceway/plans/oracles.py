"""ANSI SQL that gives the same rows as the named queries on the same tables."""

from __future__ import annotations

CENTS = "CAST(ROUND({0} * 100) AS BIGINT)"
DOLLARS = "CAST(SUM(" + CENTS + ") AS DOUBLE) / 100"
VALUE = DOLLARS.format("value")


def bucket(width: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01')"


HOUR, SIX_HOURS, DAY = bucket("1 hour"), bucket("6 hours"), bucket("1 day")

SUM_PER_KEY = f"""
SELECT event_id % 10 AS key, {HOUR} AS window_start, {VALUE} AS sum_value, COUNT(*) AS n
FROM events GROUP BY 1, 2"""

_BATCH = "(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)"

_TOKENS = r"""
WITH bodies AS (
  SELECT regexp_replace(text, '(\r\n|\r|\n)\z', '') AS body FROM documents WHERE text <> ''
), lines AS (
  SELECT unnest(string_split_regex(body, '\r\n|\r|\n')) AS line FROM bodies
), tokens AS (
  SELECT unnest(CASE
    WHEN line = '' THEN ['']
    WHEN NOT regexp_matches(line, '\p{L}') THEN CAST([] AS VARCHAR[])
    ELSE string_split_regex(regexp_replace(line, '[^\p{L}]+$', ''), '[^\p{L}]+') END) AS word
  FROM lines
)
SELECT word, COUNT(*) AS count FROM tokens GROUP BY word"""


def _kv(source: str, keep: str, group: str) -> str:
    """Pairs of ``key:value`` words up to the first word without a colon."""
    return f"""
WITH messages AS ({source}), split AS (
  SELECT *, string_split_regex(regexp_replace(text, '\\s+$', ''), '\\s+') AS words FROM messages
), cut AS (
  SELECT *, list_position(list_transform(words, lambda w: contains(w, ':')), false) AS bad FROM split
), pairs AS (
  SELECT {keep} unnest(CASE WHEN coalesce(bad, 0) = 0 THEN words ELSE words[1:bad - 1] END) AS word FROM cut
), kv AS (
  SELECT {keep} split_part(word, ':', 1) AS key, substr(word, instr(word, ':') + 1) AS value FROM pairs
)
{group}"""


_LINEITEM_MESSAGES = """
  SELECT l_returnflag || ':' || l_linenumber || ' ' || l_linestatus || ':' || CAST(l_quantity AS INTEGER) || ' '
    || CASE WHEN l_returnflag = 'R' THEN 'bad ' ELSE '' END || 'p:' || (l_partkey % 50) || ' ' AS text
  FROM lineitem"""

_EVENT_MESSAGES = """
  SELECT ts, event_type || ':' || user_id || ' ' || CASE WHEN event_type = 'error' THEN 'oops ' ELSE '' END
    || 'v:' || (event_id % 7) AS text
  FROM events"""

_SHA = """
  SELECT o_orderkey, ((h % 10) + 10) % 10 AS destination FROM (
    SELECT o_orderkey, CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END AS h FROM (
      SELECT o_orderkey,
        ('0x' || substr(sha256(unhex(lpad(to_hex(o_orderkey), 16, '0'))), 1, 16))::UBIGINT::HUGEINT AS u
      FROM orders))"""

_PANES = """
  SELECT user_id, pane, COUNT(*) AS count, CAST(SUM(cents) AS BIGINT) AS sum FROM (
    SELECT user_id, CAST(ROUND(value * 100) AS BIGINT) AS cents,
      (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 5 AS pane
    FROM events) GROUP BY 1, 2"""

_SEGMENT_ANSWERS = """
  SELECT source, MIN(target) AS target, COUNT(*) AS answers FROM (VALUES
    ('BUILDING', 'construction'), ('MACHINERY', 'machines'), ('AUTOMOBILE', 'cars'), ('AUTOMOBILE', 'vehicles')
  ) AS d(source, target) GROUP BY source"""

_BRANCHES = """
SELECT p || {column} AS value, (SELECT MAX(o_orderkey) FROM orders) AS side
FROM {table}, (VALUES ('Left-'), ('Right-')) AS b(p)"""


def _routed(null_as: str) -> str:
    return f"""
WITH raw AS (
  SELECT 'table' || substr(o_orderpriority, 1, 1) AS dest, CAST(o_orderkey AS VARCHAR) AS key,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS value FROM orders
), filled AS (SELECT dest, key, CASE WHEN value IS NULL THEN {null_as} ELSE value END AS value FROM raw)
SELECT dest, key, coalesce(CAST(value AS VARCHAR), 'null') AS value, CASE
  WHEN dest NOT IN ('table1', 'table2', 'table3') THEN 'unknown destination'
  WHEN value IS NULL AND dest IN ('table1', 'table3') THEN 'missing required value'
  ELSE 'ok' END AS status
FROM filled"""


def _per_minutes(minutes: int) -> str:
    return f"""SELECT {minutes} AS minutes, {bucket(f'{minutes} minutes')} AS window_start,
  COUNT(*) AS count, CAST(SUM(strlen(props)) AS BIGINT) AS total_bytes FROM events GROUP BY 1, 2"""


_THIRDS = """
WITH size AS (SELECT MAX(event_id) + 1 AS n FROM events),
thirds AS (SELECT event_id, ts, value, CAST(floor(event_id * 3 / n) AS BIGINT) AS third FROM events, size),
frozen AS (SELECT MAX(ts) AS frozen_ts FROM thirds WHERE third = 0),
arrivals AS (
  SELECT event_id, third, value, CASE WHEN third > 0 AND event_id % 2 = 0 THEN frozen_ts ELSE ts END AS ts
  FROM thirds, frozen),
marks AS (
  SELECT MAX(ts) FILTER (WHERE third <= 1) - INTERVAL 2 HOUR AS before_last, MAX(ts) - INTERVAL 2 HOUR AS final
  FROM arrivals)"""


def _idle(keys: str, after: str) -> str:
    return f"""
SELECT {keys}, event_id, ts, ts + INTERVAL {after} AS fired_at, n AS backlog FROM (
  SELECT *, row_number() OVER w AS n, lead(ts) OVER w AS following FROM events WINDOW w AS (PARTITION BY {keys} ORDER BY event_id))
WHERE following IS NULL OR following > ts + INTERVAL {after}"""


ORACLES: dict[str, str] = {
    "window_sum_per_key": SUM_PER_KEY,
    "window_sum_grouped": f"SELECT key, window_start, sum_value FROM ({SUM_PER_KEY})",
    "window_sum_global": f"SELECT {HOUR} AS window_start, {VALUE} AS sum_value FROM events GROUP BY 1",
    "global_sum": f"SELECT {DOLLARS.format('o_totalprice')} AS total FROM orders",
    "group_fields_count": f"""
SELECT {SIX_HOURS} AS window_start, event_type, user_id % 3 AS t, COUNT(*) AS count FROM events GROUP BY 1, 2, 3""",
    "key_stats": """
SELECT l_orderkey % 10 AS key, COUNT(l_partkey) AS count, MIN(l_partkey) AS min, MAX(l_partkey) AS max
FROM lineitem GROUP BY 1""",
    "hot_key_stats": """
SELECT 'all' AS key, COUNT(l_partkey) AS count, MIN(l_partkey) AS min, MAX(l_partkey) AS max FROM lineitem""",
    "key_bytes": """
SELECT lang, COUNT(*) AS count, CAST(SUM(octet_length(encode(text))) AS BIGINT) AS total_bytes
FROM documents GROUP BY lang""",
    "group_values": f"""
SELECT o_custkey, page, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS order_keys
FROM (SELECT o_custkey, o_orderkey, {_BATCH} // 16 AS page FROM orders) GROUP BY 1, 2""",
    "group_values_by_bytes": """
WITH sized AS (SELECT doc_id, lang, octet_length(encode(text)) AS size FROM documents),
placed AS (
  SELECT lang, size,
    CAST(SUM(size) OVER (PARTITION BY lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM sized)
SELECT lang, start // 65536 AS page, COUNT(*) AS n, CAST(SUM(size) AS BIGINT) AS bytes FROM placed GROUP BY 1, 2""",
    "ungroup_roundtrip": "SELECT o_custkey, o_orderkey FROM orders",
    "batches": f"""
SELECT o_custkey, batch, COUNT(*) AS size, MIN(o_orderkey) AS first, MAX(o_orderkey) AS last
FROM (SELECT o_custkey, o_orderkey, {_BATCH} // 10 AS batch FROM orders) GROUP BY 1, 2""",
    "global_batches": """
SELECT batch, COUNT(*) AS size, MIN(o_orderkey) AS first, MAX(o_orderkey) AS last
FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch FROM orders) GROUP BY 1""",
    "multi_bag_batches": f"""
SELECT o_custkey, batch,
  string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY (pos % 10 + 1) % 4, pos) AS order_keys
FROM (SELECT o_custkey, o_orderkey, {_BATCH} AS pos, {_BATCH} // 10 AS batch FROM orders) GROUP BY 1, 2""",
    "xml_documents": """
SELECT c_nationkey, page,
  '<root>' || chr(10) || string_agg('  <element>' || c_name || '</element>', chr(10) ORDER BY c_custkey)
    || chr(10) || '</root>' || chr(10) AS xml
FROM (
  SELECT c_nationkey, c_custkey,
    replace(replace(replace(c_name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS c_name,
    (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 50 AS page
  FROM customer) GROUP BY 1, 2""",
    "exploded_props": """
SELECT part, COUNT(*) AS count FROM (SELECT unnest(string_split(props, '"')) AS part FROM events) GROUP BY part""",
    "word_count": _TOKENS,
    "parse_kv": _kv(_LINEITEM_MESSAGES, "", "SELECT key, value, COUNT(*) AS count FROM kv GROUP BY 1, 2"),
    "kv_processed": _kv(
        _EVENT_MESSAGES,
        "ts,",
        f"""SELECT {SIX_HOURS} AS window_start, key, 'processed-' || value AS processed, COUNT(*) AS count
FROM kv GROUP BY 1, 2, 3""",
    ),
    "conditional_emit": "SELECT event_id, value FROM events WHERE value > 100",
    "tagged": "SELECT event_id, 'TODAY:2024-01-31' AS tag FROM events",
    "restamped": f"""
SELECT {bucket('1 hour', "ts + (event_id % 60) * INTERVAL 1 MINUTE")} AS window_start, COUNT(*) AS count
FROM events GROUP BY 1""",
    "traced": f"""
SELECT event_id, '[events] element:' || event_id || ', timestamp:' || CAST(ts AS VARCHAR) || ', window:[' || strftime({HOUR}, '%Y-%m-%d %H:%M:%S')
  || '..' || strftime({HOUR} + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') || ')' AS trace
FROM events""",
    "with_setup": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "fan_out": """
SELECT c_custkey, c_custkey * 5 + i AS value, CAST(16 AS BIGINT) AS payload_bytes
FROM customer, (SELECT unnest(range(0, 5)) AS i)""",
    "synthetic_messages": """
SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(1024 AS BIGINT) AS payload_bytes,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_attribute
FROM events""",
    "sequence_gaps": """
SELECT value FROM (SELECT unnest(range(0, (SELECT MAX(p_partkey) + 10 FROM part))) AS value)
WHERE value NOT IN (SELECT l_partkey FROM lineitem)""",
    "sql_source": """
SELECT o_orderpriority, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_orderpriority""",
    "sha_destinations": f"""
SELECT CAST(destination AS BIGINT) AS destination, COUNT(*) AS count FROM ({_SHA}) GROUP BY 1""",
    "multi_output": "SELECT t AS tag, o_orderkey AS value FROM orders, (VALUES ('a'), ('b')) AS tags(t)",
    "union_to_rows": """
SELECT t AS tag, t || '-' || v AS k, v FROM (VALUES ('w1'), ('w2')) AS tags(t),
  (SELECT o_orderkey AS v FROM orders UNION ALL SELECT c_custkey FROM customer)""",
    "union_branches": _BRANCHES.format(column="o_orderkey", table="orders"),
    "left_only_union": "SELECT 'Left-' || o_orderkey AS value FROM orders",
    "side_singleton": """
SELECT o_orderkey, o_totalprice, (SELECT MAX(o_totalprice) FROM orders) AS largest FROM orders""",
    "side_list": """
SELECT o_orderkey, CAST(0 AS BIGINT) AS page, (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT DISTINCT c_mktsegment AS s FROM customer))
  AS segments
FROM orders""",
    "side_list_pages": """
SELECT p_brand, page, suppliers FROM (SELECT DISTINCT p_brand FROM part), (
  SELECT page, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_suppkey) AS suppliers FROM (
    SELECT s_suppkey, (row_number() OVER (ORDER BY s_suppkey) - 1) // 20 AS page FROM supplier) GROUP BY page)""",
    "side_map": """
SELECT doc_id, lang, CAST(quality AS VARCHAR) AS quality FROM documents LEFT JOIN labels USING (doc_id)""",
    "self_list": """
WITH brands AS (SELECT DISTINCT p_brand FROM part)
SELECT p_brand, CAST(0 AS BIGINT) AS page, (SELECT string_agg(p_brand, ',' ORDER BY p_brand) FROM brands) AS seen,
  (SELECT COUNT(*) * COUNT(*) FROM brands) AS entries
FROM brands""",
    "enrich_strict": f"""
SELECT c_custkey, c_mktsegment, target FROM customer JOIN ({_SEGMENT_ANSWERS}) ON c_mktsegment = source
WHERE answers = 1""",
    "enrich_lenient": f"""
SELECT c_custkey, c_mktsegment, target FROM customer LEFT JOIN ({_SEGMENT_ANSWERS}) ON c_mktsegment = source""",
    "reshuffled": "SELECT o_orderkey, o_custkey FROM orders",
    "reshuffled_by_key": "SELECT o_orderkey, o_custkey FROM orders",
    "reshuffled_spread": "SELECT o_orderkey, o_custkey FROM orders",
    "rewindowed_globally": f"""
SELECT event_type, COUNT(*) AS count, MIN(n) AS min, MAX(n) AS max
FROM (SELECT event_type, {HOUR} AS h, COUNT(*) AS n FROM events GROUP BY 1, 2) GROUP BY event_type""",
    "multi_window": " UNION ALL ".join(_per_minutes(m) for m in (60, 120, 180, 240)),
    "window_meta": f"""
SELECT event_id, ts, w AS window_start, w + INTERVAL 15 MINUTE AS window_end,
  w + INTERVAL 15 MINUTE - INTERVAL 1 MICROSECOND AS window_time
FROM (SELECT event_id, ts, {bucket('15 minutes')} AS w FROM events)""",
    "panes_discarding": _PANES,
    "panes_accumulating": f"""
SELECT user_id, pane, CAST(SUM(count) OVER w AS BIGINT) AS count, CAST(SUM(sum) OVER w AS BIGINT) AS sum
FROM ({_PANES}) WINDOW w AS (PARTITION BY user_id ORDER BY pane ROWS UNBOUNDED PRECEDING)""",
    "running_index": """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS index FROM events""",
    "unsaved_counter": "SELECT event_id, user_id, CAST(1 AS BIGINT) AS count FROM events",
    "backlog": f"""
SELECT user_id, event_id, {DAY} AS window_start,
  row_number() OVER (PARTITION BY user_id, {DAY} ORDER BY event_id) - 1 AS backlog
FROM events""",
    "collect_until_window_end": f"""
SELECT user_id, {DAY} AS window_start, {DAY} + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS window_time,
  CAST(0 AS BIGINT) AS page, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS event_ids
FROM events GROUP BY 1, 2, 3""",
    "map_state_fold": """
WITH steps AS (SELECT user_id, event_id, event_id % 7 AS v FROM events), seen AS (
  SELECT *,
    MAX(CASE WHEN v = 0 THEN event_id END) OVER w AS cleared,
    MAX(CASE WHEN v >= 3 THEN event_id END) OVER w AS removed,
    MAX(CASE WHEN v = 1 THEN event_id END) OVER w AS put1,
    MAX(CASE WHEN v = 2 THEN event_id END) OVER w AS put2
  FROM steps WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT user_id, event_id, v, concat_ws(',',
  CASE WHEN put1 > greatest(coalesce(cleared, -1), coalesce(removed, -1)) THEN 'state-1=1' END,
  CASE WHEN put2 > coalesce(cleared, -1) THEN 'state-2=2' END) AS entries
FROM seen""",
    "multimap_entries": f"""
SELECT user_id, event_id, {DAY} AS window_start, 'state-' || (event_id % 7) AS state_key,
  row_number() OVER (PARTITION BY user_id, {DAY} ORDER BY event_id) - 1 AS entries
FROM events""",
    "multimap_at_expiry": f"""
SELECT user_id, {DAY} AS window_start, 'state-' || (event_id % 7) AS state_key, COUNT(*) AS "values"
FROM events GROUP BY 1, 2, 3""",
    "growing_output": f"""
WITH fired AS (SELECT DISTINCT user_id, {DAY} AS window_start FROM events), placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY window_start) AS i FROM fired)
SELECT user_id, window_start, i - 1 AS index, unnest(range(1, i + 1)) AS copy FROM placed""",
    "dynamic_write": f"""
SELECT printf('%08d-of-%08d', CAST(destination AS BIGINT), 10) AS destination, COUNT(*) AS n,
  CAST(SUM(o_orderkey) AS BIGINT) AS key_sum
FROM ({_SHA}) GROUP BY 1""",
    "json_lines": """
SELECT CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
  'c_mktsegment': c_mktsegment}) AS VARCHAR) AS json
FROM customer""",
    "row_json": """
SELECT o_orderkey, CAST(to_json({'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus,
  'o_orderpriority': o_orderpriority}) AS VARCHAR) AS json
FROM orders""",
    "sharded_text": "SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders",
    "compressed_text": "SELECT c_name AS value FROM customer",
    "compressed_table": "SELECT * FROM customer",
    "validated_append": """
SELECT doc_id, CASE WHEN octet_length(encode(text)) > 10000 THEN 'row too large'
  WHEN n_chars IS NULL OR n_chars < 100 THEN 'bad nested field' ELSE 'ok' END AS status
FROM documents""",
    "routed_append": _routed("NULL"),
    "routed_append_defaults": _routed("CASE dest WHEN 'table2' THEN 2 WHEN 'table3' THEN 3 END"),
    "insert_or_reject": """
SELECT o_orderkey // 3 AS k, o_orderkey AS v, CASE
  WHEN o_orderkey // 3 IN (SELECT doc_id FROM labels) THEN 'key exists'
  WHEN o_orderkey > MIN(o_orderkey) OVER (PARTITION BY o_orderkey // 3) THEN 'duplicate in input'
  ELSE 'inserted' END AS status
FROM orders""",
    "to_cells": " UNION ALL ".join(
        f"SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'info' AS family, '{c}' AS qualifier, "
        f"CAST({c} AS VARCHAR) AS value FROM customer"
        for c in ("c_name", "c_nationkey", "c_mktsegment")
    ),
    "stream_window_complete": SUM_PER_KEY,
    "stream_window_append": SUM_PER_KEY,
    "stream_rolled_windows": f"""
SELECT event_id % 10 AS key, {SIX_HOURS} AS window_start, {VALUE} AS sum_value, COUNT(*) AS n
FROM events GROUP BY 1, 2""",
    "stream_late_dropped": f"""{_THIRDS}
SELECT event_id % 10 AS key, {HOUR} AS window_start, {VALUE} AS sum_value, COUNT(*) AS n
FROM arrivals, marks
WHERE third < 2 OR {HOUR} + INTERVAL 1 HOUR > before_last
GROUP BY 1, 2""",
    "stream_stateless_late": f"{_THIRDS} SELECT event_id, ts FROM arrivals",
    "stream_trigger_update": SUM_PER_KEY,
    "stream_discarding": f"""{_THIRDS}
SELECT event_id % 10 AS key, COUNT(*) AS n, MIN(event_id) AS first, MAX(event_id) AS last
FROM thirds GROUP BY key, third""",
    "stream_static_side": _BRANCHES.format(column="event_id", table="events"),
    "stream_word_count": _TOKENS.replace("SELECT regexp_replace(text", "SELECT doc_id, regexp_replace(text")
    .replace("SELECT unnest(string_split", "SELECT doc_id, unnest(string_split")
    .replace("SELECT unnest(CASE", "SELECT doc_id, unnest(CASE")
    .replace("SELECT word, COUNT(*) AS count FROM tokens GROUP BY word", """
SELECT TIMESTAMP '1970-01-01' + (doc_id // 10 * 10) * INTERVAL 1 SECOND AS window_start, word, COUNT(*) AS count
FROM tokens GROUP BY 1, 2"""),
    "stream_collect_windows": f"""
SELECT user_id, {DAY} AS window_start, event_id % 4 AS shard, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS event_ids
FROM events GROUP BY 1, 2, 3""",
    "window_batches": f"""
SELECT user_id, window_start, batch, COUNT(*) AS size, MIN(event_id) AS first, MAX(event_id) AS last FROM (
  SELECT user_id, event_id, {DAY} AS window_start, (row_number() OVER (PARTITION BY user_id, {DAY} ORDER BY event_id) - 1) // 3 AS batch
  FROM events) GROUP BY 1, 2, 3""",
    "idle_timer_fires": _idle("user_id", "6 HOUR"),
    "timer_family_fires": _idle("user_id, event_type", "1 DAY"),
    "stream_messages": """
SELECT CAST(event_id AS VARCHAR) AS message_id, event_id % 100 AS shard,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS sent, CAST(32 AS BIGINT) AS size
FROM events""",
}

# The same questions with every key split.
ORACLES |= {
    f"{name}_split": ORACLES[name]
    for name in ("batches", "global_batches", "group_values", "map_state_fold", "backlog", "panes_accumulating")
}


def _bounded(key: str, count: int, wait: str, last: str, window: str | None = None) -> str:
    """Panes one after the other: each row's successor, and what the first row reaches. ``last``: just below the wait."""
    keys = "key, window_start" if window else "key"
    end = f"window_start + INTERVAL '{window}'" if window else "NULL"
    return f"""
WITH RECURSIVE e AS (
  SELECT {key} AS key, event_id, ts, {bucket(window) if window else 'NULL'} AS window_start FROM events
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts, event_id) - 1 AS p, count(*) OVER (PARTITION BY {keys}) AS size,
    count(*) OVER (PARTITION BY {keys} ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '{last}' FOLLOWING) AS due
  FROM e
), panes AS (
  SELECT key, window_start, 0 AS pane, 0 AS p FROM placed WHERE p = 0
  UNION ALL
  SELECT s.key, s.window_start, s.pane + 1, least(n.p + {count}, n.due)
  FROM panes s JOIN placed n ON n.key = s.key AND n.window_start IS NOT DISTINCT FROM s.window_start AND n.p = s.p
  WHERE least(n.p + {count}, n.due) < n.size
), spans AS (
  SELECT *, lead(p) OVER (PARTITION BY {keys} ORDER BY pane) AS stop FROM panes
), made AS (
  SELECT s.key, s.window_start, s.pane, count(*) AS n, min(e.ts) AS opened, max(e.ts) AS last,
    string_agg(CAST(e.event_id AS VARCHAR), ',' ORDER BY e.p) AS event_ids
  FROM spans s JOIN placed e ON e.key = s.key AND e.window_start IS NOT DISTINCT FROM s.window_start AND e.p >= s.p AND (stop IS NULL OR e.p < stop)
  GROUP BY 1, 2, 3
)
SELECT key AS {key}, {'window_start, ' if window else ''}CAST(pane AS BIGINT) AS pane,
  CASE WHEN n = {count} THEN 'size' WHEN opened + INTERVAL '{wait}' >= {end} THEN 'window' ELSE 'wait' END AS ended_by,
  CASE WHEN n = {count} THEN last ELSE least(opened + INTERVAL '{wait}', {end}) END AS fired_at, event_ids
FROM made"""


_LATE_PANES = f"""
WITH arrived AS (
  SELECT event_id, ts, event_type, least(event_id * 4 // (SELECT max(event_id) + 1 FROM events) + CAST(event_id % 5 = 0 AS INTEGER), 3) AS chunk FROM events
), marks AS (
  SELECT chunk + 1 AS chunk, max(max(ts)) OVER (ORDER BY chunk) AS mark FROM arrived GROUP BY chunk
), judged AS (
  SELECT a.*, {bucket('12 hours')} AS window_start, mark FROM arrived a LEFT JOIN marks USING (chunk)
), kept AS (
  SELECT *, CASE WHEN mark IS NULL OR window_start + INTERVAL '12 hours' > mark THEN -1 ELSE chunk END AS fired FROM judged
  WHERE mark IS NULL OR window_start + INTERVAL '12 hours' + INTERVAL '6 days' > mark
), made AS (
  SELECT event_type, window_start, fired, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS event_ids FROM kept GROUP BY 1, 2, 3
)
SELECT event_type, window_start, row_number() OVER w - 1 AS pane, CASE WHEN fired < 0 THEN 'ON_TIME' ELSE 'LATE' END AS timing, event_ids,
  CAST(sum(n) OVER w AS BIGINT) AS seen
FROM made WINDOW w AS (PARTITION BY event_type, window_start ORDER BY fired)
UNION ALL
SELECT event_type, window_start, count(*), 'EXPIRED', '', CAST(sum(n) AS BIGINT) FROM made GROUP BY 1, 2"""

_TYPE_BATCHES = _bounded("event_type", 20, "3 hours", "2 hours 59 minutes 59.999999 seconds", "1 day")
ORACLES |= {
    "trigger_any": _bounded("user_id", 5, "36 hours", "35 hours 59 minutes 59.999999 seconds"),
    "trigger_any_split": _bounded("user_id", 5, "36 hours", "35 hours 59 minutes 59.999999 seconds"),
    "bounded_batches": _TYPE_BATCHES,
    "stream_bounded_batches": f"SELECT event_type, window_start, ended_by, fired_at, event_ids FROM ({_TYPE_BATCHES})",
    "stream_late_panes": _LATE_PANES,
}

_SPREAD = "CAST(COUNT(v) * CAST(SUM(v * v) AS HUGEINT) - CAST(SUM(v) AS HUGEINT) * CAST(SUM(v) AS HUGEINT) AS DOUBLE) AS spread"
ORACLES |= {
    "window_spread_accumulated": f"""
SELECT key, window_start, {_SPREAD} FROM (SELECT event_id % 10 AS key, {HOUR} AS window_start, {CENTS.format('value')} AS v FROM events)
GROUP BY 1, 2""",
    "global_spread_accumulated": f"SELECT {_SPREAD} FROM (SELECT CAST(l_quantity AS BIGINT) AS v FROM lineitem)",
    "stream_validated_append": ORACLES["validated_append"],
    "stream_routed_append": ORACLES["routed_append"],
}

_CONTENTS = f"""
WITH e AS (
  SELECT user_id, event_id, ts, 'state-' || (event_id % 7) AS state_key, event_id % 7 AS v, {bucket('6 days')} AS window_start FROM events
), put AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, window_start ORDER BY ts, event_id) - 1 AS p,
    lead(ts) OVER (PARTITION BY user_id, window_start, state_key ORDER BY ts, event_id) AS following
  FROM e
), fired AS (
  SELECT user_id, window_start, state_key, ts + INTERVAL 1 DAY AS at FROM put
  WHERE (following IS NULL OR following > ts + INTERVAL 1 DAY) AND ts + INTERVAL 1 DAY < window_start + INTERVAL 6 DAYS
), looks AS (
  SELECT user_id, window_start, 'put' AS kind, ts AS at, state_key, p AS seen FROM put
  UNION ALL
  SELECT f.user_id, f.window_start, 'timer', f.at, f.state_key, count(e.ts)
  FROM fired f JOIN e ON e.user_id = f.user_id AND e.window_start = f.window_start AND e.ts < f.at GROUP BY ALL
  UNION ALL
  SELECT user_id, window_start, 'expiry', window_start + INTERVAL 6 DAYS, NULL, count(*) FROM e GROUP BY 1, 2
), paged AS (
  SELECT *, unnest(range(0, greatest(0, (seen - 1) // 5) + 1)) AS page FROM looks
)
SELECT l.user_id, l.window_start, kind, l.at, l.state_key, l.seen, l.page,
  coalesce(string_agg(e.state_key || '=' || e.v, ',' ORDER BY e.p) FILTER (e.p < l.seen), '') AS entries
FROM paged l JOIN put e ON e.user_id = l.user_id AND e.window_start = l.window_start AND e.p // 5 = l.page
GROUP BY ALL"""
ORACLES |= {"multimap_contents": _CONTENTS, "multimap_contents_split": _CONTENTS}
ORACLES["stream_multi_window"] = ORACLES["multi_window"]
ORACLES["insert_or_reject_bucketed"] = """
WITH w AS (SELECT o_orderkey // 3 AS k, o_orderkey AS v, o_orderkey % 2 AS half FROM orders), e AS (
  SELECT k FROM w WHERE half = 0 AND k NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL))
SELECT k, v, CASE
  WHEN k IN (SELECT doc_id FROM labels) THEN 'key exists'
  WHEN half = 1 AND k IN (SELECT k FROM e) THEN 'key exists'
  WHEN v > MIN(v) OVER (PARTITION BY k, half) THEN 'duplicate in input'
  ELSE 'inserted' END AS status
FROM w"""
