"""DuckDB SQL oracles, written from the rules, not from the Spark code.

Shared CTE fragments build the same derived inputs as ``fixtures`` straight
from the base tables, then each oracle applies the rule in plain SQL.
"""

from __future__ import annotations

# Clean raw log: one row per message, and one row per line item (orders without items have none).
ITEMS = """
messages AS (
  SELECT o.o_orderkey, p.part, CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(coalesce(p.part, 0) AS VARCHAR) AS key,
         o.o_orderkey % 101 AS dirty_case, coalesce(p.n, 0) AS n,
         strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS dt, n.n_name AS country_code, n.n_regionkey,
         CAST(year(o.o_orderdate) - 1995 AS INTEGER) AS batch_id
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT l_orderkey, (l_linenumber - 1) // 2 AS part, count(*) AS n FROM lineitem GROUP BY ALL) p
         ON p.l_orderkey = o.o_orderkey),
items AS (
  SELECT m.key,
         CAST(row_number() OVER (PARTITION BY m.key ORDER BY l.l_linenumber, l.l_returnflag, l.l_discount, l.l_linestatus) - 1 AS INTEGER) AS item_pos,
         m.dt, m.country_code, m.n_regionkey,
         l.l_returnflag AS type, l.l_discount AS score, l.l_linestatus AS level, l.l_linenumber, m.dirty_case, m.batch_id
  FROM messages m
  JOIN lineitem l ON l.l_orderkey = m.o_orderkey AND (l.l_linenumber - 1) // 2 = m.part)"""

# The dirty raw log: faults by order key modulo 101, and what is left of its items. Case 6 adds an
# item whose repeated key takes its last value.
DIRTY_ITEMS = ITEMS + """,
faults(dirty_case, reason) AS (VALUES (1, 'malformed'), (2, 'missing_data'), (3, 'malformed'), (9, 'null_item'),
  (10, 'empty'), (11, 'malformed'), (12, 'malformed'), (13, 'malformed'), (14, 'malformed'), (15, 'malformed'), (16, 'malformed')),
good_items AS (
  SELECT key, item_pos, dt, country_code, n_regionkey, type, score, level, l_linenumber, dirty_case FROM items
  WHERE dirty_case <> 4 AND dirty_case NOT IN (SELECT dirty_case FROM faults)
  UNION ALL
  SELECT key, CAST(n AS INTEGER), dt, country_code, n_regionkey, 'E', NULL, NULL, NULL, dirty_case FROM messages
  WHERE dirty_case = 6)"""

AREA_OF_REGION = "'AREA_' || r.r_name"

# Audit fields per event before faults are injected.
AUDIT = """
audit0 AS (
  SELECT e.event_id, CAST(e.event_id AS VARCHAR) AS key,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS dt0, e.event_type,
         'AREA_' || r.r_name AS area0, 'user' || CAST(e.user_id % 5 + 1 AS VARCHAR) AS user0
  FROM events e LEFT JOIN region r ON e.user_id % 5 = r.r_regionkey)"""

# Dirty audit log, parsed: time_ms is 0 when the time text is not strict or there is no sound message.
DIRTY_AUDIT = AUDIT + """,
audit1 AS (
  SELECT event_id, key, event_id % 97 AS c,
         CASE event_id % 97 WHEN 2 THEN 'empty' WHEN 8 THEN 'malformed' WHEN 9 THEN 'malformed' WHEN 10 THEN 'malformed'
              WHEN 11 THEN 'malformed' WHEN 12 THEN 'malformed' WHEN 13 THEN 'malformed' END AS fault,
         CASE event_id % 97 WHEN 1 THEN 'bad' WHEN 3 THEN NULL WHEN 4 THEN '2019-1-1 1:1:1'
              WHEN 5 THEN '2019-13-01 00:00:00' WHEN 7 THEN '1970-01-01 00:00:00' ELSE dt0 END AS dt,
         CASE WHEN event_id % 97 = 6 THEN NULL ELSE event_type END AS type, area0, user0
  FROM audit0),
texts AS (
  SELECT *, '{' || CASE WHEN c = 3 THEN '' ELSE '"dt":"' || dt || '",' END || '"type":' || coalesce('"' || type || '"', 'null')
            || ',"username":"' || user0 || '","area":"' || area0 || '"}' AS text FROM audit1),
parsed AS (
  SELECT key, event_id, fault,
         CASE c WHEN 2 THEN '' WHEN 8 THEN left(text, length(text) - 1) WHEN 9 THEN '[' || text || ']' WHEN 10 THEN text || ' x'
              WHEN 11 THEN text || '] junk' WHEN 12 THEN text || ',"e":1} x' WHEN 13 THEN text || ']]' ELSE text END AS value,
         CASE WHEN fault IS NOT NULL THEN CAST(0 AS BIGINT)
              ELSE coalesce(CASE WHEN regexp_full_match(dt, '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}')
                                 THEN epoch_ms(try_strptime(dt, '%Y-%m-%d %H:%M:%S')) END, CAST(0 AS BIGINT)) END AS time_ms,
         CASE WHEN fault IS NULL THEN type END AS type,
         CASE WHEN fault IS NULL THEN area0 END AS area
  FROM texts),
rejected AS (
  SELECT *, coalesce(fault, CASE WHEN time_ms = 0 THEN 'bad_time' ELSE 'null_key' END) AS reason FROM parsed
  WHERE NOT (time_ms <> 0 AND type IS NOT NULL AND area IS NOT NULL)),
accepted AS (SELECT * FROM parsed WHERE time_ms <> 0 AND type IS NOT NULL AND area IS NOT NULL)"""

FMT = "strftime(make_timestamp(CAST({ms} AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S')"


def fmt(ms: str) -> str:
    return FMT.format(ms=ms)


def report(size_ms: int, source: str) -> str:
    return f"""
SELECT CAST(ws AS BIGINT) AS window_start_ms, type, area, count(*) AS count, {fmt('max(time_ms)')} AS time
FROM (SELECT *, time_ms - ((time_ms % {size_ms}) + {size_ms}) % {size_ms} AS ws FROM {source})
GROUP BY ws, type, area"""


def ledger_rows(source: str, size_ms: int) -> str:
    """CTEs win (rows + window bounds), led (per-batch watermarks), cls (rows + is_late)."""
    return f"""
win AS (SELECT *, time_ms - ((time_ms % {size_ms}) + {size_ms}) % {size_ms} AS ws,
               time_ms - ((time_ms % {size_ms}) + {size_ms}) % {size_ms} + {size_ms} AS we FROM {source}),
led0 AS (SELECT batch_id, max(time_ms) AS mx FROM win GROUP BY batch_id),
led AS (SELECT batch_id,
          greatest(coalesce(max(mx) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) - 10000 AS wm_before,
          greatest(max(mx) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - 10000 AS wm_after
        FROM led0),
cls AS (SELECT win.*, led.wm_before, (we - 1 + 30000 <= led.wm_before) AS is_late
        FROM win JOIN led USING (batch_id))"""


LATE_AUDIT = AUDIT + """,
src AS (
  SELECT key, event_id, epoch_ms(strptime(dt0, '%Y-%m-%d %H:%M:%S')) AS time_ms, event_type AS type, area0 AS area,
         CAST((event_id + CASE WHEN event_id % 50 = 0 THEN 250 ELSE 0 END) // 100 AS BIGINT) AS batch_id
  FROM audit0)"""

COMPRESSED = """
src AS (
  SELECT CAST(event_id AS VARCHAR) AS key, event_id,
         CAST(1704067200000 + event_id * 1000 AS BIGINT) AS time_ms, event_type AS type,
         'AREA_' || CAST(user_id % 5 AS VARCHAR) AS area,
         CAST((event_id + CASE WHEN event_id % 11 = 0 THEN 45 WHEN event_id % 13 = 0 THEN 90 ELSE 0 END) // 7 AS BIGINT) AS batch_id
  FROM events)"""

MULTI_INPUT = COMPRESSED.replace("src AS", "one AS") + """,
inputs AS (SELECT *, CASE WHEN (event_id // 5) % 3 = 2 AND (batch_id // 20) % 2 = 1 THEN 0 ELSE (event_id // 5) % 3 END AS input FROM one),
src AS (SELECT * REPLACE (CAST(batch_id + CASE WHEN input = 1 THEN 2 ELSE 0 END AS BIGINT) AS batch_id) FROM inputs)"""


def input_ledger_rows(source: str, size_ms: int, idle: int) -> str:
    """Like ``ledger_rows``, with the least of the highest times of the inputs that aren't idle."""
    return f"""
win AS (SELECT *, time_ms - ((time_ms % {size_ms}) + {size_ms}) % {size_ms} AS ws,
               time_ms - ((time_ms % {size_ms}) + {size_ms}) % {size_ms} + {size_ms} AS we FROM {source}),
grid AS (SELECT b.batch_id, i.input, (SELECT min(batch_id) FROM win) - 1 AS start
         FROM (SELECT DISTINCT batch_id FROM win) b, (SELECT DISTINCT input FROM win) i),
high AS (SELECT g.batch_id, g.input, coalesce(max(c.batch_id), any_value(g.start)) AS last, greatest(coalesce(max(c.mx), 0), 0) AS mx
         FROM grid g LEFT JOIN (SELECT input, batch_id, max(time_ms) AS mx FROM win GROUP BY ALL) c
              ON c.input = g.input AND c.batch_id <= g.batch_id GROUP BY g.batch_id, g.input),
least_of AS (SELECT batch_id, min(mx) AS mx FROM high WHERE batch_id - last <= {idle} GROUP BY batch_id),
led AS (SELECT batch_id,
          greatest(coalesce(max(mx) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) - 10000 AS wm_before,
          greatest(max(mx) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - 10000 AS wm_after
        FROM least_of),
cls AS (SELECT win.*, led.wm_before, (we - 1 + 30000 <= led.wm_before) AS is_late
        FROM win JOIN led USING (batch_id))"""


FIRED = """,
ok AS (SELECT * FROM cls WHERE NOT is_late),
closeb AS (SELECT e.we, (SELECT min(batch_id) FROM led WHERE wm_after >= e.we - 1) AS close_b
           FROM (SELECT DISTINCT we FROM ok) e),
fired AS (SELECT ok.*, greatest(batch_id, close_b) AS fire_b FROM ok JOIN closeb USING (we) WHERE close_b IS NOT NULL),
per AS (SELECT ws, type, area, fire_b, count(*) AS n, max(time_ms) AS mx FROM fired GROUP BY ws, type, area, fire_b),
firings AS (
  SELECT CAST(ws AS BIGINT) AS window_start_ms, type, area, fire_b AS fire_batch,
         CAST(sum(n) OVER (PARTITION BY ws, type, area ORDER BY fire_b ROWS UNBOUNDED PRECEDING) AS BIGINT) AS count,
         max(mx) OVER (PARTITION BY ws, type, area ORDER BY fire_b ROWS UNBOUNDED PRECEDING) AS cmx
  FROM per)"""

STREAM_AUDIT = AUDIT + """,
span AS (SELECT CAST(ceil((max(event_id) + 1) / 8.0) AS BIGINT) AS s FROM events),
src AS (
  SELECT key, event_id, epoch_ms(strptime(dt0, '%Y-%m-%d %H:%M:%S')) AS time_ms, event_type AS type, area0 AS area,
         CAST(least(7, (event_id + CASE WHEN event_id % 50 = 0 THEN (SELECT s + s // 2 FROM span) ELSE 0 END)
                        // (SELECT s FROM span)) AS BIGINT) AS batch_id
  FROM audit0)"""

VERSIONS = """
ver AS (
  SELECT 0 AS version, n_name AS country_code, n_regionkey AS rk FROM nation
  UNION ALL SELECT 2, n_name, CASE WHEN n_nationkey = 1 THEN (n_regionkey + 1) % 5 ELSE n_regionkey END FROM nation
  UNION ALL SELECT 4, n_name, n_regionkey FROM nation WHERE n_nationkey <> 2
  UNION ALL SELECT 6, n_name, n_regionkey FROM nation),
vmap AS (SELECT version, country_code, 'AREA_' || r_name AS area FROM ver JOIN region ON rk = r_regionkey),
published AS (SELECT DISTINCT version FROM vmap),
inforce AS (SELECT b.batch_id, (SELECT max(p.version) FROM published p WHERE p.version <= b.batch_id) AS version
            FROM (SELECT DISTINCT batch_id FROM items) b)"""
