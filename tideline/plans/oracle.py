"""The same results in plain SQL: derived inputs and shared steps as named subqueries."""

from __future__ import annotations

import re

_KEY = "capture_instance, start_lsn, command_key, seqval"

STEPS = {
    "ct": """
WITH b AS (
  SELECT event_id, event_type, value,
         CAST(floor(event_id / 5) AS BIGINT) AS tx, event_id % 5 AS pos, event_id % 10 AS k
  FROM events),
r AS (
            SELECT tx, pos, event_type, 2 AS op, event_id AS pk, value AS v FROM b WHERE k IN (0, 1, 2, 3)
  UNION ALL SELECT tx, pos, event_type, 3, event_id - 4, value - 1 FROM b WHERE k IN (4, 5, 6)
  UNION ALL SELECT tx, pos, event_type, 4, event_id - 4, value     FROM b WHERE k IN (4, 5, 6)
  UNION ALL SELECT tx, pos, event_type, 1, event_id - 7, value     FROM b WHERE k = 7
  UNION ALL SELECT tx, pos, event_type, 1, event_id - 7, value - 1 FROM b WHERE k = 8
  UNION ALL SELECT tx, pos, event_type, 2, event_id - 7, value     FROM b WHERE k = 8
  UNION ALL SELECT tx, pos, event_type, 1, event_id - 7, value     FROM b WHERE k = 9
  UNION ALL SELECT tx, pos, event_type, 2, event_id - 7 + 1000000, value FROM b WHERE k = 9)
SELECT 'dbo_events' AS capture_instance,
       printf('%08X%08X%04X', 39, tx, 1) AS start_lsn,
       printf('%08X%08X%04X', 39, tx, pos + 2) AS seqval,
       CAST(pos + 1 AS INT) AS command_id, CAST(op AS INT) AS operation,
       pk AS id, event_type AS name, v AS value
FROM r""",
    "lsn_time": """
SELECT printf('%08X%08X%04X', 39, tx, 1) AS start_lsn, max(ts) AS commit_time
FROM (SELECT CAST(floor(event_id / 5) AS BIGINT) AS tx, ts FROM events) e
WHERE tx % 50 <> 7
GROUP BY tx""",
    "ct_orders": """
WITH b AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice,
         CAST(floor(o_orderkey / 8) AS BIGINT) AS tx, o_orderkey % 8 AS pos FROM orders),
r AS (
            SELECT 40 AS vlf, tx, pos, 2 AS op, o_orderkey, 'O' AS status, o_totalprice FROM b
  UNION ALL SELECT 41, tx, pos, 3, o_orderkey, 'O', o_totalprice FROM b WHERE o_orderstatus = 'F'
  UNION ALL SELECT 41, tx, pos, 4, o_orderkey, 'F', o_totalprice FROM b WHERE o_orderstatus = 'F')
SELECT 'dbo_orders' AS capture_instance,
       printf('%08X%08X%04X', vlf, tx, 1) AS start_lsn,
       printf('%08X%08X%04X', vlf, tx, pos + 2) AS seqval,
       CAST(pos + 1 AS INT) AS command_id, CAST(op AS INT) AS operation,
       o_orderkey AS id, status, o_totalprice AS totalprice
FROM r""",
    "ct_orphan": "SELECT * FROM ct WHERE NOT (operation = 4 AND id % 97 = 0)",
    "ct_badop": """
SELECT capture_instance, start_lsn, seqval, command_id,
       CASE WHEN id = 10 AND operation = 2 THEN 5 ELSE operation END AS operation, id, name, value
FROM ct""",
    "ct_shared_seq": """
SELECT capture_instance, start_lsn, start_lsn AS seqval, command_id, operation, id, name, value FROM ct""",
    "bookmarks": """
SELECT 'dbo_events' AS capture_instance, '00000027000001F40001' AS lsn
UNION ALL SELECT 'dbo_old', '00000010000000010001'""",
    "all_ct": """
SELECT capture_instance, start_lsn, seqval, command_id, operation FROM ct
UNION ALL SELECT capture_instance, start_lsn, seqval, command_id, operation FROM ct_orders""",
    "catalog": """
SELECT capture_instance, min(start_lsn) AS min_lsn, max(start_lsn) AS max_lsn,
       count(*) AS change_rows, count(command_id) AS rows_with_command_id
FROM all_ct GROUP BY capture_instance""",
    "ceiling": "SELECT max(start_lsn) AS max_lsn FROM lsn_time",
    "resume": """
SELECT w.capture_instance, w.min_lsn, b.lsn AS bookmark_lsn,
       CASE WHEN b.lsn IS NULL OR b.lsn < w.min_lsn THEN w.min_lsn
            ELSE printf('%020X', CAST('0x' || b.lsn AS HUGEINT) + 1) END AS resume_lsn,
       coalesce(b.lsn < w.min_lsn, false) AS has_gap,
       b.lsn IS NULL AS take_snapshot,
       c.max_lsn,
       CASE WHEN b.lsn > c.max_lsn THEN b.lsn ELSE c.max_lsn END AS next_lsn
FROM (SELECT capture_instance, min(start_lsn) AS min_lsn FROM all_ct GROUP BY capture_instance) w
LEFT JOIN bookmarks b ON b.capture_instance = w.capture_instance
CROSS JOIN (SELECT max(start_lsn) AS max_lsn FROM all_ct) c""",
    "windowed": """
SELECT capture_instance, start_lsn,
       CAST((dense_rank() OVER (PARTITION BY capture_instance ORDER BY start_lsn) - 1) // 300 AS BIGINT) AS window_id
FROM (SELECT DISTINCT capture_instance, start_lsn FROM all_ct) d""",
    "bounds": """
SELECT capture_instance, window_id, max(start_lsn) AS to_lsn, count(*) AS transactions
FROM windowed GROUP BY capture_instance, window_id""",
    "full_bounds": """
SELECT b.capture_instance, b.window_id, b.to_lsn, b.transactions,
       coalesce(printf('%020X', CAST('0x' || lag(b.to_lsn) OVER
                (PARTITION BY b.capture_instance ORDER BY b.window_id) AS HUGEINT) + 1), m.min_lsn) AS from_lsn
FROM bounds b
JOIN (SELECT capture_instance, min(start_lsn) AS min_lsn FROM all_ct GROUP BY capture_instance) m
  ON m.capture_instance = b.capture_instance""",
    "ev": "EVENTS OF ct",
    "ev_orphan": "EVENTS OF ct_orphan",
    "kinds": "KINDS OF ct",
    "kinds_orphan": "KINDS OF ct_orphan",
    "kinds_badop": "KINDS OF ct_badop",
    "kinds_best_effort": "KINDS OF ct_no_command",
    "ct_no_command": """
SELECT capture_instance, start_lsn, seqval, CAST(NULL AS INT) AS command_id, operation, id, name, value
FROM ct_shared_seq""",
    "ev_best_effort": "EVENTS OF ct_no_command",
    "ev_shared_seq": "EVENTS OF ct_shared_seq",
    "kinds_shared_seq": "KINDS OF ct_shared_seq",
}

# The kind of a change is decided from its operation list, independently of the Spark window form.
_KINDS = """
WITH keyed AS (SELECT *, coalesce(command_id, -1) AS command_key FROM {source}),
g AS (
  SELECT capture_instance, start_lsn, command_key, seqval, list(operation ORDER BY operation) AS ops,
         max(id) FILTER (WHERE operation = 1) AS old_id, max(id) FILTER (WHERE operation = 2) AS new_id
  FROM keyed GROUP BY capture_instance, start_lsn, command_key, seqval)
SELECT k.*, g.ops,
       row_number() OVER (PARTITION BY k.capture_instance, k.start_lsn, k.command_key, k.seqval
         ORDER BY k.operation, k.id NULLS FIRST, k.name NULLS FIRST, k.value NULLS FIRST) AS serial,
       CASE WHEN ops = [3, 4] THEN 'update_pair'
            WHEN ops = [1, 2] AND old_id IS DISTINCT FROM new_id THEN 'key_move'
            WHEN ops = [1, 2] THEN 'deferred_update' ELSE 'single' END AS kind,
       list_contains(ops, 3) OR list_contains(ops, 4) AS has_update_half
FROM keyed k JOIN g ON g.capture_instance = k.capture_instance AND g.start_lsn = k.start_lsn
  AND g.command_key = k.command_key AND g.seqval = k.seqval"""

_EVENTS = """
SELECT capture_instance, start_lsn, command_key, seqval, serial, kind, id, name, value,
       CASE WHEN kind IN ('update_pair', 'deferred_update') THEN 'u' WHEN operation = 1 THEN 'd' ELSE 'c' END AS __op
FROM {kinds}
WHERE CASE WHEN kind IN ('update_pair', 'deferred_update') THEN serial = 2
           WHEN kind = 'key_move' THEN true ELSE operation IN (1, 2) END"""

_KINDS_OF = {
    "ct": "kinds",
    "ct_orphan": "kinds_orphan",
    "ct_no_command": "kinds_best_effort",
    "ct_shared_seq": "kinds_shared_seq",
}


def _step(name: str) -> str:
    text = STEPS[name]
    if text.startswith("KINDS OF "):
        return _KINDS.format(source=text.split()[-1])
    if text.startswith("EVENTS OF "):
        return _EVENTS.format(kinds=_KINDS_OF[text.split()[-1]])
    return text


def with_steps(sql: str) -> str:
    """Put every named subquery that ``sql`` needs, directly or not, in front of it."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in STEPS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                body = _step(name)
                need(body)
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_step(n)}\n)" for n in ordered) + "\n" + sql
