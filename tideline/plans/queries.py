"""Every operator as a query over the test tables, with the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tideline.functions import lsn, times
from tideline.functions.json_values import json_columns, json_line
from tideline.model import CHANGE_KEY, ColumnInfo, CapturedTable
from tideline.operators import changes, envelope, filters, reports, resume, snapshot, windows
from tideline.plans.events import change_events as typed_events
from tideline.plans.events import commit_times, event_lines, paired_landed, paired_lines, with_commit_time
from tideline.plans.incremental import RunOptions, run_incremental
from tideline.plans.oracle import with_steps
from tideline.session import new_path, stage
from tideline.sinks import json_lines, manifest, paths
from tideline.sources import bookmarks as bookmark_store
from tideline.sources import landing
from tideline.sources.change_tables import table_facts
from tideline.sources.fixtures import ORIGIN, Fixtures
from tideline.streaming import incremental, pairing, watermark

PROCESSED_AT = datetime(2026, 1, 1, tzinfo=timezone.utc)
STARTED_AT = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
RUN_ID = "20260102T030405Z_000000000001"
WINDOW = 300
BOOKMARK = "00000027000001F40001"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

Query = Callable[[Fixtures], DataFrame]


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function name, together with its SQL form."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = lambda spark, sf_dir: run(Fixtures(spark, sf_dir))
        ORACLES[key] = with_steps(sql)
        return run

    return register


def _kinds(f: Fixtures) -> DataFrame:
    return changes.classify(f.ct, ("id",))


def _events(f: Fixtures) -> DataFrame:
    return changes.events(_kinds(f))


# --- scans and sources -------------------------------------------------------------------------------------


@query(
    f"SELECT capture_instance, start_lsn, seqval, command_id, operation, id, name, value FROM ct "
    f"WHERE start_lsn BETWEEN '{BOOKMARK}' AND (SELECT max_lsn FROM ceiling)"
)
def change_scan(f: Fixtures) -> DataFrame:
    """SC1."""
    return filters.change_scan(f.ct, f.events_table, BOOKMARK, resume.freeze_ceiling(f.lsn_time))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def snapshot_scan(f: Fixtures) -> DataFrame:
    """SC2."""
    return snapshot.snapshot_scan(f.table("customer"), f.customer_table)


@query("SELECT * FROM catalog")
def capture_catalog(f: Fixtures) -> DataFrame:
    """SC3, SC9, SO6."""
    return reports.capture_catalog(f.both)


@query("SELECT max_lsn FROM ceiling")
def run_ceiling(f: Fixtures) -> DataFrame:
    """SC7."""
    return resume.run_ceiling(f.lsn_time)


@query("SELECT capture_instance, min(start_lsn) AS min_lsn FROM all_ct GROUP BY capture_instance")
def low_watermark(f: Fixtures) -> DataFrame:
    """SC8."""
    marks = resume.low_watermarks(f.both)
    resume.check_low_watermarks(marks)
    return marks


@query("SELECT capture_instance, max_lsn AS lsn FROM catalog")
def bookmark_load(f: Fixtures) -> DataFrame:
    """SC10: what was saved last is what a run loads."""
    path = new_path(f.spark, "bookmark-store")
    marks = reports.capture_catalog(f.both)
    bookmark_store.save_bookmarks(marks.select("capture_instance", F.col("min_lsn").alias("lsn")), path)
    bookmark_store.save_bookmarks(marks.select("capture_instance", F.col("max_lsn").alias("lsn")), path)
    return bookmark_store.load_bookmarks(f.spark, path)


@query("SELECT capture_instance, '0x' || max_lsn AS lsn, CAST(2 AS BIGINT) AS entries, CAST(1 AS BIGINT) AS version FROM catalog")
def bookmark_save(f: Fixtures) -> DataFrame:
    """SK7: the stored form."""
    path = new_path(f.spark, "bookmark-store")
    marks = reports.capture_catalog(f.both)
    bookmark_store.save_bookmarks(marks.select("capture_instance", F.col("max_lsn").alias("lsn")), path)
    stored = f.spark.read.schema("capture_instance string, lsn string, entries bigint, version bigint").json(path)
    return stored.select("capture_instance", "lsn", "entries", "version")


# --- filters and joins -------------------------------------------------------------------------------------


@query("SELECT id, name, value FROM ct")
def row_state(f: Fixtures) -> DataFrame:
    """PF1."""
    return filters.row_state(f.ct, f.events_table)


@query(
    "SELECT capture_instance, start_lsn, seqval, operation FROM all_ct "
    f"WHERE start_lsn BETWEEN '{BOOKMARK}' AND '00000028FFFFFFFFFFFF'"
)
def lsn_range(f: Fixtures) -> DataFrame:
    """PF2."""
    found = filters.lsn_range(f.both, BOOKMARK, "00000028FFFFFFFFFFFF")
    return found.select("capture_instance", "start_lsn", "seqval", "operation")


@query("SELECT * FROM all_ct WHERE capture_instance = 'dbo_orders'")
def instance_filter(f: Fixtures) -> DataFrame:
    """PF3: exclude wins over include."""
    return filters.choose_instances(f.both, ("dbo_events", "dbo_orders", "dbo_absent"), ("dbo_events",))


@query(f"SELECT * FROM ct WHERE start_lsn >= printf('%020X', CAST('0x{BOOKMARK}' AS HUGEINT) + 1)")
def resume_filter(f: Fixtures) -> DataFrame:
    """PF4."""
    return filters.after_bookmark(f.ct, BOOKMARK)


@query("SELECT capture_instance, start_lsn, seqval, command_id, operation, id, name, value, -1 AS command_key FROM ct_no_command")
def best_effort_scan(f: Fixtures) -> DataFrame:
    """PF5, PF6."""
    return changes.with_change_key(f.ct_shared_seq.drop("command_id"))


@query("SELECT capture_instance, start_lsn, seqval, operation, id AS key_id FROM ct")
def event_key(f: Fixtures) -> DataFrame:
    """PF7."""
    key = envelope.key_struct(f.events_table)
    return f.ct.select("capture_instance", "start_lsn", "seqval", "operation", key.alias("key")).select(
        "capture_instance", "start_lsn", "seqval", "operation", F.col("key.id").alias("key_id")
    )


@query("SELECT ct.start_lsn, seqval, operation, id, commit_time FROM ct LEFT JOIN lsn_time t ON t.start_lsn = ct.start_lsn")
def commit_time(f: Fixtures) -> DataFrame:
    """JN1."""
    return with_commit_time(f.ct.select("start_lsn", "seqval", "operation", "id"), f.lsn_time)


@query(
    "SELECT coalesce(c.capture_instance, b.capture_instance) AS capture_instance, coalesce(c.max_lsn, b.lsn) AS lsn "
    "FROM catalog c FULL OUTER JOIN bookmarks b ON b.capture_instance = c.capture_instance"
)
def bookmark_merge(f: Fixtures) -> DataFrame:
    """JN5."""
    new = reports.capture_catalog(f.both).select("capture_instance", F.col("max_lsn").alias("lsn"))
    return resume.merge_bookmarks(f.bookmarks, new)


@query(
    "SELECT capture_instance FROM (SELECT 'dbo_absent' AS capture_instance UNION SELECT 'dbo_events' "
    "UNION SELECT 'dbo_gone') n WHERE capture_instance NOT IN (SELECT capture_instance FROM all_ct)"
)
def missing_instances(f: Fixtures) -> DataFrame:
    """JN6, ST1."""
    return filters.missing_instances(reports.capture_catalog(f.both), ("dbo_events", "dbo_absent"), ("dbo_gone",))


@query(
    "SELECT a.capture_instance, a.start_lsn, a.command_key, a.seqval, a.kind, b.id AS before_id, b.name AS before_name, "
    "b.value AS before_value, a.id AS after_id, a.name AS after_name, a.value AS after_value "
    "FROM kinds a JOIN kinds b ON a.start_lsn = b.start_lsn AND a.command_key = b.command_key AND a.seqval = b.seqval "
    "WHERE a.kind IN ('update_pair', 'deferred_update') AND a.serial = 2 AND b.serial = 1"
)
def before_after(f: Fixtures) -> DataFrame:
    """JN7, WN6."""
    return changes.before_after(f.ct, ("id",))


# --- change semantics --------------------------------------------------------------------------------------


@query(
    "SELECT capture_instance, start_lsn, coalesce(command_id, -1) AS command_key, seqval, count(*) AS group_rows "
    "FROM ct GROUP BY ALL"
)
def change_groups(f: Fixtures) -> DataFrame:
    """AG1."""
    return changes.change_groups(f.ct).drop("operations")


@query(
    "SELECT operations, count(*) AS groups, CAST(sum(group_rows) AS BIGINT) AS total_rows FROM ("
    "  SELECT capture_instance, start_lsn, seqval, CAST(sum(n) AS BIGINT) AS group_rows,"
    "         string_agg(operation || 'x' || n, ',' ORDER BY operation) AS operations"
    "  FROM (SELECT capture_instance, start_lsn, seqval, operation, count(*) AS n FROM ct_no_command GROUP BY ALL) o"
    "  GROUP BY capture_instance, start_lsn, seqval) s GROUP BY operations"
)
def group_signature(f: Fixtures) -> DataFrame:
    """AG2: operation lists of whole transactions, in best-effort mode."""
    found = changes.change_groups(f.ct_shared_seq.drop("command_id"))
    return found.groupBy("operations").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("group_rows").alias("total_rows")
    )


@query("SELECT capture_instance, start_lsn, command_key, seqval, operation, id, serial, kind, has_update_half FROM kinds")
def change_kind(f: Fixtures) -> DataFrame:
    """CP1, CP5, WN3."""
    return _kinds(f).select(*CHANGE_KEY, "operation", "id", "serial", "kind", "has_update_half")


def _of_kind(kind: str) -> str:
    return f"SELECT capture_instance, start_lsn, command_key, seqval, serial, id, name, value, __op FROM ev WHERE kind = '{kind}'"


def _kind_events(f: Fixtures, kind: str) -> DataFrame:
    return _events(f).where(F.col("kind") == kind).select(*CHANGE_KEY, "serial", "id", "name", "value", "__op")


@query(_of_kind("update_pair"))
def update_pairs(f: Fixtures) -> DataFrame:
    """CP2, WN4."""
    return _kind_events(f, changes.UPDATE_PAIR)


@query(_of_kind("deferred_update"))
def deferred_updates(f: Fixtures) -> DataFrame:
    """CP3, WN4."""
    return _kind_events(f, changes.DEFERRED_UPDATE)


@query(_of_kind("key_move"))
def key_moves(f: Fixtures) -> DataFrame:
    """CP4, WN4."""
    return _kind_events(f, changes.KEY_MOVE)


@query(
    "SELECT capture_instance, start_lsn, command_key, seqval, serial, id, name, value, __op FROM ev_best_effort"
)
def single_changes(f: Fixtures) -> DataFrame:
    """CP6, PF8: whole transactions as one group, orphan halves dropped."""
    found = changes.classify(f.ct_shared_seq, ("id",), use_command_id=False)
    return changes.events(found, strict=False).select(*CHANGE_KEY, "serial", "id", "name", "value", "__op")


@query(
    "SELECT capture_instance, start_lsn, command_key, seqval, operation, id, name, value FROM kinds_orphan "
    "WHERE kind = 'single' AND has_update_half AND operation IN (3, 4)"
)
def incomplete_pairs(f: Fixtures) -> DataFrame:
    """CP7."""
    found = changes.incomplete_pairs(changes.classify(f.ct_orphan, ("id",)))
    return found.select(*CHANGE_KEY, "operation", "id", "name", "value")


@query(
    "SELECT capture_instance, start_lsn, command_key, seqval, operation, id FROM kinds_badop "
    "WHERE kind = 'single' AND operation NOT IN (1, 2, 3, 4)"
)
def bad_operations(f: Fixtures) -> DataFrame:
    """CP8."""
    found = changes.bad_operations(changes.classify(f.ct_badop, ("id",)))
    return found.select(*CHANGE_KEY, "operation", "id")


@query("SELECT capture_instance, start_lsn, command_key, seqval, serial, id, name, value, __op FROM ev_orphan")
def lenient_events(f: Fixtures) -> DataFrame:
    """CP7, PF8: lenient mode on a table with orphan halves."""
    found = changes.events(changes.classify(f.ct_orphan, ("id",)), strict=False)
    return found.select(*CHANGE_KEY, "serial", "id", "name", "value", "__op")


@query(
    "SELECT start_lsn, id AS key_id, 'struct' AS kind, 'server1.dbo.sales.events.Key' AS name, 1 AS version, "
    "false AS optional, 'id' AS field, 'int64' AS field_type, false AS field_optional, 'bigint' AS sql_type, "
    "true AS no_value FROM ev WHERE __op = 'd'"
)
def key_schemas(f: Fixtures) -> DataFrame:
    """EN5, EN7, EN9: tombstones whose key comes with its schema document, as they are written and read back."""
    schema = F.lit(envelope.key_schema_text(f.events_table, ORIGIN))
    line = envelope.tombstone_line(envelope.key_text(f.ct, f.events_table), schema)
    fields = "array<struct<field:string,type:string,optional:boolean,parameters:struct<sqlserver_type:string>>>"
    document = f"struct<type:string,fields:{fields},optional:boolean,name:string,version:int>"
    parsed = F.from_json("line", f"key struct<schema:{document},payload:struct<id:bigint>>, value string")
    rows = _events(f).where("__op = 'd'").select("start_lsn", line.alias("line")).select("start_lsn", parsed.alias("e"))
    document, field = F.col("e.key.schema"), F.col("e.key.schema.fields")[0]
    return rows.select(
        "start_lsn",
        F.col("e.key.payload.id").alias("key_id"),
        document["type"].alias("kind"),
        document["name"].alias("name"),
        document["version"].alias("version"),
        document["optional"].alias("optional"),
        field["field"].alias("field"),
        field["type"].alias("field_type"),
        field["optional"].alias("field_optional"),
        field["parameters"]["sqlserver_type"].alias("sql_type"),
        F.col("e.value").isNull().alias("no_value"),
    )


@query(
    "SELECT start_lsn, command_key, seqval, serial, tombstone, __op, id AS key_id, "
    "CASE WHEN NOT tombstone THEN name END AS name, CASE WHEN NOT tombstone THEN value END AS value FROM ("
    "SELECT *, false AS tombstone FROM ev UNION ALL SELECT *, true AS tombstone FROM ev WHERE __op = 'd') x"
)
def tombstones(f: Fixtures) -> DataFrame:
    """CP9, EN3."""
    body = ~F.col("tombstone")
    return envelope.with_tombstones(_events(f)).select(
        "start_lsn",
        "command_key",
        "seqval",
        "serial",
        "tombstone",
        "__op",
        F.col("id").alias("key_id"),
        F.when(body, F.col("name")).alias("name"),
        F.when(body, F.col("value")).alias("value"),
    )


# January wall times of the fixtures' zone are five hours behind UTC.
_TS_MS = "coalesce(epoch_us(commit_time + INTERVAL 5 HOUR) // 1000, 1767225600000)"
_FLAT = (
    "SELECT capture_instance, e.start_lsn, command_key, seqval, serial, id, name, value, __op, 'events' AS __table, "
    f"CASE WHEN __op = 'd' THEN 'true' ELSE 'false' END AS __deleted, {_TS_MS} AS __source_ts_ms "
    "FROM {events} e LEFT JOIN lsn_time t ON t.start_lsn = e.start_lsn"
)


@query(_FLAT.format(events="ev"))
def change_events(f: Fixtures) -> DataFrame:
    """CP10, EN1, EN2, JN1: the flagship."""
    return typed_events(f.ct, f.events_table, ORIGIN, PROCESSED_AT, f.lsn_time)


@query(_FLAT.format(events="ev_shared_seq"))
def flat_events(f: Fixtures) -> DataFrame:
    """EN1, PF9: changes that only the command id separates."""
    return typed_events(f.ct_shared_seq, f.events_table, ORIGIN, PROCESSED_AT, f.lsn_time)


@query(f"SELECT ct.start_lsn, seqval, operation, {_TS_MS} AS source_ts_ms FROM ct LEFT JOIN lsn_time t ON t.start_lsn = ct.start_lsn")
def source_ts(f: Fixtures) -> DataFrame:
    """EN2."""
    rows = with_commit_time(f.ct.select("start_lsn", "seqval", "operation"), f.lsn_time)
    stamp = envelope.source_ts_ms(rows, ORIGIN, PROCESSED_AT)
    return rows.select("start_lsn", "seqval", "operation", stamp.alias("source_ts_ms"))


def _colon(name: str) -> str:
    return f"substr({name}, 1, 8) || ':' || substr({name}, 9, 8) || ':' || substr({name}, 17, 4)"


@query(
    "SELECT e.start_lsn, e.seqval, e.serial, e.__op AS op, b.id AS before_id, b.value AS before_value, "
    "CASE WHEN e.__op <> 'd' THEN e.id END AS after_id, CASE WHEN e.__op <> 'd' THEN e.value END AS after_value, "
    "'server1' AS source_name, 'sales' AS source_db, 'dbo' AS source_schema, 'events' AS source_table, "
    f"{_colon('e.seqval')} AS change_lsn, {_colon('e.start_lsn')} AS commit_lsn, CAST(e.serial AS VARCHAR) AS event_serial_no, "
    "epoch_us(commit_time + INTERVAL 5 HOUR) // 1000 AS source_ts_ms, epoch_us(commit_time + INTERVAL 5 HOUR) AS source_ts_us, "
    "epoch_us(commit_time + INTERVAL 5 HOUR) * 1000 AS source_ts_ns, 1767225600000 AS ts_ms "
    "FROM ev e LEFT JOIN lsn_time t ON t.start_lsn = e.start_lsn "
    "LEFT JOIN kinds b ON b.start_lsn = e.start_lsn AND b.command_key = e.command_key AND b.seqval = e.seqval AND "
    "(CASE WHEN e.__op = 'u' THEN b.serial = e.serial - 1 WHEN e.__op = 'd' THEN b.serial = e.serial ELSE false END)"
)
def full_envelope(f: Fixtures) -> DataFrame:
    """EN4."""
    found = changes.events(changes.classify(f.ct, ("id",), previous_image=True))
    full = envelope.full_envelopes(with_commit_time(found, f.lsn_time), f.events_table, ORIGIN, PROCESSED_AT)
    return full.select(
        "start_lsn",
        "seqval",
        "serial",
        "op",
        F.col("before.id").alias("before_id"),
        F.col("before.value").alias("before_value"),
        F.col("after.id").alias("after_id"),
        F.col("after.value").alias("after_value"),
        F.col("source.name").alias("source_name"),
        F.col("source.db").alias("source_db"),
        F.col("source.schema").alias("source_schema"),
        F.col("source.table").alias("source_table"),
        "source.change_lsn",
        "source.commit_lsn",
        "source.event_serial_no",
        F.col("source.ts_ms").alias("source_ts_ms"),
        F.col("source.ts_us").alias("source_ts_us"),
        F.col("source.ts_ns").alias("source_ts_ns"),
        "ts_ms",
    )


_SNAPSHOT = (
    "SELECT 'dbo_customer' AS capture_instance, '00000001000000010001' AS start_lsn, c_custkey, c_name, c_nationkey, "
    "c_acctbal, c_mktsegment, 'r' AS __op, 'customer' AS __table, 'false' AS __deleted, 1767225600000 AS __source_ts_ms FROM customer"
)


@query(_SNAPSHOT)
def snapshot_events(f: Fixtures) -> DataFrame:
    """EN8."""
    return snapshot.snapshot_events(f.table("customer"), f.customer_table, PROCESSED_AT, "00000001000000010001")


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS serial FROM customer")
def snapshot_serial(f: Fixtures) -> DataFrame:
    """WN5."""
    return snapshot.snapshot_serials(f.table("customer"), f.customer_table).select("c_custkey", "c_name", "serial")


@query(
    "SELECT 'dbo_events' AS capture_instance, '00000001000000010001' AS start_lsn, event_id AS id, event_type AS name, value, "
    "'r' AS __op, 'events' AS __table, 'false' AS __deleted, 1767225600000 AS __source_ts_ms FROM events UNION ALL "
    "SELECT capture_instance, start_lsn, id, name, value, __op, __table, __deleted, __source_ts_ms FROM ("
    + _FLAT.format(events="ev")
    + ") c"
)
def snapshot_plus_changes(f: Fixtures) -> DataFrame:
    """ST2."""
    current = f.table("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("name"), "value")
    first = snapshot.snapshot_events(current, f.events_table, PROCESSED_AT, "00000001000000010001")
    return snapshot.snapshot_plus_changes(first, change_events(f))


# --- order and windows -------------------------------------------------------------------------------------


@query("SELECT start_lsn, command_id, seqval, operation, id FROM ct ORDER BY start_lsn, command_id, seqval, operation")
def strict_order(f: Fixtures) -> DataFrame:
    """SO1, X3."""
    return filters.strict_order(f.ct).select("start_lsn", "command_id", "seqval", "operation", "id")


@query("SELECT start_lsn, seqval, operation, id FROM ct_no_command ORDER BY start_lsn, seqval, operation")
def best_effort_order(f: Fixtures) -> DataFrame:
    """SO2."""
    return filters.best_effort_order(f.ct_shared_seq.drop("command_id")).select("start_lsn", "seqval", "operation", "id")


@query(
    "SELECT max(start_lsn) AS window_end_lsn FROM (SELECT DISTINCT start_lsn FROM ct "
    f"WHERE start_lsn >= '{BOOKMARK}' ORDER BY start_lsn LIMIT 300) w"
)
def next_window_end(f: Fixtures) -> DataFrame:
    """AG3, SO4."""
    return windows.next_window_end(f.ct, BOOKMARK, lsn.HIGHEST, WINDOW)


@query("SELECT * FROM windowed")
def window_plan(f: Fixtures) -> DataFrame:
    """WN1, AG8."""
    return windows.window_plan(f.both, WINDOW)


@query("SELECT * FROM windowed")
def window_plan_continued(f: Fixtures) -> DataFrame:
    """WN1 over two runs: the second numbers only the positions above those of the first."""
    ledger = windows.WindowLedger(f.spark, new_path(f.spark, "windows"), WINDOW)
    ledger.extend(f.both.where(F.col("start_lsn") <= BOOKMARK), 0)
    ledger.extend(f.both, 1)
    return ledger.plan()


def _bounds(f: Fixtures, plan: DataFrame | None = None) -> DataFrame:
    starts = resume.low_watermarks(f.both).withColumnRenamed("min_lsn", "resume_lsn")
    return windows.window_bounds(windows.window_plan(f.both, WINDOW) if plan is None else plan, starts)


@query("SELECT capture_instance, window_id, from_lsn, to_lsn, transactions FROM full_bounds")
def window_bounds(f: Fixtures) -> DataFrame:
    """WN2."""
    return _bounds(f)


_ALL_EVENTS = (
    "SELECT 'dbo_events' AS capture_instance, start_lsn FROM ev UNION ALL "
    "SELECT 'dbo_orders', start_lsn FROM ct_orders WHERE operation IN (2, 4)"
)
_WINDOW_COUNTS = (
    f"SELECT w.capture_instance, window_id, count(*) AS records FROM ({_ALL_EVENTS}) e "
    "JOIN windowed w ON w.start_lsn = e.start_lsn AND w.capture_instance = e.capture_instance GROUP BY ALL"
)


def _event_counts(f: Fixtures) -> DataFrame:
    """Events of every transaction of both tables, counted without pairing them."""
    counts = [changes.event_counts(s.changes, F.struct(*s.table.primary_key), s.table.has_command_id) for s in f.sources]
    return counts[0].unionByName(counts[1])


@query(_WINDOW_COUNTS)
def window_counts(f: Fixtures) -> DataFrame:
    """AG4, JN8."""
    return windows.window_totals(_event_counts(f), windows.window_plan(f.both, WINDOW))


@query(f"SELECT count(*) AS files_written, CAST(sum(records) AS BIGINT) AS total_records FROM ({_WINDOW_COUNTS}) c")
def run_totals(f: Fixtures) -> DataFrame:
    """AG5."""
    return windows.run_totals(window_counts(f))


# --- resume ------------------------------------------------------------------------------------------------


def _resume(f: Fixtures, marks: DataFrame | None = None) -> DataFrame:
    ceiling = resume.freeze_ceiling(f.both)
    return resume.resume_plan(resume.low_watermarks(f.both), f.bookmarks if marks is None else marks, ceiling)


@query(
    "SELECT capture_instance, min_lsn, bookmark_lsn, resume_lsn, has_gap, resume_lsn > max_lsn AS is_done, "
    "take_snapshot, next_lsn FROM resume"
)
def resume_plan(f: Fixtures) -> DataFrame:
    """RS1, RS3, RS5, JN4."""
    return _resume(f)


def _old_marks(f: Fixtures) -> DataFrame:
    """A bookmark for every table: one before its oldest change, one inside its range."""
    low = F.when(F.col("capture_instance") == "dbo_events", F.lit("00000026000000010001")).otherwise(F.col("max_lsn"))
    return reports.capture_catalog(f.both).select("capture_instance", low.alias("lsn"))


@query(
    "SELECT capture_instance, '00000026000000010001' AS bookmark_lsn, min_lsn FROM catalog "
    "WHERE capture_instance = 'dbo_events' AND '00000026000000010001' < min_lsn"
)
def lsn_gaps(f: Fixtures) -> DataFrame:
    """RS2."""
    return resume.lsn_gaps(_resume(f, _old_marks(f)))


@query(
    "SELECT capture_instance, m.mode, CASE m.mode WHEN 'always' THEN true WHEN 'never' THEN false ELSE take_snapshot END "
    "AS take_snapshot FROM resume CROSS JOIN (SELECT 'initial' AS mode UNION ALL SELECT 'always' UNION ALL SELECT 'never') m"
)
def snapshot_decision(f: Fixtures) -> DataFrame:
    """RS4."""
    ceiling = resume.freeze_ceiling(f.both)
    marks = stage(resume.low_watermarks(f.both), "low-watermarks")
    plans = [
        resume.resume_plan(marks, f.bookmarks, ceiling, mode).select(
            "capture_instance", F.lit(mode).alias("mode"), "take_snapshot"
        )
        for mode in resume.SNAPSHOT_MODES
    ]
    return plans[0].unionByName(plans[1]).unionByName(plans[2])


@query(
    "SELECT capture_instance, next_lsn AS lsn FROM resume UNION ALL "
    "SELECT capture_instance, lsn FROM bookmarks WHERE capture_instance NOT IN (SELECT capture_instance FROM resume)"
)
def bookmark_next(f: Fixtures) -> DataFrame:
    """RS6, JN5."""
    return resume.merge_bookmarks(f.bookmarks, resume.next_bookmarks(_resume(f)))


@query(
    "SELECT ct.* FROM ct JOIN bookmarks b ON b.capture_instance = ct.capture_instance WHERE start_lsn <= lsn"
)
def late_rows(f: Fixtures) -> DataFrame:
    """SS5."""
    return resume.late_rows(f.ct, f.bookmarks).select(*f.ct.columns)


# --- reports -----------------------------------------------------------------------------------------------


def _half_ready(f: Fixtures) -> DataFrame:
    """Both tables, one of them without command ids."""
    orders = f.both.where("capture_instance = 'dbo_orders'").withColumn("command_id", F.lit(None).cast("int"))
    return f.both.where("capture_instance = 'dbo_events'").unionByName(orders)


@query(
    "SELECT capture_instance, capture_instance = 'dbo_events' AS has_command_id, count(*) AS change_rows "
    "FROM all_ct GROUP BY capture_instance"
)
def ordering_report(f: Fixtures) -> DataFrame:
    """MD1, AG7, SC9."""
    return reports.ordering_report(reports.capture_catalog(_half_ready(f)))


@query(
    "SELECT 'all_ready' AS case_name, CASE WHEN bool_and(rows_with_command_id > 0) THEN 'change_table_command_id' "
    "ELSE 'change_table_best_effort' END AS mode FROM catalog UNION ALL "
    "SELECT 'half_ready', CASE WHEN bool_and(rows_with_command_id > 0 AND capture_instance <> 'dbo_orders') "
    "THEN 'change_table_command_id' ELSE 'change_table_best_effort' END FROM catalog"
)
def extractor_mode(f: Fixtures) -> DataFrame:
    """AG6."""
    modes = [
        reports.extractor_mode(reports.ordering_report(reports.capture_catalog(rows))).select(
            F.lit(name).alias("case_name"), "mode"
        )
        for name, rows in (("all_ready", f.both), ("half_ready", _half_ready(f)))
    ]
    return modes[0].unionByName(modes[1])


# Runs of 300 transactions; every third one failed. Failed runs have no manifest.
_RUNS = (
    "SELECT capture_instance AS source, capture_instance || '_' || window_id AS run_id, "
    "CASE WHEN window_id % 3 = 2 THEN 'failed' ELSE 'success' END AS status, "
    "CAST(CASE WHEN window_id % 3 = 2 THEN 0 ELSE 1 END AS BIGINT) AS files_written, "
    "CASE WHEN window_id % 3 = 2 THEN 0 ELSE transactions END AS total_records FROM bounds"
)


def _runs(plan: DataFrame) -> DataFrame:
    failed = F.col("window_id") % 3 == 2
    sizes = plan.groupBy("capture_instance", "window_id").agg(F.count(F.lit(1)).alias("transactions"))
    return sizes.select(
        F.col("capture_instance").alias("source"),
        F.concat_ws("_", "capture_instance", "window_id").alias("run_id"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, 0).otherwise(1).cast("bigint").alias("files_written"),
        F.when(failed, 0).otherwise(F.col("transactions")).alias("total_records"),
    )


@query(
    "SELECT source, count(*) AS runs, count(*) FILTER (WHERE status = 'failed') AS failed_runs, "
    "CAST(sum(files_written) AS BIGINT) AS files_written, CAST(sum(total_records) AS BIGINT) AS total_records, "
    f"CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed' ELSE 'success' END AS status FROM ({_RUNS}) r GROUP BY source"
)
def source_report(f: Fixtures) -> DataFrame:
    """MS2."""
    return reports.source_report(_runs(windows.window_plan(f.both, WINDOW)))


@query(
    "SELECT w.capture_instance || '_' || window_id AS run_id, b.capture_instance, b.start_lsn, seqval, operation "
    "FROM all_ct b JOIN windowed w ON w.capture_instance = b.capture_instance AND w.start_lsn = b.start_lsn "
    f"WHERE w.capture_instance || '_' || window_id IN (SELECT run_id FROM ({_RUNS}) r WHERE status = 'success')"
)
def complete_runs(f: Fixtures) -> DataFrame:
    """SK8."""
    plan = stage(windows.window_plan(f.both, WINDOW), "window-plan")
    output = f.both.join(plan, ["capture_instance", "start_lsn"]).select(
        F.concat_ws("_", "capture_instance", "window_id").alias("run_id"),
        "capture_instance",
        "start_lsn",
        "seqval",
        "operation",
    )
    return json_lines.complete_runs(output, _runs(plan).where("status = 'success'"))


# --- scalar functions over whole change tables -------------------------------------------------------------


@query("SELECT start_lsn, seqval, operation, '0x' || seqval AS seqval_text FROM ct")
def lsn_hex(f: Fixtures) -> DataFrame:
    """LN1."""
    binary = F.unhex("seqval")
    return f.ct.select("start_lsn", "seqval", "operation", lsn.to_text(lsn.from_binary(binary)).alias("seqval_text"))


@query("SELECT start_lsn, seqval, operation, upper(seqval) AS parsed, CAST(10 AS INT) AS byte_count FROM ct")
def lsn_parse(f: Fixtures) -> DataFrame:
    """LN2: lower-case text with the prefix is read back."""
    text = F.concat(F.lit("0x"), F.lower("seqval"))
    return f.ct.select(
        "start_lsn", "seqval", "operation", lsn.parse(text).alias("parsed"), F.length(lsn.to_binary(text)).alias("byte_count")
    )


@query(f"SELECT start_lsn, seqval, operation, {_colon('seqval')} AS seqval_text FROM ct")
def lsn_debezium(f: Fixtures) -> DataFrame:
    """LN3."""
    return f.ct.select("start_lsn", "seqval", "operation", lsn.to_colon_text(F.col("seqval")).alias("seqval_text"))


@query(
    "SELECT start_lsn, seqval, operation, CASE WHEN CAST('0x' || seqval AS HUGEINT) < CAST('0x00000027000000C80003' AS HUGEINT) THEN -1 "
    "WHEN CAST('0x' || seqval AS HUGEINT) > CAST('0x00000027000000C80003' AS HUGEINT) THEN 1 ELSE 0 END AS side FROM ct"
)
def lsn_compare(f: Fixtures) -> DataFrame:
    """LN4."""
    side = lsn.compare(F.col("seqval"), F.lit("00000027000000C80003"))
    return f.ct.select("start_lsn", "seqval", "operation", side.alias("side"))


@query(
    "SELECT start_lsn, seqval, operation, printf('%020X', CAST('0x' || seqval AS HUGEINT) + 1) AS following, "
    "printf('%020X', CAST('0x' || substr(seqval, 1, 16) || 'FFFF' AS HUGEINT) + 1) AS following_slot_edge, "
    "printf('%020X', CAST('0x' || substr(seqval, 1, 8) || 'FFFFFFFFFFFF' AS HUGEINT) + 1) AS following_block_edge FROM ct"
)
def lsn_next(f: Fixtures) -> DataFrame:
    """LN5: also at both carry edges."""
    seqval = F.col("seqval")
    return f.ct.select(
        "start_lsn",
        "seqval",
        "operation",
        lsn.following(seqval).alias("following"),
        lsn.following(F.concat(F.substring(seqval, 1, 16), F.lit("FFFF"))).alias("following_slot_edge"),
        lsn.following(F.concat(F.substring(seqval, 1, 8), F.lit("F" * 12))).alias("following_block_edge"),
    )


@query(
    "SELECT event_id, epoch_us(ts) // 1000 AS utc_ms, epoch_us(ts + INTERVAL 5 HOUR) AS new_york_us, "
    "epoch_us(ts - INTERVAL 330 MINUTE) * 1000 AS kolkata_ns FROM events"
)
def epoch_ms(f: Fixtures) -> DataFrame:
    """DT1."""
    ts = F.col("ts")
    return f.table("events").select(
        "event_id",
        times.epoch_ms(ts, "UTC").alias("utc_ms"),
        times.epoch_us(ts, "America/New_York").alias("new_york_us"),
        times.epoch_ns(ts, "Asia/Kolkata").alias("kolkata_ns"),
    )


@query(
    "SELECT event_id AS id, CAST(CAST(value AS DECIMAL(18,6)) AS VARCHAR) AS amount, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_part('microseconds', ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS moment, "
    "strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS second, strftime(ts, '%Y-%m-%d') AS day, "
    "to_base64(encode(props)) AS payload, lower(upper(event_type)) AS guid, "
    "CASE WHEN event_id % 2 = 0 THEN value > 100 END AS flag FROM events"
)
def json_values(f: Fixtures) -> DataFrame:
    """JS1: one captured column of every kind, read back from the JSON line."""
    rows = f.table("events").select(
        F.col("event_id").alias("id"),
        F.col("value").cast("decimal(18,6)").alias("amount"),
        F.col("ts").alias("moment"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("second"),
        F.col("ts").cast("date").alias("day"),
        F.col("props").cast("binary").alias("payload"),
        F.upper("event_type").alias("guid"),
        F.when(F.col("event_id") % 2 == 0, F.col("value") > 100).alias("flag"),
    )
    shown = CapturedTable.of("dbo_values", rows, ("id",))
    columns = tuple(ColumnInfo("guid", "uniqueidentifier") if c.name == "guid" else c for c in shown.columns)
    table = CapturedTable("dbo_values", "dbo", "values", columns, ("id",))
    line = json_line(json_columns(rows, table))
    schema = "id bigint, amount string, moment string, second string, day string, payload string, guid string, flag boolean"
    return rows.select(F.from_json(line, schema).alias("j")).select("j.*")


# --- sinks -------------------------------------------------------------------------------------------------


@query(
    "SELECT capture_instance, window_id, 'landing/' || CASE capture_instance WHEN 'dbo_events' THEN 'server1.sales.dbo.events' "
    "ELSE 'server1.sales.dbo.orders' END || '/year=2026/month=01/day=02/0x' || from_lsn || '_0x' || to_lsn || "
    f"'_{RUN_ID}.json.gz' AS path FROM full_bounds"
)
def output_path(f: Fixtures) -> DataFrame:
    """SK4, ST3, ST4."""
    table = F.substring_index("capture_instance", "_", -1)
    topic = paths.topic_folder(F.lit(ORIGIN.topic_prefix), F.lit(ORIGIN.database), F.lit("dbo"), table)
    started = F.lit(f"{STARTED_AT:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz")
    file = F.concat(paths.window_label(F.col("from_lsn"), F.col("to_lsn"), F.lit(RUN_ID)), F.lit(".json.gz"))
    path = paths.join_path(F.lit("/landing/"), topic, *paths.date_folders(started), F.lit(""), file)
    return _bounds(f).select("capture_instance", "window_id", path.alias("path"))


@query(f"SELECT capture_instance, window_id, '0x' || from_lsn || '_0x' || to_lsn || '_{RUN_ID}' AS label FROM full_bounds")
def window_label(f: Fixtures) -> DataFrame:
    """SK5."""
    label = paths.window_label(F.col("from_lsn"), F.col("to_lsn"), F.lit(RUN_ID))
    return _bounds(f).select("capture_instance", "window_id", label.alias("label"))


def _written_files(f: Fixtures) -> DataFrame:
    """Windows of both tables with the number of their events, as manifest entries."""
    plan = stage(windows.window_plan(f.both, WINDOW), "window-plan")
    counts = windows.window_totals(_event_counts(f), plan)
    return counts.join(_bounds(f, plan), ["capture_instance", "window_id"]).select(
        "capture_instance",
        F.lit("dbo").alias("source_schema"),
        F.substring("capture_instance", 5, 20).alias("source_table"),
        lsn.to_text(F.col("from_lsn")).alias("from_lsn"),
        lsn.to_text(F.col("to_lsn")).alias("to_lsn"),
        F.col("records").alias("records_written"),
        paths.window_label(F.col("from_lsn"), F.col("to_lsn"), F.lit(RUN_ID)).alias("path"),
    )


_FILES = (
    "SELECT b.capture_instance, 'dbo' AS source_schema, substr(b.capture_instance, 5) AS source_table, '0x' || from_lsn AS from_lsn, "
    f"'0x' || to_lsn AS to_lsn, c.records AS records_written, '0x' || from_lsn || '_0x' || to_lsn || '_{RUN_ID}' AS path "
    f"FROM full_bounds b JOIN ({_WINDOW_COUNTS}) c ON c.capture_instance = b.capture_instance AND c.window_id = b.window_id"
)


@query(_FILES)
def manifest_files(f: Fixtures) -> DataFrame:
    """SK6: one row per written window."""
    return _written_files(f)


@query(
    f"SELECT '{RUN_ID}' AS run_id, 'sales' AS database_name, CAST(sum(records_written) AS BIGINT) AS total_records, "
    "count(*) AS files_written, (SELECT string_agg(capture_instance || '=0x' || lsn, ',' ORDER BY capture_instance) FROM bookmarks) AS bookmarks, "
    f"string_agg(path || '=' || records_written, ',' ORDER BY path) AS files FROM ({_FILES}) f",
    name="manifest",
)
def manifest_run(f: Fixtures) -> DataFrame:
    """SK6, MD4: the run row as it is stored, and the list of files its folder holds."""
    path = new_path(f.spark, "output")
    row = manifest.write_manifest(_written_files(f), f.bookmarks, path, RUN_ID, database_name=ORIGIN.database)
    marks = F.transform(F.map_entries("committed_bookmarks"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    one = F.concat_ws("=", "path", F.col("records_written").cast("string"))
    files = manifest.read_files(f.spark, path).groupBy("run_id").agg(F.array_sort(F.collect_list(one)).alias("files"))
    return row.join(files, "run_id").select(
        "run_id",
        "database_name",
        "total_records",
        "files_written",
        F.array_join(F.array_sort(marks), ",").alias("bookmarks"),
        F.array_join("files", ",").alias("files"),
    )


def _write_events(f: Fixtures, path: str, tombstones: bool) -> None:
    """Events of both tables as text, in folders by topic and window.

    The counts of the window plan say which task writes a transaction, so lines go to their files as they are made. Only windows
    in which one transaction is more than a file are staged, for ranges that sample them.
    """
    facts = table_facts(f.spark, [s.table for s in f.sources], ORIGIN)
    sized = windows.sized_plan(f.both, WINDOW)
    plan, parts, any_large = windows.file_parts(sized, RunOptions.rows_per_file, f.spark.sparkContext.defaultParallelism)
    events = (
        paired_lines(f.sources)
        .join(stage(plan.join(commit_times(f.lsn_time), "start_lsn", "left"), "window-plan"), ["capture_instance", "start_lsn"])
        .join(F.broadcast(facts), "capture_instance")
        .withColumn("window", F.col("window_id").cast("string"))
    )
    lines = event_lines(events, ORIGIN, PROCESSED_AT, tombstones, key_schemas=False)
    if any_large:
        lines = stage(lines, "lines")
        json_lines.write_lines(lines.where("large"), path, RUN_ID, ["topic", "window"])
    json_lines.write_lines(lines.where("NOT large"), path, RUN_ID, ["topic", "window"], parts=parts)


_ORDER_EVENTS = (
    "SELECT start_lsn, id, CASE WHEN operation = 4 THEN 'u' ELSE 'c' END AS __op, status, totalprice "
    "FROM ct_orders WHERE operation IN (2, 4)"
)
_JSON_EVENTS = (
    "SELECT 'server1.sales.dbo.events' AS topic, CAST(w.window_id AS VARCHAR) AS \"window\", id, name, value, CAST(NULL AS VARCHAR) AS status, "
    f"CAST(NULL AS DOUBLE) AS totalprice, __op, 'events' AS __table, CASE WHEN __op = 'd' THEN 'true' ELSE 'false' END AS __deleted, {_TS_MS} AS __source_ts_ms "
    "FROM ev LEFT JOIN lsn_time t ON t.start_lsn = ev.start_lsn "
    "JOIN windowed w ON w.capture_instance = 'dbo_events' AND w.start_lsn = ev.start_lsn UNION ALL "
    "SELECT 'server1.sales.dbo.orders', CAST(w.window_id AS VARCHAR), id, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), status, totalprice, __op, 'orders', "
    "CASE WHEN __op = 'd' THEN 'true' ELSE 'false' END, 1767225600000 "
    f"FROM ({_ORDER_EVENTS}) o JOIN windowed w ON w.capture_instance = 'dbo_orders' AND w.start_lsn = o.start_lsn"
)
_JSON_SCHEMA = (
    "id bigint, name string, value double, status string, totalprice double, __op string, __table string, "
    "__deleted string, __source_ts_ms bigint"
)


@query(_JSON_EVENTS)
def events_json(f: Fixtures) -> DataFrame:
    """SK1, SK2, JS2: written as compressed JSON lines, then read back from their folders."""
    path = new_path(f.spark, "output")
    _write_events(f, path, tombstones=False)
    found = json_lines.read_all_lines(f.spark, path)
    return found.select("topic", "window", F.from_json("value", _JSON_SCHEMA).alias("e")).select("topic", "window", "e.*")


@query(
    "SELECT topic, \"window\", 'event' AS shape, count(*) AS lines, count(DISTINCT id) AS ids FROM ("
    + _JSON_EVENTS
    + ") j GROUP BY topic, \"window\" UNION ALL SELECT topic, \"window\", 'tombstone', count(*), count(DISTINCT id) FROM ("
    + _JSON_EVENTS
    + ") j WHERE __op = 'd' GROUP BY topic, \"window\""
)
def tombstones_json(f: Fixtures) -> DataFrame:
    """SK1, EN3: events and tombstones share their files."""
    path = new_path(f.spark, "output")
    _write_events(f, path, tombstones=True)
    parsed = F.from_json("value", "id bigint, key struct<id:bigint>")
    found = json_lines.read_all_lines(f.spark, path).select("topic", "window", parsed.alias("e"))
    shape = F.when(F.col("e.key").isNull(), "event").otherwise("tombstone")
    return found.groupBy("topic", "window", shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct(F.coalesce("e.id", "e.key.id")).alias("ids")
    )


@query(
    "SELECT 'server1.sales.dbo.customer' AS topic, 'snapshot' AS \"window\", c_custkey, c_name, c_nationkey, c_acctbal, "
    "c_mktsegment, __op, __table, __deleted, __source_ts_ms FROM (" + _SNAPSHOT + ") s"
)
def snapshot_json(f: Fixtures) -> DataFrame:
    """SK3."""
    path = new_path(f.spark, "output")
    rows = snapshot_events(f)
    fields = [F.col(c) for c in ("__op", "__table", "__deleted", "__source_ts_ms")]
    text = json_line([*json_columns(rows, f.customer_table), *fields])
    lines = rows.select(
        F.lit(ORIGIN.topic(f.customer_table)).alias("topic"), F.lit("snapshot").alias("window"), text.alias("value")
    )
    json_lines.write_lines(lines, path, RUN_ID, ["topic", "window"], ordered=False)
    schema = (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string, __op string, "
        "__table string, __deleted string, __source_ts_ms bigint"
    )
    found = json_lines.read_all_lines(f.spark, path)
    return found.select("topic", "window", F.from_json("value", schema).alias("e")).select("topic", "window", "e.*")


# --- many tables -------------------------------------------------------------------------------------------


@query(
    "SELECT capture_instance, start_lsn, seqval, serial, CAST(id AS VARCHAR) AS id, __op FROM ev UNION ALL "
    "SELECT capture_instance, start_lsn, seqval, CAST(CASE WHEN operation = 4 THEN 2 ELSE 1 END AS BIGINT), CAST(id AS VARCHAR), "
    "CASE WHEN operation = 4 THEN 'u' ELSE 'c' END FROM ct_orders WHERE operation IN (2, 4)"
)
def multi_instance_events(f: Fixtures) -> DataFrame:
    """MS1."""
    return paired_lines(f.sources).select(
        "capture_instance",
        "start_lsn",
        "seqval",
        "serial",
        F.get_json_object("key", "$.id").alias("id"),
        "__op",
    )


@query(
    "SELECT start_lsn, seqval, serial, __op, CAST(id AS VARCHAR) AS id, capture_instance FROM ev UNION ALL "
    "SELECT start_lsn, seqval, CAST(CASE WHEN operation = 4 THEN 2 ELSE 1 END AS BIGINT), "
    "CASE WHEN operation = 4 THEN 'u' ELSE 'c' END, CAST(id AS VARCHAR), capture_instance FROM ct_orders WHERE operation IN (2, 4)"
)
def landed_events(f: Fixtures) -> DataFrame:
    """MS1: the events of all tables of a landed log, in one plan of fixed size."""
    path = _landed_log(f)
    log = landing.open_log(f.spark, path, [s.table for s in f.sources])
    return paired_landed(log.rows).select(
        "start_lsn", "seqval", "serial", "__op", F.get_json_object("key", "$.id").alias("id"), "capture_instance"
    )


@query(
    "SELECT capture_instance, start_lsn, seqval, operation, CAST(id AS VARCHAR) AS id FROM ct WHERE start_lsn BETWEEN "
    f"'{BOOKMARK}' AND '00000028FFFFFFFFFFFF' UNION ALL SELECT capture_instance, start_lsn, seqval, operation, CAST(id AS VARCHAR) "
    f"FROM ct_orders WHERE start_lsn BETWEEN '{BOOKMARK}' AND '00000028FFFFFFFFFFFF'"
)
def landed_range(f: Fixtures) -> DataFrame:
    """SC1, PF2: a range of a landed log, from the files that the position index names."""
    rows = landing.read_range(f.spark, _landed_log(f), BOOKMARK, "00000028FFFFFFFFFFFF")
    return rows.select("capture_instance", "start_lsn", "seqval", "operation", F.get_json_object("key", "$.id").alias("id"))


@query("SELECT capture_instance, min_lsn, max_lsn, change_rows, rows_with_command_id FROM catalog")
def landed_catalog(f: Fixtures) -> DataFrame:
    """SC3, SC8, SC9: the catalogue of a landed log, from its index alone."""
    return landing.landed_catalog(f.spark, _landed_log(f))


def _landed_log(f: Fixtures) -> str:
    """Both tables in one log, landed in two batches."""
    path = new_path(f.spark, "landed-log")
    for batch, source in enumerate(f.sources):
        landing.land([source], path, str(batch))
    return path


# --- full envelopes as output ------------------------------------------------------------------------------


_FULL_SCHEMA = (
    "before struct<id:bigint,value:double,status:string>, after struct<id:bigint,value:double,status:string>, "
    "source struct<version:string,connector:string,name:string,ts_ms:bigint,ts_us:bigint,ts_ns:bigint,snapshot:boolean,db:string,"
    "schema:string,table:string,change_lsn:string,commit_lsn:string,event_serial_no:string>, op string, ts_ms bigint, "
    "ts_us bigint, ts_ns bigint"
)


def _full_columns(rows: DataFrame, *more: str) -> DataFrame:
    """The fields of full envelopes that were read back, side by side."""
    return rows.select(F.from_json("value", _FULL_SCHEMA).alias("e"), *more).select(
        *more,
        "e.op",
        F.col("e.before.id").alias("before_id"),
        F.col("e.before.value").alias("before_value"),
        F.col("e.before.status").alias("before_status"),
        F.col("e.after.id").alias("after_id"),
        F.col("e.after.value").alias("after_value"),
        F.col("e.after.status").alias("after_status"),
        *[F.col(f"e.source.{n}").alias(f"source_{n}") for n in ("version", "connector", "name", "ts_ms", "ts_us", "ts_ns")],
        *[F.col(f"e.source.{n}").alias(f"source_{n}") for n in ("snapshot", "db", "schema", "table")],
        *[F.col(f"e.source.{n}").alias(n) for n in ("change_lsn", "commit_lsn", "event_serial_no")],
        *[F.col(f"e.{n}").alias(n) for n in ("ts_ms", "ts_us", "ts_ns")],
    )


def _full_sql(source: str, table: str) -> str:
    """Columns of a full envelope beside its images, for rows with seqval, start_lsn, serial and commit_time."""
    micros = "epoch_us(commit_time + INTERVAL 5 HOUR)" if source == "changes" else "CAST(NULL AS BIGINT)"
    return (
        f"'3.0.0.Final-simulated' AS source_version, 'sqlserver' AS source_connector, 'server1' AS source_name, "
        f"{micros} // 1000 AS source_ts_ms, {micros} AS source_ts_us, {micros} * 1000 AS source_ts_ns, false AS source_snapshot, "
        f"'sales' AS source_db, 'dbo' AS source_schema, '{table}' AS source_table, {_colon('seqval')} AS change_lsn, "
        f"{_colon('start_lsn')} AS commit_lsn, CAST(serial AS VARCHAR) AS event_serial_no, 1767225600000 AS ts_ms, "
        "1767225600000000 AS ts_us, 1767225600000000000 AS ts_ns"
    )


_FULL_EVENTS = (
    "SELECT e.start_lsn, e.seqval, e.serial, commit_time, e.__op AS op, b.id AS before_id, b.value AS before_value, "
    "CASE WHEN e.__op <> 'd' THEN e.id END AS after_id, CASE WHEN e.__op <> 'd' THEN e.value END AS after_value "
    "FROM ev e LEFT JOIN lsn_time t ON t.start_lsn = e.start_lsn "
    "LEFT JOIN kinds b ON b.start_lsn = e.start_lsn AND b.command_key = e.command_key AND b.seqval = e.seqval AND "
    "(CASE WHEN e.__op = 'u' THEN b.serial = e.serial - 1 WHEN e.__op = 'd' THEN b.serial = e.serial ELSE false END)"
)
_FULL_ORDERS = (
    "SELECT o.start_lsn, o.seqval, CAST(CASE WHEN operation = 4 THEN 2 ELSE 1 END AS BIGINT) AS serial, commit_time, "
    "CASE WHEN operation = 4 THEN 'u' ELSE 'c' END AS op, CASE WHEN operation = 4 THEN id END AS before_id, "
    "CASE WHEN operation = 4 THEN 'O' END AS before_status, id AS after_id, status AS after_status "
    "FROM ct_orders o LEFT JOIN lsn_time t ON t.start_lsn = o.start_lsn WHERE operation IN (2, 4)"
)


@query(
    "SELECT 'server1.sales.dbo.events' AS topic, op, before_id, before_value, CAST(NULL AS VARCHAR) AS before_status, after_id, "
    f"after_value, CAST(NULL AS VARCHAR) AS after_status, {_full_sql('changes', 'events')} FROM ({_FULL_EVENTS}) e UNION ALL "
    "SELECT 'server1.sales.dbo.orders', op, before_id, CAST(NULL AS DOUBLE), before_status, after_id, CAST(NULL AS DOUBLE), "
    f"after_status, {_full_sql('changes', 'orders')} FROM ({_FULL_ORDERS}) o"
)
def full_envelope_json(f: Fixtures) -> DataFrame:
    """EN4, SK1: a run of both tables with whole envelopes, read back from its files."""
    path, log = new_path(f.spark, "output"), f.both.select("start_lsn").distinct().join(f.lsn_time, "start_lsn", "left")
    options = RunOptions(window_size=WINDOW, snapshot_mode="never", envelope="full")
    run_incremental(f.spark, f.sources, ORIGIN, path, new_path(f.spark, "marks"), log, started_at=PROCESSED_AT, run_id=RUN_ID, options=options)
    return _full_columns(json_lines.read_complete_lines(f.spark, path), "topic")


@query(
    "SELECT 'r' AS op, CAST(NULL AS BIGINT) AS before_id, CAST(NULL AS DOUBLE) AS before_value, CAST(NULL AS VARCHAR) AS before_status, "
    "event_id AS after_id, value AS after_value, CAST(NULL AS VARCHAR) AS after_status, "
    + _full_sql("snapshot", "events")
    + " FROM (SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS serial, "
    "'00000001000000010001' AS start_lsn, '00000001000000010001' AS seqval FROM events) s"
)
def snapshot_envelope(f: Fixtures) -> DataFrame:
    """EN4, EN8, WN5, SK3: a full read as whole envelopes, each with its serial."""
    current = f.table("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("name"), "value")
    lines = snapshot.snapshot_envelopes(current, f.events_table, ORIGIN, PROCESSED_AT, "00000001000000010001")
    path = new_path(f.spark, "output")
    topic = F.lit(ORIGIN.topic(f.events_table)).alias("topic")
    named = lines.select(topic, F.lit("snapshot").alias("window"), "value")
    json_lines.write_lines(named, path, RUN_ID, ["topic", "window"], ordered=False)
    return _full_columns(json_lines.read_all_lines(f.spark, path))


# --- streaming ---------------------------------------------------------------------------------------------


_STREAM = "SELECT capture_instance, start_lsn, command_key, seqval, serial, kind, id, name, value, __op FROM ev"
_STREAM_COLUMNS = ("serial", "kind", "id", "name", "value", "__op")


@query(_STREAM)
def stream_transactions(f: Fixtures) -> DataFrame:
    """SS1, SS2, SS6: several batches; transactions cut by a file border wait for the next batch."""
    path = new_path(f.spark, "stream")
    pair = lambda rows: changes.events(changes.classify(rows, ("id",)))
    sink, last_batch = _run_as_landed(
        f.ct, _quarter(f), lambda landed: incremental.TransactionSink(path, pair, incremental.before_newest)
    )
    sink.flush(f.spark, f.ct.schema, last_batch, lsn.HIGHEST)
    return sink.events(f.spark).select(*CHANGE_KEY, *_STREAM_COLUMNS)


def _quarter(f: Fixtures) -> Column:
    """Cuts the log into four parts of about the same size, each border inside a transaction."""
    events = f.table("events").approxQuantile("event_id", [0.25, 0.5, 0.75], 0.001)
    borders = [f"{39:08X}{int(n) // 5:08X}{4:04X}" for n in events]
    return sum(((F.col("seqval") >= border).cast("int") for border in borders), F.lit(0))


@query(_STREAM)
def stream_pairs(f: Fixtures) -> DataFrame:
    """SS3: the second half of every change arrives one file (ten days) after the first; all changes come out.

    The watermark stays eleven days behind the newest commit. Changes without a commit time and those that it has not passed
    when the stream ends are closed by the flush.
    """
    sink, schema, last_batch = _watermarked_stream(f, timedelta(days=11), strict=True)
    sink.flush(f.spark, schema, last_batch)
    return sink.events(f.spark).select(*CHANGE_KEY, *_STREAM_COLUMNS)


_ARRIVALS = (
    "SELECT ct.*, commit_time, least(coalesce(date_diff('day', (SELECT min(commit_time) FROM lsn_time), commit_time), 0) // 10, 2) "
    "+ CASE WHEN operation IN (2, 4) THEN 1 ELSE 0 END AS batch FROM ct LEFT JOIN lsn_time t ON t.start_lsn = ct.start_lsn"
)


@query(
    f"SELECT CAST(batch AS BIGINT) AS batch, capture_instance, start_lsn, seqval, operation, id FROM ({_ARRIVALS}) a WHERE commit_time <= "
    f"(SELECT max(b.commit_time) FROM ({_ARRIVALS}) b WHERE b.batch < a.batch) - INTERVAL 5 DAY"
)
def stream_late_rows(f: Fixtures) -> DataFrame:
    """SS5: with a watermark five days behind, the halves that come a file later are late; the stream tells them apart."""
    sink, _, _ = _watermarked_stream(f, timedelta(days=5), strict=False)
    batch = F.col("batch_id").cast("bigint").alias("batch")
    return sink.late_rows(f.spark).select(batch, "capture_instance", "start_lsn", "seqval", "operation", "id")


@query(_STREAM)
def stream_pairs_flushed(f: Fixtures) -> DataFrame:
    """SS3: the same with the state of Spark's own watermark, flushed from the landed table."""
    sink, last_batch = _paired_stream(f, f.ct.join(f.lsn_time, "start_lsn", "left"))
    sink.flush(last_batch)
    return f.spark.read.parquet(f"{sink.path}/events").select(*CHANGE_KEY, *_STREAM_COLUMNS)


def _watermarked_stream(f: Fixtures, delay: timedelta, strict: bool) -> tuple[watermark.WatermarkSink, StructType, int]:
    timed, arrival = _halves_apart(f.ct.join(f.lsn_time, "start_lsn", "left"))
    pair = lambda rows: changes.events(changes.classify(rows.drop("commit_time"), ("id",)), strict)
    path = new_path(f.spark, "stream")
    sink, last_batch = _run_as_landed(timed, arrival, lambda landed: watermark.WatermarkSink(path, pair, delay))
    return sink, timed.schema, last_batch


def _halves_apart(timed: DataFrame) -> tuple[DataFrame, Column]:
    """Change rows and the part they arrive in; the second half of every change comes one part (ten days) after the first."""
    timed = timed.withColumn("commit_time", F.col("commit_time").cast("timestamp"))
    first = timed.agg(F.min("commit_time")).first()[0]
    age = F.coalesce(F.datediff("commit_time", F.lit(first)), F.lit(0))
    return timed, F.least(F.floor(age / 10), F.lit(2)) + F.col("operation").isin(2, 4).cast("int")


def _run_as_landed(rows: DataFrame, part: Column, sink_of: Callable, transform: incremental.Transform = lambda stream: stream) -> tuple:
    """Land four parts one after the other and run the stream after each; returns the sink and the number of the last batch.

    A part is one batch and as many files as there were tasks with rows of it, so no task holds a whole part. The rows are
    worked out once, into one folder for each part. ``sink_of`` gets what has landed so far.
    """
    spark, schema = rows.sparkSession, rows.schema
    apart, landing, checkpoint = (new_path(spark, label) for label in ("arrivals", "landing", "stream-checkpoint"))
    rows.withColumn("__part", part.cast("int")).write.partitionBy("__part").parquet(apart)
    arrived = spark.read.schema(StructType([*schema.fields, StructField("__part", IntegerType())])).parquet(apart)
    for number in range(4):
        arrived.where(F.col("__part") == number).drop("__part").write.mode("append").parquet(landing)
        sink = sink_of(spark.read.schema(schema).parquet(landing))
        done = incremental.run_available(transform(incremental.read_change_stream(spark, landing, schema)), sink, checkpoint)
    return sink, done.lastProgress["batchId"]


def _paired_stream(f: Fixtures, timed: DataFrame) -> tuple[pairing.PairingSink, int]:
    timed, arrival = _halves_apart(timed)
    path = new_path(f.spark, "stream")
    return _run_as_landed(
        timed,
        arrival,
        lambda landed: pairing.PairingSink(path, landed, ("id",)),
        lambda stream: pairing.open_changes(stream, ("id",), "11 days"),
    )
