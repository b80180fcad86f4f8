"""One incremental run: plan, pair, write, publish, advance the bookmarks.

Order of effects: everything that may refuse a run (ceiling, low watermark, gap, ordering) is checked before
the first write; events are written under the run's own folder; the manifest makes them visible; bookmarks
move last.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tideline.errors import MissingRows, MissingTable
from tideline.functions.json_values import json_columns, json_line
from tideline.functions.lsn import to_text
from tideline.model import EVENT_FIELDS, CapturedTable, Origin
from tideline.operators import reports, resume, windows
from tideline.operators.skew import GROUP_ROWS_PER_TASK
from tideline.operators.envelope import check_reserved
from tideline.operators.snapshot import snapshot_envelopes, snapshot_events
from tideline.plans.events import commit_times, event_lines, paired_landed
from tideline.session import remove, stage, staging
from tideline.sinks import json_lines, manifest
from tideline.sources import bookmarks as bookmark_store
from tideline.sources.change_tables import ChangeSource, LandedLog, change_rows, landed_all, table_facts

_FILES = (
    "capture_instance string, source_schema string, source_table string, from_lsn string, to_lsn string, "
    "records_written bigint, path string"
)


@dataclass(frozen=True)
class RunOptions:
    """Defaults of a run. ``envelope`` is ``flat`` or ``full`` (EN4: before, after, source block and times)."""

    window_size: int = windows.WINDOW_SIZE
    snapshot_mode: str = "initial"
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    strict_pairs: bool = True
    strict_gaps: bool = True
    allow_best_effort: bool = False
    tombstones: bool = False
    key_schemas: bool = True
    compress: bool = True
    partition_by_date: bool = False
    commit_bookmarks: bool = True
    cleanup_failed: bool = True
    group_rows_per_task: int = GROUP_ROWS_PER_TASK
    rows_per_file: int = 500_000
    envelope: str = "flat"


@dataclass(frozen=True)
class RunResult:
    """MD4: what a run did."""

    run_id: str
    database: str
    max_lsn: str
    mode: str
    total_records: int
    files_written: int
    missing_instances: tuple[str, ...]
    bookmarks_committed: bool


def run_incremental(
    spark: SparkSession,
    sources: Sequence[ChangeSource] | LandedLog,
    origin: Origin,
    output_path: str,
    bookmark_path: str,
    lsn_time: DataFrame,
    ceiling: str | None = None,
    low_watermarks: DataFrame | None = None,
    started_at: datetime | None = None,
    run_id: str | None = None,
    options: RunOptions = RunOptions(),
) -> RunResult:
    """Extract everything between the bookmarks and one frozen ceiling.

    ``lsn_time`` (``start_lsn``, ``commit_time``) is the commit log; its highest position is the ceiling
    unless one is given, which makes a rerun repeatable. ``low_watermarks`` (``capture_instance``,
    ``min_lsn``) says what the source still retains. By default that is everything since the oldest position
    of the commit log; the oldest change of a table would not do, since a quiet table has none.

    Tables come as one ``ChangeSource`` each, or all together as a ``LandedLog``.
    """
    if options.envelope not in ("flat", "full"):
        raise ValueError(f"envelope must be flat or full, not {options.envelope}")
    started_at = started_at or datetime.now(timezone.utc)
    run_id = run_id or f"{started_at:%Y%m%dT%H%M%SZ}_{uuid.uuid4().hex[:12]}"
    landed = isinstance(sources, LandedLog)
    offered = list(sources.tables) if landed else [s.table for s in sources]
    missing = tuple(sorted({*options.include, *options.exclude} - {t.capture_instance for t in offered}))
    chosen = {
        t.capture_instance
        for t in offered
        if (not options.include or t.capture_instance in options.include) and t.capture_instance not in options.exclude
    }
    if not chosen:
        raise MissingTable("no captured table is left to read" + (": missing " + ", ".join(missing) if missing else ""))
    if landed:
        sources = _chosen_log(sources, chosen)
        tables = list(sources.tables)
    else:
        sources = [_with_real_command_id(s) for s in sources if s.table.capture_instance in chosen]
        tables = [s.table for s in sources]
    without_command = sorted(t.capture_instance for t in tables if not t.has_command_id)
    if without_command and not options.allow_best_effort:
        raise reports.OrderingNotReady("no command id in: " + ", ".join(without_command))
    mode = reports.STRICT_MODE if tables and not without_command else reports.BEST_EFFORT_MODE

    run = _Run(spark, sources, origin, output_path, run_id, started_at, lsn_time, options)
    with staging(spark):
        try:
            totals = run.execute(bookmark_path, ceiling, low_watermarks, mode)
        except Exception:
            if options.cleanup_failed:
                run.discard_unpublished()
            raise
    return RunResult(
        run_id,
        origin.database,
        totals["max_lsn"],
        mode,
        totals["total_records"],
        totals["files_written"],
        missing,
        options.commit_bookmarks,
    )


def pending(source: ChangeSource, resume_lsn: str, ceiling: str) -> ChangeSource:
    """SC1, PF4, X13: only what lies between the resume position and the ceiling; literals reach the scan."""
    return ChangeSource(source.table, change_rows(source, resume_lsn, ceiling), source.current)


def _chosen_log(log: LandedLog, chosen: set[str]) -> LandedLog:
    """The chosen tables of a log; MD1 as for single tables, by the counts of its catalogue (one row per table)."""
    tables = [t for t in log.tables if t.capture_instance in chosen]
    for table in tables:
        check_reserved(table)
    rows = log.rows
    if len(tables) < len(log.tables):
        rows = rows.where(F.col("capture_instance").isin(sorted(chosen)))
    catalog = log.catalog if log.catalog is not None else reports.capture_catalog(rows)
    bare = {r["capture_instance"] for r in catalog.where("change_rows > 0 AND rows_with_command_id = 0").collect()}
    tables = [replace(t, has_command_id=t.has_command_id and t.capture_instance not in bare) for t in tables]
    return replace(log, tables=tuple(tables), rows=rows)


def _with_real_command_id(source: ChangeSource) -> ChangeSource:
    """MD1: a table orders strictly only if its rows carry a command id, whatever its description says."""
    there = bool({"command_id", "__$command_id"} & set(source.changes.columns))
    table = replace(source.table, has_command_id=source.table.has_command_id and there)
    return replace(source, table=table)


class _Run:
    """The steps of one run over what its caller chose."""

    def __init__(self, spark, sources, origin, output_path, run_id, started_at, lsn_time, options) -> None:
        self.spark, self.sources, self.origin, self.options = spark, sources, origin, options
        self.output_path, self.run_id, self.started_at, self.lsn_time = output_path, run_id, started_at, lsn_time
        if isinstance(sources, LandedLog):
            self.tables, self.current = list(sources.tables), dict(sources.current)
        else:
            self.tables = [s.table for s in sources]
            self.current = {s.table.capture_instance: s.current for s in sources}
        facts = table_facts(spark, self.tables, origin)
        folders = json_lines.date_columns(started_at, options.partition_by_date)
        for name, value in folders.items():
            facts = facts.withColumn(name, F.lit(value))
        # One row per captured table, listed by the caller: small by construction.
        self.facts = F.broadcast(facts)
        self.levels = ["topic", *folders, "window"]

    def execute(self, bookmark_path: str, ceiling: str | None, low_watermarks: DataFrame | None, mode: str) -> Row:
        options = self.options
        ceiling = ceiling or resume.freeze_ceiling(self.lsn_time)
        base = bookmark_store.newest_version(self.spark, bookmark_path)
        old = bookmark_store.load_bookmarks(self.spark, bookmark_path, base)
        plan = self._plan(old, ceiling, low_watermarks)
        if self._published():
            raise ValueError(f"run {self.run_id} was published before; give a new run id")
        # One row per captured table: may come to the driver, where it turns into scan literals.
        steps = {r["capture_instance"]: r for r in plan.collect()}
        names = [t.capture_instance for t in self.tables]
        absent = sorted(n for n in names if self.current.get(n) is None and steps[n]["take_snapshot"])
        if absent:
            raise MissingRows("a snapshot is due, but there are no current rows of: " + ", ".join(absent))
        self.discard_unpublished()
        files = [f for f in (self._write_snapshots(steps), self._write_changes(steps, plan, ceiling)) if f is not None]
        empty = self.spark.createDataFrame([], _FILES)
        new = resume.merge_bookmarks(old, resume.next_bookmarks(plan))
        row = manifest.write_manifest(
            reduce(DataFrame.unionByName, files, empty),
            new,
            self.output_path,
            self.run_id,
            database_name=self.origin.database,
            max_lsn="0x" + ceiling,
            mode=mode,
            started_at=self.started_at.isoformat(),
            finished_at=datetime.now(timezone.utc).isoformat(),
        ).first()
        if options.commit_bookmarks:
            try:
                bookmark_store.save_bookmarks(new, bookmark_path, base)
            except Exception:
                # The next run would read the same changes again: this one must not stay visible beside it.
                if options.cleanup_failed:
                    self._discard()
                raise
        return row

    def _published(self) -> bool:
        return bool(manifest.read_run(self.spark, self.output_path, self.run_id).head(1))

    def discard_unpublished(self) -> None:
        """SK8: remove what an attempt at this run has left, unless its manifest made it visible."""
        if not self._published():
            self._discard()

    def _discard(self) -> None:
        # The run row goes first: without it nothing of the run is visible.
        remove(self.spark, manifest.run_folder(self.output_path, self.run_id))
        remove(self.spark, manifest.files_folder(self.output_path, self.run_id))
        remove(self.spark, json_lines.run_folder(self.output_path, self.run_id))

    def _plan(self, old: DataFrame, ceiling: str, low_watermarks: DataFrame | None) -> DataFrame:
        """Resume plan, with every refusal before the first write."""
        names = [t.capture_instance for t in self.tables]
        if low_watermarks is None:
            each = F.explode(F.array(*[F.lit(n) for n in names]))
            oldest = self.lsn_time.agg(F.min("start_lsn").alias("min_lsn"))
            low_watermarks = oldest.select(each.alias("capture_instance"), "min_lsn")
        resume.check_low_watermarks(low_watermarks, names)
        known = low_watermarks.where(F.col("capture_instance").isin(names))
        plan = stage(resume.resume_plan(known, old, ceiling, self.options.snapshot_mode), "resume-plan")
        if self.options.strict_gaps:
            resume.require_no_gaps(plan)
        return plan

    def _path(self) -> Column:
        parts = [F.concat(F.lit(f"{n}="), F.col(n)) for n in self.levels]
        return F.concat_ws("/", F.lit(f"events/run_id={self.run_id}"), *parts)

    def _write_snapshots(self, steps: dict[str, Row]) -> DataFrame | None:
        """SK3: full reads of the tables that need one, counted while they are written.

        Flat events are map-only. Full envelopes carry a serial by key (WN5), so their rows are ranged once before that.
        """
        lines, counted = [], {}
        for table in self.tables:
            name = table.capture_instance
            if not steps[name]["take_snapshot"]:
                continue
            rows = self._snapshot_lines(table, steps[name]["min_lsn"])
            counted[name] = Observation(f"snapshot-{self.run_id}-{name}")
            lines.append(rows.observe(counted[name], F.count(F.lit(1)).alias("n")))
        if not lines:
            return None
        union = reduce(DataFrame.unionByName, lines).withColumn("window", F.lit("snapshot"))
        named = union.join(self.facts, "capture_instance")
        json_lines.write_lines(named, self.output_path, self.run_id, self.levels, self.options.compress, ordered=False)
        sizes = [(name, o.get["n"]) for name, o in counted.items()]
        written = self.spark.createDataFrame(sizes, "capture_instance string, records_written bigint")
        return (
            written.where("records_written > 0")
            .join(self.facts, "capture_instance")
            .withColumns({n: F.lit("snapshot") for n in ("window", "from_lsn", "to_lsn")})
            .withColumn("path", self._path())
            .select(*manifest.FILE_FIELDS)
        )

    def _snapshot_lines(self, table: CapturedTable, min_lsn: str) -> DataFrame:
        current = self.current[table.capture_instance]
        if self.options.envelope == "full":
            full = snapshot_envelopes(current, table, self.origin, self.started_at, min_lsn)
            return full.select("capture_instance", "value")
        rows = snapshot_events(current, table, self.started_at, min_lsn)
        text = json_line([*json_columns(rows, table), *[F.col(c) for c in EVENT_FIELDS]])
        return rows.select("capture_instance", text.alias("value"))

    def _pending_rows(self, steps: dict[str, Row], plan: DataFrame, ceiling: str) -> DataFrame:
        """SC1, PF4: what the run reads of all tables, as one DataFrame."""
        open_steps = {n: s["resume_lsn"] for n, s in steps.items() if not s["is_done"]}
        if not isinstance(self.sources, LandedLog):
            todo = [s for s in self.sources if s.table.capture_instance in open_steps]
            ranged = [pending(s, open_steps[s.table.capture_instance], ceiling) for s in todo]
            return landed_all(ranged, before_images=self.options.envelope == "full")
        # The literals reach the scan; the resume position of each table is a row of the plan.
        rows = self.sources.rows.where(F.col("start_lsn").between(min(open_steps.values()), ceiling))
        begins = F.broadcast(plan.where("NOT is_done").select("capture_instance", "resume_lsn"))
        ranged = rows.join(begins, "capture_instance").where("start_lsn >= resume_lsn").drop("resume_lsn")
        with_command = F.col("capture_instance").isin([t.capture_instance for t in self.tables if t.has_command_id])
        if not all(t.has_command_id for t in self.tables):
            ranged = ranged.withColumn("command_id", F.when(with_command, F.col("command_id")))
        return ranged

    def _write_changes(self, steps: dict[str, Row], plan: DataFrame, ceiling: str) -> DataFrame | None:
        """SK1: pending changes of all tables, paired in one job and written by window."""
        options = self.options
        if all(s["is_done"] for s in steps.values()):
            return None
        full = options.envelope == "full"
        rows = self._pending_rows(steps, plan, ceiling)
        sized = windows.sized_plan(rows, options.window_size)  # reads a staged table
        tasks = self.spark.sparkContext.defaultParallelism
        numbered, parts, any_large = windows.file_parts(sized, options.rows_per_file, tasks)
        bounds = windows.window_bounds(numbered, plan.select("capture_instance", "resume_lsn"))
        label = F.concat_ws("_", to_text(F.col("from_lsn")), to_text(F.col("to_lsn")))
        labelled = stage(bounds.withColumn("window", label), "windows")
        # Only the part of the log that the run reads; the literals reach its scan.
        lowest = min(s["resume_lsn"] for s in steps.values() if not s["is_done"])
        log = self.lsn_time.where(F.col("start_lsn").between(lowest, ceiling))
        # Everything known per transaction is gathered first (narrow), so events are joined only once.
        transactions = (
            numbered.join(labelled.select("capture_instance", "window_id", "window"), ["capture_instance", "window_id"])
            .join(commit_times(log), "start_lsn", "left")
            .drop("window_id")
        )
        events = (
            paired_landed(rows, options.strict_pairs, options.group_rows_per_task, before=full)
            .join(transactions, ["capture_instance", "start_lsn"])
            .join(self.facts, "capture_instance")
        )
        lines = event_lines(events, self.origin, self.started_at, options.tombstones, options.key_schemas, full)
        # Staged once: the counts prune it, the write reads it.
        columns = ["capture_instance", "part", "large", *self.levels, *json_lines.LINE_ORDER, "value"]
        staged = stage(lines.select(*columns), "lines")
        target = (self.output_path, self.run_id, self.levels, options.compress)
        json_lines.write_lines(staged.where("NOT large"), *target, parts=parts)
        if any_large:
            # Ranges of these windows alone, which sample their lines.
            json_lines.write_lines(staged.where("large"), *target)
        counts = staged.groupBy("capture_instance", "window").agg(F.count(F.lit(1)).alias("records_written"))
        ranges = labelled.select("capture_instance", "window", "from_lsn", "to_lsn")
        return (
            counts.join(ranges, ["capture_instance", "window"])
            .join(self.facts, "capture_instance")
            .withColumn("path", self._path())
            .withColumns({n: to_text(F.col(n)) for n in ("from_lsn", "to_lsn")})
            .select(*manifest.FILE_FIELDS)
        )
