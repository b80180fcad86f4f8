"""Whole runs: two runs without gap or duplicate, order in files, visibility, refusals."""

import json
import threading
import time
from collections import Counter
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tideline.errors import BookmarkConflict, LogGap, MissingPosition, MissingRows, MissingTable, OrderingNotReady
from tideline.model import CapturedTable, Origin
from tideline.operators.resume import freeze_ceiling
from tideline.plans.events import change_events, paired_lines
from tideline.plans.incremental import RunOptions, pending, run_incremental
from tideline.session import shared_folder, stage, staging
from tideline.sinks import json_lines, manifest
from tideline.sources import bookmarks as store
from tideline.sources.change_tables import ChangeSource

ORIGIN = Origin("server1", "sales", "UTC")
STARTED = datetime(2026, 2, 3, 4, 5, 6, tzinfo=timezone.utc)
QUIET = RunOptions(window_size=50, snapshot_mode="never")


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "marks")


def run(spark, fixtures, folders, sources=None, options=QUIET, **more):
    more.setdefault("started_at", STARTED)
    return run_incremental(
        spark, sources or fixtures.sources, ORIGIN, *folders, lsn_time=more.pop("lsn_time", fixtures.both), options=options, **more
    )


@pytest.fixture(scope="session", autouse=True)
def commit_log(fixtures):
    """The commit log knows every transaction, and the time of most of them."""
    known = fixtures.both.select("start_lsn").distinct()
    fixtures.log = known.join(fixtures.lsn_time, "start_lsn", "left")


def values(spark, path):
    return [json.loads(r["value"]) for r in json_lines.read_complete_lines(spark, path).collect()]


def test_two_runs_leave_no_gap_and_no_duplicate(spark, fixtures, folders):
    half = "00000027000000640001"
    first = run(spark, fixtures, folders, ceiling=half, run_id="one", lsn_time=fixtures.log)
    second = run(spark, fixtures, folders, run_id="two", lsn_time=fixtures.log)
    third = run(spark, fixtures, folders, run_id="three", lsn_time=fixtures.log)
    assert first.max_lsn == "0x" + half and second.max_lsn == "0x" + freeze_ceiling(fixtures.log)
    assert (third.total_records, third.files_written) == (0, 0)
    got = Counter(json.dumps(v, sort_keys=True) for v in values(spark, folders[0]))
    whole = str(Path(folders[0]).parent / "whole")
    run(spark, fixtures, (whole, whole + "-marks"), run_id="all", lsn_time=fixtures.log)
    want = Counter(json.dumps(v, sort_keys=True) for v in values(spark, whole))
    assert got == want
    assert first.total_records + second.total_records == sum(want.values())
    marks = {r["capture_instance"]: r["lsn"] for r in store.load_bookmarks(spark, folders[1]).collect()}
    assert set(marks.values()) == {freeze_ceiling(fixtures.log)}


def test_files_hold_whole_windows_in_log_order(spark, fixtures, folders):
    options = RunOptions(window_size=40, snapshot_mode="never", tombstones=True, compress=False, partition_by_date=True)
    result = run(spark, fixtures, folders, [fixtures.sources[0]], options, run_id="r", lsn_time=fixtures.log)
    base = Path(folders[0]) / "events/run_id=r/topic=server1.sales.dbo.events/year=2026/month=02/day=03"
    windows = sorted(p.name for p in base.iterdir() if p.name.startswith("window="))
    lines = []
    for name in windows:
        for part in sorted((base / name).glob("part-*.txt")):
            lines += [json.loads(x) for x in part.read_text(encoding="utf-8").splitlines()]
    assert len(lines) == result.total_records and len(windows) == result.files_written == 5
    deletes = [at for at, x in enumerate(lines) if x.get("__op") == "d"]
    assert deletes and all(lines[at + 1]["key"]["payload"] == {"id": lines[at]["id"]} for at in deletes)
    schema = lines[deletes[0] + 1]["key"]["schema"]
    assert schema["name"] == "server1.dbo.sales.events.Key"
    assert schema["fields"] == [
        {"field": "id", "type": "int64", "optional": False, "parameters": {"sqlserver_type": "bigint"}}
    ]
    events = [x for x in lines if "__op" in x]
    ordered = change_events(fixtures.ct, fixtures.events_table, ORIGIN, STARTED, fixtures.lsn_time).orderBy(
        "start_lsn", "command_key", "seqval", "serial"
    )
    assert [(e["id"], e["name"], e["value"], e["__op"], e["__source_ts_ms"]) for e in events] == [
        (r["id"], r["name"], r["value"], r["__op"], r["__source_ts_ms"]) for r in ordered.collect()
    ]


def test_manifest_lists_windows_and_bookmarks(spark, fixtures, folders):
    run(spark, fixtures, folders, run_id="r", lsn_time=fixtures.log)
    row = manifest.read_runs(spark, folders[0]).first()
    top = "0x" + freeze_ceiling(fixtures.log)
    assert (row["run_id"], row["mode"], row["max_lsn"]) == ("r", "change_table_command_id", top)
    assert row["committed_bookmarks"] == {"dbo_events": top, "dbo_orders": top}
    files = manifest.read_files(spark, folders[0]).collect()
    assert row["files_path"] == "manifests/files/run_id=r" and {x["run_id"] for x in files} == {"r"}
    assert sum(x["records_written"] for x in files) == row["total_records"]
    assert len(files) == row["files_written"]
    for name in ("dbo_events", "dbo_orders"):
        mine = sorted((x["from_lsn"], x["to_lsn"]) for x in files if x["capture_instance"] == name)
        for (_, end), (start, _) in zip(mine, mine[1:], strict=False):
            assert int(start, 16) == int(end, 16) + 1
    listed = {(x["path"], x["records_written"]) for x in files}
    found = (
        json_lines.read_complete_lines(spark, folders[0]).groupBy("topic", "window").count().collect()
    )
    assert listed == {(f"events/run_id=r/topic={r['topic']}/window={r['window']}", r["count"]) for r in found}


def test_snapshot_comes_with_the_first_run_only(spark, fixtures, folders):
    current = fixtures.table("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("name"), "value")
    nothing = ChangeSource(
        CapturedTable("dbo_orders", "dbo", "orders", fixtures.orders_table.columns, ("id",)),
        fixtures.ct_orders,
        fixtures.ct_orders.select("id", "status", "totalprice").where("false"),
    )
    sources = [ChangeSource(fixtures.events_table, fixtures.ct, current), nothing]
    options = RunOptions(window_size=50)
    first = run(spark, fixtures, folders, sources, options, run_id="one", lsn_time=fixtures.log)
    again = run(spark, fixtures, folders, sources, options, run_id="two", lsn_time=fixtures.log)
    lines = json_lines.read_complete_lines(spark, folders[0]).where("window = 'snapshot'")
    assert lines.count() == current.count()
    assert {json.loads(r["value"])["__op"] for r in lines.limit(50).collect()} == {"r"}
    files = manifest.read_files(spark, folders[0]).where("from_lsn = 'snapshot'").collect()
    assert [(x["capture_instance"], x["records_written"]) for x in files] == [("dbo_events", current.count())]
    assert first.total_records > current.count() and again.total_records == 0


def test_failed_run_stays_invisible_and_keeps_bookmarks(spark, fixtures, folders):
    good = ChangeSource(fixtures.events_table, fixtures.ct)
    run(spark, fixtures, folders, [good], run_id="one", ceiling="00000027000000010001", lsn_time=fixtures.log)
    before = store.load_bookmarks(spark, folders[1]).collect()
    bad = ChangeSource(fixtures.events_table, fixtures.ct_orphan)
    with pytest.raises(Exception, match="incomplete update pair"):
        run(spark, fixtures, folders, [bad], run_id="two", lsn_time=fixtures.log, low_watermarks=spark.sql("SELECT 'dbo_events' AS capture_instance, '00000027000000000001' AS min_lsn"))
    assert {r["run_id"] for r in json_lines.read_complete_lines(spark, folders[0]).collect()} == {"one"}
    assert store.load_bookmarks(spark, folders[1]).collect() == before
    # A half-written run folder without manifest is ignored as well.
    spark.createDataFrame([("t", "w", "{}")], "topic string, window string, value string").write.partitionBy(
        "topic", "window"
    ).text(json_lines.run_folder(folders[0], "crashed"))
    assert {r["run_id"] for r in json_lines.read_complete_lines(spark, folders[0]).collect()} == {"one"}


def test_failed_run_is_cleaned_and_may_be_repeated(spark, fixtures, folders):
    left = Path(json_lines.run_folder(folders[0], "r"))
    frame = spark.createDataFrame([("t", "w", "{}")], "topic string, window string, value string")
    frame.write.partitionBy("topic", "window").text(str(left))
    bad = ChangeSource(fixtures.events_table, fixtures.ct_badop)
    keep = RunOptions(snapshot_mode="never", cleanup_failed=False)
    with pytest.raises(Exception, match="unsupported operation code"):
        run(spark, fixtures, folders, [bad], run_id="r", lsn_time=fixtures.log)
    assert not left.exists()
    frame.write.partitionBy("topic", "window").text(str(left))
    good = ChangeSource(fixtures.events_table, fixtures.ct)
    result = run(spark, fixtures, folders, [good], keep, run_id="r", lsn_time=fixtures.log)
    assert json_lines.read_complete_lines(spark, folders[0]).count() == result.total_records == 1100
    with pytest.raises(ValueError, match="published before"):
        run(spark, fixtures, folders, [good], run_id="r", lsn_time=fixtures.log)
    assert json_lines.read_complete_lines(spark, folders[0]).count() == 1100


def test_failed_bookmark_save_hides_the_run(spark, fixtures, folders, monkeypatch):
    def broken(*_, **__):
        raise OSError("no space")

    with monkeypatch.context() as patched:
        patched.setattr("tideline.sources.bookmarks.save_bookmarks", broken)
        with pytest.raises(OSError):
            run(spark, fixtures, folders, run_id="r", lsn_time=fixtures.log)
    assert json_lines.read_all_lines(spark, folders[0]).count() == 0
    result = run(spark, fixtures, folders, run_id="r2", lsn_time=fixtures.log)
    assert json_lines.read_complete_lines(spark, folders[0]).count() == result.total_records


def test_runs_that_overlap_do_not_both_win(spark, fixtures, folders, monkeypatch):
    """Two runs plan from the same bookmarks: of the same tables one is taken back, of different tables both count."""
    names = ["dbo_events", "dbo_orders"]
    options = [replace(QUIET, include=(n,)) for n in names]
    plain = store.save_bookmarks

    def second_first(rows, path, base):
        with monkeypatch.context() as again:
            again.setattr("tideline.sources.bookmarks.save_bookmarks", plain)
            for n, other in enumerate(others):
                run(spark, fixtures, folders, options=other, run_id=f"inner{n}", lsn_time=fixtures.log)
        return plain(rows, path, base)

    with monkeypatch.context() as patched:
        patched.setattr("tideline.sources.bookmarks.save_bookmarks", second_first)
        others = [options[1]]
        first = run(spark, fixtures, folders, options=options[0], run_id="outer", lsn_time=fixtures.log)
    assert {r["capture_instance"] for r in store.load_bookmarks(spark, folders[1]).collect()} == set(names)
    ids = {r["run_id"] for r in json_lines.read_complete_lines(spark, folders[0]).collect()}
    assert ids == {"outer", "inner0"} and first.total_records == 1100
    other = (folders[0] + "2", folders[1] + "2")
    folders = other
    with monkeypatch.context() as patched:
        patched.setattr("tideline.sources.bookmarks.save_bookmarks", second_first)
        others = [options[0]]
        with pytest.raises(BookmarkConflict, match="dbo_events"):
            run(spark, fixtures, other, options=options[0], run_id="outer", lsn_time=fixtures.log)
    assert {r["run_id"] for r in json_lines.read_complete_lines(spark, other[0]).collect()} == {"inner0"}


def test_run_ids_stay_text_and_prune_the_scan(spark, fixtures, folders):
    result = run(spark, fixtures, folders, run_id="007", lsn_time=fixtures.log)
    lines = json_lines.read_complete_lines(spark, folders[0])
    assert lines.count() == result.total_records and {r["run_id"] for r in lines.select("run_id").collect()} == {"007"}
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan or "PartitionFilters: [(run_id" in plan


def test_repeated_log_rows_change_nothing(spark, fixtures, folders):
    twice = fixtures.log.union(fixtures.log)
    one = run(spark, fixtures, folders, run_id="r", lsn_time=fixtures.log)
    other = (folders[0] + "2", folders[1] + "2")
    assert run(spark, fixtures, other, run_id="r", lsn_time=twice).total_records == one.total_records


def test_a_run_refuses_what_it_would_lose(spark, fixtures, folders):
    plain = fixtures.ct.drop("command_id")
    with pytest.raises(OrderingNotReady):
        run(spark, fixtures, folders, [ChangeSource(fixtures.events_table, plain)], lsn_time=fixtures.log)
    one = spark.sql("SELECT 'dbo_orders' AS capture_instance, '00000001000000010001' AS min_lsn")
    with pytest.raises(MissingPosition, match="dbo_events"):
        run(spark, fixtures, folders, low_watermarks=one, lsn_time=fixtures.log)
    with pytest.raises(MissingRows, match="dbo_events"):
        source = [ChangeSource(fixtures.events_table, fixtures.ct)]
        run(spark, fixtures, folders, source, RunOptions(snapshot_mode="initial"), lsn_time=fixtures.log)
    with pytest.raises(MissingTable):
        run(spark, fixtures, folders, options=RunOptions(include=("dbo_gone",)), lsn_time=fixtures.log)
    assert not Path(folders[0]).exists()


def test_scopes_of_two_threads_do_not_meet(spark):
    opened, ended = threading.Event(), threading.Event()
    kept = []

    def other():
        with staging(spark):
            opened.wait(60)
            kept.append(stage(spark.range(3).toDF("i"), "mine"))
            ended.wait(60)
            kept.append(kept[0].count())

    thread = threading.Thread(target=other)
    thread.start()
    with staging(spark):
        opened.set()
        while not kept:
            time.sleep(0.1)
    ended.set()
    thread.join()
    assert kept[1] == 3


def test_gap_refuses_before_writing_or_restarts(spark, fixtures, folders):
    source = [ChangeSource(fixtures.events_table, fixtures.ct)]
    old = spark.createDataFrame([("dbo_events", "00000001000000010001")], "capture_instance string, lsn string")
    store.save_bookmarks(old, folders[1])
    with pytest.raises(LogGap, match="dbo_events"):
        run(spark, fixtures, folders, source, lsn_time=fixtures.log)
    assert not Path(folders[0]).exists()
    result = run(spark, fixtures, folders, source, RunOptions(snapshot_mode="never", strict_gaps=False), lsn_time=fixtures.log)
    assert result.total_records == 1100 and result.files_written == 1


def test_refusals(spark, fixtures, folders):
    empty = fixtures.log.where("false")
    with pytest.raises(MissingPosition):
        run(spark, fixtures, folders, lsn_time=empty)
    table = CapturedTable.of("dbo_events", fixtures.ct, ("id",), has_command_id=False)
    with pytest.raises(OrderingNotReady):
        run(spark, fixtures, folders, [ChangeSource(table, fixtures.ct)], lsn_time=fixtures.log)
    zero = spark.sql("SELECT 'dbo_events' AS capture_instance, '00000000000000000000' AS min_lsn")
    with pytest.raises(MissingPosition, match="dbo_events"):
        run(spark, fixtures, folders, low_watermarks=zero, lsn_time=fixtures.log)
    assert not Path(folders[0]).exists()


def test_include_exclude_and_missing(spark, fixtures, folders):
    options = RunOptions(snapshot_mode="never", include=("dbo_orders", "dbo_gone"), exclude=("dbo_events", "dbo_never"))
    result = run(spark, fixtures, folders, options=options, lsn_time=fixtures.log)
    assert result.missing_instances == ("dbo_gone", "dbo_never")
    assert {r["topic"] for r in json_lines.read_complete_lines(spark, folders[0]).collect()} == {"server1.sales.dbo.orders"}


def test_best_effort_run(spark, fixtures, folders):
    table = CapturedTable.of("dbo_events", fixtures.ct, ("id",), has_command_id=False)
    options = RunOptions(snapshot_mode="never", allow_best_effort=True, strict_pairs=False, commit_bookmarks=False)
    result = run(spark, fixtures, folders, [ChangeSource(table, fixtures.ct_shared_seq)], options, lsn_time=fixtures.log)
    assert (result.mode, result.total_records, result.bookmarks_committed) == ("change_table_best_effort", 900, False)
    assert store.load_bookmarks(spark, folders[1]).count() == 0


def test_large_transaction_run(spark, fixtures, folders):
    """Small limits send whole transactions down the split path; the lines stay the same."""
    table = CapturedTable.of("dbo_events", fixtures.ct, ("id",), has_command_id=False)
    source = [ChangeSource(table, fixtures.ct_shared_seq)]
    base = dict(snapshot_mode="never", allow_best_effort=True, strict_pairs=False, window_size=50)
    run(spark, fixtures, folders, source, RunOptions(**base), run_id="a", lsn_time=fixtures.log)
    other = (folders[0] + "2", folders[1] + "2")
    run(spark, fixtures, other, source, RunOptions(**base, group_rows_per_task=7), run_id="a", lsn_time=fixtures.log)
    one, two = (json_lines.read_complete_lines(spark, p) for p in (folders[0], other[0]))
    assert one.count() == 900 and one.exceptAll(two).count() == 0


@pytest.mark.parametrize("hot_rows", [2_000_000, 4])
def test_other_tables_change_no_event(spark, fixtures, hot_rows):
    """Many tables in one run give each table what it gives alone, order included."""
    table = CapturedTable.of("dbo_shared", fixtures.ct, ("id",), has_command_id=False)
    shared = ChangeSource(table, fixtures.ct_shared_seq)
    alone = paired_lines([shared], strict=False, hot_rows=hot_rows)
    few = [replace(shared, table=replace(table, capture_instance=f"dbo_{k}")) for k in range(8)]
    among = paired_lines([*fixtures.sources, shared, *few], strict=False, hot_rows=hot_rows)
    mine = among.where("capture_instance = 'dbo_shared'").select(*alone.columns)
    assert alone.count() == mine.count() > 0 and alone.exceptAll(mine).count() == 0


@pytest.mark.parametrize("raw", [False, True])
def test_range_reaches_the_scan(spark, fixtures, tmp_path, raw):
    rows = fixtures.ct
    if raw:
        names = {"start_lsn": "__$start_lsn", "seqval": "__$seqval", "operation": "__$operation", "command_id": "__$command_id"}
        binary = [F.unhex(c).alias(n) if c.endswith(("lsn", "val")) else F.col(c).alias(n) for c, n in names.items()]
        rows = rows.select(*binary, "id", "name", "value")
    path = str(tmp_path / "ct")
    rows.write.parquet(path)
    source = ChangeSource(fixtures.events_table, spark.read.parquet(path))
    lines = paired_lines([pending(source, "00000027000000640001", "00000027000000700001")])
    assert lines.count() == 71
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(" in pushed and "LessThanOrEqual(" in pushed
    assert lines.exceptAll(paired_lines([pending(fixtures.sources[0], "00000027000000640001", "00000027000000700001")])).count() == 0


def test_staged_tables_are_removed(spark, fixtures, folders):
    area = Path(shared_folder(spark).removeprefix("file:")) / "tideline"
    before = set(area.iterdir()) if area.exists() else set()
    run(spark, fixtures, folders, lsn_time=fixtures.log)
    assert set(area.iterdir()) - before == set()


def test_lines_are_listed_once_and_written_without_a_staged_copy(spark, fixtures, monkeypatch):
    from pyspark.sql import DataFrameReader

    from tideline.plans import queries

    calls, staged = [], []
    text, stage = DataFrameReader.text, queries.stage
    monkeypatch.setattr(DataFrameReader, "text", lambda self, *a, **k: calls.append(a) or text(self, *a, **k))
    monkeypatch.setattr(queries, "stage", lambda rows, label: staged.append(label) or stage(rows, label))
    found = queries.events_json(fixtures)
    assert found.count() > 0
    assert len(calls) == 1 and "lines" not in staged


def test_levels_are_read_off_one_file(spark, tmp_path):
    from tideline.session import levels_of_first_file

    assert levels_of_first_file(spark, str(tmp_path / "none")) is None
    (tmp_path / "a=1" / "b=2").mkdir(parents=True)
    assert levels_of_first_file(spark, str(tmp_path)) == []
    (tmp_path / "a=2" / "b=1").mkdir(parents=True)
    (tmp_path / "a=2" / "_SUCCESS").touch()
    (tmp_path / "a=2" / "b=1" / "part-0.txt").touch()
    assert levels_of_first_file(spark, str(tmp_path)) == ["a", "b"]
