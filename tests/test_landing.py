"""One log of many tables: plan size, position index, runs over it, full envelopes, file borders."""

import json
import re
from collections import Counter
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_changes import random_changes
from tideline.errors import OrderingNotReady
from tideline.model import Origin
from tideline.operators import changes, windows
from tideline.plans.events import paired_landed, paired_lines
from tideline.plans.incremental import RunOptions, run_incremental
from tideline.sinks import json_lines, manifest
from tideline.sources import landing
from tideline.sources.change_tables import ChangeSource, LandedLog, landed_all

ORIGIN = Origin("server1", "sales", "UTC")
STARTED = datetime(2026, 2, 3, 4, 5, 6, tzinfo=timezone.utc)
HALF = "00000027000000640001"


@pytest.fixture(scope="session")
def log(spark, fixtures, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed"))
    for batch, source in enumerate(fixtures.sources):
        landing.land([source], path, f"b{batch}")
    return path


@pytest.fixture(scope="session")
def commits(fixtures):
    return fixtures.both.select("start_lsn").distinct().join(fixtures.lsn_time, "start_lsn", "left")


def run(spark, source, folder, commits, **more):
    options = RunOptions(**{"window_size": 50, "snapshot_mode": "never", **more.pop("options", {})})
    more.setdefault("run_id", "r")
    return run_incremental(spark, source, ORIGIN, f"{folder}/out", f"{folder}/marks", commits, started_at=STARTED, options=options, **more)


def lines(spark, folder):
    return Counter((r["topic"], r["window"], r["value"]) for r in json_lines.read_complete_lines(spark, f"{folder}/out").collect())


def nodes(frame):
    """Nodes of the physical plan as it is before it runs."""
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    return len(re.findall(r"^[\s:+\-*()0-9]*[A-Z]\w+", plan, re.M))


def many(source, n):
    return [replace(source, table=replace(source.table, capture_instance=f"dbo_{k}")) for k in range(n)]


def of_all(fixtures, tables):
    """A few orders, as change rows of every one of many tables."""
    few = replace(fixtures.sources[1], changes=fixtures.ct_orders.where("id < 40"))
    rows = landed_all([few]).drop("capture_instance")
    return few, rows.select(F.explode(F.lit([t.capture_instance for t in tables])).alias("capture_instance"), "*")


def test_plan_of_a_landed_log_does_not_grow_with_its_tables(spark, fixtures, commits, tmp_path):
    """300 tables and 3 tables: the same number of nodes; the same events as a table on its own; one run writes them."""
    sizes = []
    for n in (3, 300):
        tables = [s.table for s in many(fixtures.sources[1], n)]
        few, rows = of_all(fixtures, tables)
        landing.land_rows(rows, str(tmp_path / f"log{n}"), "0")
        opened = landing.open_log(spark, str(tmp_path / f"log{n}"), tables)
        paired = paired_landed(opened.rows)
        sizes.append(nodes(paired))
        alone = paired_lines([few]).drop("capture_instance")
        mine = paired.where(F.col("capture_instance") == tables[-1].capture_instance).drop("capture_instance")
        assert mine.count() == alone.count() > 0 and mine.exceptAll(alone).count() == 0
    assert sizes[0] == sizes[1]
    result = run(spark, opened, tmp_path, commits)
    assert (result.total_records, result.files_written) == (paired.count(), 300)


def test_separate_tables_share_one_exchange(fixtures):
    for n in (2, 20):
        plan = paired_lines(many(fixtures.sources[1], n))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Window") - plan.count("RunningWindow") <= 2


def test_range_reads_open_only_the_files_that_hold_it(spark, fixtures, tmp_path):
    """Files in any order; the index names those that overlap."""
    path, rows = str(tmp_path), landed_all(fixtures.sources)
    for batch in range(3):
        part = rows.where(F.crc32("seqval") % 3 == batch).repartitionByRange(4, F.reverse("start_lsn") if batch else F.col("start_lsn"))
        landing.land_rows(part, path, str(batch), cluster=False)
    low, high = "00000027000000100001", "00000027000000140001"
    found = landing.read_range(spark, path, low, high)
    index = landing.read_index(spark, path)
    files = {r["file"] for r in index.where((F.col("min_lsn") <= high) & (F.col("max_lsn") >= low)).collect()}
    assert {Path(f).name for f in found.inputFiles()} == {Path(f).name for f in files}
    assert len(files) < index.select("file").distinct().count()
    want = rows.where(F.col("start_lsn").between(low, high))
    assert found.count() == want.count() > 0 and found.exceptAll(want).count() == 0
    assert landing.read_range(spark, path, "F" * 20, "F" * 20).count() == 0
    assert landing.read_range(spark, path, low, high, ["dbo_orders"]).count() == 0


def test_catalogue_reads_no_change_row(spark, fixtures, log):
    found = landing.landed_catalog(spark, log)
    assert all("/index/" in f for f in found.inputFiles()) and found.count() == 2
    marks = {r["capture_instance"]: r["min_lsn"] for r in landing.landed_watermarks(spark, log).collect()}
    assert marks == {r[0]: r[1] for r in fixtures.both.groupBy("capture_instance").agg(F.min("start_lsn")).collect()}
    assert landing.landed_catalog(spark, log + "-none").count() == 0


def test_landing_again_replaces_the_batch(spark, fixtures, tmp_path):
    path = str(tmp_path)
    landing.land(fixtures.sources, path, "1")
    landing.land(fixtures.sources[:1], path, "1")
    assert landing.landed_catalog(spark, path).count() == 1
    assert landing.read_range(spark, path, "0", "F" * 20).count() == fixtures.ct.count()
    landing.land_rows(landed_all(fixtures.sources).where("false"), path, "2")
    assert landing.read_range(spark, path, "0", "F" * 20).count() == fixtures.ct.count()


def test_run_over_a_log_equals_the_run_over_its_tables(spark, fixtures, log, commits, tmp_path):
    opened = landing.open_log(spark, log, [s.table for s in fixtures.sources])
    for name, source in (("log", opened), ("tables", fixtures.sources)):
        run(spark, source, tmp_path / name, commits, run_id="one", ceiling=HALF)
        run(spark, source, tmp_path / name, commits, run_id="two", options={"tombstones": True})
    assert lines(spark, tmp_path / "log") == lines(spark, tmp_path / "tables")
    assert run(spark, opened, tmp_path / "log", commits, run_id="three").total_records == 0


def test_log_without_command_ids_is_refused(spark, fixtures, commits, tmp_path):
    rows = landed_all(fixtures.sources).withColumn("command_id", F.when(F.col("capture_instance") != "dbo_orders", F.col("command_id")))
    bare = LandedLog(tuple(s.table for s in fixtures.sources), rows)
    with pytest.raises(OrderingNotReady, match="dbo_orders"):
        run(spark, bare, tmp_path, commits)
    only = run(spark, bare, tmp_path, commits, options={"include": ("dbo_events",)})
    assert (only.mode, only.total_records) == ("change_table_command_id", 1100)
    with pytest.raises(ValueError, match="envelope"):
        run(spark, bare, tmp_path, commits, options={"envelope": "half"})


def test_two_runs_with_full_envelopes(spark, fixtures, commits, tmp_path):
    """Snapshot and changes as whole envelopes; two runs write what one run writes."""
    current = fixtures.table("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("name"), "value")
    sources = [replace(fixtures.sources[0], current=current)]
    options = {"envelope": "full", "snapshot_mode": "initial", "tombstones": True, "key_schemas": False}
    run(spark, sources, tmp_path / "a", commits, run_id="one", ceiling=HALF, options=options)
    run(spark, sources, tmp_path / "a", commits, run_id="two", options=options)
    run(spark, sources, tmp_path / "b", commits, run_id="all", options=options)
    texts = [Counter({v: n for (_, _, v), n in lines(spark, tmp_path / x).items()}) for x in ("a", "b")]
    assert texts[0] == texts[1]
    found = [json.loads(v) for v in texts[0].elements()]
    events = [x for x in found if "op" in x]
    assert list(events[0]) == ["before", "after", "source", "op", "ts_ms", "ts_us", "ts_ns"]
    assert sum("key" in x for x in found) == sum(x["op"] == "d" for x in events) > 0
    snapshot = [x for x in events if x["op"] == "r"]
    rows = current.orderBy("id").collect()
    assert sorted((int(x["source"]["event_serial_no"]), x["after"]["id"]) for x in snapshot) == [(k + 1, r["id"]) for k, r in enumerate(rows)]
    assert all(x["before"] is None and x["source"]["ts_ms"] is None and x["source"]["commit_lsn"] == "00000027:00000000:0001" for x in snapshot)
    for x in events:
        if x["op"] == "u":
            assert x["before"]["id"] == x["after"]["id"] and x["before"]["value"] == x["after"]["value"] - 1
        if x["op"] == "d":
            assert x["after"] is None and x["before"]["id"] is not None
    assert events[0]["ts_us"] == events[0]["ts_ms"] * 1000 == int(STARTED.timestamp()) * 1_000_000


@pytest.mark.parametrize("rows_per_file", [7, 60, 500_000])
def test_files_of_a_window_follow_the_log(spark, fixtures, commits, tmp_path, rows_per_file):
    """Small files cut windows between transactions, or inside one that is larger than a file; order and lines stay."""
    options = {"window_size": 60, "rows_per_file": rows_per_file, "compress": False}
    result = run(spark, fixtures.sources, tmp_path, commits, options=options)
    base = tmp_path / "out/events/run_id=r"
    total = 0
    paired = paired_lines(fixtures.sources).orderBy("capture_instance", "start_lsn", "command_key", "seqval", "serial")
    expected = {}
    for r in paired.collect():
        expected.setdefault(r["capture_instance"], []).append(json.loads(r["key"])["id"])
    for topic in sorted(base.iterdir()):
        if not topic.name.startswith("topic"):
            continue
        ids = []
        for window in sorted(p for p in topic.iterdir() if p.is_dir()):
            parts = sorted(window.glob("part-*.txt"))
            assert rows_per_file < 60 or rows_per_file == 60 or len(parts) == 1
            for part in parts:
                ids += [json.loads(x)["id"] for x in part.read_text().splitlines()]
        assert ids == expected["dbo_" + topic.name.rsplit(".", 1)[1]]
        total += len(ids)
    assert total == result.total_records


def test_staged_lines_are_read_once(spark, fixtures, commits, tmp_path):
    """The write of a run has no sampling of its input: no range partitioning of lines."""
    sized = windows.sized_plan(fixtures.both, 50)
    placed, parts, large = windows.file_parts(sized, 100, 8)
    rows = placed.collect()
    assert not large and parts >= 8 and {r["part"] for r in rows} <= set(range(parts))
    known = {(r["capture_instance"], r["start_lsn"]): r for r in sized.collect()}
    by_window = {}
    for r in sorted(rows, key=lambda r: (r["capture_instance"], r["start_lsn"])):
        by_window.setdefault((r["capture_instance"], r["window_id"]), []).append((r["part"], known[r["capture_instance"], r["start_lsn"]]["rows"]))
    for entries in by_window.values():
        assert [p for p, _ in entries] == sorted(p for p, _ in entries)
    placed, parts, large = windows.file_parts(sized.where("false"), 100, 8)
    assert (placed.count(), parts, large) == (0, 1, False)


@pytest.mark.parametrize("strict", [True, False])
def test_events_are_counted_as_they_are_paired(spark, strict):
    rows = random_changes(17, 400, [1, 2, 3, 5, 9])
    rows = [r for r in rows if r[4] in (1, 2)] if strict else rows
    frame = spark.createDataFrame(rows, "capture_instance string, start_lsn string, seqval string, command_id int, operation int, id int, name string, email string")
    paired = changes.events(changes.classify(frame, ("id",)), strict).groupBy("capture_instance", "start_lsn").agg(F.count(F.lit(1)).alias("events"))
    counted = changes.event_counts(frame, F.struct("id"), strict=strict).where("events > 0")
    assert counted.count() == paired.count() > 0 and counted.exceptAll(paired).count() == 0
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan


def test_counting_refuses_what_pairing_refuses(spark, fixtures):
    for rows, message in ((fixtures.ct_orphan, "incomplete update pair"), (fixtures.ct_badop, "unsupported operation")):
        with pytest.raises(Exception, match=message):
            changes.event_counts(rows, F.struct("id")).collect()
    assert manifest.read_runs(spark, "/tmp/tideline-none").count() == 0
