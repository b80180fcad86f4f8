"""Bookmarks, raw change rows and path names."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tideline.errors import BookmarkConflict
from tideline.operators import windows
from tideline.operators.resume import resume_plan
from tideline.sinks import paths
from tideline.sources import bookmarks as store
from tideline.sources.change_tables import from_raw


def marks(spark, **values):
    return spark.createDataFrame(list(values.items()), "capture_instance string, lsn string")


def test_absent_store_is_empty(spark, tmp_path):
    assert store.load_bookmarks(spark, str(tmp_path / "none")).count() == 0


def test_newest_complete_version_wins(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert store.save_bookmarks(marks(spark, a="0" * 19 + "1"), path) == 1
    assert store.save_bookmarks(marks(spark, a="0" * 19 + "2", b="0" * 19 + "3"), path) == 2
    broken = spark.createDataFrame([("a", "0x" + "F" * 20, 2)], "capture_instance string, lsn string, entries bigint")
    broken.write.json(path + "/version=3")
    found = {r["capture_instance"]: r["lsn"] for r in store.load_bookmarks(spark, path).collect()}
    assert found == {"a": "0" * 19 + "2", "b": "0" * 19 + "3"}
    assert store.save_bookmarks(marks(spark, a="0" * 19 + "4"), path) == 3
    assert store.load_bookmarks(spark, path).count() == 1


def test_saves_that_overlap_lose_no_mark(spark, tmp_path):
    """Two runs load the same version; the later one keeps what the other saved, or refuses if both moved a table."""
    path, one, two, three = str(tmp_path / "marks"), "0" * 19 + "1", "0" * 19 + "2", "0" * 19 + "3"
    store.save_bookmarks(marks(spark, a=one, b=one), path)
    base = store.newest_version(spark, path)
    assert store.save_bookmarks(marks(spark, a=two, b=one), path, base) == 2
    assert store.save_bookmarks(marks(spark, a=one, b=three, c=one), path, base) == 3
    found = {r["capture_instance"]: r["lsn"] for r in store.load_bookmarks(spark, path).collect()}
    assert found == {"a": two, "b": three, "c": one}
    with pytest.raises(BookmarkConflict, match="a"):
        store.save_bookmarks(marks(spark, a=three), path, base)
    assert store.newest_version(spark, path) == 3


def test_a_claimed_version_is_awaited(spark, tmp_path, monkeypatch):
    path, one, two = str(tmp_path / "marks"), "0" * 19 + "1", "0" * 19 + "2"
    store.save_bookmarks(marks(spark, a=one), path)
    assert store._claimed(spark, path, 2) and not store._claimed(spark, path, 2)
    with pytest.raises(BookmarkConflict, match="_claims/2"):
        store.save_bookmarks(marks(spark, b=one), path, patience=0)
    rows = spark.createDataFrame([("a", "0x" + two, 1)], "capture_instance string, lsn string, entries bigint")
    writer = threading.Timer(1, lambda: rows.coalesce(1).write.json(path + "/version=2"))
    writer.start()
    assert store.save_bookmarks(marks(spark, b=one), path) == 3
    writer.join()
    assert {r["capture_instance"]: r["lsn"] for r in store.load_bookmarks(spark, path).collect()} == {"a": two, "b": one}


def test_window_plan_goes_on(spark, fixtures, tmp_path, monkeypatch):
    """Three runs number what one run numbers; each sorts only positions that are new, and a repetition changes nothing."""
    sorted_rows, plain = [], windows.number_rows
    monkeypatch.setattr(windows, "number_rows", lambda rows, *a, **b: sorted_rows.append(rows.count()) or plain(rows, *a, **b))
    ledger = windows.WindowLedger(spark, str(tmp_path), 40)
    cuts = ["00000027000000640001", "00000028000000640001", "F" * 20, "F" * 20]
    for batch, top in enumerate(cuts):
        for _ in range(1 + batch % 2):
            ledger.extend(fixtures.both.where(F.col("start_lsn") <= top), batch)
    want = windows.window_plan(fixtures.both, 40)
    assert ledger.plan().exceptAll(want).count() == 0 and ledger.plan().count() == want.count()
    total = sorted_rows.pop()
    assert sorted_rows[0] + sorted_rows[1] + sorted_rows[3] == total and sorted_rows[-1] == sorted_rows[-2] == 0


def test_document_round_trip(spark, tmp_path):
    document = {"capture_instances": {"dbo_a": "0x00000028000001A40003", "dbo_b": "0x0000002a000002b50001"}}
    file = tmp_path / "bookmarks.json"
    file.write_text(json.dumps(document, indent=2))
    loaded = store.read_bookmark_document(spark, str(file))
    assert {r["lsn"] for r in loaded.collect()} == {"00000028000001A40003", "0000002A000002B50001"}
    text = store.bookmark_document(loaded).first()["value"]
    assert json.loads(text)["capture_instances"]["dbo_b"] == "0x0000002A000002B50001"


def test_resume_rules(spark):
    low = spark.createDataFrame([(n, "00000027000000100001") for n in "abcd"], "capture_instance string, min_lsn string")
    saved = marks(spark, b="00000027000000200001", c="00000026000000200001", d="00000028000000000001")
    plan = {r["capture_instance"]: r for r in resume_plan(low, saved, "00000027000000300001").collect()}
    assert plan["a"]["resume_lsn"] == "00000027000000100001" and plan["a"]["take_snapshot"]
    assert plan["b"]["resume_lsn"] == "00000027000000200002" and not plan["b"]["has_gap"]
    assert plan["c"]["has_gap"] and plan["c"]["resume_lsn"] == "00000027000000100001"
    assert plan["d"]["is_done"] and plan["d"]["next_lsn"] == "00000028000000000001"
    with pytest.raises(ValueError):
        resume_plan(low, saved, "0" * 20, "sometimes")


def test_raw_rows(spark):
    lsn, seq = bytes.fromhex("0000002700000AC00007"), bytes.fromhex("0000002700000AC00002")
    raw = spark.createDataFrame(
        [(bytearray(lsn), None, bytearray(seq), 2, bytearray(b"\x07"), 1, 7)],
        "`__$start_lsn` binary, `__$end_lsn` binary, `__$seqval` binary, `__$operation` int, `__$update_mask` binary, "
        "`__$command_id` int, id int",
    )
    row = from_raw(raw, "dbo_x").first().asDict()
    assert row == {
        "capture_instance": "dbo_x",
        "start_lsn": "0000002700000AC00007",
        "seqval": "0000002700000AC00002",
        "operation": 2,
        "command_id": 1,
        "id": 7,
    }


def test_join_path(spark):
    parts = [F.lit("/a/b/"), F.lit(""), F.lit("//"), F.lit(None).cast("string"), F.lit("c")]
    assert spark.range(1).select(paths.join_path(*parts)).first()[0] == "a/b/c"
