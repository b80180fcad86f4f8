"""Extents, catalogue, readiness and run reports on small inputs."""

import random

import pytest

from tideline.errors import OrderingNotReady
from tideline.operators import filters, reports
from tideline.operators.extents import lsn_extent
from tideline.operators.windows import next_window_end, run_totals, window_bounds, window_plan


def test_extents_agree_with_plain_minimum(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), f"{rng.choice([rng.randrange(1 << 80), rng.randrange(1 << 20), 0xFF << 72]):020X}") for _ in range(2000)]
    frame = spark.createDataFrame(rows, "k string, start_lsn string")
    found = {r["k"]: (r["min_lsn"], r["max_lsn"], r["n"]) for r in lsn_extent(frame.selectExpr("*", "1L AS one"), ["k"], n=frame["k"].isNotNull().cast("bigint")).collect()}
    for k in "abc":
        mine = [v for key, v in rows if key == k]
        assert found[k] == (min(mine), max(mine), len(mine))


def test_ordering_report_refuses(spark):
    frame = spark.createDataFrame(
        [("a", "0" * 20, 1), ("b", "0" * 20, None)], "capture_instance string, start_lsn string, command_id int"
    )
    report = reports.ordering_report(reports.capture_catalog(frame))
    with pytest.raises(OrderingNotReady, match="b"):
        reports.require_ordering(report)
    reports.require_ordering(report.where("has_command_id"))
    assert reports.extractor_mode(report).first()[0] == "change_table_best_effort"
    assert reports.extractor_mode(report.where("has_command_id")).first()[0] == "change_table_command_id"
    assert reports.extractor_mode(report.where("false")).first()[0] == "change_table_best_effort"


def test_instance_choice(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("c",)], "capture_instance string")

    def chosen(**lists):
        return sorted(r[0] for r in filters.choose_instances(frame, **lists).collect())

    assert chosen() == ["a", "b", "c"]
    assert chosen(include=["a", "b"]) == ["a", "b"]
    assert chosen(include=["a", "b"], exclude=["b"]) == ["a"]
    assert chosen(exclude=["b"]) == ["a", "c"]


def test_windows_of_two_tables(spark):
    lsns = [f"{n:020X}" for n in (0xFFFE, 0xFFFF, 0x10000, 0x10005, 0x20000)]
    rows = [("a", x) for x in lsns for _ in range(3)] + [("b", lsns[0])]
    frame = spark.createDataFrame(rows, "capture_instance string, start_lsn string")
    plan = window_plan(frame, 2)
    assert sorted(map(tuple, plan.collect())) == sorted(
        [("a", x, at // 2) for at, x in enumerate(lsns)] + [("b", lsns[0], 0)]
    )
    starts = spark.createDataFrame([("a", "0" * 20), ("b", "0" * 19 + "1")], "capture_instance string, resume_lsn string")
    bounds = {(r[0], r[1]): tuple(r)[2:] for r in window_bounds(plan, starts).collect()}
    assert bounds == {
        ("a", 0): ("0" * 20, lsns[1], 2),
        ("a", 1): (f"{0x10000:020X}", lsns[3], 2),
        ("a", 2): (f"{0x10006:020X}", lsns[4], 1),
        ("b", 0): ("0" * 19 + "1", lsns[0], 1),
    }
    assert next_window_end(frame.where("capture_instance = 'a'"), lsns[1], lsns[3], 2).first()[0] == lsns[2]
    assert next_window_end(frame, "F" * 20, "F" * 20, 2).first()[0] is None


def test_totals_without_windows(spark):
    counts = spark.createDataFrame([], "capture_instance string, window_id bigint, records bigint")
    assert tuple(run_totals(counts).first()) == (0, 0)


def test_source_report(spark):
    runs = [("a", "success", 2, 10), ("a", "failed", 0, 0), ("b", "success", 1, 5)]
    frame = spark.createDataFrame(runs, "source string, status string, files_written bigint, total_records bigint")
    found = {r["source"]: (r["runs"], r["failed_runs"], r["total_records"], r["status"]) for r in reports.source_report(frame).collect()}
    assert found == {"a": (2, 1, 10, "failed"), "b": (1, 0, 5, "success")}


@pytest.mark.parametrize("hot_rows", [2_000_000, 50])
def test_log_order_with_equal_rows(spark, hot_rows):
    rng = random.Random(9)
    rows = [(f"{rng.randrange(4):020X}", rng.randrange(3), "0" * 20, rng.choice([1, 2]), rng.randrange(2)) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "start_lsn string, command_id int, seqval string, operation int, id int")
    strict = [tuple(r) for r in filters.strict_order(frame, hot_rows).collect()]
    assert sorted(strict) == sorted(rows) and [r[:4] for r in strict] == sorted(r[:4] for r in rows)
    loose = [tuple(r) for r in filters.best_effort_order(frame.drop("command_id"), hot_rows).collect()]
    assert [r[:3] for r in loose] == sorted((r[0], r[2], r[3]) for r in rows)


def test_snapshot_numbers_without_a_key(spark):
    from tideline.model import CapturedTable
    from tideline.operators.snapshot import snapshot_serials

    frame = spark.createDataFrame([("same", 1)] * 500 + [(f"r{n}", n) for n in range(200)], "a string, b int")
    found = snapshot_serials(frame, CapturedTable.of("t_t", frame)).collect()
    assert sorted(r["serial"] for r in found) == list(range(1, 701))
