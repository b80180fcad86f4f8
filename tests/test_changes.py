"""Pairing: the known cases, then random changes against plain Python rules."""

import json
import random
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.pairing_rules import expected_events
from tideline.model import CapturedTable, ColumnInfo, Origin
from tideline.operators import changes, envelope
from tideline.errors import ReservedColumn

SCHEMA = (
    "capture_instance string, start_lsn string, seqval string, command_id int, operation int, id int, name string, email string"
)
CUSTOMERS = CapturedTable(
    "dbo_customers",
    "dbo",
    "customers",
    (
        ColumnInfo("id", "int", nullable=False),
        ColumnInfo("name", "nvarchar", max_length=200),
        ColumnInfo("email", "nvarchar", max_length=200),
    ),
    ("id",),
)
ORIGIN = Origin("server1", "sales")
NOW = datetime(2026, 4, 12, 10, 1, tzinfo=timezone.utc)


def change(spark, lsn, seq, *rows):
    return spark.createDataFrame(
        [("dbo_customers", lsn, seq, None, op, key, "Alice", email) for op, key, email in rows], SCHEMA
    )


def flat(rows, strict=True, **options):
    kept = changes.events(changes.classify(rows, ("id",), **options), strict)
    return envelope.flat_events(kept, CUSTOMERS, ORIGIN, NOW)


def test_update_pair(spark):
    got = flat(change(spark, "0000002700000AC00007", "0000002700000AC00002", (3, 7, "old"), (4, 7, "new"))).collect()
    assert [(e["__op"], e["email"], e["__deleted"], e["__table"]) for e in got] == [("u", "new", "false", "customers")]
    assert got[0]["__source_ts_ms"] == 1775988060000


def test_delete_with_tombstone(spark):
    rows = change(spark, "0000002700000DB00007", "0000002700000DB00005", (1, 7, "old"))
    got = envelope.with_tombstones(flat(rows)).orderBy("serial", "tombstone").collect()
    assert [(e["__op"], e["tombstone"], e["__deleted"]) for e in got] == [("d", False, "true"), ("d", True, "true")]


def test_deferred_update_same_key(spark):
    got = flat(change(spark, "0000002800000AA00003", "0000002800000AA00001", (1, 7, "old"), (2, 7, "new"))).collect()
    assert [(e["__op"], e["email"]) for e in got] == [("u", "new")]


def test_deferred_update_key_moved(spark):
    rows = change(spark, "0000002800000BB00004", "0000002800000BB00002", (1, 7, "old"), (2, 8, "new"))
    got = envelope.with_tombstones(flat(rows)).orderBy("serial", "tombstone").collect()
    assert [(e["__op"], e["id"], e["tombstone"], e["serial"]) for e in got] == [
        ("d", 7, False, 1),
        ("d", 7, True, 1),
        ("c", 8, False, 2),
    ]


def test_no_key_is_always_an_update(spark):
    rows = change(spark, "0" * 20, "0" * 20, (1, 7, "old"), (2, 8, "new"))
    assert [e["__op"] for e in changes.events(changes.classify(rows, ())).collect()] == ["u"]


def test_null_key_values_are_equal(spark):
    same = change(spark, "0" * 20, "0" * 20, (1, None, "old"), (2, None, "new"))
    moved = change(spark, "0" * 20, "1" * 20, (1, None, "old"), (2, 8, "new"))
    got = changes.events(changes.classify(same.unionByName(moved), ("id",))).collect()
    assert sorted((e["seqval"][0], e["__op"]) for e in got) == [("0", "u"), ("1", "c"), ("1", "d")]


def test_key_documents():
    document = envelope.key_schema(CUSTOMERS, ORIGIN)
    assert document == {
        "type": "struct",
        "fields": [{"field": "id", "type": "int32", "optional": False, "parameters": {"sqlserver_type": "int"}}],
        "optional": False,
        "name": "server1.dbo.sales.customers.Key",
        "version": 1,
    }
    keyless = CapturedTable("dbo_log", "dbo", "log", (ColumnInfo("amount", "decimal", None, 18, 4),))
    assert envelope.key_schema(keyless, ORIGIN)["fields"] == [] and envelope.key_schema(keyless, ORIGIN)["optional"]
    assert envelope.field_schema(keyless.columns[0], optional=True)["parameters"] == {
        "sqlserver_type": "decimal",
        "numeric_precision": "18",
        "numeric_scale": "4",
    }


def test_tombstone_lines(spark):
    rows = change(spark, "0" * 20, "0" * 20, (1, 7, "old"))
    bare = envelope.tombstone_line(envelope.key_text(rows, CUSTOMERS))
    wrapped = envelope.tombstone_line(
        envelope.key_text(rows, CUSTOMERS), F.lit(envelope.key_schema_text(CUSTOMERS, ORIGIN))
    )
    keyless = CapturedTable("dbo_log", "dbo", "log", CUSTOMERS.columns)
    got = rows.select(bare, wrapped, envelope.tombstone_line(envelope.key_text(rows, keyless), F.lit("{}"))).first()
    assert json.loads(got[0]) == {"key": {"id": 7}, "value": None}
    assert json.loads(got[1]) == {
        "key": {"schema": envelope.key_schema(CUSTOMERS, ORIGIN), "payload": {"id": 7}},
        "value": None,
    }
    assert json.loads(got[2]) == {"key": None, "value": None}


def test_reserved_column_is_refused(spark):
    rows = change(spark, "0" * 20, "0" * 20, (2, 7, "x")).withColumnRenamed("name", "__op")
    table = CapturedTable.of("dbo_customers", rows, ("id",))
    with pytest.raises(ReservedColumn):
        envelope.flat_events(changes.classify(rows, ("id",)), table, ORIGIN, NOW)


def test_strict_refuses_and_lenient_drops(spark):
    rows = change(spark, "0" * 20, "0" * 20, (3, 7, "x"), (2, 7, "y"))
    with pytest.raises(Exception, match="incomplete update pair"):
        flat(rows).collect()
    assert [e["__op"] for e in flat(rows, strict=False).collect()] == ["c"]
    found = changes.incomplete_pairs(changes.classify(rows, ("id",))).collect()
    assert [(r["operation"], r["email"]) for r in found] == [(3, "x")]


@pytest.mark.parametrize("strict", [True, False])
def test_unknown_operation_fails(spark, strict):
    rows = change(spark, "0" * 20, "0" * 20, (5, 7, "x"))
    with pytest.raises(Exception, match="unsupported operation code 5"):
        flat(rows, strict).collect()
    assert changes.bad_operations(changes.classify(rows, ("id",))).count() == 1


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("beside", [[], [(1, 7, "x")], [(3, 7, "x"), (4, 7, "y")]])
def test_a_missing_operation_fails(spark, strict, beside):
    rows = change(spark, "0" * 20, "0" * 20, (None, 7, "z"), *beside)
    with pytest.raises(Exception, match="unsupported operation code null|incomplete update pair"):
        flat(rows, strict).collect()


def random_changes(seed, groups, sizes):
    rng = random.Random(seed)
    rows = []
    for at in range(groups):
        key = ("t%d" % (at % 2), f"{at // 4:020X}", f"{at % 4:020X}", rng.choice([None, at % 3]))
        pattern = rng.choice([[3, 4], [1, 2], None])
        codes = pattern or [rng.choice([1, 2, 3, 4]) for _ in range(rng.choice(sizes))]
        for op in rng.sample(codes, len(codes)):
            rows.append((*key, op, rng.choice([1, 1, 2, None]), rng.choice(["a", "b", None]), rng.choice(["x", "y"])))
    return rows


@pytest.mark.parametrize("hot_rows", [2_000_000, 2])
def test_random_changes_match_the_rules(spark, hot_rows):
    rows = random_changes(11, 600, [1, 2, 3, 5, 9])
    frame = spark.createDataFrame(rows, SCHEMA.replace("id int,", "id int,", 1))
    kept = changes.events(changes.classify(frame, ("id",), hot_rows=hot_rows), strict=False)
    got = {}
    for e in kept.collect():
        key = (e["capture_instance"], e["start_lsn"], e["seqval"], e["command_key"])
        got.setdefault(key, []).append((e["serial"], e["__op"], e["id"], e["name"], e["email"]))
    groups = {}
    for ci, start, seq, command, op, key, name, email in rows:
        group = (ci, start, seq, -1 if command is None else command)
        groups.setdefault(group, []).append({"operation": op, "id": key, "name": name, "email": email})
    low = lambda v: (v is not None, v if v is not None else 0)
    for group, members in groups.items():
        members.sort(key=lambda r: (r["operation"], low(r["id"])))
        want = expected_events(members, ("id",), False)
        mine = sorted(got.pop(group, []), key=lambda e: e[0])
        # Operation and key decide the order; rows that agree on both may come in any order.
        assert [(s, op, key) for s, op, key, _, _ in mine] == [(s, op, r["id"]) for op, s, r in want]
        assert Counter(e[1:] for e in mine) == Counter((op, r["id"], r["name"], r["email"]) for op, _, r in want)
    assert not got


def test_strict_fails_exactly_for_groups_the_rules_refuse(spark):
    rows = random_changes(12, 200, [1, 2, 3])
    frame = spark.createDataFrame(rows, SCHEMA)
    audit = changes.incomplete_pairs(changes.classify(frame, ("id",)))
    refused = {tuple(r) for r in audit.select("capture_instance", "start_lsn", "seqval", "command_key").collect()}
    groups = {}
    for ci, start, seq, command, op, key, *_ in rows:
        groups.setdefault((ci, start, seq, -1 if command is None else command), []).append({"operation": op, "id": key})
    want = set()
    for group, members in groups.items():
        try:
            expected_events(members, ("id",), True)
        except ValueError:
            want.add(group)
    assert refused == want


def test_one_group_with_most_rows(spark):
    """A transaction with equal copies of one row: everything comes out, numbered, whatever path it takes."""
    rows = [("t", "0" * 20, "0" * 20, 1, 2, 5, "same", "same")] * 3000
    rows += [("t", "0" * 20, "0" * 20, 1, 1, k, "gone", "x") for k in range(500)]
    rows += [("t", "1" * 20, "0" * 20, 1, 3, 9, "b", "x"), ("t", "1" * 20, "0" * 20, 1, 4, 9, "a", "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    usual = changes.events(changes.classify(frame, ("id",)))
    split = changes.events(changes.classify(frame, ("id",), hot_rows=100))
    assert split.count() == 3501
    assert usual.exceptAll(split).count() == 0
    assert sorted(r[0] for r in split.where("start_lsn = '%s'" % ("0" * 20)).select("serial").collect()) == list(range(1, 3501))


def test_one_exchange_pairs_changes(spark, fixtures):
    plan = changes.events(changes.classify(fixtures.ct, ("id",)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 1


def test_known_counts(spark):
    from tideline.sources.fixtures import Fixtures

    f = Fixtures(spark, "/root/testdata/sf0.01")
    assert (f.ct.count(), f.ct_orders.count(), f.lsn_time.count(), f.ct_orphan.count()) == (15000, 24866, 1960, 14968)

    def ops(frame):
        return {r["__op"]: r["count"] for r in frame.groupBy("__op").count().collect()}

    assert ops(changes.events(changes.classify(f.ct, ("id",)))) == {"c": 5000, "u": 4000, "d": 2000}
    assert envelope.with_tombstones(changes.events(changes.classify(f.ct, ("id",)))).count() == 13000
    assert changes.events(changes.classify(f.ct_orphan, ("id",)), strict=False).count() == 10968
    best = changes.classify(f.ct_shared_seq, ("id",), use_command_id=False)
    assert ops(changes.events(best, strict=False)) == {"c": 6000, "d": 3000}
    assert ops(changes.events(changes.classify(f.ct_shared_seq, ("id",)))) == {"c": 5000, "u": 4000, "d": 2000}
    signatures = {r["operations"]: r["n"] for r in changes.change_groups(f.ct).groupBy("operations").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert signatures == {"2x1": 4000, "3x1,4x1": 3000, "1x1,2x1": 2000, "1x1": 1000}
