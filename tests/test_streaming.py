"""Streaming forms: large changes, repeated batches, rows without a commit time, late rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_changes import random_changes
from tideline.operators import changes
from tideline.streaming import incremental, pairing

SCHEMA = (
    "capture_instance string, start_lsn string, seqval string, command_id int, operation int, id int, name string, "
    "email string, commit_time timestamp"
)


def timed_rows(seed, groups, strict_codes):
    """Random changes, one day per transaction."""
    rows = random_changes(seed, groups, [1, 2, 3, 5, 9])
    if strict_codes:
        rows = [r for r in rows if r[4] in (1, 2)]
    return [(*r, datetime(2024, 1, 1) + timedelta(days=int(r[1], 16))) for r in rows]


def land(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def columns(frame):
    return frame.select("capture_instance", "start_lsn", "seqval", "command_key", "serial", "__op", "id", "name", "email")


@pytest.mark.parametrize("strict", [True, False])
def test_stream_pairs_equal_batch_pairs(spark, tmp_path, strict):
    rows = timed_rows(21, 120, strict_codes=strict)
    path = str(tmp_path / "landing")
    for part in range(3):
        land(spark, rows[part::3], path)
    land(spark, [("t0", "F" * 20, "0" * 20, 1, 2, 1, "a", "x", datetime(2025, 1, 1))], path)
    landed = spark.read.schema(SCHEMA).parquet(path)
    stream = incremental.read_change_stream(spark, path, landed.schema, files_per_batch=1)
    sink = pairing.PairingSink(str(tmp_path / "out"), landed, ("id",), strict)
    incremental.run_available(pairing.open_changes(stream, ("id",), "40 days"), sink, str(tmp_path / "check"))
    got = columns(spark.read.parquet(str(tmp_path / "out" / "events")))
    known = spark.createDataFrame(rows, SCHEMA).drop("commit_time")
    want = columns(changes.events(changes.classify(known, ("id",)), strict))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_late_rows_are_dropped_by_the_watermark_and_reported(spark, tmp_path):
    from tideline.operators.resume import late_rows

    def row(number, day):
        return ("t", f"{number:020X}", "0" * 20, 1, 2, number, "a", "x", datetime(2024, 1, 1) + timedelta(days=day))

    path = str(tmp_path / "landing")
    land(spark, [row(1, 0), row(2, 50)], path)
    land(spark, [row(4, 90)], path)
    land(spark, [row(3, 1), row(5, 91)], path)  # Spark drops late rows one batch after the watermark moved
    landed = spark.read.schema(SCHEMA).parquet(path)
    stream = incremental.read_change_stream(spark, path, landed.schema, files_per_batch=1)
    sink = pairing.PairingSink(str(tmp_path / "out"), landed, ("id",))
    incremental.run_available(pairing.open_changes(stream, ("id",), "10 days"), sink, str(tmp_path / "check"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out" / "events")).collect()) == [1, 2]
    marks = spark.createDataFrame([("t", f"{2:020X}")], "capture_instance string, lsn string")
    assert [r["id"] for r in late_rows(landed.where("id = 1"), marks).collect()] == [1]


def test_rows_without_commit_time_take_the_given_one(spark, tmp_path):
    path = str(tmp_path / "landing")
    land(spark, [("t", "0" * 20, "0" * 20, 1, 2, 5, "a", "x", None), ("t", "1" * 20, "0" * 20, 1, 2, 6, "a", "x", datetime(2024, 1, 1))], path)
    land(spark, [("t", "2" * 20, "0" * 20, 1, 2, 7, "a", "x", datetime(2024, 3, 1))], path)
    landed = spark.read.schema(SCHEMA).parquet(path)
    stream = incremental.read_change_stream(spark, path, landed.schema, files_per_batch=1)
    sink = pairing.PairingSink(str(tmp_path / "out"), landed, ("id",))
    changes_open = pairing.open_changes(stream, ("id",), "1 day", no_time="2024-01-01 00:00:00")
    incremental.run_available(changes_open, sink, str(tmp_path / "check"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out" / "events")).collect()) == [5, 6]


def test_transactions_wait_and_repeated_batches_replace(spark, tmp_path):
    schema = SCHEMA.rsplit(",", 1)[0]

    def half(tx, op, name):
        return ("t", f"{tx:020X}", "0" * 20, 1, op, 7, name, "x")

    def frame(*rows):
        return spark.createDataFrame(list(rows), schema)

    sink = incremental.TransactionSink(
        str(tmp_path / "out"), lambda rows: changes.events(changes.classify(rows, ("id",))), incremental.before_newest
    )
    sink(frame(half(1, 3, "a"), half(1, 4, "b"), half(2, 3, "b")), 0)
    second = frame(half(2, 4, "c"), half(3, 1, "c"))
    for _ in range(2):
        sink(second, 1)
    sink.flush(spark, frame(half(1, 2, "")).schema, 1, f"{3:020X}")
    got = sink.events(spark).orderBy("start_lsn").collect()
    assert [(e["__op"], e["name"]) for e in got] == [("u", "b"), ("u", "c"), ("d", "c")]
    assert sink.events(spark).agg(F.countDistinct("batch_id")).first()[0] == 3


def test_second_run_reads_only_new_files(spark, tmp_path):
    path, out = str(tmp_path / "landing"), str(tmp_path / "out")
    rows = [("t", f"{n:020X}", "0" * 20, 1, 2, n, "a", "x", None) for n in range(6)]
    land(spark, rows[:3], path)
    landed = spark.read.schema(SCHEMA).parquet(path)
    ceiling = incremental.up_to("F" * 20)
    for fresh in (None, rows[3:]):
        if fresh:
            land(spark, fresh, path)
        sink = incremental.TransactionSink(out, lambda r: changes.events(changes.classify(r, ("id",))), ceiling)
        stream = incremental.read_change_stream(spark, path, landed.schema)
        incremental.run_available(stream, sink, str(tmp_path / "check"))
    got = spark.read.parquet(out + "/events").select("id", "batch_id").collect()
    assert sorted(map(tuple, got)) == [(n, n // 3) for n in range(6)]


def test_flush_brings_out_every_change_and_lists_late_rows(spark, tmp_path):
    def row(number, day, operation=2, name="a"):
        time = None if day is None else datetime(2024, 1, 1) + timedelta(days=day)
        return ("t", f"{number:020X}", "0" * 20, 1, operation, number, name, "x", time)

    path = str(tmp_path / "landing")
    land(spark, [row(1, 0), row(2, 50), row(6, 1, 1)], path)
    land(spark, [row(4, 90), row(7, None, 3), row(7, None, 4, "b")], path)
    land(spark, [row(3, 1), row(5, 91), row(6, 1, 2)], path)
    landed = spark.read.schema(SCHEMA).parquet(path)
    stream = incremental.read_change_stream(spark, path, landed.schema, files_per_batch=1)
    sink = pairing.PairingSink(str(tmp_path / "out"), landed, ("id",))
    done = incremental.run_available(pairing.open_changes(stream, ("id",), "10 days"), sink, str(tmp_path / "check"))
    for _ in range(2):
        sink.flush(done.lastProgress["batchId"])
    got = spark.read.parquet(str(tmp_path / "out" / "events")).collect()
    assert sorted((r["id"], r["__op"]) for r in got) == [(1, "c"), (2, "c"), (3, "c"), (4, "c"), (5, "c"), (6, "d"), (7, "u")]
    assert sorted((r["id"], r["operation"]) for r in spark.read.parquet(str(tmp_path / "out" / "late")).collect()) == [(6, 1), (6, 2)]


def held_bytes(folder):
    return {p.name: sum(f.stat().st_size for f in p.glob("part-*")) for p in (folder / "segments").iterdir() if p.is_dir()}


def test_open_transaction_is_written_once(spark, tmp_path):
    """A large transaction stays open over 20 batches: its rows lie in one segment, which no later batch writes again."""
    schema = SCHEMA.rsplit(",", 1)[0]
    big = spark.range(20_000).select(
        F.lit("t").alias("capture_instance"), F.lit("F" * 20).alias("start_lsn"), F.format_string("%020X", "id").alias("seqval"),
        F.lit(1).alias("command_id"), F.lit(2).alias("operation"), F.col("id").cast("int"), F.sha2(F.col("id").cast("string"), 256).alias("name"),
        F.lit("x").alias("email"),
    )
    sink = incremental.TransactionSink(
        str(tmp_path / "out"), lambda rows: changes.events(changes.classify(rows, ("id",))), incremental.before_newest, most_segments=4
    )
    sink(big, 0)
    first = held_bytes(tmp_path / "out")["batch_id=0"]
    written = 0
    for batch in range(1, 21):
        one = spark.createDataFrame([("t", f"{batch:020X}", "0" * 20, 1, 2, batch, "a", "x")], schema)
        for _ in range(2 if batch in (3, 20) else 1):
            sink(one, batch)
        written += held_bytes(tmp_path / "out")[f"batch_id={batch}"]
    assert first > 500_000 and written < first / 5
    assert set(held_bytes(tmp_path / "out")) == {"batch_id=0", "batch_id=20"}
    index = sink.open_transactions(spark, 20).collect()
    assert [(r["start_lsn"], r["rows"], r["segments"]) for r in index] == [("F" * 20, 20_000, [0])]
    sink.flush(spark, big.schema, 20, "F" * 20)
    assert sink.events(spark).count() == 20_020 and sink.open_transactions(spark, 21).count() == 0


def test_many_segments_are_gathered(spark, tmp_path):
    """A transaction that grows in every batch is gathered when it lies in too many segments; nothing is lost or doubled."""
    schema = SCHEMA.rsplit(",", 1)[0]
    sink = incremental.TransactionSink(
        str(tmp_path / "out"), lambda rows: changes.events(changes.classify(rows, ("id",))), incremental.before_newest, most_segments=3
    )
    for batch in range(8):
        rows = [("t", "F" * 20, f"{batch:020X}", 1, 2, batch, "a", "x"), ("t", f"{batch:020X}", "0" * 20, 1, 2, 100 + batch, "a", "x")]
        for _ in range(1 + batch % 2):
            sink(spark.createDataFrame(rows, schema), batch)
        assert len(sink.open_transactions(spark, batch).first()["segments"]) <= 3
    sink.flush(spark, spark.createDataFrame([], schema).schema, 7, "F" * 20)
    assert sorted(r["id"] for r in sink.events(spark).collect()) == [*range(8), *range(100, 108)]


def test_watermark_splits_late_rows_off_and_flush_brings_out_the_rest(spark, tmp_path):
    from datetime import timedelta

    from tideline.streaming.watermark import WatermarkSink

    def row(number, day, operation=2, name="a"):
        time = None if day is None else datetime(2024, 1, 1) + timedelta(days=day)
        return ("t", f"{number:020X}", "0" * 20, 1, operation, number, name, "x", time)

    def frame(*rows):
        return spark.createDataFrame(list(rows), SCHEMA)

    pair = lambda rows: changes.events(changes.classify(rows.drop("commit_time"), ("id",)))
    sink = WatermarkSink(str(tmp_path / "out"), pair, timedelta(days=10))
    batches = [
        frame(row(1, 0), row(2, 50), row(6, 1, 1)),
        frame(row(4, 90), row(7, None, 3), row(7, None, 4, "b"), row(8, 48, 1)),
        frame(row(3, 1), row(5, 91), row(6, 1, 2)),
        frame(),
    ]
    for n, batch in enumerate(batches):
        for _ in range(1 + n % 2):
            sink(batch, n)
    assert sorted(r["id"] for r in sink.events(spark).collect()) == [1, 2, 6, 8]
    assert sorted((r["batch_id"], r["id"]) for r in sink.late_rows(spark).collect()) == [(2, 3), (2, 6)]
    assert [tuple(r) for r in sink.late_counts(spark).collect()] == [(2, "t", 2)]
    for _ in range(2):
        sink.flush(spark, batches[0].schema, 3)
    got = sorted((r["id"], r["__op"]) for r in sink.events(spark).collect())
    assert got == [(1, "c"), (2, "c"), (3, "c"), (4, "c"), (5, "c"), (6, "d"), (7, "u"), (8, "d")]
    assert sorted((r["batch_id"], r["id"]) for r in sink.late_rows(spark).collect()) == [(2, 3), (2, 6)]


def test_watermark_sink_without_rows(spark, tmp_path):
    from datetime import timedelta

    from tideline.streaming.watermark import WatermarkSink

    sink = WatermarkSink(str(tmp_path / "out"), lambda rows: changes.events(changes.classify(rows.drop("commit_time"), ("id",))), timedelta(days=1))
    empty = spark.createDataFrame([], SCHEMA)
    sink(empty, 0)
    sink.flush(spark, empty.schema, 0)
    assert sink.events(spark).count() == sink.late_rows(spark).count() == 0


def spread(spark, files):
    """The smallest tables with their events in several tasks."""
    from tests.conftest import SMALL
    from tideline.sources.fixtures import Fixtures

    class Spread(Fixtures):
        def table(self, name):
            found = super().table(name)
            return found.repartition(files) if name == "events" else found

    return Spread(spark, SMALL)


def landed_parts(spark, monkeypatch, run):
    """The files that a stream query lands, and how many rows each has."""
    from tideline.plans import queries

    made = {}
    new_path = queries.new_path
    monkeypatch.setattr(queries, "new_path", lambda s, label: made.setdefault(label, new_path(s, label)))
    result = run(queries)
    rows = spark.read.parquet(made["landing"]).groupBy(F.input_file_name()).count().collect()
    return made, result, [r["count"] for r in rows]


def test_a_part_of_a_watermarked_stream_is_landed_by_many_tasks(spark, monkeypatch):
    f = spread(spark, 6)
    made, _, sizes = landed_parts(spark, monkeypatch, lambda q: q.stream_late_rows(f).count())
    assert len(sizes) > 12 and max(sizes) < sum(sizes) / 8
    marks = spark.read.parquet(f"{made['stream']}/marks")
    assert sorted(r["batch_id"] for r in marks.collect()) == [0, 1, 2, 3]


def test_a_part_of_a_paired_stream_is_landed_by_many_tasks(spark, monkeypatch):
    f = spread(spark, 6)
    _, events, sizes = landed_parts(spark, monkeypatch, lambda q: q.stream_pairs_flushed(f).count())
    assert len(sizes) > 12 and max(sizes) < sum(sizes) / 8
    assert events == changes.events(changes.classify(f.ct, ("id",))).count()


def test_a_part_of_the_log_is_landed_by_many_tasks_and_cut_inside_transactions(spark, monkeypatch):
    f = spread(spark, 6)
    made, events, sizes = landed_parts(spark, monkeypatch, lambda q: q.stream_transactions(f).count())
    assert len(sizes) > 12 and max(sizes) < sum(sizes) / 8
    assert events == changes.events(changes.classify(f.ct, ("id",))).count()
    batches = spark.read.parquet(f"{made['stream']}/events").select("batch_id").distinct().collect()
    assert sorted(r["batch_id"] for r in batches) == [0, 1, 2, 3, 4]  # the last is the flush of the newest transaction
    held = spark.read.parquet(f"{made['stream']}/segments").select("batch_id").distinct().count()
    assert held >= 1
