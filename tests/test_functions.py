"""Log positions, times and JSON values."""

import base64
import json
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tideline.functions import lsn, times
from tideline.functions.json_values import extend_object, json_columns, json_line
from tideline.model import CapturedTable, ColumnInfo


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column).first()[0]


def test_text_forms_of_a_position(spark):
    raw = bytes.fromhex("0000002700000AC00002")
    frame = spark.createDataFrame([(bytearray(raw),)], "b binary")
    canonical = lsn.from_binary(F.col("b"))
    got = frame.select(lsn.to_text(canonical), lsn.to_colon_text(canonical)).first()
    assert tuple(got) == ("0x0000002700000AC00002", "00000027:00000AC0:0002")


@pytest.mark.parametrize("text", ["0x0000002700000ac00002", "0000002700000AC00002", "0X0000002700000AC00002 "])
def test_parse(spark, text):
    assert one(spark, lsn.parse(F.col("t")), t=text) == "0000002700000AC00002"
    assert bytes(one(spark, lsn.to_binary(F.col("t")), t=text)) == bytes.fromhex("0000002700000AC00002")


@pytest.mark.parametrize("text", ["0x123", "0xZZ"])
def test_parse_refuses(spark, text):
    with pytest.raises(Exception, match="not a hex log position"):
        one(spark, lsn.parse(F.col("t")), t=text)


def test_colon_text_refuses_other_lengths(spark):
    with pytest.raises(Exception, match="10 bytes"):
        one(spark, lsn.to_colon_text(F.col("t")), t="0102")


def test_compare_and_following_agree_with_integers(spark):
    rng = random.Random(7)
    numbers = [rng.randrange(1 << 80) for _ in range(300)]
    numbers += [0xFFFF, 0xFFFFFFFFFFFF, (1 << 80) - 2, 0x7F << 72, 0x80 << 72]
    pairs = [(f"{a:020X}", f"{b:020X}") for a in numbers for b in (rng.choice(numbers), a)]
    frame = spark.createDataFrame(pairs, "a string, b string")
    for a, b, side, after in frame.select("a", "b", lsn.compare(F.col("a"), F.col("b")), lsn.following(F.col("a"))).collect():
        x, y = int(a, 16), int(b, 16)
        assert side == (x > y) - (x < y)
        assert int(after, 16) == x + 1


def test_nothing_follows_the_highest(spark):
    with pytest.raises(Exception, match="follows the highest"):
        one(spark, lsn.following(F.col("t")), t=lsn.HIGHEST)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe"])
def test_epoch_matches_zone_rules(spark, zone):
    rng = random.Random(3)
    moments = [datetime(1970, 1, 2) + timedelta(microseconds=rng.randrange(2_000_000_000_000_000)) for _ in range(400)]
    moments += [datetime(2024, 3, 10, 2, 30, 0, 123456), datetime(2024, 11, 3, 1, 30), datetime(2024, 4, 7, 1, 45)]
    frame = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    wall = F.col("t")
    got = frame.select("t", times.epoch_ms(wall, zone), times.epoch_us(wall, zone), times.epoch_ns(wall, zone)).collect()
    for t, ms, us, ns in got:
        exact = (t.replace(tzinfo=ZoneInfo(zone)) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
        assert (ms, us, ns) == (exact // 1000, exact, exact * 1000)


def test_epoch_before_1970_is_cut_towards_zero(spark):
    frame = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 999_500),)], "t timestamp_ntz")
    assert frame.select(times.epoch_ms(F.col("t"), "UTC")).first()[0] == 0


def test_json_values_of_every_type(spark):
    row = {
        "n": 7,
        "money": Decimal("0.0000001000"),
        "text": "é \"q\"",
        "day": datetime(2024, 2, 3).date(),
        "whole": datetime(2024, 2, 3, 4, 5, 6),
        "part": datetime(2024, 2, 3, 4, 5, 6, 7000),
        "raw": bytearray(range(200)),
        "guid": "ABCDEF00-0000-0000-0000-000000000001",
        "yes": True,
        "gone": None,
    }
    schema = (
        "n int, money decimal(20,10), text string, day date, whole timestamp_ntz, part timestamp_ntz, raw binary, "
        "guid string, yes boolean, gone string"
    )
    frame = spark.createDataFrame([tuple(row.values())], schema)
    table = CapturedTable.of("dbo_x", frame)
    columns = tuple(ColumnInfo("guid", "uniqueidentifier") if c.name == "guid" else c for c in table.columns)
    text = frame.select(json_line(json_columns(frame, CapturedTable("dbo_x", "dbo", "x", columns)))).first()[0]
    assert "é" in text
    assert json.loads(text) == {
        "n": 7,
        "money": "0.0000001000",
        "text": "é \"q\"",
        "day": "2024-02-03",
        "whole": "2024-02-03T04:05:06",
        "part": "2024-02-03T04:05:06.007000",
        "raw": base64.b64encode(bytes(range(200))).decode(),
        "guid": "abcdef00-0000-0000-0000-000000000001",
        "yes": True,
        "gone": None,
    }


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decimals_are_plain_text(spark, ansi):
    values = ["0", "0.0000001", "-0.0000000012", "-12345678.5", "1E-10"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        frame = spark.createDataFrame([(Decimal(v),) for v in values], "d decimal(20,10)")
        got = [json.loads(r[0])["d"] for r in frame.select(json_line(json_columns(frame, CapturedTable.of("t_t", frame)))).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got == [format(Decimal(v).quantize(Decimal("1E-10")), "f") for v in values]


def test_extend_object(spark):
    text = one(spark, extend_object(F.col("a"), F.col("b")), a='{"x":"}"}', b='{"y":1}')
    assert json.loads(text) == {"x": "}", "y": 1}
